"""Queries whose tasks hold a state for nearly every row: their number of tasks follows the rows."""

from collections import Counter

import pytest

from lodeworks.operators import joins
from lodeworks.queries import QUERIES

LINES = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp"


@pytest.fixture()
def given(spark, tmp_path, monkeypatch):
    """400 lines and some odd ones; repeated orders, null keys; ten rows a task."""
    monkeypatch.setattr(joins, "TASK_ROWS", 10)
    ids = spark.range(400).selectExpr(
        "id % 130 AS l_orderkey", "id % 90 AS l_partkey", "id % 7 AS l_suppkey", "1.0D + id % 3 AS l_quantity", "id + 0.25D AS l_extendedprice",
        "0.05D AS l_discount", "0.02D AS l_tax", "substr('ARN', cast(id % 3 AS int) + 1, 1) AS l_returnflag", "timestamp'2024-01-01' + make_interval(0, 0, 0, cast(id % 4 AS int)) AS l_shipdate",
    )
    odd = spark.createDataFrame([(None, None, None, 1.0, None, 0.1, 0.0, "A", None), (1, None, 2, None, 2.0, 0.1, 0.0, "R", None), (1, None, 2, 1.0, 2.0, 0.1, 0.0, None, None)], LINES)
    ids.unionByName(odd).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(k % 125, k % 11) for k in range(130)] + [(None, 5), (7, None)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def test_set_except_edges_tasks_follow_the_rows(spark, given):
    got = QUERIES["set_except_edges"](spark, given)
    assert got.rdd.getNumPartitions() >= 41
    lines = [(r.l_partkey, r.l_suppkey, r.l_returnflag) for r in spark.read.parquet(f"{given}/lineitem.parquet").collect()]
    recorded, declared = ({(p, s) for p, s, f in lines if f not in (None, without)} for without in ("R", "A"))
    want = [(*e, "recorded") for e in recorded - declared] + [(*e, "declared") for e in declared - recorded]
    assert Counter(tuple(r) for r in got.collect()) == Counter(want) and len(want) > 50


def test_sales_by_customer_and_day_tasks_follow_the_rows(spark, given):
    """Both sides of the join are dealt to as many tasks as the lines ask for; agg_monthly_rollup shares the step."""
    for name in ("agg_dwm_sales_daily", "agg_monthly_rollup"):
        assert QUERIES[name](spark, given)._jdf.queryExecution().executedPlan().toString().count(", 41), REPARTITION_BY_NUM") >= 2
    orders = [(r.o_orderkey, r.o_custkey) for r in spark.read.parquet(f"{given}/orders.parquet").collect()]
    groups = {}
    for r in spark.read.parquet(f"{given}/lineitem.parquet").collect():
        for order, customer in orders:
            if order is not None and order == r.l_orderkey:
                key = (customer, r.l_returnflag, r.l_shipdate and f"{r.l_shipdate:%Y-%m-%d}")
                groups.setdefault(key, []).append((order, r.l_quantity, r.l_extendedprice))
    total = lambda values: sum(x for x in values if x is not None) if any(x is not None for x in values) else None
    want = Counter((*k, len({o for o, _, _ in v}), total([q for _, q, _ in v]), total([a for _, _, a in v])) for k, v in groups.items())
    got = QUERIES["agg_dwm_sales_daily"](spark, given).select("customer_id", "coal_type", "dt", "orders", "shipped_t", "amount").collect()
    assert Counter(tuple(r) for r in got) == want and max(r.orders for r in got) > 1
