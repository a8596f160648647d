import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodeworks.operators import catalog, lineage
from lodeworks.operators.aggregates import refresh_days, truncated
from lodeworks.plans import layers, marts
from lodeworks.session import work_path
from lodeworks.sources import files
from lodeworks.sources import tables as lake


def test_versions(spark):
    path = work_path(spark, "t")
    assert lake.latest_version(spark, path) == -1 and lake.history(spark, path).count() == 0
    with pytest.raises(FileNotFoundError):
        lake.read_version(spark, path)
    assert lake.commit(spark.range(3), path) == 0
    assert lake.upsert(spark.range(2, 5), path, ["id"]) == 1
    assert lake.read_version(spark, path).count() == 5
    assert lake.read_version(spark, path, 0).count() == 3
    assert [r.operation for r in lake.history(spark, path).collect()] == ["UPSERT", "OVERWRITE"]
    with pytest.raises(FileNotFoundError):
        lake.read_as_of(spark, path, F.lit("1999-01-01").cast("timestamp"))


def test_uncommitted_snapshot_is_invisible(spark):
    path = work_path(spark, "t")
    lake.commit(spark.range(3), path)
    spark.range(99).write.parquet(f"{path}/snapshot-1-abandoned")
    assert lake.read_version(spark, path).count() == 3
    assert lake.commit(spark.range(4), path) == 1
    assert lake.read_version(spark, path).count() == 4


def test_upsert_inside_a_batch_takes_the_newest(spark):
    current = spark.createDataFrame([(1, 10, "old"), (2, 10, "old")], "k int, seq int, v string")
    batch = spark.createDataFrame([(1, 1, "late"), (1, 2, "newest"), (3, 1, "new")], "k int, seq int, v string")
    assert {r.k: r.v for r in lake.merged(current, batch, ["k"], ["seq"]).collect()} == {1: "newest", 2: "old", 3: "new"}


def test_drifting_columns(spark):
    old = spark.createDataFrame([(1,)], "a int")
    new = spark.createDataFrame([(2, "x")], "a int, IHREZ string")
    assert [tuple(r) for r in files.concat_years([old, new]).orderBy("a").collect()] == [(1, None), (2, "x")]


def test_partition_values_in_file_names(spark, tmp_path):
    pd.DataFrame({"v": [1, 2]}).to_parquet(tmp_path / "tags_year=2023_month=06.parquet")
    pd.DataFrame({"v": [3]}).to_parquet(tmp_path / "kna1.parquet")
    rows = files.with_name_partitions(spark.read.parquet(str(tmp_path / "*.parquet"))).orderBy("v").collect()
    assert [(r.v, r.year, r.month) for r in rows] == [(1, 2023, 6), (2, 2023, 6), (3, None, None)]
    parts = {r.table_name: r for r in catalog.partitions(spark, [str(tmp_path)]).collect()}
    assert parts["tags"].row_count == 2 and parts["tags"].partition_value == "2023/06" and parts["tags"].partition_field == "year/month" and parts["kna1"].partition_field == ""


def test_layers_skip_absent_sources(spark):
    root = work_path(spark, "lake")
    flow = spark.createDataFrame([("f", "审批", "2022-01-01"), ("g", None, "2022-01-01")], "FLOW_ID string, FLOW_TYPE string, APPLY_DATE string")
    layers.ingest_ods(root, {"oa/doc_flow": flow})
    layers.build_dwd(spark, root, {})
    assert [tuple(r) for r in layers.stats(spark, root).collect()] == [("finance/dwd_doc_flow", 2, 1, 1)]


def test_wide_table_grain_and_money(spark):
    orders = spark.createDataFrame([(1, "2022-01-01", "7", 100.0, "D001"), (2, "2022-01-02", None, 50.0, "D009")], "VBELN int, ERDAT string, KUNNR string, NETWR double, BZIRK string")
    customers = spark.createDataFrame([("0000000007", "Seven")], "KUNNR string, NAME1 string")
    tags = spark.createDataFrame([("M001", "A", 1.0), ("M001", "A", 3.0), ("M001", "B", 5.0)], "mine string, face string, value double")
    samples = spark.createDataFrame([("M001", 10.0, 20.0)], "MINE_CODE string, AD double, QGR_AD double")
    wide = marts.sales_production(orders, customers, tags, samples)
    rows = sorted((r.VBELN, r.customer_name, r.face, r.daily_production, r.first_face) for r in wide.fillna("-", ["face", "customer_name"]).collect())
    assert rows == [(1, "Seven", "A", 2.0, True), (1, "Seven", "B", 5.0, False), (2, "-", "-", None, True)]
    row = marts.fulfillment(wide).first()
    assert (row.order_count, row.total_amount, row.order_amount) == (1, 200.0, 100.0)
    filled = marts.fill_defaults(wide).where("VBELN = 2").first()
    assert (filled.customer_name, filled.daily_production) == ("", 0.0)


def test_refresh_keeps_untouched_days(spark):
    facts = spark.createDataFrame([("d1", 1), ("d2", 2), ("d2", 3)], "day string, v int")
    stale = spark.createDataFrame([("d1", 999), ("d2", 0)], "day string, v bigint")
    fresh = refresh_days(stale, facts, spark.createDataFrame([("d2",)], "day string"), "day", lambda d: d.groupBy("day").agg(F.sum("v").alias("v")))
    assert {r.day: r.v for r in fresh.collect()} == {"d1": 999, "d2": 5}


def test_truncation_flag(spark):
    assert truncated(spark.range(5), ["id"], 5).first().truncated is False
    assert truncated(spark.range(6), ["id"], 5).first().truncated is True


def _edges(spark, pairs):
    return spark.createDataFrame(pairs, "src string, dst string")


def test_blast_radius_is_topological(spark):
    # d hangs on a directly and through b -> c: the long way decides.
    edges = _edges(spark, [("a", "b"), ("b", "c"), ("c", "d"), ("a", "d"), ("x", "d")])
    assert [(r.node, r.depth) for r in lineage.blast_radius(edges, "a").collect()] == [("b", 1), ("c", 2), ("d", 3)]
    assert [r.node for r in lineage.ancestors(edges, "d").collect()] == ["a", "b", "c", "x"]
    assert lineage.blast_radius(edges, "d").count() == 0
    assert [r.node for r in lineage.upstream(edges, "d").collect()] == ["a", "c", "x"]


def test_a_cycle_is_refused(spark):
    with pytest.raises(ValueError, match="cycle"):
        lineage.reach(_edges(spark, [("a", "b"), ("b", "a")]), "a")


def test_transform_summary(spark):
    rows = [("t", "AVG(x)"), ("t", "SUM(y)"), ("u", "直接映射"), ("u", None), ("v", "foo"), ("w", "count(*)"), ("w", "ROUND(AVG(x), 2)"), ("w", "MAX(z)")]
    got = {r.dst: r.summary for r in lineage.summarize_transforms(spark.createDataFrame(rows, "dst string, transform string")).collect()}
    assert got == {"t": "AVG聚合+SUM累加", "u": "直接映射", "v": "ETL加工", "w": "AVG聚合+COUNT计数+等4类"}


def test_layer_order(spark):
    nodes = spark.createDataFrame([("dwa.x",), ("zzz.y",), ("sap_erp.v",), ("dwd.a",)], "node string")
    assert [r.node for r in lineage.by_layer(nodes).collect()] == ["sap_erp.v", "dwd.a", "dwa.x", "zzz.y"]


def test_a_refused_writer_changes_nothing(spark, monkeypatch):
    path = work_path(spark, "raced")
    assert lake.commit(spark.range(3), path) == 0
    # Both writers saw no version; the second finds the commit file taken.
    monkeypatch.setattr(lake, "latest_version", lambda *_: -1)
    with pytest.raises(Exception, match="exist"):
        lake.commit(spark.range(100, 200), path)
    monkeypatch.undo()
    assert sorted(r.id for r in lake.read_version(spark, path).collect()) == [0, 1, 2]


def test_a_chain_of_seventy_edges(spark):
    got = lineage.blast_radius(_edges(spark, [(f"n{i:02d}", f"n{i + 1:02d}") for i in range(70)]), "n00").collect()
    assert len(got) == 70 and got[-1].depth == 70


def test_catalog_sees_a_directory_as_one_table(spark, tmp_path):
    spark.range(10).repartition(3).write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(8).selectExpr("id", "2023 AS year", "id % 2 AS month").write.partitionBy("year", "month").parquet(str(tmp_path / "tags"))
    files = catalog.partitions(spark, [str(tmp_path / "orders.parquet"), str(tmp_path / "tags")])
    sizes = {r.table_name: r for r in catalog.table_sizes(files).collect()}
    assert sizes["orders"].row_count == 10 and sizes["tags"].row_count == 8 and sizes["tags"].partition_field == "year/month"
