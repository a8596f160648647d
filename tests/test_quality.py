import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodeworks import constants as c
from lodeworks.operators import quality as dq
from lodeworks.operators import rules as rl
from lodeworks.operators.dedup import duplicate_rows, surplus


def _table(spark, schema, rows):
    return spark.createDataFrame(rows, schema)


def test_orders_report_nulls_repeats_and_broken_links(spark):
    # Eight order heads: two lack the time, one the clerk and the amount; rows 1 and 2 are alike, and so are 5, 6, 7.
    heads = [(1.5, "07:10:00", "anna", "c1")] * 2 + [(2.5, None, "bert", "c2"), (None, None, None, "c3")] + [(9.0, "23:59:59", "cleo", None)] * 3 + [(3.0, "00:00:01", "dora", "c4")]
    lines = [(n,) for n in (10, 11, -1, 12, -1, -1, 13, None)]
    clients = [("c1", "x"), ("c1", "x"), ("c1", "y"), (None, "z"), (None, "z")]
    row = dq.check_orders(
        _table(spark, "NETWR double, ERZET string, ERNAM string, KUNNR string", heads), _table(spark, "VBELN int", lines), _table(spark, "KUNNR string, NAME1 string", clients), -1
    ).first()
    assert (row.null_NETWR, row.null_ERZET, row.null_ERNAM, row.null_KUNNR) == (12.5, 25.0, 12.5, 37.5)
    assert (row.dup_vbak, row.dup_kna1, row.invalid_link_pct) == (37.5, 40.0, 37.5)


def test_sensor_report_compares_gas_with_its_own_median(spark):
    # Gas: median 0.25, so 0.75 is not above three times that and 0.80 is; one reading is dangerous.
    gas = [0.20, 0.25, 0.25, 0.25, 0.75, 0.80, 1.40, 0.10]
    rows = [("M7_WAGAS_N", v, -1 if i in (1, 6) else 0) for i, v in enumerate(gas)] + [("M7_DUST", 500.0, s) for s in (0, -1, None, 3)] + [("M7_DUST", None, -1)] * 4
    row = dq.check_sensor(_table(spark, "tag string, value double, status int", rows)).first()
    assert (row.missing_pct, row.wagas_danger_pct, row.wagas_anomaly_pct) == (43.75, 12.5, 25.0)


def test_check_sensor_without_gas_tags(spark):
    df = spark.createDataFrame([("M001_TEMP", 1.0, 0)], "tag string, value double, status int")
    assert dq.check_sensor(df).first().asDict() == {"missing_pct": 0.0, "wagas_danger_pct": 0.0, "wagas_anomaly_pct": 0.0}


def test_lab_report_uses_the_range_of_each_type(spark):
    # Bounds belong to the range; a type without a range has no outliers, and NULL is none.
    rows = [("p", 4.0, 1.0), ("p", 8.0, None), ("p", 8.5, 1.0), ("q", 8.5, 2.0), ("q", 30.0, 2.0), ("q", 30.5, None), ("r", 999.0, None), ("p", None, 0.0), ("p", None, 0.0), ("p", 3.9, 1.0)]
    row = dq.check_lab(_table(spark, "SAMPLE_TYPE string, AD double, VD double", rows), ["AD", "VD", "absent"], {"p": (4.0, 8.0), "q": (8.0, 30.0)}).first().asDict()
    assert row == {"null_AD": 20.0, "null_VD": 30.0, "ad_outlier_pct": 30.0, "dup_pct": 10.0}


def test_flow_report(spark):
    rows = [("leave", "open"), ("leave", "open"), (None, "open"), (None, "open"), (None, None), ("leave", None), ("order", "done"), ("order", "open")]
    row = dq.check_flow(_table(spark, "FLOW_TYPE string, STATUS string", rows)).first()
    assert (row.dup_pct, row.null_FLOW_TYPE, row.null_STATUS) == (25.0, 37.5, 25.0)


def test_composite_weighs_the_dimensions(spark):
    columns = ["completeness", "consistency", "accuracy", "uniqueness"]
    unit = [(name, *[100.0 if c == name else 0.0 for c in columns]) for name in columns] + [("all", 50.0, 50.0, 50.0, 50.0), ("some", 12.34, 56.78, 90.12, 34.56)]
    df = _table(spark, "system string, " + ", ".join(f"{x} double" for x in columns), unit)
    got = {r.system: r.composite for r in dq.composite(df).collect()}
    assert got == {"completeness": 30.0, "consistency": 30.0, "accuracy": 20.0, "uniqueness": 20.0, "all": 50.0, "some": pytest.approx(45.67)}


def test_duplicates_are_told_by_digests(spark):
    # NULL in one column is not NULL in the next, texts do not run together, and both zeros are one.
    rows = [("a", None, 0.0), (None, "a", 0.0), ("a", None, -0.0), ("ab", "c", 1.0), ("a", "bc", 1.0), ("ab", "c", 1.0), (None, None, None), (None, None, None), (None, None, 1.0)]
    df = _table(spark, "x string, y string, `z.z` double", rows)
    assert tuple(duplicate_rows(df).first()) == (9, 3)
    assert "h0" in duplicate_rows(df)._jdf.queryExecution().toString()
    nested = df.select(F.array("x", "y").alias("xy"))
    assert tuple(duplicate_rows(nested).first()) == (9, 4) and tuple(surplus(df.limit(0), ["x", "y"]).first()) == (0, 0)
    rng = np.random.default_rng(1)
    wide = spark.createDataFrame(pd.DataFrame({f"c{k}": rng.integers(0, 2, 3000) for k in range(70)} | {"d": rng.integers(0, 9, 3000)}))
    narrow = wide.select("c0", "c1", "c2", "d")
    for frame in (wide, narrow):
        assert duplicate_rows(frame).first().dup == frame.count() - frame.distinct().count()


def test_several_key_sets_in_one_pass(spark):
    rows = [(1, "a", "x"), (1, "b", "x"), (2, "a", None), (2, "a", None), (None, "a", "x"), (None, None, "x")]
    df = _table(spark, "k int, s string, t string", rows)
    sets = [("k",), ("k", "s"), ("t",), ("k", "s", "t")]
    rules = [rl.Rule(c.UNIQUE, columns) for columns in sets] + [rl.Rule(c.NOT_NULL, ("k",))]
    got = {r.rule_no: (r.unexpected_count, r.unexpected_pct, r.column_name) for r in rl.evaluate(df, rules).collect()}
    for no, columns in enumerate(sets, 1):
        dup = len(rows) - df.select(*columns).distinct().count()
        assert got[no] == (dup, float(f"{dup * 100 / 6:.3f}"), ",".join(columns))
    plan = rl.evaluate(df, rules)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LocalRelation") + plan.count("LogicalRDD") == 2  # row rules, and all key sets
    assert [r.unexpected_count for r in rl.evaluate(df.limit(0), rules).collect()] == [0] * 5


def test_cost_of_a_year(spark):
    # The two figures of the first row are fixed values; the others are worked out by hand.
    alerts = _table(spark, "alert_key string, total_rows bigint, rate_pct double", [("SAP.dup_vbak", 18_105_000, 0.498), ("OA.dup_pct", 1000, 0.0), ("no.such.key", 7, 50.0)])
    rows = {r.alert_key: (r.events_per_year, r.total_yuan) for r in dq.annual_cost(alerts).collect()}
    assert rows["SAP.dup_vbak"] == (90_162, 721_296.0) and rows["no.such.key"][1] is None
    assert rows["OA.dup_pct"][0] == 0


def test_rules_null_fails_a_range_unless_ignored(spark):
    df = spark.createDataFrame([(1.0, "abc"), (None, None), (-1.0, "abcdef")], "v double, s string")
    rules = [rl.Rule(c.BETWEEN, ("v",), 0, None), rl.Rule(c.LENGTH, ("s",), 1, 4), rl.Rule(c.NOT_NULL, ("v",)), rl.Rule(c.UNIQUE, ("v", "s"))]
    strict = [r.unexpected_count for r in rl.evaluate(df, rules).orderBy("rule_no").collect()]
    lax = [r.unexpected_count for r in rl.evaluate(df, rules, ignore_nulls=True).orderBy("rule_no").collect()]
    assert strict == [2, 2, 1, 0] and lax == [1, 1, 1, 0]


def test_a_bad_rule_stops_nothing(spark):
    df = spark.createDataFrame([(1,)], "a int")
    rules = [rl.Rule(c.NOT_NULL, ("a",)), rl.Rule(c.NOT_NULL, ("nope",)), rl.Rule("expect_magic", ("a",))]
    rows = {r.rule_no: (r.success, r.unexpected_count, r.error) for r in rl.evaluate(df, rules).collect()}
    assert rows[1] == (True, 0, None)
    assert rows[2] == (False, -1, "no such column: nope")
    assert rows[3][:2] == (False, -1) and "unknown expectation" in rows[3][2]


def test_only_broken_rules_and_empty_table(spark):
    empty = spark.createDataFrame([], "a int")
    assert [r.unexpected_pct for r in rl.evaluate(empty, [rl.Rule(c.NOT_NULL, ("a",)), rl.Rule(c.UNIQUE, ("a",))]).collect()] == [0.0, 0.0]


def test_grade_scales(spark):
    df = spark.createDataFrame([(95.0,), (90.0,), (85.0,), (80.0,), (70.0,), (69.9,)], "s double")
    rows = df.select(rl.grade(F.col("s"), c.GRADES_SCAN).alias("a"), rl.grade(F.col("s"), c.GRADES_CHECKPOINT).alias("b")).collect()
    assert "".join(r.a for r in rows) == "ABBCCD" and "".join(r.b for r in rows) == "AABBCD"


def test_history_replaces_on_key(spark):
    schema = "run_date string, system string, table_name string, score double"
    old = spark.createDataFrame([("1999-01-02", "s", "a", 10.0), ("1999-01-02", "s", "b", 20.0), ("1999-01-03", "s", "a", 95.0)], schema)
    new = spark.createDataFrame([("1999-01-02", "s", "b", 99.0), ("1999-01-04", "s", "b", 0.0)], schema)
    merged = dq.merge_history(old, new)
    assert sorted((r.run_date, r.table_name, r.score) for r in merged.collect()) == [("1999-01-02", "a", 10.0), ("1999-01-02", "b", 99.0), ("1999-01-03", "a", 95.0), ("1999-01-04", "b", 0.0)]
    assert sorted((r.run_date, r.table_name) for r in dq.alerts_below(merged).collect()) == [("1999-01-02", "a"), ("1999-01-04", "b")]
