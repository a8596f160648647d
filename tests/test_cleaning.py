import numpy as np
import pandas as pd
import pytest

from lodeworks.functions import exact_avg, half_up, mask_text, sensor_of, zfill
from lodeworks.operators import cleaning
from lodeworks.operators.dedup import duplicate_rows, file_order, keep_first, surplus
from lodeworks.operators.joins import flag_member, hot_keys, orphan_counts
from pyspark.sql import functions as F


def test_clean_vbak_keeps_the_first_copy(spark):
    df = spark.createDataFrame(
        [("1", "U", 10.005, 2), ("1", "U", 99.0, 1), ("2", None, 5.0, 3), ("3", "U", None, 4), ("4", "U", 7.0, 5)],
        "VBELN string, ERNAM string, NETWR double, seq int",
    )
    rows = {r.VBELN: r.NETWR for r in cleaning.clean(df, "vbak", ["seq"]).collect()}
    assert rows == {"1": 99.0, "4": 7.0}


def test_clean_needs_an_order_when_it_drops_copies(spark):
    df = spark.createDataFrame([("1", "U", 1.0)], "VBELN string, ERNAM string, NETWR double")
    with pytest.raises(ValueError):
        cleaning.clean(df, "vbak")


def test_clean_tags_keeps_null_status(spark):
    df = spark.createDataFrame(
        [("t", 1.0, None), ("t", 1.0, -1), ("t", -0.5, 0), ("t", 10001.0, 0), ("t", 10000.0, 0)], "tag string, value double, status int"
    )
    assert cleaning.clean(df, "tags").count() == 2


def test_clean_kna1_pads_without_cutting(spark):
    df = spark.createDataFrame([("123", "a", "s"), ("123456789012", "b", "s")], "KUNNR string, NAME1 string, STCD1 string")
    assert {r.KUNNR for r in cleaning.clean(df, "kna1").collect()} == {"0000000123", "123456789012"}


def test_file_order_of_raw_rows(spark, tmp_path):
    pd.DataFrame({"k": [1, 1, 2], "v": ["first", "second", "third"]}).to_parquet(tmp_path / "a.parquet")
    raw = spark.read.parquet(str(tmp_path))
    assert {r.v for r in keep_first(raw, ["k"], file_order()).collect()} == {"first", "third"}


def test_stats(spark):
    before, after = spark.range(200), spark.range(150)
    assert cleaning.cleaning_stats(before, after).first().asDict() == {"before": 200, "after": 150, "dropped": 50, "dropped_pct": 25.0}
    assert cleaning.cleaning_stats(spark.range(0), spark.range(0)).first().dropped_pct == 0.0


def test_surplus_counts_null_as_a_key(spark):
    df = spark.createDataFrame([(None,), (None,), (1,), (2,), (2,)], "k int")
    assert surplus(df, ["k"]).first().asDict() == {"total": 5, "dup": 2}
    assert duplicate_rows(spark.createDataFrame([], "k int")).first().dup == 0


def test_link_flag_with_a_key_that_holds_a_third(spark):
    rng = np.random.default_rng(7)
    keys = np.concatenate([np.full(4000, -1), rng.integers(0, 900, 7900), [500] * 50])
    child = pd.DataFrame({"VBELN": pd.array(keys, dtype="Int64"), "n": range(len(keys))})
    child.loc[:50, "VBELN"] = pd.NA
    parent = pd.DataFrame({"VBELN": [k for k in range(1000) if k % 3]})
    flagged = flag_member(spark.createDataFrame(child), spark.createDataFrame(pd.concat([parent, parent])), "VBELN", "ok").toPandas()
    assert len(flagged) == len(child)
    want = dict(zip(child["n"], child["VBELN"].isin(parent["VBELN"]).fillna(False), strict=True))
    assert dict(zip(flagged["n"], flagged["ok"], strict=True)) == want


def test_orphan_counts(spark):
    child = spark.createDataFrame([(-1,), (-1,), (1,), (9,)], "k int")
    parent = spark.createDataFrame([(1,), (1,)], "k int")
    assert orphan_counts(child, parent, "k").first().asDict() == {"orphan_rows": 3, "orphan_keys": 2}


def test_clamp_spikes_keeps_the_original(spark):
    values = list(np.linspace(0, 1, 1000)) + [50.0]
    df = spark.createDataFrame(pd.DataFrame({"tag": "t", "value": values}))
    fixed = cleaning.clamp_spikes(df).toPandas()
    limit = pd.Series(values).quantile(0.995)
    assert fixed["value"].max() == pytest.approx(limit)
    assert fixed["value_original"].max() == 50.0
    assert (fixed["value"] != fixed["value_original"]).sum() == (np.array(values) > limit).sum()


def test_clamp_ash(spark):
    df = spark.createDataFrame([("原煤", 1200.0), ("原煤", 5.0), ("原煤", 20.0), ("其他", 99.0), ("精煤", None)], "SAMPLE_TYPE string, AD double")
    got = sorted((r.SAMPLE_TYPE, r.AD, r.repaired) for r in cleaning.clamp_ash(df).collect() if r.AD is not None)
    assert got == [("其他", 99.0, False), ("原煤", 10.0, True), ("原煤", 20.0, False), ("原煤", 50.0, True)]


def test_scalars(spark):
    row = spark.range(1).select(
        half_up(F.lit(0.125), 2).alias("a"),
        zfill(F.lit("12"), 5).alias("b"),
        sensor_of(F.lit("M001_FACE_A_CO2")).alias("c"),
        mask_text(F.lit("914100001234"), 4).alias("d"),
        mask_text(F.lit("91"), 4).alias("e"),
    ).first()
    assert tuple(row) == (0.13, "00012", "CO2", "9141********", "91")


def test_readings_keep_their_decimals(spark):
    tags = spark.createDataFrame([("M001_FACE_A_WAGAS", v) for v in (0.0042, 0.0043, 0.0048)], "tag string, value double")
    assert round(tags.agg(exact_avg("value")).first()[0], 4) == 0.0044


def test_a_hot_key_is_dealt_over_several_parts(spark):
    child = spark.range(30_000).selectExpr("id", "if(id % 3 = 0, id, -1) AS k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        flagged = flag_member(child, spark.range(20_000).selectExpr("id AS k"), "k", "known")
        assert "_salt" in flagged._jdf.queryExecution().executedPlan().toString()
        counts = {r.known: r["count"] for r in flagged.groupBy("known").count().collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert counts == {True: 6_667, False: 23_333}


def test_hot_keys_are_found_and_only_they_are_dealt(spark):
    rows = [(-1, i) for i in range(400)] + [(None, i) for i in range(300)] + [(i, i) for i in range(300)] + [(7, i) for i in range(100)]
    child = spark.createDataFrame(rows, "k bigint, _salt int").repartition(5)
    assert hot_keys(child, "k", 0.05) == ([-1, 7], True) and hot_keys(child.limit(0), "k") == ([], False)
    assert hot_keys(child.select(F.array("k").alias("k")), "k") == ([], False)
    parent = spark.createDataFrame([(7,), (7,), (5,), (None,), (299,), (1000,)], "k bigint")
    want = sorted((k or 0, s, k in (5, 7, 299)) for k, s in rows)
    for few in (0, 1_000_000):  # by exchange, by broadcast
        got = flag_member(child, parent, "k", "_hit", broadcast_keys=few)
        assert got.columns == ["k", "_salt", "_hit"] and sorted((r.k or 0, r._salt, r._hit) for r in got.collect()) == want
    plan = flag_member(child, parent, "k", "ok", broadcast_keys=0)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1 and "IN (-1,7)" in plan.replace(" ", "").replace("IN(", "IN (")
    calm = flag_member(spark.range(1000).withColumnRenamed("id", "k"), parent, "k", "ok", broadcast_keys=0)
    assert "Generate" not in calm._jdf.queryExecution().optimizedPlan().toString() and calm.where("ok").count() == 3
