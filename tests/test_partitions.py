"""Only what a change touches is written again, and a writer that dies loses nothing."""

import datetime
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodeworks.session import work_path
from lodeworks.sources import partitions
from lodeworks.streaming import ingest, io


def _files(path):
    return {str(f.relative_to(path)): (f.stat().st_ino, f.stat().st_mtime_ns) for f in Path(path).rglob("*.parquet")}


def _rows(spark, rows):
    return spark.createDataFrame(rows, "k bigint, seq bigint, v string")


def test_upsert_leaves_other_buckets_alone(spark):
    path = work_path(spark, "buckets")
    partitions.upsert(_rows(spark, [(k, 1, "old") for k in range(500)]), path, ["k"], ["seq"], 16)
    before = _files(path)
    touched = partitions.upsert(_rows(spark, [(7, 1, "a"), (7, 3, "c"), (7, 2, "b"), (900, 1, "new")]), path, ["k"], ["seq"], 16)
    after = _files(path)
    assert 1 <= len(touched) <= 2
    same = {f for f in before if after.get(f) == before[f]}
    assert {f for f in before if f.split("/")[0].split("=")[1] not in touched} == same and len(same) >= 14
    rows = {r.k: (r.seq, r.v) for r in partitions.read_buckets(spark, path).collect()}
    assert rows == {**{k: (1, "old") for k in range(500)}, 7: (3, "c"), 900: (1, "new")}
    with pytest.raises(ValueError, match="bucket_of_16"):
        partitions.upsert(_rows(spark, [(1, 1, "x")]), path, ["k"], ["seq"], 32)


def test_upserts_equal_a_dictionary(spark):
    path, want, rng = work_path(spark, "random"), {}, np.random.default_rng(4)
    for no in range(4):
        batch = [(int(k) if k else None, int(s), f"{no}-{s}") for k, s in zip(rng.integers(0, 60, 80), rng.permutation(80), strict=True)]
        newest = {}
        for k, s, v in batch:
            if k not in newest or s > newest[k][0]:
                newest[k] = (s, v)
        want |= newest
        partitions.upsert(_rows(spark, batch), path, ["k"], ["seq"], 8)
        partitions.upsert(_rows(spark, batch), path, ["k"], ["seq"], 8)  # once more: no change
        assert {r.k: (r.seq, r.v) for r in partitions.read_buckets(spark, path).collect()} == want
    before = _files(path)
    assert partitions.upsert(_rows(spark, []), path, ["k"], ["seq"], 8) == [] and _files(path) == before


def test_a_writer_that_died_is_finished(spark):
    path = work_path(spark, "died")
    partitions.upsert(_rows(spark, [(k, 1, "old") for k in range(50)]), path, ["k"], ["seq"], 4)
    # It had staged bucket 0 in full and deleted the old one.
    staged = spark.read.parquet(path).where("bucket_of_4 = 0").withColumn("v", F.lit("staged"))
    staged.write.partitionBy("bucket_of_4").parquet(f"{path}/_stage")
    partitions._delete(spark, f"{path}/bucket_of_4=0")
    partitions.upsert(_rows(spark, [(1000, 1, "next")]), path, ["k"], ["seq"], 4)
    rows = spark.read.parquet(path).collect()
    assert sorted(r.k for r in rows) == [*range(50), 1000]
    assert {r.v for r in rows if r.bucket_of_4 == 0 and r.k < 50} == {"staged"} and not Path(f"{path}/_stage").exists()
    # A stage without its end mark was not complete: it is dropped.
    _rows(spark, [(5, 9, "half")]).withColumn("bucket_of_4", F.lit(0)).write.partitionBy("bucket_of_4").parquet(f"{path}/_stage")
    Path(f"{path}/_stage/_SUCCESS").unlink()
    partitions.upsert(_rows(spark, [(1001, 1, "next")]), path, ["k"], ["seq"], 4)
    assert sorted(r.k for r in partitions.read_buckets(spark, path).collect()) == [*range(50), 1000, 1001]


def test_stream_of_upserts(spark, tmp_path):
    pdf = pd.DataFrame({"k": [1, 2, 1, 3, 1, 2], "seq": [1, 1, 2, 1, 3, 2], "v": list("abcdef")})
    for i in range(3):
        spark.createDataFrame(pdf.iloc[2 * i : 2 * i + 2]).coalesce(1).write.mode("append").parquet(str(tmp_path / "inc.parquet"))
    path = work_path(spark, "stream")
    ingest.upsert_buckets(io.stream_table(spark, str(tmp_path), "inc", 1), path, ["k"], ["seq"], 8)
    assert {r.k: r.v for r in partitions.read_buckets(spark, path).collect()} == {1: "e", 2: "f", 3: "d"}


def test_refresh_writes_changed_days_only(spark):
    path = work_path(spark, "daily")
    day = [datetime.date(2024, 5, d) for d in range(1, 6)]
    facts = spark.createDataFrame([(d, float(k)) for d in day for k in range(3)], "day date, v double")
    daily = lambda df: df.groupBy("day").agg(F.sum("v").alias("v"), F.count("v").alias("n"))
    partitions.replace(daily(facts), path, "day")
    before = _files(path)
    # One day got a row more, one lost all of its rows, one is new; a day without rows at all is no harm.
    changed = facts.where(F.col("day") != day[1]).unionByName(spark.createDataFrame([(day[2], 10.0), (datetime.date(2024, 6, 1), 1.0)], "day date, v double"))
    days = spark.createDataFrame([(day[1],), (day[2],), (day[2],), (datetime.date(2024, 6, 1),), (datetime.date(2024, 7, 1),), (None,)], "day date")
    assert partitions.refresh(path, changed, days, "day", daily) == ["2024-05-02", "2024-05-03", "2024-06-01", "2024-07-01"]
    rows = {str(r.day): (r.v, r.n) for r in spark.read.parquet(path).collect()}
    assert rows == {"2024-05-01": (3.0, 3), "2024-05-03": (13.0, 4), "2024-05-04": (3.0, 3), "2024-05-05": (3.0, 3), "2024-06-01": (1.0, 1)}
    after = _files(path)
    for d in ("2024-05-01", "2024-05-04", "2024-05-05"):
        assert {f: x for f, x in before.items() if d in f} == {f: x for f, x in after.items() if d in f}
    assert partitions.refresh(path, changed, days.limit(0), "day", daily) == []
