"""Tables changed in place: only the partitions that a change touches are read and written.

New partitions are first written aside in full (``_stage``), then put over the old ones by dynamic partition
overwrite. A writer that dies while it does so leaves the stage behind, and the next writer finishes from it before it
starts, so no partition is lost. Readers that run during the overwrite may miss partitions that are being replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.operators.dedup import keep_first
from lodeworks.sources.tables import exists, merged


def _stage(path: str) -> str:
    return f"{path}/_stage"


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def folders(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the partition column that have a folder, as text."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []
    return sorted(name.removeprefix(f"{column}=") for name in names if name.startswith(f"{column}="))


def read_partitions(spark: SparkSession, path: str, column: str, values: list[str]) -> DataFrame:
    """The rows of some partitions; no other folder is listed or read."""
    return spark.read.option("basePath", path).parquet(*[f"{path}/{column}={v}" for v in values])


def finish(spark: SparkSession, path: str, column: str) -> None:
    """Carry a complete stage over into the table; drop one that is not."""
    stage = _stage(path)
    if exists(spark, f"{stage}/_SUCCESS") and folders(spark, stage, column):
        staged = spark.read.parquet(stage)
        staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    if exists(spark, stage):
        _delete(spark, stage)


def replace(rows: DataFrame, path: str, column: str) -> list[str]:
    """Overwrite the partitions that the rows have, and say which. A partition's size decides its number of
    files, by adaptive rebalancing."""
    spark = rows.sparkSession
    finish(spark, path, column)
    rows.hint("rebalance", column).write.partitionBy(column).parquet(_stage(path))
    written = folders(spark, _stage(path), column)
    if written:
        finish(spark, path, column)
    else:
        _delete(spark, _stage(path))
    return written


def _bucket_column(spark: SparkSession, path: str, buckets: int) -> str:
    """The name tells the number of buckets, so that no writer can use another."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    names = {s.getPath().getName().split("=")[0] for s in fs.listStatus(place)} if fs.exists(place) else set()
    other = sorted(n for n in names if n.startswith("bucket_of_") and n != f"bucket_of_{buckets}")
    if other:
        raise ValueError(f"{path} is kept as {other[0]}, not as bucket_of_{buckets}")
    return f"bucket_of_{buckets}"


def upsert(batch: DataFrame, path: str, keys: list[str], newest: list[str] | None = None, buckets: int = 64) -> list[str]:
    """Rows of the batch replace rows of equal keys; inside the batch ``newest`` decides. Returns the buckets written.

    A row is filed by the hash of its key. Only buckets that the batch has rows for are read, merged and
    overwritten. Repeating a batch changes nothing.
    """
    spark = batch.sparkSession
    column = _bucket_column(spark, path, buckets)
    finish(spark, path, column)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    touched = {str(r.b) for r in batch.select(bucket.alias("b")).distinct().collect()}  # at most ``buckets`` numbers
    known = sorted(touched & set(folders(spark, path, column)))
    if known:
        fresh = merged(read_partitions(spark, path, column, known).drop(column), batch, keys, newest)
    else:
        fresh = keep_first(batch, keys, [F.col(c).desc_nulls_last() for c in (newest or keys)])
    return replace(fresh.withColumn(column, bucket), path, column) if touched else []


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    table = spark.read.parquet(path)
    return table.drop(*[c for c in table.columns if c.startswith("bucket_of_")])


def refresh(path: str, facts: DataFrame, changed: DataFrame, day: str, aggregate: Callable[[DataFrame], DataFrame]) -> list[str]:
    """Recompute the days that changed and overwrite their partitions alone; says which days those are.

    The days are a list of calendar days, so the facts are filtered by constants, which prune partitions
    and row groups. A changed day that has no facts any more loses its partition.
    """
    spark = facts.sparkSession
    finish(spark, path, day)
    days = sorted(r.d for r in changed.select(F.col(day).alias("d")).distinct().collect() if r.d is not None)
    if not days:
        return []
    written = replace(aggregate(facts.where(F.col(day).isin(days))), path, day)
    for gone in sorted({str(d) for d in days} - set(written)):
        _delete(spark, f"{path}/{day}={gone}")
    return [str(d) for d in days]
