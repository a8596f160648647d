"""Versioned tables: Parquet with one folder per snapshot and one small commit file per version.

A snapshot becomes visible when its commit file is created, after its data; a job that dies
half-way leaves a folder nobody reads. Every writer has a folder of its own, which the commit file
names; creating that file fails if another writer took the version first, and changes nothing then.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.operators.dedup import keep_first

LOG_SCHEMA = "snapshot_version bigint, committed_at timestamp, operation string"


def _log_path(path: str) -> str:
    return f"{path}/_commits"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed version numbers, from the names of the commit files."""
    fs, log = _file_system(spark, _log_path(path))
    if not fs.exists(log):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(log)]
    return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))


def latest_version(spark: SparkSession, path: str) -> int:
    """Newest committed version, -1 for a table that does not exist yet."""
    return max(versions(spark, path), default=-1)


def history(spark: SparkSession, path: str) -> DataFrame:
    """Version list, newest first."""
    if not versions(spark, path):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).json(_log_path(path)).orderBy(F.desc("snapshot_version"))


def commit(df: DataFrame, path: str, operation: str = "OVERWRITE", partition_by: list[str] | None = None) -> int:
    """Write a full snapshot as the next version."""
    spark = df.sparkSession
    version = latest_version(spark, path) + 1
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    folder = f"snapshot-{version}-{uuid.uuid4().hex}"
    writer.parquet(f"{path}/{folder}")
    entry = {
        "folder": folder,
        "snapshot_version": version,
        "committed_at": datetime.now(timezone.utc).isoformat(timespec="milliseconds"),
        "operation": operation,
    }
    fs, target = _file_system(spark, f"{_log_path(path)}/{version}.json")
    stream = fs.create(target, False)
    stream.write(bytearray(json.dumps(entry), "utf-8"))
    stream.close()
    return version


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A given version, the newest by default."""
    version = latest_version(spark, path) if version is None else version
    if version < 0:
        raise FileNotFoundError(f"no committed version under {path}")
    log = spark.read.schema("folder string").json(f"{_log_path(path)}/{version}.json")
    return spark.read.parquet(f"{path}/{log.first().folder}")


def read_as_of(spark: SparkSession, path: str, moment: Column) -> DataFrame:
    """The version that was current at a moment."""
    row = history(spark, path).where(F.col("committed_at") <= moment).agg(F.max("snapshot_version").alias("v")).first()
    if row.v is None:
        raise FileNotFoundError(f"no version of {path} at that time")
    return read_version(spark, path, row.v)


def read_table(spark: SparkSession, path: str, fallback: str | None = None) -> DataFrame:
    """Newest snapshot, or the raw files while the table has none."""
    if latest_version(spark, path) >= 0:
        return read_version(spark, path)
    if fallback is None:
        raise FileNotFoundError(path)
    return spark.read.parquet(fallback)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def merged(current: DataFrame, batch: DataFrame, keys: list[str], newest: list[str] | None = None) -> DataFrame:
    """Keyed upsert: rows of the batch replace rows of the table; ``newest`` decides inside a batch."""
    both = current.withColumn("_src", F.lit(0)).unionByName(batch.withColumn("_src", F.lit(1)), allowMissingColumns=True)
    order = [F.desc("_src"), *[F.col(c).desc_nulls_last() for c in (newest or [])]]
    return keep_first(both, keys, order).drop("_src")


def upsert(batch: DataFrame, path: str, keys: list[str], newest: list[str] | None = None) -> int:
    """Merge a batch into the newest snapshot and commit the result as a new one."""
    spark = batch.sparkSession
    if latest_version(spark, path) < 0:
        return commit(keep_first(batch, keys, [F.col(c).desc_nulls_last() for c in (newest or keys)]), path, "UPSERT")
    return commit(merged(read_version(spark, path), batch, keys, newest), path, "UPSERT")


def copy_by_subject(
    tables: dict[str, DataFrame], mapping: dict[str, str], root: str, dry_run: bool = False
) -> DataFrame:
    """Copy system-partitioned tables to their subject paths and report rows written per table."""
    report = None
    for source, df in tables.items():
        target = f"{root}/{mapping[source]}"
        if not dry_run:
            df.write.mode("overwrite").parquet(target)
        written = df.where(F.lit(False)) if dry_run else df.sparkSession.read.parquet(target)
        row = written.agg(F.count(F.lit(1)).alias("written_rows")).select(
            F.lit(source).alias("source"), F.lit(mapping[source]).alias("target"), "written_rows"
        )
        report = row if report is None else report.unionByName(row)
    return report
