"""Increments into the lake: append, keyed upsert, overwrite."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lodeworks.session import work_path
from lodeworks.sources import partitions
from lodeworks.sources import tables as lake
from lodeworks.sources.files import with_audit
from lodeworks.streaming.io import run_append, run_batches


def append_increments(stream: DataFrame, source_system: str, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Append-type increments with audit columns. The checkpoint remembers what was taken, so a
    second run only takes what is new."""
    return run_append(with_audit(stream, source_system), "increment", path, checkpoint)


def upsert_buckets(stream: DataFrame, path: str, keys: list[str], newest: list[str], buckets: int = 64) -> None:
    """Upsert-type increments into a table filed by key: a batch reads and writes the buckets of its keys only."""
    run_batches(stream, "upsert", lambda batch, _: partitions.upsert(batch, path, keys, newest, buckets))


def upsert_increments(stream: DataFrame, path: str, keys: list[str], newest: list[str]) -> None:
    """Upsert-type increments into a versioned table: each batch is a new version of the whole table, so this is
    for small tables whose history is wanted. Repeating a batch changes nothing."""
    run_batches(stream, "upsert", lambda batch, _: _unless_empty(batch, lambda b: lake.upsert(b, path, keys, newest)))


def overwrite_increments(stream: DataFrame, path: str) -> None:
    """Master data: each delivery replaces the table. A delivery is what one run of the job finds;
    however many batches bring it, they are put aside and committed together."""
    spark = stream.sparkSession
    aside = work_path(spark, "delivery")
    # The batch number in the path makes a repeated batch replace itself.
    run_batches(stream, "overwrite", lambda batch, no: batch.write.mode("overwrite").parquet(f"{aside}/batch={no}"))
    if lake.exists(spark, aside):
        delivery = spark.read.schema(stream.schema).option("recursiveFileLookup", "true").parquet(aside)
        _unless_empty(delivery, lambda rows: lake.commit(rows, path))


def _unless_empty(batch: DataFrame, action) -> None:
    if not batch.isEmpty():
        action(batch)
