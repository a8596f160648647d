"""Deduplication and set operations with a stated order instead of file order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def not_null(df: DataFrame, columns) -> DataFrame:
    """Drop rows with NULL in any of the columns. Written as plain ``IS NOT NULL`` conditions, which
    reach the file scan; ``dropna`` hides them in a function that does not."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def keep_first(df: DataFrame, keys: list[str], order_by: list) -> DataFrame:
    """First row per key. The rank filter is pushed below the shuffle by Spark (a group limit per
    map task), so a hot key sends one row per task and not all its copies."""
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") == 1).drop("_rn")


def keep_latest(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    return keep_first(df, keys, [F.col(c).desc_nulls_last() for c in order_by])


def file_order() -> list[Column]:
    """Order of raw rows as stored: by file, then by position in the file."""
    return [F.col("_metadata.file_path"), F.col("_metadata.row_index")]


def distinct_by(df: DataFrame, keys: list[str], columns: list[str], order_by: list[str]) -> DataFrame:
    """One row per non-NULL key for a dimension. An aggregate, so copies meet map-side first."""
    rest = [c for c in columns if c not in keys]
    kept = not_null(df, keys)
    if not rest:
        return kept.select(*keys).distinct()
    picked = kept.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order_by)).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*columns)


_NARROW = {"boolean", "tinyint", "smallint", "int", "bigint", "date", "timestamp", "timestamp_ntz"}
_HASHED = _NARROW | {"string", "float", "double", "binary"}


def digest(columns: list[str]) -> list[Column]:
    """Two 64-bit numbers that stand for the values of some columns. Which of them are NULL is part of it, as the
    hash functions skip NULLs."""
    absent = [
        reduce(lambda a, b: a.bitwiseOR(b), [F.when(F.col(f"`{c}`").isNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, c in enumerate(columns[at : at + 60])])
        for at in range(0, len(columns), 60)
    ]
    values = [F.col(f"`{c}`") for c in columns]
    return [F.xxhash64(*values, *absent), F.xxhash64(F.lit(0x5EED), *absent, *values)]


def hashable(df: DataFrame, columns) -> bool:
    """May a digest stand for these columns? Not for nested ones, whose inner NULLs the hash functions skip, nor for decimals."""
    return {df.schema[c].dataType.simpleString() for c in columns} <= _HASHED


def _stands_for(df: DataFrame, keys: list[str]) -> list[Column]:
    """What to group by: a few narrow columns as they are, wide or many ones by their 128-bit digest (two
    different keys among 10**12 meet in one with a chance of one in 10**14), nested and decimal ones as they are."""
    narrow = len(keys) <= 2 and {df.schema[k].dataType.simpleString() for k in keys} <= _NARROW
    if narrow or not hashable(df, keys):
        return [F.col(f"`{k}`") for k in keys]
    return [h.alias(f"h{i}") for i, h in enumerate(digest(keys))]


def surplus(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows after the first of each key, NULL equal to NULL: ``total`` and ``dup``. A shuffled row has the same
    size however wide the key is."""
    return df.groupBy(*_stands_for(df, keys)).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("total"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("dup"),
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Fully duplicated rows after the first."""
    return surplus(df, df.columns)


def difference(left: DataFrame, right: DataFrame, left_label: str, right_label: str) -> DataFrame:
    """Rows found on one side only, with the side they come from."""
    return (
        left.exceptAll(right)
        .withColumn("only_in", F.lit(left_label))
        .unionByName(right.exceptAll(left).withColumn("only_in", F.lit(right_label)))
    )


def compare_counts(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Row counts of old and new copies side by side, in one job."""
    parts = None
    for name, (old, new) in pairs.items():
        for side, df in (("old", old), ("new", new)):
            counted = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), F.lit(side).alias("side"), "n")
            parts = counted if parts is None else parts.unionByName(counted)
    return (
        parts.groupBy("table_name")
        .agg(
            F.sum(F.when(F.col("side") == "old", F.col("n"))).alias("old_rows"),
            F.sum(F.when(F.col("side") == "new", F.col("n"))).alias("new_rows"),
        )
        .withColumn("equal", F.col("old_rows") == F.col("new_rows"))
    )
