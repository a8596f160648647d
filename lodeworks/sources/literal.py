"""Small constant tables as part of the query plan."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_table(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """Rows written into the plan as literals: no job, no Python worker, size known from the code."""
    fields = [part.strip().rsplit(" ", 1) for part in schema.split(",")]
    structs = [
        F.struct(*[F.lit(v).cast(kind).alias(name.strip("`")) for v, (name, kind) in zip(row, fields, strict=True)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))
