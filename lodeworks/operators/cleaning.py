"""Cleaning rules per source table, and repairs that change values but drop nothing."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.constants import ASH_RANGES
from lodeworks.functions import clamp, half_up, outside, zfill
from lodeworks.operators.dedup import keep_first, not_null
from lodeworks.operators.joins import attach, flag_member, side_by_side, with_ranges
from lodeworks.operators.quantiles import exact_quantiles


@dataclass(frozen=True)
class CleaningRule:
    """What a cleaned table promises: non-NULL columns, a row filter, a key, normalized columns."""

    required: tuple[str, ...]
    keep: str | None = None
    unique: tuple[str, ...] = ()
    normalize: dict = field(default_factory=dict)


RULES = {
    "vbak": CleaningRule(
        ("NETWR", "ERNAM", "VBELN"), unique=("VBELN",), normalize={"NETWR": lambda c: half_up(c, 2)}
    ),
    "vbap": CleaningRule(("MATNR", "VBELN"), keep="NETWR > 0", unique=("VBELN", "POSNR")),
    "kna1": CleaningRule(("NAME1", "STCD1", "KUNNR"), normalize={"KUNNR": lambda c: zfill(c, 10)}),
    "tags": CleaningRule(("tag", "value"), keep="NOT (status <=> -1) AND value BETWEEN 0 AND 10000"),
    "samples": CleaningRule(("SAMPLE_ID", "AD"), keep="AD >= 0"),
    "doc_flow": CleaningRule(("FLOW_TYPE", "APPLY_DATE")),
}


def clean(df: DataFrame, table: str, order_by: list | None = None) -> DataFrame:
    """Apply the cleaning rule of a table. ``order_by`` says which copy of a key is the first."""
    rule = RULES[table]
    df = not_null(df, rule.required)
    if rule.keep:
        df = df.where(rule.keep)
    if rule.unique:
        if not order_by:
            raise ValueError(f"cleaning {table} drops duplicates: name the order of rows")
        df = keep_first(df, list(rule.unique), order_by)
    return df.withColumns({c: fn(c) for c, fn in rule.normalize.items()}) if rule.normalize else df


def cleaning_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """before / after / dropped / dropped_pct as one row."""
    counts = side_by_side(before.agg(F.count(F.lit(1)).alias("before")), after.agg(F.count(F.lit(1)).alias("after")))
    return counts.select(
        "before",
        "after",
        (F.col("before") - F.col("after")).alias("dropped"),
        F.coalesce(
            half_up(F.try_divide((F.col("before") - F.col("after")) * F.lit(100.0), F.col("before")), 2), F.lit(0.0)
        ).alias("dropped_pct"),
    )


def mark_valid_link(lines: DataFrame, orders: DataFrame, key: str = "VBELN") -> DataFrame:
    """Add ``IS_VALID_LINK``. The order side must be all years, never a filtered part."""
    return flag_member(lines, orders, key, "IS_VALID_LINK")


def clamp_spikes(df: DataFrame, key: str = "tag", value: str = "value", p: float = 0.995) -> DataFrame:
    """Cut values above the exact per-key quantile down to it; keep ``value_original``."""
    limits = exact_quantiles(df, [key], value, {"_upper": p})
    return (
        attach(df, limits, key)
        .withColumn("value_original", F.col(value))
        .withColumn(value, F.when(F.col(value) > F.col("_upper"), F.col("_upper")).otherwise(F.col(value)))
        .drop("_upper")
    )


def clamp_ash(df: DataFrame, ranges: dict = ASH_RANGES, key: str = "SAMPLE_TYPE", value: str = "AD") -> DataFrame:
    """Pull the ash value back into the range of its coal type; ``repaired`` marks changed rows."""
    ranged = with_ranges(df, ranges, key)
    return (
        ranged.withColumn("repaired", outside(value, "lo", "hi"))
        .withColumn(value, clamp(value, F.col("lo"), F.col("hi")))
        .drop("lo", "hi")
        .select(*df.columns, "repaired")
    )
