"""Grouped reports over facts and series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodeworks.functions import half_up
from lodeworks.operators.joins import attach, with_total
from lodeworks.operators.quantiles import exact_quantiles


def value_counts(df: DataFrame, column: str, k: int | None = None) -> DataFrame:
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    if k is None:
        return counted
    return counted.orderBy(F.desc("n"), F.asc_nulls_last(column)).limit(k)


def describe(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """count, mean, std, min, quartiles, max per group; the quartiles are exact and skew-proof."""
    quartiles = exact_quantiles(df, keys, value, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    basics = df.groupBy(*keys).agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    return basics.join(quartiles, keys, "left")


def shared_owner(df: DataFrame, key: str, owner: str) -> DataFrame:
    """Values of ``key`` held by more than one distinct ``owner``."""
    return df.groupBy(key).agg(F.countDistinct(owner).alias("owners")).where(F.col("owners") > 1)


def top_share(df: DataFrame, key: str, measure: Column, k: int = 10) -> DataFrame:
    """The k largest groups with their share and running share of the grand total."""
    grouped = df.groupBy(key).agg(measure.alias("amount"))
    top = with_total(grouped, F.sum("amount"), "_total").orderBy(F.desc("amount"), key).limit(k)
    running = Window.orderBy(F.desc("amount"), key).rowsBetween(Window.unboundedPreceding, 0)
    return top.select(
        key,
        "amount",
        half_up(F.col("amount") * 100.0 / F.col("_total"), 2).alias("share_pct"),
        half_up(F.sum("amount").over(running) * 100.0 / F.col("_total"), 2).alias("running_pct"),
    )


def group_spikes(df: DataFrame, key: str, value: str, multiple: float = 3.0) -> DataFrame:
    """Per group: rows above a multiple of that group's own median."""
    medians = exact_quantiles(df, [key], value, {"median": 0.5})
    return (
        attach(df, medians, key)
        .groupBy(key)
        .agg(
            F.count_if(F.col(value) > F.col("median") * F.lit(multiple)).alias("spikes"),
            F.count(F.lit(1)).alias("readings"),
        )
    )


def truncated(df: DataFrame, order_by: list, max_rows: int = 100) -> DataFrame:
    """First rows of a result, each saying whether there were more. One distributed top-k of one row
    more than asked for; the windows see those few rows only."""
    top = df.orderBy(*order_by).limit(max_rows + 1)
    total = F.count(F.lit(1)).over(Window.partitionBy(F.lit(1)))
    place = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order_by))
    marked = top.select("*", (total > max_rows).alias("truncated"), place.alias("_place"))
    return marked.where(F.col("_place") <= max_rows).drop("_place")


def refresh_days(existing: DataFrame, facts: DataFrame, changed_days: DataFrame, day: str, aggregate) -> DataFrame:
    """Recompute only the days that changed and keep the other rows as they are."""
    days = changed_days.select(day).distinct()  # at most one row per calendar day
    fresh = aggregate(facts.join(days, day, "left_semi"))
    return existing.join(days, day, "left_anti").unionByName(fresh)
