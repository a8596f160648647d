"""Exact quantiles per group without holding a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodeworks.operators.joins import attach

STEPS_PER_OCTAVE = 64
SUB_SLICES = 65_536


def _bucket(value: Column) -> Column:
    """A coarse number that never falls while the value rises: 64 steps per power of two."""
    steps = F.floor(F.least(F.log2(F.abs(value)) * STEPS_PER_OCTAVE, F.lit(1e6))) + F.lit(STEPS_PER_OCTAVE * 1100)
    return F.when(value > 0, steps).when(value < 0, -steps).otherwise(F.lit(0).cast("bigint"))


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact, linearly interpolated quantiles: one row per key, one column per entry of ``probs``.

    ``percentile`` keeps every distinct value of a group in one buffer, which a group holding a
    third of all rows would not survive. Here rows are counted per coarse value bucket (a hash
    aggregate with partial sums), the counts tell which bucket holds the wanted ranks, and only that
    bucket is looked at again: it is cut evenly between its own bounds, and the slice with the ranks is ranked.
    Equal values are counted before they are ranked. No step guesses, so the answer is exact.
    """
    number = F.col(value).cast("double")
    data = df.select(*keys, number.alias("_v")).where(number.isNotNull() & ~F.isnan(number))
    if not keys:
        data = data.withColumn("_all", F.lit(1))
    group = keys or ["_all"]
    position = {name: F.lit(p) * (F.col("_total") - 1) for name, p in probs.items()}

    def holds_a_rank(before: Column, n: Column) -> Column:
        hit = F.lit(False)
        for name in probs:
            hit = hit | ((F.floor(position[name]) < before + n) & (F.ceil(position[name]) >= before))
        return hit

    def running(partition: list[str], order: str) -> Column:
        window = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_n").over(window), F.lit(0))

    data = data.withColumn("_b", _bucket(F.col("_v")))
    counts = data.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    counts = counts.withColumns(
        {"_before": running(group, "_b"), "_total": F.sum("_n").over(Window.partitionBy(*group))}
    )
    wanted = counts.where(holds_a_rank(F.col("_before"), F.col("_n"))).drop("_n")

    place = [*group, "_b"]
    rows = attach(data, wanted, place, "inner")
    # A bucket is cut evenly between its own bounds, and only the slice that holds the rank is ranked.
    share = F.coalesce(F.try_divide(F.col("_v") - F.col("_lo"), F.col("_hi") - F.col("_lo")), F.lit(0.0))
    rows = rows.withColumn("_s", F.floor(share * SUB_SLICES)).drop("_lo", "_hi")
    subs = rows.groupBy(*place, "_before", "_total", "_s").agg(F.count(F.lit(1)).alias("_n"))
    subs = subs.withColumn("_before", F.col("_before") + running(place, "_s"))
    place = [*place, "_s"]
    subs = subs.where(holds_a_rank(F.col("_before"), F.col("_n"))).select(*place, "_before", "_total")
    rows = attach(rows.drop("_before", "_total"), subs, place, "inner")

    equal = rows.groupBy(*place, "_before", "_total", "_v").agg(F.count(F.lit(1)).alias("_n"))
    ranked = equal.withColumn("_end", F.col("_before") + running(place, "_v") + F.col("_n"))
    picks = ranked.groupBy(*group, "_total").agg(
        *[F.min(F.when(F.col("_end") > F.floor(position[n]), F.col("_v"))).alias(f"_lo_{n}") for n in probs],
        *[F.min(F.when(F.col("_end") > F.ceil(position[n]), F.col("_v"))).alias(f"_hi_{n}") for n in probs],
    )
    return picks.select(
        *keys,
        *[
            (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * (position[n] - F.floor(position[n]))).alias(n)
            for n in probs
        ],
    )


def exact_median(df: DataFrame, keys: list[str], value: str, alias: str = "median") -> DataFrame:
    return exact_quantiles(df, keys, value, {alias: 0.5})


def above_multiple_of_median(
    df: DataFrame, value: str, multiple: float = 3.0, keys: list[str] | None = None
) -> DataFrame:
    """Rows of ``df`` with ``median`` and ``is_spike`` (value above ``multiple`` times the median)."""
    keys = keys or []
    median = exact_median(df, keys, value)
    joined = attach(df, median, keys) if keys else df.withColumn("median", median.scalar())
    return joined.withColumn("is_spike", F.coalesce(F.col(value) > F.col("median") * F.lit(multiple), F.lit(False)))
