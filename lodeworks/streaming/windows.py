"""Event-time windows: continuous aggregates, deduplication, three-sigma alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.functions import exact_avg, half_up


def windowed(events: DataFrame, key: str, size: str, slide: str | None = None, ts: str = "ts", value: str = "value") -> DataFrame:
    """Tumbling (or, with a slide, sliding) aggregates per key; partial sums are built map-side."""
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    return events.groupBy(key, window).agg(
        F.count(F.lit(1)).alias("n"),
        half_up(exact_avg(value), 4).alias("avg_value"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
    ).select(
        key,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "n",
        "avg_value",
        "min_value",
        "max_value",
    )


def window_stats(events: DataFrame, key: str, size: str, slide: str, ts: str = "ts", value: str = "value") -> DataFrame:
    """Mean and deviation of each sliding window, labelled by its end."""
    grouped = events.groupBy(key, F.window(ts, size, slide)).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("sigma"))
    return grouped.select(key, F.col("window.end").alias("window_end"), "mean", "sigma")


def sigma_alerts(events: DataFrame, stats: DataFrame, key: str, slide: str, k: float = 3.0, ts: str = "ts", value: str = "value") -> DataFrame:
    """Events further than k deviations from the window that closed before them: an equi-join on key
    and window end, so an event meets one row and never its own window."""
    current = events.withColumn("window_end", F.window(ts, slide)["start"])
    joined = current.join(stats, [key, "window_end"])
    return joined.where(F.abs(F.col(value) - F.col("mean")) > F.lit(k) * F.col("sigma"))


def without_replays(events: DataFrame, keys: list[str]) -> DataFrame:
    """Replayed events dropped; state is kept only as long as the watermark allows a replay."""
    return events.dropDuplicatesWithinWatermark(keys)


def in_time_order(batch: DataFrame, key: str, ts: str = "ts") -> DataFrame:
    """A micro-batch in order of key and event time. Ranges split a busy key by time."""
    return batch.repartitionByRange(F.col(key), F.col(ts)).sortWithinPartitions(key, ts)
