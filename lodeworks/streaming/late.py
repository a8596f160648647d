"""Event-time jobs that lose no row, however late it comes and however the files are cut into batches.

Spark drops rows behind the watermark from a stateful aggregate. Here a micro-batch is reduced to partial
results, and those are written under their event day and batch number::

    <path>/parts/day=<day of the window's end>/batch=<number>   partial results
    <path>/late/batch=<number>                                  rows that came behind the watermark
    <path>/marks/batch=<number>                                 one row: counts, greatest event time so far
    <path>/closed/day=<day>                                     merged results of closed windows

The watermark is the greatest event time of all batches so far less the delay. It decides when a window is
published, not which rows count: a row behind it is written aside, counted, and its window, closed before,
is merged and published again. What a batch costs follows the days it touches, as only their
folders are read and overwritten.

A batch that is repeated after a failure writes the same files again: it looks at earlier batches only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodeworks.functions import exact_parts, exact_total, half_up
from lodeworks.session import work_path
from lodeworks.sources.tables import exists
from lodeworks.streaming.io import run_batches

Step = Callable[[DataFrame], DataFrame]


def _micros(column: Column | str) -> Column:
    return F.unix_micros(column)


def _write(rows: DataFrame, path: str, *by: str) -> None:
    """Replace the partitions that the rows have; others stay."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _days(spark: SparkSession, path: str) -> list[str]:
    """Days that have a folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []
    return sorted(name.removeprefix("day=") for name in names if name.startswith("day="))


def _read_days(spark: SparkSession, path: str, days: list[str]) -> DataFrame:
    return spark.read.option("basePath", path).parquet(*[f"{path}/day={day}" for day in days])


def _on_days(column: Column | str, rows: DataFrame) -> list[str]:
    """The days of a batch: one entry per calendar day."""
    return [r.day for r in rows.select(F.to_date(column).cast("string").alias("day")).distinct().collect() if r.day]


def _high_before(spark: SparkSession, path: str, no: int) -> int | None:
    """Greatest event time of the batches before this one, in microseconds."""
    mark = f"{path}/marks/batch={no - 1}"
    return spark.read.parquet(mark).first().high if no and exists(spark, mark) else None


def _mark(batch: DataFrame, path: str, no: int, ts: str, delay: int) -> tuple[int | None, int | None]:
    """Write the batch's mark and its late rows; (watermark before the batch, watermark after it)."""
    spark = batch.sparkSession
    high = _high_before(spark, path, no)
    before = None if high is None else high - delay
    behind = F.lit(None).cast("bigint") if before is None else F.lit(before) - _micros(ts)
    seen = batch.agg(
        F.max(_micros(ts)).alias("high"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(behind > 0).alias("late_rows"),
        F.max(F.when(behind > 0, behind)).alias("behind_micros"),
    ).first()
    if seen.late_rows:
        batch.where(F.col(ts) < F.timestamp_micros(F.lit(before))).write.mode("overwrite").parquet(f"{path}/late/batch={no}")
    high = max((h for h in (high, seen.high) if h is not None), default=None)
    row = [(high, seen.rows, seen.late_rows, seen.behind_micros)]
    mark = spark.createDataFrame(row, "high bigint, rows bigint, late_rows bigint, behind_micros bigint")
    mark.write.mode("overwrite").parquet(f"{path}/marks/batch={no}")
    return before, None if high is None else high - delay


def run_windows(stream: DataFrame, partial: Step, merge: Step, label: str, path: str | None = None, ts: str = "ts", delay_seconds: int = 600) -> DataFrame:
    """Drain a stream into windows and return the closed ones.

    ``partial`` reduces rows to partial results with a column ``closes``, the end of their window; ``merge`` adds partial
    results up and keeps ``closes``. A later run with the same path goes on where the last one stopped. Rows
    without event time are counted in the marks and belong to no window.
    """
    spark, delay = stream.sparkSession, delay_seconds * 1_000_000
    path = path or work_path(spark, label)
    parts, closed = f"{path}/parts", f"{path}/closed"

    def handle(batch: DataFrame, no: int) -> None:
        before, after = _mark(batch, path, no, ts, delay)
        reduced = partial(batch.where(F.col(ts).isNotNull()))
        _write(reduced.select("*", F.to_date("closes").alias("day"), F.lit(no).alias("batch")), parts, "day", "batch")
        if after is None:
            return
        # Days of this batch, and days whose windows the watermark has just passed.
        limit = F.timestamp_micros(F.lit(after))
        touched = set(_on_days("closes", reduced.where(F.col("closes") <= limit)))
        if before is not None and before < after:
            span = spark.range(1).select(*[F.to_date(F.timestamp_micros(F.lit(x))).cast("string") for x in (before, after)]).first()
            touched |= {day for day in _days(spark, parts) if span[0] <= day <= span[1]}
        if touched:
            held = _read_days(spark, parts, sorted(touched)).where((F.col("batch") <= no) & (F.col("closes") <= limit))
            _write(merge(held.drop("day", "batch")).withColumn("day", F.to_date("closes")), closed, "day")

    run_batches(stream, label, handle, f"{path}/checkpoint")
    if not _days(spark, closed):
        return merge(partial(spark.createDataFrame([], stream.schema)))
    return spark.read.parquet(closed).drop("day")


def partials(spark: SparkSession, path: str) -> DataFrame:
    """All partial results, of open windows too."""
    return spark.read.parquet(f"{path}/parts").drop("day", "batch")


def late_report(spark: SparkSession, path: str) -> DataFrame:
    """Per batch: rows, rows behind the watermark, and how far behind the latest of them was; a delay of that
    length would have left none behind."""
    return spark.read.parquet(f"{path}/marks").select("batch", "rows", "late_rows", "behind_micros")


def late_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows that came behind the watermark, or None if there were none."""
    return spark.read.parquet(f"{path}/late") if exists(spark, f"{path}/late") else None


def run_distinct(stream: DataFrame, keys: list[str], label: str, path: str | None = None, ts: str = "ts") -> DataFrame:
    """Drain a stream of events that may be replayed; each key and event time is taken once.

    A replay carries the time of its event, so a batch is compared with the days it touches, not with
    everything taken so far. Without a time limit, no replay is too late to be known.
    """
    spark = stream.sparkSession
    path = path or work_path(spark, label)
    taken = f"{path}/taken"

    def handle(batch: DataFrame, no: int) -> None:
        day = F.coalesce(F.to_date(ts), F.lit("1970-01-01").cast("date"))
        rows = batch.dropDuplicates([*keys, ts]).withColumn("day", day)
        known = sorted(set(_on_days("day", rows)) & set(_days(spark, taken)))
        if known:
            old = _read_days(spark, taken, known).where(F.col("batch") < no).select(*[F.col(c).alias(f"old_{c}") for c in (*keys, ts)])
            same = [F.col(c).eqNullSafe(F.col(f"old_{c}")) for c in (*keys, ts)]
            rows = rows.join(old, same, "left_anti")
        _write(rows.withColumn("batch", F.lit(no)), taken, "day", "batch")

    run_batches(stream, label, handle, f"{path}/checkpoint")
    if not _days(spark, taken):
        return spark.createDataFrame([], stream.schema)
    return spark.read.parquet(taken).select(*stream.columns)


def run_rows(stream: DataFrame, label: str, path: str | None = None, ts: str = "ts") -> DataFrame:
    """Drain a stream into rows filed by event day, for jobs that need them in order."""
    spark = stream.sparkSession
    path = path or work_path(spark, label)
    rows = f"{path}/rows"

    def handle(batch: DataFrame, no: int) -> None:
        day = F.coalesce(F.to_date(ts), F.lit("1970-01-01").cast("date"))
        _write(batch.select("*", day.alias("day"), F.lit(no).alias("batch")), rows, "day", "batch")

    run_batches(stream, label, handle, f"{path}/checkpoint")
    if not _days(spark, rows):
        return spark.createDataFrame([], stream.schema)
    return spark.read.parquet(rows).select(*stream.columns)


# --- what the windows hold ---


def _window(ts: str, size: str, slide: str | None) -> Column:
    return F.window(ts, size, slide) if slide else F.window(ts, size)


def run_aggregates(stream: DataFrame, key: str, size: str, label: str, slide: str | None = None, ts: str = "ts", value: str = "value", **options) -> DataFrame:
    """Tumbling (or, with a slide, sliding) aggregates per key: n, avg_value, min_value, max_value."""

    def partial(rows: DataFrame) -> DataFrame:
        high, low = exact_parts(value)
        grouped = rows.groupBy(key, _window(ts, size, slide).alias("w")).agg(
            F.count(F.lit(1)).alias("n"), F.count(value).alias("known"), high.alias("high"), low.alias("low"), F.min(value).alias("lo"), F.max(value).alias("hi")
        )
        return grouped.select(key, F.col("w.start").alias("window_start"), F.col("w.end").alias("closes"), "n", "known", "high", "low", "lo", "hi")

    def merge(parts: DataFrame) -> DataFrame:
        mean = F.try_divide(exact_total(F.sum("high"), F.sum("low")), F.sum("known"))
        return parts.groupBy(key, "window_start", "closes").agg(
            F.sum("n").alias("n"), half_up(mean, 4).alias("avg_value"), F.min("lo").alias("min_value"), F.max("hi").alias("max_value")
        )

    done = run_windows(stream, partial, merge, label, ts=ts, **options)
    return done.select(key, "window_start", F.col("closes").alias("window_end"), "n", "avg_value", "min_value", "max_value")


def run_stats(stream: DataFrame, key: str, size: str, slide: str, label: str, ts: str = "ts", value: str = "value", **options) -> DataFrame:
    """Mean and deviation of each sliding window, labelled by its end.

    Squares are added up around one of the group's own means, so that a large mean does not eat up a small deviation.
    """

    def partial(rows: DataFrame) -> DataFrame:
        grouped = rows.where(F.col(value).isNotNull()).groupBy(key, _window(ts, size, slide).alias("w"))
        stats = grouped.agg(F.count(value).alias("n"), F.avg(value).alias("m"), F.var_pop(value).alias("v"))
        return stats.select(key, F.col("w.end").alias("closes"), "n", "m", "v")

    def merge(parts: DataFrame) -> DataFrame:
        around = parts.withColumn("d", F.col("m") - F.min("m").over(Window.partitionBy(key, "closes")))
        sums = around.groupBy(key, "closes").agg(
            F.sum("n").alias("n"),
            F.min("m").alias("m"),
            F.sum(F.col("n") * F.col("d")).alias("s"),
            F.sum(F.col("n") * (F.col("v") + F.col("d") * F.col("d"))).alias("q"),
        )
        spread = F.greatest(F.col("q") - F.col("s") * F.col("s") / F.col("n"), F.lit(0.0))
        return sums.select(key, "closes", (F.col("m") + F.col("s") / F.col("n")).alias("mean"), F.sqrt(F.try_divide(spread, F.col("n") - 1)).alias("sigma"))

    done = run_windows(stream, partial, merge, label, ts=ts, **options)
    return done.select(key, F.col("closes").alias("window_end"), "mean", "sigma")


def run_heartbeat(stream: DataFrame, device: str, silence_seconds: int, label: str, path: str | None = None, ts: str = "ts", delay_seconds: int = 600) -> DataFrame:
    """An offline mark (value NULL) for every device that stays silent too long; nothing is filled in.

    Beats are reduced to the first and the last of each stretch as long as the silence: inside it no
    silence can lie. A device's few stretches are then put in order, so a late beat closes a silence that an earlier
    run has reported. A silence that goes on counts once the watermark has passed it.
    """
    spark, silence = stream.sparkSession, silence_seconds * 1_000_000
    path = path or work_path(spark, label)

    def partial(rows: DataFrame) -> DataFrame:
        grouped = rows.groupBy(device, F.window(ts, f"{silence_seconds} seconds").alias("w")).agg(F.min(_micros(ts)).alias("first"), F.max(_micros(ts)).alias("last"))
        return grouped.select(device, F.col("w.end").alias("closes"), "first", "last")

    def merge(parts: DataFrame) -> DataFrame:
        return parts.groupBy(device, "closes").agg(F.min("first").alias("first"), F.max("last").alias("last"))

    none = run_windows(stream, partial, merge, label, path, ts, delay_seconds).where(F.lit(False))
    stretches = merge(partials(spark, path)) if _days(spark, f"{path}/parts") else none
    high = spark.read.parquet(f"{path}/marks").agg(F.max("high").alias("high")).first().high if exists(spark, f"{path}/marks") else None
    after = F.lead("first").over(Window.partitionBy(device).orderBy("closes"))
    ended, going_on = F.col("after") - F.col("last") > silence, F.col("after").isNull() & (F.col("last") + silence < F.lit(None if high is None else high - delay_seconds * 1_000_000).cast("bigint"))
    marks = stretches.withColumn("after", after).where(ended | going_on)
    return marks.select(device, F.timestamp_micros(F.col("last") + silence).alias("offline_at"), F.lit(None).cast("double").alias("value"))
