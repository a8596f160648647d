"""Ordered work on time series, cut into time buckets.

A window over a whole series puts that series into one task. Here a series is cut by time bucket
(a day by default): each bucket is sorted on its own, and the few values that cross a bucket
border travel through a small table with one row per series and bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _micros(column: Column) -> Column:
    return F.unix_micros(column.cast("timestamp"))


def with_bucket(df: DataFrame, ts: str, unit: str = "day") -> DataFrame:
    return df.withColumn("_bucket", F.date_trunc(unit, F.col(ts)))


def with_previous(
    df: DataFrame, keys: list[str], order_by: list[str], carry: dict[str, str], ts: str | None = None, unit: str = "day"
) -> DataFrame:
    """``lag`` of some columns within a series: ``carry`` maps new name -> source column.

    ``order_by`` must be a total order that starts with the time column.
    """
    ts = ts or order_by[0]
    df = with_bucket(df, ts, unit)
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order_by)
    sources = list(dict.fromkeys(carry.values()))
    edge = df.groupBy(*keys, "_bucket").agg(
        F.max_by(F.struct(*sources), F.struct(*order_by)).alias("_last")
    )
    across = Window.partitionBy(*keys).orderBy("_bucket")
    edge = edge.select(*keys, "_bucket", F.lag("_last").over(across).alias("_edge"))
    ranked = df.withColumns(
        {"_rn": F.row_number().over(inside), **{f"_in_{n}": F.lag(c).over(inside) for n, c in carry.items()}}
    )
    joined = ranked.join(edge, [*keys, "_bucket"], "left")
    return joined.withColumns(
        {n: F.when(F.col("_rn") == 1, F.col("_edge")[c]).otherwise(F.col(f"_in_{n}")) for n, c in carry.items()}
    ).drop("_rn", "_edge", "_bucket", *[f"_in_{n}" for n in carry])


def glitches(events: DataFrame, device: str, state: str, order_by: list[str], changes: int = 3, within_seconds: int = 5, unit: str = "day") -> DataFrame:
    """Events at which a device changes its state for the third (``changes``) time within a few seconds.

    ``order_by`` is a total order of a device's events that starts with the time. Each look back at the change
    before is a lag over time buckets, so a busy device is never in one task.
    """
    ts = order_by[0]
    dated = events.where(F.col(ts).isNotNull())
    moved = with_previous(dated, [device], order_by, {"_before": state}, unit=unit).where(F.col("_before") != F.col(state)).drop("_before")
    moved = moved.withColumn("_t0", F.col(ts))
    for k in range(1, changes):
        moved = with_previous(moved, [device], order_by, {f"_t{k}": f"_t{k - 1}"}, unit=unit)
    quick = _micros(F.col(ts)) - _micros(F.col(f"_t{changes - 1}")) <= within_seconds * 1_000_000
    return moved.where(quick).drop(*[f"_t{k}" for k in range(changes)])


def gap_steps(
    df: DataFrame, keys: list[str], ts: str, limit_seconds: int = 120, unit: str = "day"
) -> DataFrame:
    """Per series: steps between readings, and how many are longer than the limit.

    Only aggregates leave a bucket: steps inside it, and its first and last time.
    """
    inside = Window.partitionBy(*keys, "_bucket").orderBy(ts)
    limit = F.lit(limit_seconds * 1_000_000)
    steps = with_bucket(df.select(*keys, ts).where(F.col(ts).isNotNull()), ts, unit).withColumn(
        "_step", _micros(F.col(ts)) - _micros(F.lag(ts).over(inside))
    )
    per_bucket = steps.groupBy(*keys, "_bucket").agg(
        F.min(ts).alias("_first"),
        F.max(ts).alias("_last"),
        F.count("_step").alias("_steps"),
        F.count_if(F.col("_step") > limit).alias("_gaps"),
        F.max("_step").alias("_max"),
    )
    across = Window.partitionBy(*keys).orderBy("_bucket")
    per_bucket = per_bucket.withColumn("_border", _micros(F.col("_first")) - _micros(F.lag("_last").over(across)))
    return per_bucket.groupBy(*keys).agg(
        (F.sum("_steps") + F.count("_border")).alias("steps"),
        (F.sum("_gaps") + F.count_if(F.col("_border") > limit)).alias("gaps"),
        F.greatest(F.max("_max"), F.max("_border")).alias("longest_micros"),
    )


def continuity(df: DataFrame, keys: list[str], ts: str, step: str = "hour") -> DataFrame:
    """Expected and actual points of each series on a fixed grid; repeated times count once."""
    micros = {"minute": 60, "hour": 3600, "day": 86400}[step] * 1_000_000
    grid = df.where(F.col(ts).isNotNull()).select(*keys, F.date_trunc(step, F.col(ts)).alias("_slot")).distinct()
    return grid.groupBy(*keys).agg(
        F.min("_slot").alias("_lo"), F.max("_slot").alias("_hi"), F.count(F.lit(1)).alias("actual")
    ).select(
        *keys,
        (F.floor((_micros(F.col("_hi")) - _micros(F.col("_lo"))) / F.lit(micros)) + 1).cast("bigint").alias("expected"),
        "actual",
    ).withColumn("missing", F.col("expected") - F.col("actual"))


def missing_slots(df: DataFrame, keys: list[str], ts: str, step: str = "hour") -> DataFrame:
    """The absent points themselves. Slots are laid out day by day, so no row carries a whole series."""
    every = F.expr(f"INTERVAL 1 {step.upper()}")
    grid = df.where(F.col(ts).isNotNull()).select(*keys, F.date_trunc(step, F.col(ts)).alias("slot")).distinct()
    span = grid.groupBy(*keys).agg(F.min("slot").alias("_lo"), F.max("slot").alias("_hi"))
    days = span.withColumn(
        "_day", F.explode(F.sequence(F.date_trunc("day", "_lo"), F.date_trunc("day", "_hi"), F.expr("INTERVAL 1 DAY")))
    )
    slots = days.withColumn(
        "slot",
        F.explode(
            F.sequence(
                F.greatest("_lo", "_day"),
                F.least(F.col("_hi"), F.col("_day") + F.expr("INTERVAL 1 DAY") - every),
                every,
            )
        ),
    )
    return slots.select(*keys, "slot").join(grid, [*keys, "slot"], "left_anti")


def fill_gaps(
    df: DataFrame, keys: list[str], order_by: list[str], value: str, ts: str | None = None, unit: str = "day"
) -> DataFrame:
    """Missing readings filled forward (``value_ffill``) and by straight line (``value_linear``)."""
    ts = ts or order_by[0]
    df = with_bucket(df, ts, unit)
    point = F.when(F.col(value).isNotNull(), F.struct(_micros(F.col(ts)).alias("t"), F.col(value).alias("v")))
    df = df.withColumn("_p", point)
    order = F.struct(*order_by)
    known = F.col("_p").isNotNull()
    edges = df.groupBy(*keys, "_bucket").agg(
        F.min_by("_p", F.when(known, order)).alias("_first"), F.max_by("_p", F.when(known, order)).alias("_last")
    )
    # Looking ahead is looking back in reverse order: a frame that grows is linear, a frame that
    # shrinks towards the end is evaluated anew for each row.
    across, across_back = (Window.partitionBy(*keys).orderBy(o) for o in (F.asc("_bucket"), F.desc("_bucket")))
    edges = edges.select(
        *keys,
        "_bucket",
        F.last("_last", ignorenulls=True).over(across.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.last("_first", ignorenulls=True).over(across_back.rowsBetween(Window.unboundedPreceding, -1)).alias("_after"),
    )
    bucket = Window.partitionBy(*keys, "_bucket")
    so_far = (Window.unboundedPreceding, Window.currentRow)
    back = F.last("_p", ignorenulls=True).over(bucket.orderBy(*order_by).rowsBetween(*so_far))
    ahead = F.last("_p", ignorenulls=True).over(bucket.orderBy(*[F.desc(c) for c in order_by]).rowsBetween(*so_far))
    joined = df.withColumns({"_back": back, "_ahead": ahead}).join(edges, [*keys, "_bucket"], "left")
    lo, hi = F.coalesce("_back", "_before"), F.coalesce("_ahead", "_after")
    joined = joined.withColumns({"_lo": lo, "_hi": hi})
    t, width = _micros(F.col(ts)), F.col("_hi.t") - F.col("_lo.t")
    line = F.col("_lo.v") + (F.col("_hi.v") - F.col("_lo.v")) * F.try_divide(t - F.col("_lo.t"), width)
    return joined.withColumns(
        {
            "value_ffill": F.coalesce(F.col(value), F.col("_lo.v")),
            "value_linear": F.coalesce(F.col(value), line),
        }
    ).drop("_bucket", "_p", "_back", "_ahead", "_before", "_after", "_lo", "_hi")


def scd2(df: DataFrame, keys: list[str], day: str, attribute: str, order_by: list[str]) -> DataFrame:
    """History rows with ``valid_from`` / ``valid_to`` out of dated observations.

    Observations are first reduced to the last one of each day, which bounds a key by the number
    of calendar days; only then are they put in order.
    """
    daily = df.groupBy(*keys, day).agg(F.max_by(attribute, F.struct(*order_by)).alias(attribute))
    window = Window.partitionBy(*keys).orderBy(day)
    changed = daily.withColumn("_prev", F.lag(attribute).over(window)).withColumn(
        "_rn", F.row_number().over(window)
    ).where((F.col("_rn") == 1) | ~F.col("_prev").eqNullSafe(F.col(attribute)))
    end = F.date_sub(F.lead(day).over(window), 1)
    return changed.select(
        *keys, attribute, F.col(day).alias("valid_from"), F.coalesce(end, F.to_date(F.lit("9999-12-31"))).alias("valid_to")
    )
