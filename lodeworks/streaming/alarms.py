"""Threshold alarms. The same functions serve a batch and a stream: both are stateless."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.constants import POINT_ALARMS
from lodeworks.sources.literal import literal_table


def alarm_level(events: DataFrame, alarms: dict[str, float | None] = POINT_ALARMS) -> DataFrame:
    """Level 2 from 1.2 times the alarm threshold on, 1 from the threshold on, else 0. A point
    without a threshold never alarms. The threshold table is a constant of a few rows."""
    table = literal_table(events.sparkSession, alarms.items(), "point string, alarm double")
    value, alarm = F.col("value"), F.col("alarm")
    level = F.when(value >= alarm * F.lit(1.2), 2).when(value >= alarm, 1).otherwise(0)
    return events.join(F.broadcast(table), "point", "left").withColumn("level", level)


def gas_alarms(events: DataFrame, point: str, limit: float) -> DataFrame:
    """Events of one point above a fixed limit."""
    return events.where((F.col("point") == point) & (F.col("value") > limit))
