"""Deviation detector: a window count against the rolling mean of earlier ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from duskwatch.functions.text import message
from duskwatch.operators.velocity import none_text

MULTIPLIER = 3.0
HISTORY = 12

# Fixed value: wording of an alert.
DESCRIPTION = ("BASELINE DEVIATION: %s generated %s %s events — "
               "%sx above rolling average of %s over %s windows.")


def alert_columns(count: Column, mean: Column, depth: Column, multiplier: float) -> list[Column]:
    """Columns of one alert, shared by the batch and the stream form."""
    ratio = count / mean
    stats = F.struct(
        count.cast("int").alias("current_count"), F.bround(mean, 2).alias("rolling_average"),
        F.bround(ratio, 2).alias("multiplier"), F.lit(float(multiplier)).alias("threshold"),
        depth.cast("int").alias("windows_in_baseline"))
    stamp = (F.unix_millis("window_end") - 1).cast("string")
    return [
        F.concat(F.lit("baseline_"), F.col("velocity_key"), F.lit("_"), stamp).alias("id"),
        F.lit("baseline").alias("aggregation_type"), F.lit("HIGH").alias("severity"),
        F.col("source_ip"), F.col("event_type").alias("source_event_type"),
        F.col("window_end").alias("event_time"), F.col("velocity_key"),
        F.col("event_count"), F.col("first_seen"), F.col("last_seen"),
        F.col("window_minutes"), stats.alias("baseline_stats"),
        message(DESCRIPTION, none_text(F.col("source_ip")), count, F.col("event_type"),
                F.bround(ratio, 1), F.bround(mean, 1), depth).alias("description"),
        F.lit(True).alias("aggregated"), F.lit(False).alias("correlated")]


def baseline_alerts(windows: DataFrame, multiplier: float = MULTIPLIER, history: int = HISTORY,
                    min_depth: int | None = None) -> DataFrame:
    """Alert on windows whose count is ``multiplier`` times the rolling mean.

    The mean covers up to ``history`` earlier windows of the same key and needs
    at least half as many.  ``windows`` come from the rate detector: its
    threshold decides which windows count (1 = every window that had events).

    The window frame runs over one row per key and time window, so its size is
    bounded by the time span, not by the number of events.
    """
    min_depth = history // 2 if min_depth is None else min_depth
    earlier = (Window.partitionBy("velocity_key").orderBy("window_start")
               .rowsBetween(-history, -1))
    rated = (windows.withColumn("__mean", F.avg("event_count").over(earlier))
             .withColumn("__depth", F.count("event_count").over(earlier)))
    mean = F.col("__mean")
    return (rated.where((F.col("__depth") >= min_depth) & (mean > 0)
                        & (F.col("event_count") >= mean * multiplier))
            .select(*alert_columns(F.col("event_count"), mean, F.col("__depth"), multiplier)))
