"""Analytical views over the warm ``events`` and ``aggregations`` tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from duskwatch.operators.interval import BUCKET, range_min
from duskwatch.sinks import textindex

ALERTING = ("page", "contain")


def _mean_points() -> Column:
    """Mean score as a whole number, halves away from zero."""
    return F.round(F.avg("threat_score")).cast("int")


def hourly_threat_trends(events: DataFrame) -> DataFrame:
    return (events.groupBy(F.date_trunc("hour", "event_time").alias("hour"), "event_type",
                           "severity", "recommended_action")
            .agg(F.count("*").alias("event_count"), _mean_points().alias("avg_score"),
                 F.max("threat_score").alias("max_score"),
                 F.count_if(F.col("recommended_action").isin(*ALERTING))
                 .alias("high_severity_count")))


def top_threat_ips(events: DataFrame) -> DataFrame:
    """Per address: counts, scores, its event types and tactics, worst first.

    Types and tactics are first reduced to one row per (address, type, tactic),
    so the sets are collected from few rows even for a hot address.
    """
    parts = (events.where(F.col("source_ip").isNotNull())
             .groupBy("source_ip", "event_type", "mitre_tactic")
             .agg(F.count("*").alias("n"), F.count("threat_score").alias("scored"),
                  F.sum("threat_score").alias("total"), F.max("threat_score").alias("hi"),
                  F.max("event_time").alias("last")))
    types = F.sort_array(F.collect_set("event_type"))
    has_blank = F.max(F.col("event_type").isNull())
    tactics = F.sort_array(F.collect_set("mitre_tactic"))
    out = parts.groupBy("source_ip").agg(
        F.sum("n").alias("event_count"),
        F.round(F.sum("total") / F.sum("scored")).cast("int").alias("avg_score"),
        F.max("hi").alias("max_score"),
        # A missing type counts as a value and sorts last.
        F.when(has_blank, F.array_append(types, F.lit(None).cast("string")))
         .otherwise(types).alias("event_types"),
        F.when(F.size(tactics) > 0, tactics).alias("mitre_tactics"),
        F.max("last").alias("last_seen"))
    return out.orderBy(F.desc_nulls_first("avg_score"), F.desc("event_count"))


def mitre_coverage(events: DataFrame) -> DataFrame:
    return (events.where(F.col("mitre_tactic").isNotNull()).groupBy("mitre_tactic")
            .agg(F.count("*").alias("event_count"), F.avg("threat_score").alias("avg_score"),
                 F.max("event_time").alias("last_seen")).orderBy(F.desc("event_count")))


def action_summary(events: DataFrame) -> DataFrame:
    return (events.groupBy(F.date_trunc("day", "event_time").alias("day"), "recommended_action")
            .agg(F.count("*").alias("count")).orderBy(F.desc("day"), F.desc("count")))


AGGREGATION_FIELDS = (
    "flink_id", "aggregation_type", "source_ip", "source_event_type", "event_time", "first_seen",
    "last_seen", "window_minutes", "event_count", "description", "pattern", "rolling_average",
    "baseline_multiplier", "max_threat_score", "avg_threat_score", "recommended_action",
    "mitre_tactic", "narrative", "ip_reputation", "asset_context", "identity_context")


def aggregation_enriched(aggregations: DataFrame, events: DataFrame,
                         bucket: str = BUCKET) -> DataFrame:
    """Findings with the highest-scoring event of their address and time range.

    Equal scores fall to the earliest event, then the smallest id.
    """
    points = events.select(
        "source_ip", F.col("event_time").alias("__at"), F.col("silver_id").alias("top_event_id"),
        F.col("event_type").alias("top_event_type"), F.col("threat_score").alias("top_event_score"),
        F.col("narrative").alias("top_event_narrative"),
        F.col("destination_ip").alias("top_dest_ip"),
        F.col("destination_port").alias("top_dest_port"))
    ranges = aggregations.select("flink_id", "source_ip", "first_seen", "last_seen")
    tops = [c for c in points.columns if c.startswith("top_")]
    # The search carries narrow rows; one event per finding is fetched afterwards.
    rank = F.struct((-F.col("top_event_score")).alias("s"), F.col("__at").alias("__at"),
                    F.col("top_event_id").alias("top_event_id"))
    found = range_min(points, ranges, ["source_ip"], "__at", "first_seen", "last_seen", rank,
                      "flink_id", bucket).select("flink_id", "least.__at", "least.top_event_id")
    best = (points.join(found, ["__at", "top_event_id"]).groupBy("flink_id")
            .agg(F.first(F.struct(*tops)).alias("top")))
    return (aggregations.select(*AGGREGATION_FIELDS).join(best, "flink_id", "left")
            .select(*AGGREGATION_FIELDS, *[F.col(f"top.{c}").alias(c) for c in tops]))


def ip_full_picture(events: DataFrame, aggregations: DataFrame) -> DataFrame:
    """All activity of all addresses from both tables, latest first."""
    singles = events.select(
        "source_ip", F.lit("event").alias("record_type"), F.col("silver_id").alias("record_id"),
        "event_time", "event_type", "threat_score", "recommended_action", "mitre_tactic",
        "narrative")
    findings = aggregations.select(
        "source_ip", F.lit("aggregation").alias("record_type"),
        F.col("flink_id").alias("record_id"), "event_time",
        F.col("source_event_type").alias("event_type"),
        F.col("max_threat_score").alias("threat_score"), "recommended_action", "mitre_tactic",
        F.col("description").alias("narrative"), "aggregation_type", "event_count", "pattern")
    return (singles.unionByName(findings, allowMissingColumns=True)
            .orderBy(F.desc_nulls_first("event_time")))


def events_health(events: DataFrame) -> DataFrame:
    return events.agg(F.count("*").alias("count"), F.round(F.avg("threat_score")).alias("avg_score"))


def top_events(events: DataFrame, n: int, by: str = "threat_score") -> DataFrame:
    """The ``n`` highest events; ties by time, then id."""
    return events.orderBy(F.desc(by), "event_time", "silver_id").limit(n)


def recent_events(events: DataFrame, n: int) -> DataFrame:
    return events.orderBy(F.desc("event_time"), "silver_id").limit(n)


def events_where(events: DataFrame, **equal) -> DataFrame:
    """Events by exact field values (type, action, address, severity, tactic, user, device)."""
    return reduce(DataFrame.where, [F.col(k) == v for k, v in equal.items()], events)


def ip_timeline(events: DataFrame, ip: str, start=None, end=None) -> DataFrame:
    """One address, latest first, optionally within a time range."""
    rows = events.where(F.col("source_ip") == ip)
    if start is not None:
        rows = rows.where(F.col("event_time") >= F.lit(start))
    if end is not None:
        rows = rows.where(F.col("event_time") < F.lit(end))
    return rows.orderBy(F.desc("event_time"), "silver_id")


def searchable(events: DataFrame, aggregations: DataFrame) -> DataFrame:
    """Events and findings as records with one text each."""
    return (events.select(F.lit("event").alias("record_type"), F.col("silver_id").alias("record_id"),
                          "source_ip", "event_time", "recommended_action",
                          F.col("narrative").alias("text"))
            .unionByName(aggregations.select(
                F.lit("aggregation").alias("record_type"), F.col("flink_id").alias("record_id"),
                "source_ip", "event_time", "recommended_action",
                F.concat_ws(" ", "description", "narrative").alias("text"))))


def text_search(events: DataFrame, aggregations: DataFrame, words: list[str],
                index: DataFrame | None = None, **equal) -> DataFrame:
    """Events and findings whose narrative or description holds all the words.

    Words are matched whole and without regard to case; ``equal`` adds exact
    filters on fields both sides have.  With an ``index`` (``sinks.textindex``) of the
    records only the texts it names are read; without one every text is split.
    """
    both = searchable(events, aggregations)
    if index is not None:
        both = textindex.indexed(both, index, words)
    terms = textindex.text_words()
    found = reduce(lambda a, b: a & b, [F.array_contains(terms, w.lower()) for w in words])
    return events_where(both.where(found), **equal)


def register_views(spark: SparkSession, events: DataFrame, aggregations: DataFrame,
                   bucket: str = BUCKET) -> None:
    """Make the tables and views available to ``spark.sql``."""
    for name, rows in {
        "events": events, "aggregations": aggregations,
        "v_hourly_threat_trends": hourly_threat_trends(events),
        "v_top_threat_ips": top_threat_ips(events),
        "v_mitre_coverage": mitre_coverage(events),
        "v_action_summary": action_summary(events),
        "v_aggregation_enriched": aggregation_enriched(aggregations, events, bucket),
        "v_ip_full_picture": ip_full_picture(events, aggregations),
    }.items():
        rows.createOrReplaceTempView(name)
