"""Stream-stream interval join of findings with gold events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from duskwatch.functions.timing import seconds
from duskwatch.operators.interval import gold_points

# Gold events are kept for findings to come over so many of the detectors' windows.
KEEP_WINDOWS = 3


def enrich_findings_stream(findings: DataFrame, gold: DataFrame, window: str = "10 minutes",
                           keep: str | None = None, delay: str = "30 seconds") -> DataFrame:
    """Summary per finding of a stream, as in ``interval.enrichment_summary``.

    Both sides carry event-time watermarks and the join bounds the distance of a
    gold event from the finding, so Spark drops state it can no longer match.
    A finding without a match leaves with NULL scores once the watermark passed.
    ``window`` is the longest span of a finding; keeping less would lose matches.  A
    finding that reaches further than is kept gets no summary rather than that of a part
    of its events.  Deliveries of one finding or gold event count once, as long as they
    are not further apart than the watermark.  ``record`` is the whole finding.
    """
    keep = keep or f"{KEEP_WINDOWS * seconds(window)} seconds"
    if seconds(keep) < seconds(window):
        raise ValueError(f"gold events kept for {keep} miss matches of findings over {window}")
    left = (findings.select(
        F.col("id").alias("finding_id"), "source_ip", "source_event_type", "event_time",
        F.coalesce("first_seen", "event_time").alias("range_start"),
        F.coalesce("last_seen", "event_time").alias("range_end"),
        F.struct(*findings.columns).alias("record"))
        .withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["finding_id"]).alias("f"))
    right = (gold_points(gold).withWatermark("gold_time", delay)
             .dropDuplicatesWithinWatermark(["silver_id"]).alias("g"))
    on = F.expr(f"""
        f.source_ip = g.source_ip AND f.source_event_type = g.source_event_type
        AND g.gold_time BETWEEN f.range_start AND f.range_end
        AND f.range_start >= f.event_time - INTERVAL {keep}
        AND f.range_end <= f.event_time + INTERVAL {keep}
        AND g.gold_time BETWEEN f.event_time - INTERVAL {keep} AND f.event_time + INTERVAL {keep}""")
    rank = F.struct((-F.col("threat_score")).alias("s"), F.col("gold_time").alias("t"),
                    F.col("silver_id").alias("i"))
    rows = left.join(right, on, "leftOuter").select(
        "finding_id", "event_time", "record", "gold_time", "silver_id", "threat_score", "context")
    hit = F.col("silver_id").isNotNull()
    ids = F.array_sort(F.collect_list(F.when(hit, rank)))
    return rows.groupBy("finding_id", "event_time").agg(
        F.max("threat_score").alias("max_threat_score"),
        F.floor(F.avg("threat_score")).cast("int").alias("avg_threat_score"),
        F.count("silver_id").cast("int").alias("gold_events_found"),
        F.min_by("context", F.when(hit, rank)).alias("top"),
        F.transform(ids, lambda r: r["i"]).alias("source_event_ids"),
        F.first("record").alias("record"))


def enriched_records(summaries: DataFrame) -> DataFrame:
    """Whole findings of :func:`enrich_findings_stream` with their ``enrichment_summary``."""
    top = F.col("top")
    summary = F.struct(
        "max_threat_score", "avg_threat_score",
        *[top[n].alias(n) for n in ("recommended_action", "mitre_tactic", "narrative",
                                    "ip_reputation", "asset_context", "identity_context")],
        "source_event_ids", "gold_events_found")
    fields = [n for n in summaries.schema["record"].dataType.names if n != "enrichment_summary"]
    return summaries.select(
        *[F.col(f"record.{n}").alias(n) for n in fields],
        F.when(F.col("gold_events_found") > 0, summary).alias("enrichment_summary"))
