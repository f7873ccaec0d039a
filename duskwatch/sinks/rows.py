"""Wide relational rows of gold events and findings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from duskwatch.functions.text import json_text



def document(column: Column | str) -> Column:
    """JSON text with explicit nulls; a missing struct is the JSON value null."""
    return F.coalesce(json_text(column), F.lit("null"))


def events_wide(gold: DataFrame) -> DataFrame:
    """Nested gold records -> rows of the warm ``events`` table (key ``silver_id``)."""
    s = {c: F.col(f"silver.{c}") for c in gold.schema["silver"].dataType.names}
    policy = s["policy_violation"]

    def renamed(*names):
        return [s[n].alias(n) for n in names]

    return gold.select(
        s["id"].alias("silver_id"), *renamed("original_id", "event_time", "ingestion_time"),
        "processing_time_ms",
        *renamed("event_type", "severity", "action", "protocol", "application",
                 "connection_state"),
        *renamed("response_code"), *renamed("rule_id", "source_ip", "destination_ip",
                                           "destination_domain", "source_port",
                                           "destination_port", "bytes_sent", "bytes_received"),
        *renamed("packet_count", "duration_ms"), *renamed("tcp_flags"),
        s["user"].alias("user_name"),
        *renamed("device_name", "source_type", "pipeline", "collector", "network_segment",
                 "security_zone", "geo_location"),
        *renamed("vlan_id"), *renamed("asset_tags", "correlation_id", "process_name"),
        *renamed("process_id"), *renamed("cpu_percent", "memory_percent"),
        policy["policy_name"].alias("policy_name"),
        policy["violation_type"].alias("policy_violation_type"),
        policy["policy_severity"].alias("policy_severity"),
        "threat_score", "recommended_action", "mitre_tactic", "narrative",
        *[document(c).alias(c) for c in ("score_breakdown", "ip_reputation", "asset_context",
                                          "identity_context")],
        s["cleaning_warnings"].alias("cleaning_warnings"))


def aggregations_wide(findings: DataFrame) -> DataFrame:
    """Enriched findings -> rows of the warm ``aggregations`` table (key ``flink_id``)."""
    summary, stats = F.col("enrichment_summary"), F.col("baseline_stats")
    return findings.select(
        F.col("id").alias("flink_id"), "aggregation_type", "source_ip", "source_event_type",
        "event_time", "first_seen", "last_seen", "window_minutes", "description", "event_count",
        "unique_dest_ips", "unique_dest_ports", "total_bytes_sent",
        stats["rolling_average"].alias("rolling_average"),
        stats["multiplier"].alias("baseline_multiplier"),
        stats["windows_in_baseline"].alias("windows_in_baseline"),
        "pattern", "chain",
        *[summary[n].alias(n) for n in ("max_threat_score", "avg_threat_score",
                                        "recommended_action", "mitre_tactic", "narrative")],
        *[document(summary[n]).alias(n) for n in ("ip_reputation", "asset_context",
                                                   "identity_context")],
        F.coalesce(summary["source_event_ids"],
                   F.array().cast("array<string>")).alias("source_event_ids"))
