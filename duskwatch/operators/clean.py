"""Bronze -> silver, duplicates, and cleaning statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from duskwatch import schemas
from duskwatch.functions import cleaning as c
from duskwatch.functions.text import given

CLEANING_VERSION = "1.0"
CLEAN_TOPIC_STAGE = "clean"


def stable_id(bronze: DataFrame) -> Column:
    """Surrogate key from all fields of a bronze record, nested ones included.

    Replaying the same input gives the same key, so idempotent sinks see a
    replay, and exact copies of a record, as one record.  Records that differ in
    any field have different keys; an absent field counts as null.
    """
    fields = [f.name for f in schemas.layer_schema("bronze").fields if f.name in bronze.columns]
    # One JSON text: an expression per field would make Spark's inferred constraints explode.
    return F.sha2(F.concat_ws("", F.to_json(F.struct(*fields))), 256)


def clean_event(bronze: DataFrame, as_of: Column | None = None,
                keep: tuple[str, ...] = ()) -> DataFrame:
    """Normalise bronze records into silver records in one projection.

    ``as_of`` stands in for missing or unreadable event times (default: now).
    ``keep`` names further input columns to carry along.
    """
    as_of = F.current_timestamp() if as_of is None else as_of
    col = F.col
    time = c.clean_timestamp(col("timestamp"), as_of)
    ingest = c.clean_optional_timestamp(col("log_metadata.ingestion_time"), as_of)
    src = c.clean_ip(col("source_ip"), "source_ip")
    dst = c.clean_ip(col("destination_ip"), "destination_ip")
    severity = c.clean_severity(col("severity"))
    action = c.clean_action(col("action"))
    kind = c.clean_event_type(col("event_type"))
    domain = c.clean_domain(col("destination_domain"))
    sport = c.clean_port(col("source_port"))
    dport = c.clean_port(col("destination_port"))
    # Warning order is part of the record.
    warnings = given(*[x.warning for x in (
        time, src, dst, severity, action, kind, domain, ingest, sport, dport)])
    no_text = F.array().cast("array<string>")
    return bronze.select(
        stable_id(bronze).alias("id"),
        col("id").alias("original_id"),
        time.value.alias("event_time"),
        ingest.value.alias("ingestion_time"),
        src.value.alias("source_ip"),
        dst.value.alias("destination_ip"),
        domain.value.alias("destination_domain"),
        sport.value.alias("source_port"),
        dport.value.alias("destination_port"),
        c.upper_or_null(col("protocol")).alias("protocol"),
        c.upper_or_null(col("application")).alias("application"),
        c.counter(col("bytes_sent")).alias("bytes_sent"),
        c.counter(col("bytes_received")).alias("bytes_received"),
        c.counter(col("packet_count")).alias("packet_count"),
        c.counter(col("duration_ms")).alias("duration_ms"),
        kind.value.alias("event_type"),
        severity.value.alias("severity"),
        action.value.alias("action"),
        "connection_state",
        c.clean_tcp_flags(col("tcp_flags")).alias("tcp_flags"),
        "response_code",
        c.clean_user(col("user")).alias("user"),
        "device_name",
        "log_metadata.source_type", "log_metadata.pipeline", "log_metadata.collector",
        "network_details.network_segment", "network_details.security_zone",
        "geo_location",
        "vlan_id",
        F.coalesce("asset_tags", no_text).alias("asset_tags"),
        "rule_id",
        "correlation_id",
        "policy_violation",
        F.coalesce("threat_indicators", no_text).alias("threat_indicators"),
        "resource_utilization.process_name", "resource_utilization.process_id",
        "resource_utilization.cpu_percent", "resource_utilization.memory_percent",
        F.lit(CLEANING_VERSION).alias("cleaning_version"),
        warnings.alias("cleaning_warnings"),
        *keep)


def dedup(silver: DataFrame, keys: list[str] | None = None,
          order: tuple[str, ...] = ("event_time", "id"), watermark: str | None = None) -> DataFrame:
    """One record per key: the earliest in batch, the first seen in a stream.

    The batch form is an aggregate, so a key holding a large share of all rows
    is reduced inside each map task before anything is shuffled.
    """
    keys = keys or ["original_id"]
    if silver.isStreaming:
        if watermark:
            silver = silver.withWatermark("event_time", watermark)
        return silver.dropDuplicatesWithinWatermark(keys)
    rest = [x for x in silver.columns if x not in keys]
    kept = silver.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("__kept"))
    return kept.select(*[F.col(f"__kept.{x}").alias(x) if x in rest else F.col(x)
                         for x in silver.columns])


WARNING_KINDS = {
    "missing timestamp%": "timestamp missing",
    "timestamp %": "timestamp without zone",
    "unparseable timestamp%": "timestamp unreadable",
    "invalid IP in source_ip%": "source ip invalid",
    "invalid IP in destination_ip%": "destination ip invalid",
    "invalid domain%": "domain invalid",
    "invalid port%": "port invalid",
    "missing severity%": "severity missing",
    "unknown severity%": "severity unknown",
    "unknown action%": "action unknown",
    "missing event_type%": "event type missing",
}


def warning_breakdown(silver: DataFrame) -> DataFrame:
    """Records per kind of warning, and records with and without any."""
    status = F.when(F.size("cleaning_warnings") > 0, F.lit("any warning")).otherwise("clean")
    kinds = F.array_distinct(F.transform("cleaning_warnings", _kind))
    return (silver.select(F.explode(F.concat(F.array(status), kinds)).alias("kind"))
            .groupBy("kind").agg(F.count("*").alias("events")))


def _kind(text: Column) -> Column:
    kind = F.lit("other")
    for pattern, label in reversed(WARNING_KINDS.items()):
        kind = F.when(text.like(pattern), F.lit(label)).otherwise(kind)
    return kind
