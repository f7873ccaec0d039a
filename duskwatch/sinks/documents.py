"""Field types of the search documents, and the check that a record fits them.

A search index takes a document whole or not at all, so one value beyond its field's type
would lose the record without a trace.  Records that do not fit become dead letters here;
the warm tables, whose columns are wider, still take them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from duskwatch.functions.cleaning import DOTTED_QUAD, instant
from duskwatch.functions.text import json_text
from duskwatch.operators.deadletter import dead_letters

# Field types of the two kinds of documents.  Fields that are not listed are
# text, or objects of any shape.
EVENT_FIELDS = {
    "date": ("silver.event_time", "silver.ingestion_time"),
    "ip": ("silver.source_ip", "silver.destination_ip"),
    "long": ("silver.bytes_sent", "silver.bytes_received"),
    "integer": ("silver.source_port", "silver.destination_port", "silver.packet_count", "silver.duration_ms",
                "silver.response_code", "silver.vlan_id", "silver.process_id", "threat_score",
                "processing_time_ms"),
    "float": ("silver.cpu_percent", "silver.memory_percent"),
    "boolean": ("routed",),
}
AGGREGATION_FIELDS = {
    "date": ("event_time", "first_seen", "last_seen"),
    "ip": ("source_ip",),
    "long": ("total_bytes_sent",),
    "integer": ("window_minutes", "event_count", "unique_dest_ips", "unique_dest_ports",
                "baseline_stats.current_count", "baseline_stats.windows_in_baseline",
                "enrichment_summary.max_threat_score", "enrichment_summary.avg_threat_score"),
    "float": ("baseline_stats.rolling_average", "baseline_stats.multiplier", "baseline_stats.threshold"),
    "boolean": ("aggregated", "correlated"),
    "object": ("chain",),
}
DOCUMENTS = {"events": EVENT_FIELDS, "aggregations": AGGREGATION_FIELDS}

INTEGER_MAX, FLOAT_MAX = 2 ** 31 - 1, 3.4028234663852886e38
IPV6 = r"^(?=.*:)[0-9A-Fa-f:]{2,39}(?:\d{1,3}(?:\.\d{1,3}){3})?$"


def _type_at(schema: T.StructType, path: str) -> T.DataType | None:
    """Type of a nested field, None if the records lack it."""
    kind: T.DataType = schema
    for name in path.split("."):
        if not isinstance(kind, T.StructType) or name not in kind.names:
            return None
        kind = kind[name].dataType
    return kind


def fits(value: Column, kind: str, stored: T.DataType) -> Column:
    """Whether a value that is not NULL can be indexed as a field of that type."""
    text = isinstance(stored, T.StringType)
    if kind == "date":
        return instant(value).isNotNull() if text else F.lit(isinstance(stored, (T.TimestampType, T.DateType)))
    if kind == "ip":
        return value.rlike(DOTTED_QUAD) | value.rlike(IPV6) if text else F.lit(False)
    if kind in ("integer", "long"):
        number = value.try_cast("decimal(38,0)") if text else value
        whole = isinstance(stored, (T.IntegralType, T.StringType))
        limit = INTEGER_MAX if kind == "integer" else 2 ** 63 - 1
        return F.coalesce(number.between(-limit - 1, limit), F.lit(False)) if whole else F.lit(False)
    if kind == "float":
        number = value.try_cast("double")
        return F.coalesce(~F.isnan(number) & (F.abs(number) <= FLOAT_MAX), F.lit(False))
    if kind == "boolean":
        return value.isin("true", "false") if text else F.lit(isinstance(stored, T.BooleanType))
    if kind == "object":
        if not text:
            return F.lit(isinstance(stored, (T.StructType, T.MapType)))
        return F.coalesce(F.schema_of_variant(F.try_parse_json(value)).startswith("OBJECT"), F.lit(False))
    raise ValueError(f"unknown field type: {kind}")


def conform(records: DataFrame, kind: str, topic: str, as_of: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(records that fit their document kind, dead letters of stage ``document``).

    ``kind`` is ``events`` (nested gold records) or ``aggregations``.  NULL fits every
    field, and so does a field the records lack.  The error names all fields at fault.
    """
    problems = []
    for field_type, paths in DOCUMENTS[kind].items():
        for path in paths:
            stored = _type_at(records.schema, path)
            if stored is not None:
                wrong = F.col(path).isNotNull() & ~fits(F.col(path), field_type, stored)
                problems.append(F.when(wrong, F.lit(f"{path}: not {field_type}")))
    checked = records.withColumn("error", F.nullif(F.concat_ws("; ", *problems), F.lit("")))
    failed = checked.where(F.col("error").isNotNull()).select(
        "error", json_text(F.struct(*records.columns)).alias("value"),
        F.col("silver.event_time" if kind == "events" else "event_time").alias("event_time"))
    dead = dead_letters(failed, stage="document", topic=topic, as_of=F.col("event_time") if as_of is None else as_of)
    return checked.where(F.col("error").isNull()).drop("error"), dead
