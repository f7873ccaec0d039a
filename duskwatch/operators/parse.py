"""Strict decoding of JSON messages into typed records, with dead letters.

Decoding keeps apart what ``from_json`` merges: an absent key, an explicit
null and a value of the wrong type.  A record is good when it has no problems;
otherwise it goes to the dead letters with its problems as the error text.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from duskwatch import schemas
from duskwatch.functions.plan import settled
from duskwatch.functions.text import JSON_TIME
from duskwatch.operators.deadletter import dead_letters
from duskwatch.operators.interval import aggregation_type

DOC, KEYS = "__doc", "__keys"

# Field kinds of the bronze record, in record order.
LOG_METADATA = {"collector": "text", "source_type": "text", "ingestion_time": "text",
                "pipeline": "text"}
NETWORK_DETAILS = {"network_segment": "text", "subnet": "text", "security_zone": "text"}
POLICY_VIOLATION = {"policy_name": "text", "violation_type": "text", "policy_severity": "text"}
RESOURCE_UTILIZATION = {"cpu_percent": "number", "memory_percent": "number",
                        "disk_io_percent": "number", "process_name": "text",
                        "process_id": "integer"}
BRONZE_FIELDS = {
    "id": "required text", "timestamp": "required text",
    "source_ip": "text", "destination_ip": "text", "destination_domain": "text",
    "source_port": "integer", "destination_port": "integer", "protocol": "text",
    "application": "text", "action": "text", "bytes_sent": "integer",
    "bytes_received": "integer", "packet_count": "integer", "duration_ms": "integer",
    "event_type": "text", "severity": "text", "user": "text", "correlation_id": "text",
    "device_name": "text", "vlan_id": "integer", "geo_location": "text", "user_agent": "text",
    "log_metadata": LOG_METADATA, "network_details": NETWORK_DETAILS,
    "connection_state": "text", "tcp_flags": "text", "policy_violation": POLICY_VIOLATION,
    "asset_tags": "text list", "session_details": "any",
    "resource_utilization": RESOURCE_UTILIZATION, "response_code": "integer",
    "threat_indicators": "any list", "rule_id": "text", "reason": "text",
    "description": "text", "raw": "document",
}

SILVER_FIELDS = {
    "id": "required text", "original_id": "required text", "event_time": "required text",
    "ingestion_time": "text", "source_ip": "text", "destination_ip": "text",
    "destination_domain": "text", "source_port": "integer", "destination_port": "integer",
    "protocol": "text", "application": "text", "bytes_sent": "count", "bytes_received": "count",
    "packet_count": "count", "duration_ms": "count", "event_type": "required text",
    "severity": "required INFO|LOW|MEDIUM|HIGH|CRITICAL", "action": "ALLOW|BLOCK|ALERT|DROP",
    "connection_state": "text", "tcp_flags": "text list", "response_code": "integer",
    "user": "text", "device_name": "text", "source_type": "text", "pipeline": "text",
    "collector": "text", "network_segment": "text", "security_zone": "text",
    "geo_location": "text", "vlan_id": "integer", "asset_tags": "text list", "rule_id": "text",
    "correlation_id": "text", "policy_violation": POLICY_VIOLATION,
    "threat_indicators": "any list", "process_name": "text", "process_id": "integer",
    "cpu_percent": "number", "memory_percent": "number", "cleaning_version": "text",
    "cleaning_warnings": "text list",
}

BASELINE_STATS = {"current_count": "integer", "rolling_average": "number",
                  "multiplier": "number", "threshold": "number", "windows_in_baseline": "integer"}
FINDING_FIELDS = {
    "id": "required text", "source_ip": "text", "source_event_type": "text",
    "event_time": "text", "description": "text", "event_count": "integer", "first_seen": "text",
    "last_seen": "text", "window_minutes": "integer", "unique_dest_ips": "integer",
    "unique_dest_ports": "integer", "total_bytes_sent": "integer", "velocity_key": "text",
    "baseline_stats": BASELINE_STATS, "triggering_event": "optional document", "pattern": "text",
    "chain": "optional document",
}

INTEGER_TEXT = r"^\s*[+-]?\d+(?:\.0*)?\s*$"
NUMBER_TEXT = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$"


class Field(NamedTuple):
    value: Column
    problem: Column      # NULL when the field is fine


def _get(item: Column, kind: str) -> Column:
    return F.try_variant_get(item, "$", kind)


def _kind_of(item: Column) -> Column:
    """JSON type name: NULL when the key is absent, VOID for an explicit null."""
    return F.schema_of_variant(item)


def _keys(item: Column, fields: dict) -> Column:
    """The named keys of a JSON object, each still a JSON value."""
    return _get(item, "struct<" + ",".join(f"`{name}`:variant" for name in fields) + ">")


def _text(item, name, required):
    kind = _kind_of(item)
    bad = (kind.isNull() | (kind != "STRING")) if required else ~kind.isin("STRING", "VOID")
    return Field(F.when(kind == "STRING", _get(item, "string")),
                 F.when(bad, F.lit(f"{name}: expected text")))


def _one_of(item, name, options, required):
    text = _text(item, name, required)
    bad = ~text.value.isin(*options)
    return Field(text.value, F.coalesce(
        text.problem, F.when(bad, F.lit(f"{name}: expected one of {', '.join(options)}"))))


def _integer(item, name):
    kind = _kind_of(item)
    text = _get(item, "string")
    value = (F.when(kind.isin("BIGINT", "BOOLEAN"), _get(item, "bigint"))
             .when(kind == "STRING", F.when(
                 text.rlike(INTEGER_TEXT),
                 F.regexp_replace(text, r"\s|\.0*\s*$", "").try_cast("bigint")))
             .when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), F.when(
                 _get(item, "double") == F.floor(_get(item, "double")), _get(item, "bigint"))))
    return Field(value, F.when(kind.isNotNull() & (kind != "VOID") & value.isNull(),
                               F.lit(f"{name}: expected integer")))


def _count(item, name):
    """Integer that may be absent (0) but not null."""
    inner, kind = _integer(item, name), _kind_of(item)
    return Field(F.coalesce(inner.value, F.lit(0).cast("bigint")), F.coalesce(
        inner.problem, F.when(kind == "VOID", F.lit(f"{name}: expected integer"))))


def _number(item, name):
    kind = _kind_of(item)
    text = _get(item, "string")
    value = (F.when(kind == "STRING",
                    F.when(text.rlike(NUMBER_TEXT), F.trim(text).try_cast("double")))
             .when(~kind.startswith("OBJECT") & ~kind.startswith("ARRAY"), _get(item, "double")))
    return Field(value, F.when(kind.isNotNull() & (kind != "VOID") & value.isNull(),
                               F.lit(f"{name}: expected number")))


def _text_list(item, name):
    kind = _kind_of(item)
    items = _get(item, "array<string>")
    good = kind.isin("ARRAY<STRING>", "ARRAY<VOID>") & ~F.exists(items, lambda x: x.isNull())
    return Field(F.when(good, items).otherwise(F.array().cast("array<string>")),
                 F.when(kind.isNotNull() & ~good, F.lit(f"{name}: expected list of text")))


def _any_list(item, name):
    kind = _kind_of(item)
    items = F.transform(
        _get(item, "array<variant>"),
        lambda x: F.coalesce(F.try_variant_get(x, "$", "string"), F.to_json(x)))
    return Field(F.coalesce(items, F.array().cast("array<string>")),
                 F.when(kind.isNotNull() & ~kind.startswith("ARRAY"),
                        F.lit(f"{name}: expected list")))


def _document(item, name):
    kind = _kind_of(item)
    return Field(_get(item, "variant"),
                 F.when(kind.isNotNull() & ~kind.startswith("OBJECT"),
                        F.lit(f"{name}: expected object")))


def _optional_document(item, name):
    kind = _kind_of(item)
    return Field(F.when(kind.startswith("OBJECT"), F.to_json(item)),
                 F.when(~kind.startswith("OBJECT") & (kind != "VOID"),
                        F.lit(f"{name}: expected object")))


def _record(item, keys, name, fields):
    kind = _kind_of(item)
    inner = _decode(keys, fields, prefix=f"{name}.")
    is_object = kind.startswith("OBJECT")
    value = F.when(is_object, F.struct(*[f.value.alias(n) for n, f in inner.items()]))
    problem = (F.when(is_object, F.nullif(
                   F.concat_ws("; ", *[f.problem for f in inner.values()]), F.lit("")))
               .when(kind != "VOID", F.lit(f"{name}: expected object")))
    return Field(value, problem)


def _decode(keys: str, fields: dict, prefix: str = "") -> dict[str, Field]:
    """Fields of an object whose keys were taken apart into the column ``keys``."""
    decoded = {}
    for name, kind in fields.items():
        item, shown = F.col(f"{keys}.{name}"), prefix + name
        if isinstance(kind, dict):
            decoded[name] = _record(item, f"__{name}", shown, kind)
            continue
        required = kind.startswith("required ")
        kind = kind.removeprefix("required ")
        if kind == "text":
            decoded[name] = _text(item, shown, required)
        elif "|" in kind:
            decoded[name] = _one_of(item, shown, kind.split("|"), required)
        elif kind == "any":
            decoded[name] = Field(item, F.lit(None).cast("string"))
        else:
            decoded[name] = {"integer": _integer, "count": _count, "number": _number,
                             "text list": _text_list, "any list": _any_list,
                             "document": _document,
                             "optional document": _optional_document}[kind](item, shown)
    return decoded


def decode_records(df: DataFrame, fields: dict, value: str = "value") -> DataFrame:
    """Add ``record`` (typed struct) and ``error`` (NULL when good) to messages.

    The text must hold exactly one JSON object.  It is parsed once, as the only
    element of an array, so that trailing text is noticed; texts in which a
    bracket follows a brace could close that array early and are checked again.
    """
    text = F.col(value)
    boxed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    docs = df.withColumn(DOC, boxed)
    single = (
        F.col(DOC).isNotNull() & F.ltrim(F.regexp_replace(text, r"^\s+", "")).startswith("{")
        & F.try_variant_get(F.col(DOC), "$[1]", "variant").isNull()
        & F.when(text.rlike(r"\}\s*\]"), F.try_parse_json(
            F.concat(F.lit('{"w":'), text, F.lit("}"))).isNotNull()).otherwise(F.lit(True)))
    # Keys are taken apart first, then the keys of nested objects, then values.
    docs = docs.withColumn(KEYS, F.when(single, _keys(
        F.try_variant_get(F.col(DOC), "$[0]", "variant"), fields)))
    docs = docs.select("*", *[_keys(F.col(f"{KEYS}.{name}"), kind).alias(f"__{name}")
                              for name, kind in fields.items() if isinstance(kind, dict)])
    decoded = _decode(KEYS, fields)
    problems = F.concat_ws("; ", *[f.problem for f in decoded.values()])
    error = (F.when(text.isNull(), F.lit("message: empty or not UTF-8"))
             .when(F.col(KEYS).isNull(), F.lit("message: not a JSON object"))
             .otherwise(F.nullif(problems, F.lit(""))))
    record = F.struct(*[f.value.alias(n) for n, f in decoded.items()])
    # Otherwise the split by error would decode every message twice.
    return settled(docs.select(*df.columns, record.alias("record"), error.alias("error")),
                   "record", "error")


def _split(df, fields, value, topic, stage, as_of, *carried):
    parsed = decode_records(df, fields, value)
    good = parsed.where(F.col("error").isNull()).select("record.*", *carried)
    dead = dead_letters(parsed.where(F.col("error").isNotNull()), stage=stage, message=value,
                        topic=topic, as_of=as_of)
    return good, dead


def parse_bronze(df: DataFrame, value: str = "value", topic: str = "topic",
                 as_of=None, received: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Messages -> (bronze records, dead letters of stage ``parse``).

    ``received`` names the column with a message's arrival time; records carry it
    on as ``received_at``, to stand in for event times that cannot be read.
    """
    carried = [F.col(received).alias("received_at")] if received else []
    return _split(df, BRONZE_FIELDS, value, topic, "parse", as_of, *carried)


def parse_silver(df: DataFrame, value: str = "value", topic: str = "topic",
                 as_of=None) -> tuple[DataFrame, DataFrame]:
    """Silver messages -> (silver records, dead letters of stage ``enrich-parse``).

    A silver message whose event time cannot be read is dead as well: every
    later step needs it.
    """
    parsed = decode_records(df, SILVER_FIELDS, value)
    when = F.try_to_timestamp(F.col("record.event_time"))
    parsed = parsed.withColumn("error", F.coalesce(
        "error", F.when(when.isNull(), F.lit("event_time: expected timestamp"))))
    casts = {f.name: f.dataType for f in schemas.layer_schema("silver").fields}
    record = [
        (F.try_to_timestamp(F.col(f"record.{n}")) if n in ("event_time", "ingestion_time")
         else F.col(f"record.{n}").try_cast(t) if n in ("source_port", "destination_port")
         else F.coalesce(F.col(f"record.{n}"), F.lit("1.0")) if n == "cleaning_version"
         else F.col(f"record.{n}")).alias(n)
        for n, t in casts.items()]
    good = parsed.where(F.col("error").isNull()).select(*record)
    dead = dead_letters(parsed.where(F.col("error").isNotNull()), stage="enrich-parse",
                        message=value, topic=topic, as_of=as_of)
    return good, dead


def parse_gold(df: DataFrame, value: str = "value", topic: str = "topic",
               as_of=None) -> tuple[DataFrame, DataFrame]:
    """Messages of the gold topic -> (nested gold records, dead letters of stage ``gold-parse``).

    The engine writes these itself, so they are read by schema; a message that does not
    hold a record with an id and an event time is dead.
    """
    schema = schemas.layer_schema("gold")
    parsed = df.withColumn("record", F.from_json(value, schema, {"timestampFormat": JSON_TIME}))
    error = (F.when(F.col("record.silver.id").isNull(), F.lit("silver.id: missing"))
             .when(F.col("record.silver.event_time").isNull(), F.lit("silver.event_time: expected timestamp"))
             .when(F.col("record.threat_score").isNull(), F.lit("threat_score: expected integer")))
    parsed = settled(parsed.withColumn("error", error), "record", "error")
    dead = dead_letters(parsed.where(F.col("error").isNotNull()), stage="gold-parse",
                        message=value, topic=topic, as_of=as_of)
    return parsed.where(F.col("error").isNull()).select("record.*"), dead


def parse_findings(df: DataFrame, value: str = "value", topic: str = "topic",
                   as_of=None, received: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Messages of the finding topics -> (aggregation records, dead letters).

    The kind of finding follows from the topic a message came from.  A finding without a
    readable time gets its message's time where ``received`` names it.
    """
    parsed = decode_records(df, FINDING_FIELDS, value)
    good, kind = parsed.where(F.col("error").isNull()), aggregation_type(F.col(topic))
    columns = []
    for field in schemas.layer_schema("aggregation").fields:
        source, name = F.col(f"record.{field.name}"), field.name
        if name == "aggregation_type":
            columns.append(kind.alias(name))
        elif name in ("aggregated", "correlated"):
            columns.append((F.lit(True) if name == "aggregated" else kind == "cep_chain").alias(name))
        elif name == "enrichment_summary":
            columns.append(F.lit(None).cast(field.dataType).alias(name))
        elif field.dataType.typeName() == "timestamp":
            at = F.try_to_timestamp(source)
            columns.append((F.coalesce(at, F.col(received)) if received and name == "event_time" else at).alias(name))
        elif field.dataType.typeName() == "struct":
            columns.append(source.cast(field.dataType).alias(name))
        else:
            columns.append(source.try_cast(field.dataType).alias(name))
    dead = dead_letters(parsed.where(F.col("error").isNotNull()), stage="aggregate-parse",
                        message=value, topic=topic, as_of=as_of)
    return good.select(*columns), dead
