"""Log records inside reply texts that hold a JSON array."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from duskwatch.functions.text import outer_fences
from duskwatch.operators.parse import (LOG_METADATA, NETWORK_DETAILS, POLICY_VIOLATION,
                                       RESOURCE_UTILIZATION)

# Types each element must have, stricter than those of a bronze message: a text
# is a text, an integer is an integer; a null leaves the field empty.
ENTRY_FIELDS = {
    "id": "text", "timestamp": "text", "source_ip": "text", "destination_ip": "text",
    "destination_domain": "text", "source_port": "integer", "destination_port": "integer",
    "protocol": "text", "application": "text", "action": "text", "bytes_sent": "integer",
    "bytes_received": "integer", "packet_count": "integer", "duration_ms": "integer",
    "event_type": "text", "severity": "text", "user": "text", "correlation_id": "text",
    "device_name": "text", "vlan_id": "integer", "geo_location": "text", "user_agent": "text",
    "log_metadata": LOG_METADATA, "network_details": NETWORK_DETAILS,
    "connection_state": "text", "tcp_flags": "text", "policy_violation": POLICY_VIOLATION,
    "asset_tags": "text list", "resource_utilization": RESOURCE_UTILIZATION,
    "response_code": "integer", "threat_indicators": "text list", "rule_id": "text",
    "description": "text", "reason": "text", "alert_id": "text", "file_hash": "text",
    "malware_family": "text",
}


def _fits(path, kind):
    found = F.schema_of_variant(F.try_variant_get(F.col("entry"), path, "variant"))
    absent = found.isNull() | (found == "VOID")
    if isinstance(kind, dict):
        ok = found.startswith("OBJECT")
        for name, inner in kind.items():
            ok = ok & _fits(f"{path}.{name}", inner)
        return absent | ok
    if kind == "text":
        return absent | (found == "STRING")
    if kind == "integer":
        return absent | (found == "BIGINT")
    if kind == "number":
        return absent | (found == "BIGINT") | (found == "DOUBLE") | found.startswith("DECIMAL")
    return absent | found.isin("ARRAY<STRING>", "ARRAY<VOID>")


def entries(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """One row per readable element of each reply: input columns, ``position``, ``entry``.

    A reply that is not a JSON array gives no rows.  An element that is not a
    log record is left out, its neighbours stay.
    """
    boxed = F.try_parse_json(F.concat(F.lit('{"w":'), outer_fences(F.col(reply)), F.lit("}")))
    items = F.try_variant_get(boxed, "$.w", "array<variant>")
    rows = replies.select("*", F.posexplode(items).alias("position", "entry"))
    shape = F.schema_of_variant("entry")
    good = shape.startswith("OBJECT") | (shape == "VOID")
    for name, kind in ENTRY_FIELDS.items():
        good = good & _fits(f"$.{name}", kind)
    return rows.where(good)


def entry_messages(replies: DataFrame, topic: str, reply: str = "reply") -> DataFrame:
    """Readable elements as bronze messages."""
    return entries(replies, reply).select(
        F.try_variant_get("entry", "$.id", "string").alias("key"),
        F.to_json("entry").alias("value"), F.lit(topic).alias("topic"))
