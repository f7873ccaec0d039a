"""Layer schemas as DDL text, and a conformity check."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

POLICY = "struct<policy_name:string,violation_type:string,policy_severity:string>"

BRONZE = f"""
    id string, timestamp string,
    source_ip string, destination_ip string, destination_domain string,
    source_port bigint, destination_port bigint, protocol string, application string,
    action string, bytes_sent bigint, bytes_received bigint, packet_count bigint,
    duration_ms bigint, event_type string, severity string, user string,
    correlation_id string, device_name string, vlan_id bigint, geo_location string,
    user_agent string,
    log_metadata struct<collector:string,source_type:string,ingestion_time:string,pipeline:string>,
    network_details struct<network_segment:string,subnet:string,security_zone:string>,
    connection_state string, tcp_flags string, policy_violation {POLICY},
    asset_tags array<string>, session_details variant,
    resource_utilization struct<cpu_percent:double,memory_percent:double,
        disk_io_percent:double,process_name:string,process_id:bigint>,
    response_code bigint, threat_indicators array<string>, rule_id string,
    reason string, description string, raw variant
"""

SILVER = f"""
    id string, original_id string, event_time timestamp, ingestion_time timestamp,
    source_ip string, destination_ip string, destination_domain string,
    source_port int, destination_port int, protocol string, application string,
    bytes_sent bigint, bytes_received bigint, packet_count bigint, duration_ms bigint,
    event_type string, severity string, action string, connection_state string,
    tcp_flags array<string>, response_code bigint, user string, device_name string,
    source_type string, pipeline string, collector string, network_segment string,
    security_zone string, geo_location string, vlan_id bigint, asset_tags array<string>,
    rule_id string, correlation_id string, policy_violation {POLICY},
    threat_indicators array<string>, process_name string, process_id bigint,
    cpu_percent double, memory_percent double, cleaning_version string,
    cleaning_warnings array<string>
"""

IP_REPUTATION = ("struct<ip:string,is_malicious:boolean,threat_types:array<string>,"
                 "country:string,abuse_score:int,source:string>")
ASSET_CONTEXT = ("struct<host:string,criticality:int,environment:string,owner:string,"
                 "internet_facing:boolean>")
IDENTITY_CONTEXT = ("struct<user:string,is_privileged:boolean,is_service_acct:boolean,"
                    "recent_offboard:boolean,risk_score:int>")

GOLD = f"""
    silver struct<{SILVER}>, ip_reputation {IP_REPUTATION}, asset_context {ASSET_CONTEXT},
    identity_context {IDENTITY_CONTEXT}, threat_score int, score_breakdown map<string,int>,
    recommended_action string, narrative string, mitre_tactic string,
    enrichment_version string, processing_time_ms int, routed boolean
"""

BASELINE_STATS = ("struct<current_count:int,rolling_average:double,multiplier:double,"
                  "threshold:double,windows_in_baseline:int>")
ENRICHMENT_SUMMARY = (
    "struct<max_threat_score:int,avg_threat_score:int,recommended_action:string,"
    f"mitre_tactic:string,narrative:string,ip_reputation:{IP_REPUTATION},"
    f"asset_context:{ASSET_CONTEXT},identity_context:{IDENTITY_CONTEXT},"
    "source_event_ids:array<string>,gold_events_found:int>")

AGGREGATION = f"""
    id string, aggregation_type string, source_ip string, source_event_type string,
    event_time timestamp, description string, event_count int, first_seen timestamp,
    last_seen timestamp, window_minutes int, unique_dest_ips int, unique_dest_ports int,
    total_bytes_sent bigint, velocity_key string, baseline_stats {BASELINE_STATS},
    triggering_event string, pattern string, chain string, aggregated boolean,
    correlated boolean, enrichment_summary {ENRICHMENT_SUMMARY}
"""

DEAD_LETTER = """
    original_message string, error string, stage string, timestamp timestamp, topic string
"""

IP_INTEL = """
    ip string, abuse_score int, country string, geo_country string, category_ids array<int>,
    pulse_count int, pulses array<struct<tags:array<string>,attack_ids:array<string>>>
"""

LAYERS = {
    "bronze": BRONZE, "silver": SILVER, "gold": GOLD,
    "aggregation": AGGREGATION, "dead_letter": DEAD_LETTER, "ip_intel": IP_INTEL,
}


def layer_schema(layer: str) -> T.StructType:
    """Spark schema of a named layer (needs an active session)."""
    return T.StructType.fromDDL(" ".join(LAYERS[layer].split()))


def _describe(schema: T.StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def assert_schema(df: DataFrame, layer: str, partial: bool = False) -> DataFrame:
    """Raise when ``df`` departs from the layer's declared columns or types.

    ``partial`` allows declared columns to be absent (union records).
    """
    want, have = _describe(layer_schema(layer)), _describe(df.schema)
    wrong = [f"{name}: {have[name]} is not {want[name]}"
             for name in have if name in want and have[name] != want[name]]
    extra = [name for name in have if name not in want]
    missing = [] if partial else [name for name in want if name not in have]
    if wrong or extra or missing:
        raise ValueError(f"{layer} schema mismatch: types {wrong}, extra {extra}, missing {missing}")
    return df
