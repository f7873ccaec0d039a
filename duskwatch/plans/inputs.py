"""Security records derived from the general ``events`` and ``supplier`` tables.

The mapping is written as SQL that Spark and DuckDB both read, so that a check
can start from the same records.  It spells values the way raw logs do: mixed
case, synonyms, ports glued to addresses, missing zones, absent fields.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from duskwatch.functions.plan import spread

AS_OF = "2024-02-01 00:00:00"

SPARK = {
    "date": "date_format({0}, 'yyyy-MM-dd')", "clock": "date_format({0}, 'HH:mm:ss.SSSSSS')",
    "div": "div",
}
DUCKDB = {
    "date": "strftime({0}, '%Y-%m-%d')", "clock": "strftime({0}, '%H:%M:%S.%f')",
    "div": "//",
}


def _stamp(at: str, joint: str, dialect: dict) -> str:
    return f"{dialect['date'].format(at)} || '{joint}' || {dialect['clock'].format(at)}"


def record_fields(dialect: dict) -> dict[str, str]:
    """Raw fields of one log record per row of ``events``."""
    iso = f"{_stamp('ts', 'T', dialect)} || 'Z'"
    naive = _stamp("ts", " ", dialect)
    shifted = _stamp("(ts - interval '5' hour)", "T", dialect)
    later = "(ts + interval '1' second)"
    address = "'10.0.0.' || cast(user_id % 20 + 1 as string)"
    kind = ("case event_type when 'error' then 'FAILED_LOGIN' when 'signup' then 'SSH_ATTEMPT' "
            "when 'purchase' then 'PORT_SCAN' when 'click' then 'HTTPS_CONNECTION' "
            "else 'DNS_QUERY' end")
    user = ("case user_id % 10 when 0 then 'admin' when 1 then 'svc-deploy' "
            "when 2 then 'john.doe.old' else 'user.' || cast(user_id as string) end")
    return {
        "n": "event_id",
        "id_text": "'log_' || cast(event_id as string)",
        "time_text": f"case when event_id % 211 = 0 then 'nope' when event_id % 223 = 0 then '' "
                     f"when event_id % 13 = 0 then {naive} "
                     f"when event_id % 19 = 0 then {shifted} || '-05:00' else {iso} end",
        "src_text": f"case when event_id % 101 = 0 then '256.1.1.1' when event_id % 103 = 0 then '' "
                    f"when event_id % 107 = 0 then null when event_id % 109 = 0 then '::1' "
                    f"when event_id % 17 = 0 then {address} || ':4444' else {address} end",
        "dst_text": "case when event_id % 113 = 0 then '01.2.3.4' "
                    "else '10.1.0.' || cast(event_id % 40 + 1 as string) end",
        "domain_text": "case when event_id % 197 = 0 then repeat('x', 254) else "
                       "case event_id % 12 when 0 then null when 1 then ' Docs.Example.COM ' "
                       "when 2 then 'a b' when 3 then '  ' "
                       "else 'host' || cast(event_id % 25 as string) || '.example.com' end end",
        "sport": "case when event_id % 127 = 0 then -1 when event_id % 131 = 0 then 65536 "
                 "when event_id % 137 = 0 then null else 1024 + event_id % 60000 end",
        "dport": "case when event_id % 139 = 0 then 70000 else "
                 "case event_id % 4 when 0 then 22 when 1 then 443 when 2 then 445 "
                 "else 3389 end end",
        "protocol_text": "case when event_id % 29 = 0 then '' when event_id % 31 = 0 then null "
                         "else 'tcp' end",
        "application_text": "case event_id % 4 when 0 then 'ssh' when 1 then 'https' "
                            "when 2 then 'smb' else 'rdp' end",
        "action_text": "case when event_id % 149 = 0 then 'bogus' when event_id % 151 = 0 then null "
                       "when event_id % 157 = 0 then 'monitor' else "
                       "case event_id % 12 when 0 then 'ALLOW' when 3 then 'permit' "
                       "when 6 then ' Pass ' when 9 then 'allow' when 1 then 'BLOCK' "
                       "when 4 then 'deny' when 7 then 'Block' when 10 then 'BLOCK' "
                       "when 2 then 'DROP' else ' drop ' end end",
        "type_text": f"case when event_id % 163 = 0 then null when event_id % 167 = 0 then '  ' "
                     f"when event_id % 7 = 0 then ' ' || lower({kind}) || ' ' else {kind} end",
        "severity_text": "case when event_id % 53 = 0 then null when event_id % 59 = 0 then 'bogus' "
                         "when event_id % 61 = 0 then '  ' "
                         "when value < 10 then case when event_id % 5 = 0 then 'info' else 'INFO' end "
                         "when value < 50 then case when event_id % 5 = 0 then ' Low' else 'LOW' end "
                         "when value < 100 then case when event_id % 5 = 0 then 'med' else 'MEDIUM' end "
                         "when value < 200 then 'HIGH' "
                         "else case when event_id % 5 = 0 then ' Crit ' else 'CRITICAL' end end",
        "user_text": f"case when event_id % 173 = 0 then '  ' when event_id % 179 = 0 then null "
                     f"when event_id % 11 = 0 then ' ' || upper({user}) || ' ' else {user} end",
        "sent": "case when event_id % 181 = 0 then -1 when event_id % 191 = 0 then null "
                "else cast(floor(value * 100) as bigint) end",
        "received": "event_id % 5000",
        "packets": "event_id % 100",
        "duration": "case when event_id % 37 = 0 then -1 else event_id % 3000 end",
        "correlation": "case when event_id % 6 = 0 then 'corr_' || cast(event_id % 1000 as string) end",
        "device": "case event_id % 8 when 0 then 'auth-server-01' when 1 then 'web-proxy' "
                  "when 2 then null when 3 then '' else 'ws-' || cast(user_id as string) end",
        "vlan": "event_id % 4094",
        "geo": "case user_id % 4 when 0 then 'Toronto, ON, CA' when 1 then 'Frankfurt, DE' "
               "when 2 then 'Kyiv, UA' end",
        "has_meta": "event_id % 9 <> 0",
        "source_kind": "case event_id % 2 when 0 then 'firewall' else 'edr_agent' end",
        "collector_text": "'collector-' || cast(event_id % 5 as string)",
        "ingest_text": f"case when event_id % 41 = 0 then '' when event_id % 23 = 0 then "
                       f"{_stamp(later, ' ', dialect)} else {_stamp(later, 'T', dialect)} || 'Z' end",
        "has_net": "event_id % 43 <> 0",
        "zone": "case when user_id % 5 = 0 then 'untrusted' else 'trusted' end",
        "state": "case event_id % 3 when 0 then 'ESTABLISHED' else 'CLOSED' end",
        "flags_text": "case event_id % 4 when 0 then 'ACK,PSH' when 1 then ' syn , ,ack' "
                      "when 2 then null else '' end",
        "has_policy": "event_id % 3 <> 0",
        "policy_level": "case when event_id % 47 = 0 then null else case event_id % 4 "
                        "when 0 then 'low' when 1 then 'Medium' when 2 then 'high' "
                        "else 'critical' end end",
        "tag": "case when event_id % 6 = 0 then 'production' "
               "when event_id % 6 = 1 then 'workstation' end",
        "has_load": "event_id % 4 = 0",
        "cpu": "cast(event_id % 1000 as double) / 10",
        "process": "'proc' || cast(event_id % 20 as string)",
        "process_no": "event_id % 30000",
        "response": "case event_id % 3 when 0 then 200 when 1 then null else 404 end",
        "indicator": "case when event_id % 50 = 0 then 'known_bad_ip' end",
        "rule": "'R-' || cast(event_id % 30 as string)",
    }


def _text(name: str, column: str) -> str:
    return f"'\"{name}\":' || coalesce('\"' || {column} || '\"', 'null')"


def _number(name: str, column: str) -> str:
    return f"'\"{name}\":' || coalesce(cast({column} as string), 'null')"


def _list(name: str, column: str) -> str:
    return f"'\"{name}\":' || coalesce('[\"' || {column} || '\"]', '[]')"


def _object(name: str, present: str, *fields: str) -> str:
    inner = " || ',' || ".join(fields)
    return f"'\"{name}\":' || case when {present} then '{{' || {inner} || '}}' else 'null' end"


def message_document() -> str:
    """JSON text of a record, some with a missing or mistyped field."""
    head = ("case when n % 97 = 0 then '' when n % 71 = 0 then '\"id\":5,' "
            "else '\"id\":\"' || id_text || '\",' end")
    port = ("case when n % 73 = 0 then '\"source_port\":1.5' "
            "when n % 67 = 0 then '\"source_port\":\"443\"' else "
            + _number("source_port", "sport") + " end")
    tags = ("case when n % 79 = 0 then '\"asset_tags\":null' else "
            + _list("asset_tags", "tag") + " end")
    extra = "case when n % 61 = 0 then ',\"alert_id\":\"A-1\"' else '' end"
    fields = [
        _text("timestamp", "time_text"), _text("source_ip", "src_text"),
        _text("destination_ip", "dst_text"), _text("destination_domain", "domain_text"), port,
        _number("destination_port", "dport"), _text("protocol", "protocol_text"),
        _text("application", "application_text"), _text("action", "action_text"),
        _number("bytes_sent", "sent"), _number("bytes_received", "received"),
        _number("packet_count", "packets"), _number("duration_ms", "duration"),
        _text("event_type", "type_text"), _text("severity", "severity_text"),
        _text("user", "user_text"), _text("correlation_id", "correlation"),
        _text("device_name", "device"), _number("vlan_id", "vlan"), _text("geo_location", "geo"),
        _object("log_metadata", "has_meta", _text("collector", "collector_text"),
                _text("source_type", "source_kind"), _text("ingestion_time", "ingest_text")),
        _object("network_details", "has_net", _text("security_zone", "zone")),
        _text("connection_state", "state"), _text("tcp_flags", "flags_text"),
        _object("policy_violation", "has_policy", _text("policy_severity", "policy_level")), tags,
        _object("resource_utilization", "has_load", _number("cpu_percent", "cpu"),
                _text("process_name", "process"), _number("process_id", "process_no")),
        _number("response_code", "response"), _list("threat_indicators", "indicator"),
        _text("rule_id", "rule")]
    return "'{' || " + head + " || " + " || ',' || ".join(fields) + " || " + extra + " || '}'"


# Message around a document (columns ``n, doc``): some are cut off, boxed or empty.
MESSAGE_TEXT = ("case when n % 199 = 0 then '' when n % 83 = 0 then left(doc, 200) "
                "when n % 89 = 0 then '[' || doc || ']' when n % 193 = 0 then doc || ' x' "
                "else doc end")


def reply_text() -> str:
    """Assessment reply to a scored event (columns ``n, event_type, source_ip, threat_score``)."""
    tier = ("case when threat_score >= 80 then 'contain' when threat_score >= 60 then 'page' "
            "when threat_score >= 40 then 'ticket' when threat_score >= 20 then 'digest' "
            "else 'archive' end")
    tactic = ("case event_type when 'FAILED_LOGIN' then '\"Credential Access\"' "
              "when 'SSH_ATTEMPT' then '\"Initial Access\"' "
              "when 'PORT_SCAN' then '\"Reconnaissance\"' else 'null' end")
    story = ("event_type || ' from ' || coalesce(source_ip, 'unknown') || ' scored ' "
             "|| cast(threat_score as string) || '.'")
    doc = (f"'{{\"recommended_action\":\"' || {tier} || '\",\"mitre_tactic\":' || {tactic} "
           f"|| ',\"narrative\":\"' || {story} || '\"}}'")
    return (f"case when n % 31 = 0 then 'I cannot assess this.' "
            f"when n % 37 = 0 then '{{\"recommended_action\":\"escalate\",\"mitre_tactic\":null}}' "
            f"when n % 41 = 0 then '[1,2]' "
            f"when n % 43 = 0 then '{{\"recommended_action\":\"page\",\"narrative\":null,"
            f"\"mitre_tactic\":\"Impact\"}}' "
            f"when n % 7 = 0 then '```json' || chr(10) || {doc} || chr(10) || '```' "
            f"when n % 7 = 1 then 'Here is my assessment: ' || {doc} || ' Regards' "
            f"else {doc} end")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spread(table(spark, sf_dir, "events"))
    return events.selectExpr(*[f"{sql} AS {name}" for name, sql in record_fields(SPARK).items()])


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze records with their nested fields."""
    c = F.col
    text = F.lit(None).cast("string")

    def when(flag, **fields):
        return F.when(c(flag), F.struct(*[v.alias(k) for k, v in fields.items()]))

    def listed(column):
        empty = F.array().cast("array<string>")
        return F.when(c(column).isNull(), empty).otherwise(F.array(column))

    return raw_records(spark, sf_dir).select(
        c("id_text").alias("id"), c("time_text").alias("timestamp"),
        c("src_text").alias("source_ip"), c("dst_text").alias("destination_ip"),
        c("domain_text").alias("destination_domain"), c("sport").alias("source_port"),
        c("dport").cast("bigint").alias("destination_port"), c("protocol_text").alias("protocol"),
        c("application_text").alias("application"), c("action_text").alias("action"),
        c("sent").alias("bytes_sent"), c("received").alias("bytes_received"),
        c("packets").alias("packet_count"), c("duration").alias("duration_ms"),
        c("type_text").alias("event_type"), c("severity_text").alias("severity"),
        c("user_text").alias("user"), c("correlation").alias("correlation_id"),
        c("device").alias("device_name"), c("vlan").alias("vlan_id"), c("geo").alias("geo_location"),
        text.alias("user_agent"),
        when("has_meta", collector=c("collector_text"), source_type=c("source_kind"),
             ingestion_time=c("ingest_text"), pipeline=text).alias("log_metadata"),
        when("has_net", network_segment=text, subnet=text,
             security_zone=c("zone")).alias("network_details"),
        c("state").alias("connection_state"), c("flags_text").alias("tcp_flags"),
        when("has_policy", policy_name=text, violation_type=text,
             policy_severity=c("policy_level")).alias("policy_violation"),
        listed("tag").alias("asset_tags"),
        when("has_load", cpu_percent=c("cpu"), memory_percent=F.lit(None).cast("double"),
             disk_io_percent=F.lit(None).cast("double"), process_name=c("process"),
             process_id=c("process_no")).alias("resource_utilization"),
        c("response").cast("bigint").alias("response_code"),
        listed("indicator").alias("threat_indicators"), c("rule").alias("rule_id"),
        text.alias("reason"), text.alias("description"))


def bronze_messages(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """The records as JSON messages of a topic."""
    docs = raw_records(spark, sf_dir).selectExpr("n", f"{message_document()} AS doc")
    return docs.select("n", F.expr(MESSAGE_TEXT).alias("value"), F.lit(topic).alias("topic"))


def ip_intel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address feed: one entry per supplier."""
    k = F.col("s_suppkey")
    pulses = F.transform(F.sequence(F.lit(1), k % 14), lambda i: F.struct(
        F.array(F.concat(F.lit("tag"), (i % 5).cast("string")),
                F.concat(F.lit("tag"), ((i + k) % 12).cast("string"))).alias("tags"),
        F.array(F.concat(F.lit("T"), (i + 1000).cast("string")), F.lit("")).alias("attack_ids")))
    empty = F.array().cast("array<struct<tags:array<string>,attack_ids:array<string>>>")
    return table(spark, sf_dir, "supplier").select(
        supplier_address().alias("ip"), (k * 13 % 101).cast("int").alias("abuse_score"),
        F.expr("case when s_suppkey % 5 = 0 then null when s_suppkey % 7 = 0 then '' "
               "else 'N' || cast(s_nationkey as string) end").alias("country"),
        F.expr("case when s_suppkey % 3 = 0 then null "
               "else 'G' || cast(s_nationkey as string) end").alias("geo_country"),
        F.array((3 + k % 21).cast("int"), F.lit(99), F.lit(18)).alias("category_ids"),
        (k % 14).cast("int").alias("pulse_count"),
        F.when(k % 4 != 0, F.when(k % 14 == 0, empty).otherwise(pulses)).alias("pulses"))


def engines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second-opinion engine counts: one entry per supplier."""
    return table(spark, sf_dir, "supplier").select(
        supplier_address().alias("ip"),
        (F.col("s_suppkey") % 9).cast("int").alias("malicious_engines"))


def supplier_address():
    return F.expr("'10.0.' || cast(s_suppkey div 250 as string) || '.' "
                  "|| cast(s_suppkey % 250 + 1 as string)")
