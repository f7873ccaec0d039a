"""DuckDB statements that give the same results as the catalog's queries.

They start from the same derived records (``inputs``) and restate every operator
in plain SQL.  Steps are named subqueries, of which a statement lists those it
needs.
"""

from __future__ import annotations

from duskwatch.operators.enrich import CATEGORY_LABELS
from duskwatch.plans import inputs

AS_OF = f"TIMESTAMP '{inputs.AS_OF}'"
DAY_MINUTES = 1440


def clock(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def text(x: str) -> str:
    return f"coalesce(array_to_string({x}, '; '), '')"


def instant(x: str) -> str:
    return (f"CASE WHEN {x} LIKE '%-05:00' THEN try_cast(left({x}, length({x}) - 6) AS TIMESTAMP) "
            f"+ INTERVAL 5 HOUR ELSE try_cast({x} AS TIMESTAMP) END")


def is_quad(x: str) -> str:
    return (f"coalesce(len(string_split({x}, '.')) = 4 AND list_bool_and(list_transform("
            f"string_split({x}, '.'), lambda q: regexp_full_match(q, '0|[1-9][0-9]?[0-9]?') "
            f"AND coalesce(try_cast(q AS INTEGER), 999) <= 255)), false)")


def time_warning(x: str) -> str:
    return (f"CASE WHEN coalesce({x}, '') = '' THEN 'missing timestamp — using current UTC time' "
            f"WHEN ({instant(x)}) IS NULL THEN 'unparseable timestamp ''' || {x} || "
            f"''' — using current UTC time' WHEN NOT ({x} LIKE '%Z' OR {x} LIKE '%-05:00') "
            f"THEN 'timestamp ''' || {x} || ''' has no timezone — assuming UTC' END")


def ip_warning(x: str, host: str, field: str) -> str:
    return (f"CASE WHEN {x} <> '' AND NOT {is_quad(host)} THEN 'invalid IP in {field}: ''' "
            f"|| {host} || ''' — set to null' END")


def port_warning(x: str) -> str:
    return (f"CASE WHEN {x} < 0 OR {x} > 65535 THEN 'invalid port ' || {x} || ' — set to null' END")


SEVERITY = ("CASE lower(trim(severity_text)) WHEN 'info' THEN 'INFO' WHEN 'low' THEN 'LOW' "
            "WHEN 'med' THEN 'MEDIUM' WHEN 'medium' THEN 'MEDIUM' WHEN 'high' THEN 'HIGH' "
            "WHEN 'crit' THEN 'CRITICAL' WHEN 'critical' THEN 'CRITICAL' END")
ACTION = ("CASE WHEN lower(trim(action_text)) IN ('allow', 'permit', 'pass') THEN 'ALLOW' "
          "WHEN lower(trim(action_text)) IN ('block', 'deny') THEN 'BLOCK' "
          "WHEN lower(trim(action_text)) = 'drop' THEN 'DROP' "
          "WHEN lower(trim(action_text)) IN ('alert', 'monitor') THEN 'ALERT' END")
LABELS = "[" + ", ".join(f"'{CATEGORY_LABELS[k]}'" for k in sorted(CATEGORY_LABELS)) + "]"


def json_string(name: str, x: str) -> str:
    return f"'\"{name}\":\"' || {x} || '\"'"


def json_number(name: str, x: str) -> str:
    return f"'\"{name}\":' || ({x})::VARCHAR"


def json_list(name: str, x: str) -> str:
    return f"'\"{name}\":[' || coalesce('\"' || {x} || '\"', '') || ']'"


def json_object(name: str, present: str, *fields: str) -> str:
    return (f"CASE WHEN {present} THEN '\"{name}\":{{' || concat_ws(',', {', '.join(fields)}) "
            "|| '}' END")


# All fields of a raw record that are not null, as JSON in the order of its layer.
RECORD_ID = "sha256('{' || concat_ws(',', " + ", ".join([
    json_string("id", "id_text"), json_string("timestamp", "time_text"), json_string("source_ip", "src_text"),
    json_string("destination_ip", "dst_text"), json_string("destination_domain", "domain_text"),
    json_number("source_port", "sport"), json_number("destination_port", "dport"),
    json_string("protocol", "protocol_text"), json_string("application", "application_text"),
    json_string("action", "action_text"), json_number("bytes_sent", "sent"),
    json_number("bytes_received", "received"), json_number("packet_count", "packets"),
    json_number("duration_ms", "duration"), json_string("event_type", "type_text"),
    json_string("severity", "severity_text"), json_string("user", "user_text"),
    json_string("correlation_id", "correlation"), json_string("device_name", "device"), json_number("vlan_id", "vlan"),
    json_string("geo_location", "geo"),
    json_object("log_metadata", "has_meta", json_string("collector", "collector_text"),
           json_string("source_type", "source_kind"), json_string("ingestion_time", "ingest_text")),
    json_object("network_details", "has_net", json_string("security_zone", "zone")),
    json_string("connection_state", "state"), json_string("tcp_flags", "flags_text"),
    json_object("policy_violation", "has_policy", json_string("policy_severity", "policy_level")),
    json_list("asset_tags", "tag"),
    json_object("resource_utilization", "has_load", json_number("cpu_percent", "cpu"),
           json_string("process_name", "process"), json_number("process_id", "process_no")),
    json_number("response_code", "response"), json_list("threat_indicators", "indicator"),
    json_string("rule_id", "rule")]) + ") || '}')"
PULSES = "range(1, s_suppkey % 14 + 1)"
WORDS = "regexp_split_to_array(lower({0}), '[^\\p{{L}}\\p{{N}}]+')"

STEPS = {
    "raw": "SELECT " + ", ".join(
        f"{sql} AS {name}" for name, sql in inputs.record_fields(inputs.DUCKDB).items())
        + " FROM events",
    "hosts": "SELECT *, split_part(src_text, ':', 1) AS src_host, "
             "split_part(dst_text, ':', 1) AS dst_host, "
             "lower(trim(domain_text)) AS domain_name, "
             f"{instant('time_text')} AS read_time FROM raw",
    "warned": f"""
        SELECT *, coalesce(CASE WHEN time_text <> '' THEN read_time END, {AS_OF}) AS event_time,
          {time_warning('time_text')} AS w_time,
          {ip_warning('src_text', 'src_host', 'source_ip')} AS w_src,
          {ip_warning('dst_text', 'dst_host', 'destination_ip')} AS w_dst,
          CASE WHEN coalesce(severity_text, '') = '' THEN 'missing severity — defaulting to INFO'
               WHEN ({SEVERITY}) IS NULL THEN 'unknown severity ''' || severity_text
                    || ''' — defaulting to INFO' END AS w_severity,
          CASE WHEN action_text <> '' AND ({ACTION}) IS NULL
               THEN 'unknown action ''' || action_text || ''' — set to null' END AS w_action,
          CASE WHEN coalesce(type_text, '') = ''
               THEN 'missing event_type — defaulting to UNKNOWN' END AS w_type,
          CASE WHEN domain_text <> '' AND (length(domain_name) > 253 OR contains(domain_name, ' '))
               THEN 'invalid domain ''' || domain_name || ''' — set to null' END AS w_domain,
          CASE WHEN has_meta AND ingest_text <> '' THEN {time_warning('ingest_text')} END AS w_ingest,
          {port_warning('sport')} AS w_sport, {port_warning('dport')} AS w_dport
        FROM hosts""",
    "silver": f"""
        SELECT n, id_text AS original_id,
          {RECORD_ID} AS id,
          event_time,
          CASE WHEN has_meta AND ingest_text <> '' THEN coalesce({instant('ingest_text')}, {AS_OF})
               END AS ingestion_time,
          CASE WHEN src_text <> '' AND {is_quad('src_host')} THEN src_host END AS source_ip,
          CASE WHEN dst_text <> '' AND {is_quad('dst_host')} THEN dst_host END AS destination_ip,
          CASE WHEN domain_text <> '' AND w_domain IS NULL THEN domain_name END AS destination_domain,
          CASE WHEN sport BETWEEN 0 AND 65535 THEN sport::INTEGER END AS source_port,
          CASE WHEN dport BETWEEN 0 AND 65535 THEN dport::INTEGER END AS destination_port,
          nullif(upper(protocol_text), '') AS protocol,
          nullif(upper(application_text), '') AS application,
          greatest(coalesce(sent, 0), 0)::BIGINT AS bytes_sent,
          greatest(received, 0)::BIGINT AS bytes_received,
          greatest(packets, 0)::BIGINT AS packet_count,
          greatest(duration, 0)::BIGINT AS duration_ms,
          CASE WHEN coalesce(type_text, '') = '' THEN 'UNKNOWN' ELSE trim(upper(type_text)) END
            AS event_type,
          coalesce({SEVERITY}, 'INFO') AS severity, {ACTION} AS action, state AS connection_state,
          list_filter(list_transform(string_split(coalesce(flags_text, ''), ','),
                      lambda f: upper(trim(f))), lambda f: f <> '') AS tcp_flags,
          response::BIGINT AS response_code, nullif(lower(trim(user_text)), '') AS user_name,
          device AS device_name, CASE WHEN has_meta THEN source_kind END AS source_type,
          NULL::VARCHAR AS pipeline, CASE WHEN has_meta THEN collector_text END AS collector,
          NULL::VARCHAR AS network_segment, CASE WHEN has_net THEN zone END AS security_zone,
          geo AS geo_location, vlan::BIGINT AS vlan_id,
          CASE WHEN tag IS NULL THEN [] ELSE [tag] END AS asset_tags, rule AS rule_id,
          correlation AS correlation_id,
          CASE WHEN indicator IS NULL THEN [] ELSE [indicator] END AS threat_indicators,
          CASE WHEN has_load THEN process END AS process_name,
          CASE WHEN has_load THEN process_no END AS process_id,
          CASE WHEN has_load THEN cpu END AS cpu_percent, NULL::DOUBLE AS memory_percent,
          '1.0' AS cleaning_version, has_policy,
          CASE WHEN has_policy THEN policy_level END AS policy_severity,
          list_filter([w_time, w_src, w_dst, w_severity, w_action, w_type, w_domain, w_ingest,
                       w_sport, w_dport], lambda w: w IS NOT NULL) AS cleaning_warnings
        FROM warned""",
    "intel": f"""
        SELECT '10.0.' || (s_suppkey // 250) || '.' || (s_suppkey % 250 + 1) AS ip,
          (s_suppkey * 13 % 101)::INTEGER AS abuse_score,
          CASE WHEN s_suppkey % 5 = 0 OR s_suppkey % 7 = 0
               THEN CASE WHEN s_suppkey % 3 <> 0 THEN 'G' || s_nationkey END
               ELSE 'N' || s_nationkey END AS country,
          [{LABELS}[s_suppkey % 21 + 1], 'brute_force'] AS labels,
          (s_suppkey % 14)::INTEGER AS pulse_count, (s_suppkey % 9)::INTEGER AS engine_hits,
          CASE WHEN s_suppkey % 4 <> 0 THEN list_sort(list_distinct(flatten(list_transform(
            {PULSES}, lambda i: ['tag' || (i % 5), 'tag' || ((i + s_suppkey) % 12)])))) END AS tags,
          CASE WHEN s_suppkey % 4 <> 0 THEN list_sort(list_transform(
            {PULSES}, lambda i: 'T' || (i + 1000))) END AS attack_ids
        FROM supplier""",
    "context": """
        SELECT s.*, i.ip IS NOT NULL AS in_feed, coalesce(i.abuse_score, 0) AS abuse_score,
          i.country, coalesce(i.abuse_score, 0) >= 25 OR coalesce(i.pulse_count, 0) > 0
            AS is_malicious,
          CASE WHEN i.ip IS NULL THEN [] WHEN i.tags IS NULL THEN i.labels
               ELSE list_sort(list_distinct(list_concat(i.labels, i.tags))) END AS threat_types,
          CASE WHEN s.severity IN ('HIGH', 'CRITICAL') THEN i.engine_hits END AS engine_hits,
          coalesce(nullif(s.device_name, ''), s.destination_ip) AS host,
          coalesce(s.device_name = 'auth-server-01', false)
            OR list_contains(s.asset_tags, 'production') AS is_prod,
          coalesce(s.device_name = 'web-proxy', false)
            OR coalesce(s.security_zone = 'untrusted', false) AS facing,
          coalesce(s.user_name IN ('admin', 'root', 'svc-deploy', 'svc-backup'), false) AS privileged,
          coalesce(s.user_name IN ('john.doe.old', 'contractor_expired'), false) AS offboard
        FROM silver s LEFT JOIN intel i ON s.source_ip = i.ip""",
    "parts": """
        SELECT *,
          CASE severity WHEN 'INFO' THEN 5 WHEN 'LOW' THEN 15 WHEN 'MEDIUM' THEN 35
               WHEN 'HIGH' THEN 60 ELSE 85 END AS p_severity,
          CASE event_type WHEN 'FAILED_LOGIN' THEN 5 WHEN 'SSH_ATTEMPT' THEN 10
               WHEN 'PORT_SCAN' THEN 10 ELSE 0 END AS p_type,
          CASE WHEN action = 'ALLOW' AND severity <> 'INFO' THEN 5 ELSE 0 END AS p_action,
          CASE WHEN NOT has_policy THEN 0 WHEN lower(policy_severity) = 'medium' THEN 15
               WHEN lower(policy_severity) = 'high' THEN 25 ELSE 5 END AS p_policy,
          CASE WHEN security_zone = 'untrusted' THEN 10 ELSE 0 END AS p_zone,
          CASE WHEN source_ip IS NOT NULL AND is_malicious THEN least(abuse_score // 2, 30)
               ELSE 0 END::INTEGER AS p_ip,
          CASE WHEN host IS NULL THEN 0 ELSE CASE WHEN is_prod THEN 18 ELSE 8 END
               + CASE WHEN facing THEN 5 ELSE 0 END END AS p_asset,
          CASE WHEN user_name IS NULL THEN 0 WHEN offboard THEN 33 WHEN privileged THEN 16
               ELSE 1 END AS p_identity,
          CASE WHEN offboard THEN 85 WHEN privileged THEN 60 ELSE 10 END AS risk
        FROM context""",
    "scored": """
        SELECT *, least(p_severity + p_type + p_action + p_policy + p_zone + p_ip + p_asset
                        + p_identity, 100)::INTEGER AS threat_score FROM parts""",
    "replied": f"SELECT *, {inputs.reply_text()} AS reply FROM scored",
    "stripped": r"""
        SELECT *, regexp_replace(regexp_replace(reply, '```(?:json)?', '', 'g'),
                                 '^\s+|\s+$', '', 'g') AS bare FROM replied""",
    "docs": r"""
        SELECT *, CASE WHEN json_valid(bare) THEN bare
                       WHEN json_valid(regexp_extract(bare, '(?s)\{.*\}'))
                       THEN regexp_extract(bare, '(?s)\{.*\}') END AS doc FROM stripped""",
    "read_replies": """
        SELECT *, CASE WHEN is_doc THEN CASE WHEN wanted IN
              ('archive', 'digest', 'ticket', 'page', 'contain') THEN wanted ELSE 'ticket' END END AS tier,
          CASE WHEN is_doc THEN CASE WHEN json_type(doc, '$.narrative') IS NULL
              THEN 'No narrative generated.' ELSE json_extract_string(doc, '$.narrative') END END
            AS said,
          CASE WHEN is_doc THEN json_extract_string(doc, '$.mitre_tactic') END AS tactic,
          CASE WHEN NOT is_doc THEN 'reply: no JSON object' END AS problem
        FROM (SELECT *, coalesce(json_type(doc) = 'OBJECT', false) AS is_doc,
                     json_extract_string(doc, '$.recommended_action') AS wanted FROM docs)""",
    "assessed": """
        SELECT *, CASE WHEN threat_score >= 15 THEN tier END AS recommended_action,
          CASE WHEN threat_score >= 15 THEN said END AS narrative,
          CASE WHEN threat_score >= 15 THEN tactic END AS mitre_tactic,
          CASE WHEN threat_score >= 15 THEN problem END AS error FROM read_replies""",
    "gold": "SELECT * EXCLUDE (error) FROM assessed WHERE error IS NULL",
    "windows": f"""
        SELECT date_trunc('day', event_time) AS window_start, source_ip, event_type,
          coalesce(source_ip, 'None') || ':' || event_type AS velocity_key,
          count(*)::INTEGER AS event_count,
          count(DISTINCT coalesce(destination_ip, ''))::INTEGER AS unique_dest_ips,
          count(DISTINCT coalesce(destination_port, -1))::INTEGER AS unique_dest_ports,
          sum(bytes_sent)::BIGINT AS total_bytes_sent, min(event_time) AS first_seen,
          max(event_time) AS last_seen, {DAY_MINUTES}::INTEGER AS window_minutes,
          'VELOCITY: ' || count(*) || ' ' || event_type || ' events from '
            || coalesce(source_ip, 'None') || ' in {DAY_MINUTES} minutes' AS description
        FROM silver GROUP BY date_trunc('day', event_time), source_ip, event_type""",
    "busy": "SELECT * FROM windows WHERE event_count >= 3",
    "represented": """
        SELECT b.*, 'agg_' || r.id AS finding_id, r.event_time AS event_time, r.severity,
          r.user_name, r.destination_port, r.cleaning_warnings
        FROM busy b JOIN (
          SELECT *, date_trunc('day', event_time) AS day, row_number() OVER (
            PARTITION BY source_ip, event_type, date_trunc('day', event_time)
            ORDER BY event_time DESC, id DESC) AS k FROM silver) r
        ON r.k = 1 AND r.day = b.window_start AND r.event_type = b.event_type
          AND r.source_ip IS NOT DISTINCT FROM b.source_ip""",
    "rated": """
        SELECT *, avg(event_count) OVER w AS mean, count(*) OVER w AS depth FROM windows
        WINDOW w AS (PARTITION BY velocity_key ORDER BY window_start
                     ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)""",
    "alerts": """
        SELECT 'baseline_' || velocity_key || '_'
            || (epoch_ms(window_start + INTERVAL 1 DAY) - 1) AS finding_id,
          source_ip, event_type AS source_event_type, window_start + INTERVAL 1 DAY AS event_time,
          event_count, first_seen, last_seen, window_minutes,
          round_even(mean::DOUBLE, 2)::DOUBLE AS rolling_average,
          round_even((event_count / mean)::DOUBLE, 2)::DOUBLE AS multiplier,
          2.0::DOUBLE AS threshold, depth::INTEGER AS windows_in_baseline,
          'BASELINE DEVIATION: ' || coalesce(source_ip, 'None') || ' generated ' || event_count
            || ' ' || event_type || ' events — ' || round_even((event_count / mean)::DOUBLE, 1)::DOUBLE
            || 'x above rolling average of ' || round_even(mean::DOUBLE, 1)::DOUBLE || ' over '
            || depth || ' windows.' AS description
        FROM rated WHERE depth >= 6 AND mean > 0 AND event_count >= mean * 2.0""",
    "steps": """
        SELECT *, row_number() OVER (PARTITION BY ip ORDER BY event_time, id) AS pos FROM (
          SELECT coalesce(source_ip, 'None') AS ip, event_time, id, original_id, event_type, action,
            CASE WHEN event_type IN ('PORT_SCAN', 'SSH_ATTEMPT') THEN 'scan'
                 WHEN action IN ('BLOCK', 'DROP') THEN 'block'
                 WHEN action = 'ALLOW' THEN 'success' END AS role FROM silver)
        WHERE role IS NOT NULL""",
    "latest": """
        SELECT *, max(CASE WHEN role = 'scan' THEN pos END) OVER w AS scan_pos,
          max(CASE WHEN role = 'block' THEN pos END) OVER w AS block_pos FROM steps
        WINDOW w AS (PARTITION BY ip ORDER BY pos)""",
    "ready": """
        SELECT a.*, s.event_time AS scan_time, b.event_time AS block_time,
          least(a.scan_pos, a.block_pos) AS m
        FROM latest a JOIN steps s ON s.ip = a.ip AND s.pos = a.scan_pos
        JOIN steps b ON b.ip = a.ip AND b.pos = a.block_pos
        WHERE a.role = 'success'
          AND least(s.event_time, b.event_time) >= a.event_time - INTERVAL 6 HOUR""",
    "walk": """
        SELECT ip, min(pos) AS pos FROM ready GROUP BY ip
        UNION ALL
        SELECT ip, next_pos FROM (
          SELECT w.ip, (SELECT min(r.pos) FROM ready r WHERE r.ip = w.ip AND r.m > w.pos) AS next_pos
          FROM walk w) WHERE next_pos IS NOT NULL""",
    "ends": "SELECT ip, pos, coalesce(lag(pos) OVER (PARTITION BY ip ORDER BY pos), 0) AS since "
            "FROM walk",
    "chains": """
        SELECT e.ip, any_value(a.event_time) AS event_time, any_value(a.id) AS success_id,
          any_value(a.original_id) AS success_event,
          min(CASE WHEN p.role = 'scan' THEN p.pos END) AS scan_pos,
          min(CASE WHEN p.role = 'block' THEN p.pos END) AS block_pos
        FROM ends e JOIN steps a ON a.ip = e.ip AND a.pos = e.pos
        JOIN steps p ON p.ip = e.ip AND p.pos > e.since AND p.pos < e.pos
          AND p.event_time >= a.event_time - INTERVAL 6 HOUR
        GROUP BY e.ip, e.pos""",
    "chain_rows": """
        SELECT c.ip, s.id AS scan_id, s.event_time AS scan_time, s.event_type AS scan_type,
          b.id AS block_id, b.event_time AS block_time, b.action AS block_action,
          b.original_id AS block_event, c.success_id, c.success_event, c.event_time,
          'ATTACK CHAIN DETECTED: ' || c.ip || ' performed port scan, was blocked, then achieved '
            || 'successful connection. Possible reconnaissance leading to compromise.' AS description
        FROM chains c JOIN steps s ON s.ip = c.ip AND s.pos = c.scan_pos
        JOIN steps b ON b.ip = c.ip AND b.pos = c.block_pos""",
    "findings": """
        SELECT finding_id, 'velocity' AS aggregation_type, source_ip,
          event_type AS source_event_type, event_time, first_seen, last_seen, window_minutes,
          description, event_count, unique_dest_ips, unique_dest_ports, total_bytes_sent,
          NULL::DOUBLE AS rolling_average, NULL::DOUBLE AS multiplier,
          NULL::INTEGER AS windows_in_baseline, NULL::VARCHAR AS pattern FROM represented
        UNION ALL
        SELECT finding_id, 'baseline', source_ip, source_event_type, event_time, first_seen,
          last_seen, window_minutes, description, event_count, NULL, NULL, NULL,
          rolling_average, multiplier, windows_in_baseline, NULL FROM alerts
        UNION ALL
        SELECT 'cep_' || scan_id, 'cep_chain', nullif(ip, 'None'), NULL, event_time, NULL, NULL,
          360, description, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
          'port_scan → blocked_attempt → success' FROM chain_rows""",
    "links": """
        SELECT f.finding_id, g.id AS silver_id, g.event_time AS gold_time, g.threat_score,
          g.recommended_action, g.mitre_tactic, g.narrative,
          row_number() OVER (PARTITION BY f.finding_id
                             ORDER BY g.threat_score DESC, g.event_time, g.id) AS k
        FROM findings f JOIN gold g ON g.source_ip = f.source_ip
          AND g.event_type = f.source_event_type
          AND g.event_time >= coalesce(f.first_seen, f.event_time)
          AND g.event_time <= coalesce(f.last_seen, f.event_time)
        WHERE f.source_ip <> '' AND f.source_event_type <> ''""",
    "summary": """
        SELECT finding_id, max(threat_score) AS max_threat_score,
          floor(avg(threat_score))::INTEGER AS avg_threat_score,
          max(CASE WHEN k = 1 THEN recommended_action END) AS recommended_action,
          max(CASE WHEN k = 1 THEN mitre_tactic END) AS mitre_tactic,
          max(CASE WHEN k = 1 THEN narrative END) AS narrative,
          count(*)::INTEGER AS gold_events_found,
          string_agg(silver_id, '; ' ORDER BY k) AS source_event_ids
        FROM links GROUP BY finding_id""",
    "aggregations": """
        SELECT f.finding_id AS flink_id, f.* EXCLUDE (finding_id, multiplier),
          f.multiplier AS baseline_multiplier, s.max_threat_score, s.avg_threat_score,
          s.recommended_action, s.mitre_tactic, s.narrative,
          coalesce(s.source_event_ids, '') AS source_event_ids
        FROM findings f LEFT JOIN summary s ON s.finding_id = f.finding_id""",
    "incoming": f"SELECT n, CASE WHEN true THEN doc END AS doc FROM (SELECT n, "
                f"{inputs.message_document()} AS doc FROM raw)",
    "messages": f"SELECT n, {inputs.MESSAGE_TEXT} AS value FROM incoming",
    "judged": """
        SELECT *, concat_ws('; ',
          CASE WHEN json_type(value, '$.id') IS DISTINCT FROM 'VARCHAR' THEN 'id: expected text' END,
          CASE WHEN json_type(value, '$.source_port') = 'DOUBLE'
               THEN 'source_port: expected integer' END,
          CASE WHEN json_type(value, '$.asset_tags') = 'NULL'
               THEN 'asset_tags: expected list of text' END) AS problems
        FROM messages WHERE json_valid(value) AND left(value, 1) = '{'""",
    "dead_parse": f"""
        SELECT m.n, m.value AS original_message, CASE WHEN j.n IS NULL
            THEN 'message: not a JSON object' ELSE j.problems END AS error, 'parse' AS stage,
          'logs.bronze.events.v1' AS topic
        FROM messages m LEFT JOIN judged j ON j.n = m.n WHERE j.n IS NULL OR j.problems <> ''""",
    "dead_enrich": """
        SELECT original_id AS original_message, 'severity: expected text' AS error,
          'enrich-parse' AS stage, 'logs.silver.events.v1' AS topic FROM silver WHERE n % 40 = 3
        UNION ALL
        SELECT original_id, error, 'enrich', 'logs.silver.events.v1' FROM assessed
        WHERE error IS NOT NULL""",
}

SILVER = ["hosts", "warned", "silver"]
SCORED = ["intel", "context", "parts", "scored"]
ASSESSED = ["replied", "stripped", "docs", "read_replies", "assessed"]
VELOCITY = ["windows", "busy", "represented"]
ALERTS = ["rated", "alerts"]
CHAINS = ["steps", "latest", "ready", "walk", "ends", "chains", "chain_rows"]


def _needs() -> dict[str, list[str]]:
    silver = ["raw", *SILVER]
    scored = [*silver, *SCORED]
    gold = [*scored, *ASSESSED, "gold"]
    found = [*gold, *VELOCITY, *ALERTS, *CHAINS, "findings", "links", "summary", "aggregations"]
    return {"raw": ["raw"], "hosts": ["raw", "hosts"], "warned": ["raw", "hosts", "warned"],
            "silver": silver, "intel": ["intel"], "context": [*silver, "intel", "context"],
            "scored": scored, "replies": [*scored, *ASSESSED[:-1]], "gold": gold,
            "assessed": [*scored, *ASSESSED], "velocity": [*silver, *VELOCITY],
            "alerts": [*silver, "windows", *ALERTS], "chains": [*silver, *CHAINS], "found": found,
            "messages": ["raw", "incoming", "messages", "judged", "dead_parse"],
            "dead": [*scored, *ASSESSED, "incoming", "messages", "judged", "dead_parse",
                     "dead_enrich"]}


NEEDS = _needs()


def statement(need: str, body: str) -> str:
    steps = NEEDS[need]
    head = "WITH RECURSIVE " if "walk" in steps else "WITH "
    return head + ",\n".join(f"{name} AS ({STEPS[name].strip()})" for name in steps) + "\n" + body


EVENT_COLUMNS = f"""
    id AS silver_id, original_id, {clock('event_time')} AS event_time,
    {clock('ingestion_time')} AS ingestion_time, NULL::INTEGER AS processing_time_ms, event_type,
    severity, action, protocol, application, connection_state, response_code,
    rule_id, source_ip, destination_ip, destination_domain, source_port, destination_port,
    bytes_sent, bytes_received, packet_count,
    duration_ms, {text('tcp_flags')} AS tcp_flags, user_name, device_name,
    source_type, pipeline, collector, network_segment, security_zone, geo_location,
    vlan_id, {text('asset_tags')} AS asset_tags, correlation_id, process_name,
    process_id, cpu_percent, memory_percent, NULL::VARCHAR AS policy_name,
    NULL::VARCHAR AS policy_violation_type, policy_severity, threat_score, recommended_action,
    mitre_tactic, narrative,
    '{{"severity_base":' || p_severity || ',"event_type_boost":' || p_type || ',"action_modifier":'
      || p_action || ',"policy_violation":' || p_policy || ',"security_zone":' || p_zone
      || ',"ip_reputation":' || p_ip || ',"asset_criticality":' || p_asset || ',"identity_risk":'
      || p_identity || ',"composite":' || threat_score || '}}' AS score_breakdown,
    CASE WHEN source_ip IS NULL THEN 'null' ELSE to_json({{'ip': source_ip,
      'is_malicious': is_malicious, 'threat_types': threat_types, 'country': country,
      'abuse_score': abuse_score, 'source': 'abuseipdb,ipinfo'}})::VARCHAR END AS ip_reputation,
    CASE WHEN host IS NULL THEN 'null' ELSE to_json({{'host': host,
      'criticality': CASE WHEN is_prod THEN 9 ELSE 4 END,
      'environment': CASE WHEN is_prod THEN 'prod' ELSE 'dev' END,
      'owner': CASE WHEN is_prod THEN 'platform-team' ELSE 'dev-team' END,
      'internet_facing': facing}})::VARCHAR END AS asset_context,
    CASE WHEN user_name IS NULL THEN 'null' ELSE to_json({{'user': user_name,
      'is_privileged': privileged, 'is_service_acct': starts_with(user_name, 'svc-'),
      'recent_offboard': offboard, 'risk_score': risk}})::VARCHAR END AS identity_context,
    {text('cleaning_warnings')} AS cleaning_warnings"""

AGGREGATION_COLUMNS = f"""
    flink_id, aggregation_type, source_ip, source_event_type, {clock('event_time')} AS event_time,
    {clock('first_seen')} AS first_seen, {clock('last_seen')} AS last_seen, window_minutes,
    description, event_count, unique_dest_ips, unique_dest_ports, total_bytes_sent,
    rolling_average, baseline_multiplier, windows_in_baseline, pattern, max_threat_score,
    avg_threat_score, recommended_action, mitre_tactic, narrative, source_event_ids"""

SHORT = "id AS silver_id, original_id, event_time, threat_score"
IN_SPAN = ("event_time >= TIMESTAMP '2024-01-05 06:00:00' "
           "AND event_time < TIMESTAMP '2024-01-12 19:00:00'")

_BODIES = {
    "agg_type_tag": ("raw", """
        SELECT topic, CASE WHEN topic LIKE '%windowed%' THEN 'velocity' WHEN topic LIKE '%correlated%'
            THEN 'cep_chain' WHEN topic LIKE '%baseline%' THEN 'baseline' ELSE 'unknown' END
            AS aggregation_type, count(*) AS events, max(n) AS last_event
        FROM (SELECT n, CASE n % 4 WHEN 0 THEN 'logs.aggregated.windowed-events.v1'
                WHEN 1 THEN 'logs.aggregated.correlated-events.v1'
                WHEN 2 THEN 'logs.aggregated.baseline-alerts.v1'
                ELSE 'logs.silver.events.v1' END AS topic FROM raw) GROUP BY ALL"""),
    "reply_explode": ("raw", """
        SELECT n // 10 AS batch, (n % 10)::INTEGER AS position, id_text AS id, received AS bytes_sent
        FROM raw WHERE (n // 10) % 11 <> 0 AND n % 17 <> 0 AND n % 23 <> 0"""),
    "bronze_parse": ("messages", """
        SELECT json_extract_string(value, '$.id') AS id,
          json_extract_string(value, '$.timestamp') AS timestamp,
          json_extract_string(value, '$.source_ip') AS source_ip,
          json_extract_string(value, '$.source_port')::BIGINT AS source_port,
          json_extract_string(value, '$.destination_port')::BIGINT AS destination_port,
          json_extract_string(value, '$.bytes_sent')::BIGINT AS bytes_sent,
          json_extract_string(value, '$.event_type') AS event_type,
          json_extract_string(value, '$.user') AS user_name,
          json_extract_string(value, '$.log_metadata.ingestion_time') AS ingestion_time,
          json_type(value, '$.policy_violation') = 'OBJECT' AS has_policy,
          json_extract_string(value, '$.policy_violation.policy_severity') AS policy_severity,
          coalesce(json_extract_string(value, '$.asset_tags[0]'), '') AS asset_tags,
          json_extract_string(value, '$.resource_utilization.cpu_percent')::DOUBLE AS cpu_percent,
          json_extract_string(value, '$.resource_utilization.process_id')::BIGINT AS process_id,
          coalesce(json_extract_string(value, '$.threat_indicators[0]'), '') AS threat_indicators
        FROM judged WHERE problems = ''"""),
    "dead_letter_parse": ("messages", f"""
        SELECT original_message, error, stage, {clock(AS_OF)} AS timestamp, topic FROM dead_parse"""),
    "dead_letter_enrich": ("dead", f"""
        SELECT original_message, error, stage, {clock(AS_OF)} AS timestamp, topic FROM dead_enrich"""),
    "dead_letter_by_stage": ("dead", """
        SELECT stage, topic AS source_topic, count(*) AS events FROM (
          SELECT stage, topic FROM dead_parse UNION ALL SELECT stage, topic FROM dead_enrich)
        GROUP BY ALL"""),
    "clean_timestamp": ("warned", f"SELECT id_text AS id, {clock('event_time')} AS event_time, "
                                  "w_time AS warning FROM warned"),
    "clean_ip": ("warned", f"""
        SELECT id_text AS id, CASE WHEN src_text <> '' AND {is_quad('src_host')} THEN src_host END
            AS source_ip, w_src AS warning,
          CASE WHEN dst_text <> '' AND {is_quad('dst_host')} THEN dst_host END AS destination_ip,
          w_dst AS destination_warning FROM warned"""),
    "clean_domain": ("silver", """
        SELECT original_id AS id, destination_domain,
          list_filter(cleaning_warnings, lambda w: starts_with(w, 'invalid domain'))[1] AS warning
        FROM silver"""),
    "clean_port": ("warned", """
        SELECT id_text AS id, CASE WHEN w_sport IS NULL THEN sport::INTEGER END AS source_port,
          w_sport AS warning, CASE WHEN w_dport IS NULL THEN dport::INTEGER END AS destination_port,
          w_dport AS destination_warning FROM warned"""),
    "clean_severity": ("warned", f"""
        SELECT id_text AS id, coalesce({SEVERITY}, 'INFO') AS severity, w_severity AS warning
        FROM warned"""),
    "clean_action": ("warned", f"SELECT id_text AS id, {ACTION} AS action, w_action AS warning "
                               "FROM warned"),
    "clean_tcp_flags": ("silver", f"SELECT original_id AS id, {text('tcp_flags')} AS tcp_flags "
                                  "FROM silver"),
    "clean_event_type": ("warned", """
        SELECT id_text AS id, CASE WHEN coalesce(type_text, '') = '' THEN 'UNKNOWN'
          ELSE upper(trim(type_text)) END AS event_type, w_type AS warning FROM warned"""),
    "clean_user": ("silver", "SELECT original_id AS id, user_name FROM silver"),
    "clean_counters": ("silver", "SELECT original_id AS id, bytes_sent, bytes_received, "
                                 "packet_count, duration_ms FROM silver"),
    "flatten_nested": ("silver", """
        SELECT original_id, source_type, collector, pipeline, network_segment, security_zone,
          process_name, process_id, cpu_percent FROM silver"""),
    "cleaning_warnings": ("silver", f"""
        SELECT original_id, len(cleaning_warnings)::INTEGER AS warnings,
          {text('cleaning_warnings')} AS warning_text FROM silver"""),
    "clean_event": ("silver", f"""
        SELECT * EXCLUDE (n) REPLACE ({clock('event_time')} AS event_time,
          {clock('ingestion_time')} AS ingestion_time, {text('tcp_flags')} AS tcp_flags,
          {text('asset_tags')} AS asset_tags, {text('threat_indicators')} AS threat_indicators,
          {text('cleaning_warnings')} AS cleaning_warnings) FROM silver"""),
    "dedup_exact": ("silver", f"SELECT original_id, id, {clock('event_time')} AS event_time, "
                              "source_ip, event_type FROM silver"),
    "warning_breakdown": ("warned", """
        SELECT kind, count(*) AS events FROM (
          SELECT unnest(list_distinct(list_filter([
            CASE WHEN coalesce(w_time, w_src, w_dst, w_severity, w_action, w_type, w_domain, w_ingest,
                               w_sport, w_dport) IS NULL THEN 'clean' ELSE 'any warning' END,
            CASE WHEN w_time LIKE 'missing%' THEN 'timestamp missing'
                 WHEN w_time LIKE 'unpars%' THEN 'timestamp unreadable' END,
            CASE WHEN w_time LIKE 'timestamp%' OR w_ingest LIKE 'timestamp%'
                 THEN 'timestamp without zone' END,
            CASE WHEN w_src IS NOT NULL THEN 'source ip invalid' END,
            CASE WHEN w_dst IS NOT NULL THEN 'destination ip invalid' END,
            CASE WHEN w_domain IS NOT NULL THEN 'domain invalid' END,
            CASE WHEN w_sport IS NOT NULL OR w_dport IS NOT NULL THEN 'port invalid' END,
            CASE WHEN w_severity LIKE 'missing%' THEN 'severity missing'
                 WHEN w_severity LIKE 'unknown%' THEN 'severity unknown' END,
            CASE WHEN w_action IS NOT NULL THEN 'action unknown' END,
            CASE WHEN w_type IS NOT NULL THEN 'event type missing' END],
            lambda k: k IS NOT NULL))) AS kind FROM warned) GROUP BY kind"""),
    "enrich_ip_reputation": ("context", f"""
        SELECT original_id, source_ip AS ip,
          CASE WHEN source_ip IS NOT NULL THEN is_malicious END AS is_malicious,
          CASE WHEN source_ip IS NOT NULL THEN {text('threat_types')} END AS threat_types, country,
          CASE WHEN source_ip IS NOT NULL THEN abuse_score END AS abuse_score,
          CASE WHEN source_ip IS NOT NULL THEN 'abuseipdb,ipinfo' END AS source FROM context"""),
    "ip_category_labels": ("intel", f"SELECT ip, {text('labels')} AS labels FROM intel"),
    "enrich_pulse_merge": ("intel", """
        SELECT ip, CASE WHEN tags IS NOT NULL THEN coalesce(array_to_string(tags, '; '), '') END
            AS tags,
          CASE WHEN attack_ids IS NOT NULL THEN coalesce(array_to_string(attack_ids, '; '), '') END
            AS attack_ids FROM intel"""),
    "enrich_engine_count": ("context", "SELECT original_id, severity, source_ip, "
                                       "engine_hits AS engine_malicious_count FROM context"),
    "enrich_asset": ("context", """
        SELECT original_id, host, CASE WHEN host IS NOT NULL THEN CASE WHEN is_prod THEN 9 ELSE 4 END
            END AS criticality,
          CASE WHEN host IS NOT NULL THEN CASE WHEN is_prod THEN 'prod' ELSE 'dev' END END
            AS environment,
          CASE WHEN host IS NOT NULL THEN CASE WHEN is_prod THEN 'platform-team' ELSE 'dev-team' END
            END AS owner,
          CASE WHEN host IS NOT NULL THEN facing END AS internet_facing FROM context"""),
    "enrich_identity": ("context", """
        SELECT original_id, user_name,
          CASE WHEN user_name IS NOT NULL THEN privileged END AS is_privileged,
          starts_with(user_name, 'svc-') AS is_service_acct,
          CASE WHEN user_name IS NOT NULL THEN offboard END AS recent_offboard,
          CASE WHEN user_name IS NOT NULL THEN CASE WHEN offboard THEN 85 WHEN privileged THEN 60
            ELSE 10 END END AS risk_score FROM context"""),
    "score_severity": ("scored", "SELECT original_id, severity, p_severity AS points FROM scored"),
    "score_event_type": ("scored", "SELECT original_id, event_type, p_type AS points FROM scored"),
    "score_policy": ("scored", "SELECT original_id, p_policy AS points FROM scored"),
    "threat_score": ("scored", """
        SELECT original_id, threat_score, p_severity AS part_severity_base,
          p_type AS part_event_type_boost, p_action AS part_action_modifier,
          p_policy AS part_policy_violation, p_zone AS part_security_zone,
          p_ip AS part_ip_reputation, p_asset AS part_asset_criticality,
          p_identity AS part_identity_risk, threat_score AS part_composite FROM scored"""),
    "assessment_gate": ("scored", """
        SELECT threat_score >= 15 AS assessed, count(*) AS events, min(threat_score) AS low,
          max(threat_score) AS high FROM scored GROUP BY 1"""),
    "assessment_request": ("scored", f"""
        SELECT id, threat_score, 'Assess this security event and respond with JSON only:' || chr(10)
          || chr(10) || to_json({{
            'event': {{'id': id, 'event_time': strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f+00:00'),
              'event_type': event_type, 'severity': severity, 'action': action,
              'source_ip': source_ip, 'destination_ip': destination_ip,
              'destination_domain': destination_domain, 'destination_port': destination_port,
              'protocol': protocol, 'application': application, 'user': user_name,
              'device_name': device_name, 'security_zone': security_zone,
              'policy_violation': CASE WHEN has_policy THEN {{'policy_name': NULL::VARCHAR,
                'violation_type': NULL::VARCHAR, 'policy_severity': policy_severity}} END,
              'tcp_flags': tcp_flags, 'bytes_sent': bytes_sent, 'bytes_received': bytes_received,
              'process_name': process_name, 'asset_tags': asset_tags,
              'cleaning_warnings': cleaning_warnings}},
            'threat_score': threat_score,
            'score_breakdown': {{'severity_base': p_severity, 'event_type_boost': p_type,
              'action_modifier': p_action, 'policy_violation': p_policy, 'security_zone': p_zone,
              'ip_reputation': p_ip, 'asset_criticality': p_asset, 'identity_risk': p_identity,
              'composite': threat_score}},
            'ip_reputation': CASE WHEN source_ip IS NOT NULL THEN {{'ip': source_ip,
              'is_malicious': is_malicious, 'threat_types': threat_types, 'country': country,
              'abuse_score': abuse_score, 'source': 'abuseipdb,ipinfo'}} END,
            'asset_context': CASE WHEN host IS NOT NULL THEN {{'host': host,
              'criticality': CASE WHEN is_prod THEN 9 ELSE 4 END,
              'environment': CASE WHEN is_prod THEN 'prod' ELSE 'dev' END,
              'owner': CASE WHEN is_prod THEN 'platform-team' ELSE 'dev-team' END,
              'internet_facing': facing}} END,
            'identity_context': CASE WHEN user_name IS NOT NULL THEN {{'user': user_name,
              'is_privileged': privileged, 'is_service_acct': starts_with(user_name, 'svc-'),
              'recent_offboard': offboard, 'risk_score': risk}} END
          }})::VARCHAR AS request FROM scored WHERE threat_score >= 15"""),
    "assessment_parse": ("replies", "SELECT original_id, tier, said AS narrative, "
                                    "tactic AS mitre_tactic, problem AS error FROM read_replies"),
    "action_tier": ("scored", """
        SELECT original_id, threat_score, CASE WHEN threat_score < 20 THEN 'archive'
          WHEN threat_score < 40 THEN 'digest' WHEN threat_score < 60 THEN 'ticket'
          WHEN threat_score < 80 THEN 'page' ELSE 'contain' END AS tier FROM scored"""),
    "route_counts": ("gold", "SELECT coalesce(recommended_action, 'archive') AS tier, "
                             "count(*) AS events FROM gold GROUP BY 1"),
    "gold_events": ("gold", f"""
        SELECT id AS silver_id, original_id, {clock('event_time')} AS event_time, threat_score,
          recommended_action, narrative, mitre_tactic,
          CASE WHEN source_ip IS NOT NULL THEN is_malicious END AS is_malicious,
          CASE WHEN host IS NOT NULL THEN CASE WHEN is_prod THEN 9 ELSE 4 END END AS criticality,
          CASE WHEN user_name IS NOT NULL THEN risk END AS risk_score,
          '1.0' AS enrichment_version, true AS routed FROM gold"""),
    "velocity_windows": ("velocity", f"""
        SELECT * REPLACE ({clock('window_start')} AS window_start, {clock('first_seen')} AS first_seen,
          {clock('last_seen')} AS last_seen) FROM busy"""),
    "velocity_representative": ("velocity", f"""
        SELECT finding_id AS id, velocity_key, event_type AS source_event_type,
          {clock('event_time')} AS event_time, severity, user_name, destination_port,
          {text('cleaning_warnings')} AS warnings FROM represented"""),
    "attack_chains": ("chains", f"""
        SELECT ip AS source_ip, scan_id, {clock('scan_time')} AS scan_time, block_id,
          {clock('block_time')} AS block_time, success_id, {clock('event_time')} AS event_time
        FROM chain_rows"""),
    "attack_chain_candidates": ("chains", f"""
        SELECT ip AS source_ip, id AS success_id, {clock('event_time')} AS event_time,
          {clock('scan_time')} AS latest_scan, {clock('block_time')} AS latest_block FROM ready"""),
    "attack_chain_records": ("chains", f"""
        SELECT 'cep_' || scan_id AS id, nullif(ip, 'None') AS source_ip,
          {clock('event_time')} AS event_time, 'CRITICAL' AS severity,
          'CORRELATED_ATTACK_CHAIN' AS event_type, 360 AS window_minutes,
          'port_scan → blocked_attempt → success' AS pattern, description, scan_type, block_action,
          block_event, success_event FROM chain_rows"""),
    "baseline_alerts": ("alerts", f"""
        SELECT finding_id AS id, source_ip, source_event_type, {clock('event_time')} AS event_time,
          event_count, 'HIGH' AS severity, description, rolling_average, multiplier, threshold,
          windows_in_baseline FROM alerts"""),
    "agg_gold_interval_join": ("found", f"SELECT finding_id, silver_id, {clock('gold_time')} "
                                        "AS gold_time, threat_score FROM links"),
    "enrichment_summary": ("found", "SELECT * FROM summary"),
    "lake_partitions": ("hosts", """
        SELECT year(read_time)::INTEGER AS year, month(read_time)::INTEGER AS month,
          day(read_time)::INTEGER AS day, hour(read_time)::INTEGER AS hour, count(*) AS events
        FROM hosts WHERE read_time IS NOT NULL GROUP BY ALL"""),
    "lake_bad_rows": ("hosts", """
        SELECT id_text AS id, 'timestamp: no time to file the record under' AS error,
          'archive' AS stage, 'logs.bronze.events.v1' AS topic FROM hosts WHERE read_time IS NULL"""),
    "lake_pruned_read": ("silver", f"""
        SELECT month(event_time)::INTEGER AS month, day(event_time)::INTEGER AS day,
          hour(event_time)::INTEGER AS hour, count(*) AS events, sum(bytes_sent)::BIGINT AS bytes_sent
        FROM silver WHERE {IN_SPAN} GROUP BY ALL"""),
    "events_wide": ("gold", f"SELECT {EVENT_COLUMNS} FROM gold"),
    "insert_ignore": ("gold", f"""
        SELECT silver_id, original_id, {clock('event_time')} AS event_time, threat_score
        FROM (SELECT {SHORT} FROM gold) WHERE event_time >= TIMESTAMP '2024-01-16'"""),
    "aggregations_wide": ("found", f"SELECT {AGGREGATION_COLUMNS} FROM aggregations"),
    "upsert_latest": ("gold", f"""
        SELECT silver_id, original_id, {clock('event_time')} AS event_time,
          (CASE WHEN n % 3 = 0 THEN (threat_score + 1) * 3 ELSE threat_score END)::INTEGER
            AS threat_score, (CASE WHEN n % 3 = 0 THEN 3 ELSE 1 END)::INTEGER AS version
        FROM (SELECT n, {SHORT} FROM gold)"""),
    "hot_window": ("gold", f"""
        SELECT strftime(event_time, '%Y-%m-%d') AS day, count(*) AS events,
          max(threat_score) AS max_score FROM gold
        WHERE event_time >= {AS_OF} - INTERVAL 15 DAY GROUP BY 1"""),
    "v_hourly_threat_trends": ("gold", f"""
        SELECT {clock("date_trunc('hour', event_time)")} AS hour, event_type, severity,
          recommended_action, count(*) AS event_count, round(avg(threat_score))::INTEGER AS avg_score,
          max(threat_score) AS max_score,
          count(*) FILTER (WHERE recommended_action IN ('page', 'contain')) AS high_severity_count
        FROM gold GROUP BY ALL"""),
    "v_top_threat_ips": ("gold", f"""
        SELECT source_ip, count(*) AS event_count, round(avg(threat_score))::INTEGER AS avg_score,
          max(threat_score) AS max_score,
          array_to_string(list_sort(list(DISTINCT event_type)), '; ') AS event_types,
          array_to_string(list_sort(list(DISTINCT mitre_tactic)
            FILTER (WHERE mitre_tactic IS NOT NULL)), '; ') AS mitre_tactics,
          {clock('max(event_time)')} AS last_seen
        FROM gold WHERE source_ip IS NOT NULL GROUP BY source_ip"""),
    "v_mitre_coverage": ("gold", f"""
        SELECT mitre_tactic, count(*) AS event_count, round(avg(threat_score), 6) AS avg_score,
          {clock('max(event_time)')} AS last_seen
        FROM gold WHERE mitre_tactic IS NOT NULL GROUP BY mitre_tactic"""),
    "v_action_summary": ("gold", f"""
        SELECT {clock("date_trunc('day', event_time)")} AS day, recommended_action, count(*) AS count
        FROM gold GROUP BY ALL"""),
    "v_aggregation_enriched": ("found", f"""
        SELECT a.flink_id, a.aggregation_type, a.source_ip, a.source_event_type,
          {clock('a.event_time')} AS event_time, {clock('a.first_seen')} AS first_seen,
          {clock('a.last_seen')} AS last_seen, a.window_minutes, a.event_count, a.description,
          a.pattern, a.rolling_average, a.baseline_multiplier, a.max_threat_score,
          a.avg_threat_score, a.recommended_action, a.mitre_tactic, a.narrative,
          e.id AS top_event_id, e.event_type AS top_event_type, e.threat_score AS top_event_score,
          e.narrative AS top_event_narrative, e.destination_ip AS top_dest_ip,
          e.destination_port AS top_dest_port
        FROM aggregations a LEFT JOIN (
          SELECT x.flink_id, g.*, row_number() OVER (PARTITION BY x.flink_id
                   ORDER BY g.threat_score DESC, g.event_time, g.id) AS k
          FROM aggregations x JOIN gold g ON g.source_ip = x.source_ip
            AND g.event_time BETWEEN x.first_seen AND x.last_seen) e
        ON e.flink_id = a.flink_id AND e.k = 1"""),
    "v_ip_full_picture": ("found", f"""
        SELECT source_ip, 'event' AS record_type, id AS record_id, {clock('event_time')} AS event_time,
          event_type, threat_score, recommended_action, mitre_tactic, narrative,
          NULL::VARCHAR AS aggregation_type, NULL::INTEGER AS event_count, NULL::VARCHAR AS pattern
        FROM gold
        UNION ALL
        SELECT source_ip, 'aggregation', flink_id, {clock('event_time')}, source_event_type,
          max_threat_score, recommended_action, mitre_tactic, description, aggregation_type,
          event_count, pattern FROM aggregations"""),
    "events_health": ("gold", "SELECT count(*) AS count, round(avg(threat_score)) AS avg_score "
                              "FROM gold"),
    "top_events_by_score": ("gold", f"""
        SELECT id AS silver_id, {clock('event_time')} AS event_time, event_type, source_ip,
          threat_score FROM (SELECT *, row_number() OVER (
            ORDER BY threat_score DESC, event_time, id) AS k FROM gold) WHERE k <= 50"""),
    "ip_timeline": ("gold", f"""
        SELECT id AS silver_id, {clock('event_time')} AS event_time, event_type, severity, action,
          threat_score FROM gold WHERE source_ip = '10.0.0.7'"""),
    "narrative_search": ("found", f"""
        SELECT * FROM (
          SELECT 'event' AS record_type, id AS record_id, source_ip,
            {clock('event_time')} AS event_time, recommended_action, narrative AS text FROM gold
          UNION ALL
          SELECT 'aggregation', flink_id, source_ip, {clock('event_time')}, recommended_action,
            concat_ws(' ', description, narrative) FROM aggregations)
        WHERE regexp_matches(lower(text), '(^|[^a-z0-9])ssh([^a-z0-9]|$)')
          AND regexp_matches(lower(text), '(^|[^a-z0-9])attempt([^a-z0-9]|$)')"""),
}

# Queries that write a table and read it back have the statement of the plain form.
for _stored, _plain in (("archive_read", "lake_pruned_read"), ("insert_ignore_table", "insert_ignore"),
                        ("upsert_versions", "upsert_latest"), ("narrative_index_search", "narrative_search")):
    _BODIES[_stored] = _BODIES[_plain]

ORACLE = {name: statement(need, body.strip()) for name, (need, body) in _BODIES.items()}
