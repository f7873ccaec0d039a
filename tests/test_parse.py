"""Strict decoding: what is a record, what is a dead letter, and why."""

import json

import pytest
from pyspark.sql import functions as F

from duskwatch import schemas
from duskwatch.operators.assess import apply_replies, parse_replies
from duskwatch.operators.parse import parse_bronze, parse_findings, parse_silver
from duskwatch.plans import pipeline
from duskwatch.sinks.messages import dead_letter_messages, to_messages
from duskwatch.sources.replies import entry_messages
from duskwatch.sources.topics import BASELINE, CORRELATED, WINDOWED

OK = {"id": "a", "timestamp": "2026-02-08T09:15:32Z"}


def feed(spark, *texts):
    return spark.createDataFrame([(t, "bronze") for t in texts], "value string, topic string")


def one(spark, **fields):
    good, dead = parse_bronze(feed(spark, json.dumps({**OK, **fields})))
    return good.collect(), dead.collect()


NOT_RECORDS = [
    "{bad", "[1]", "", None, "5", "null", '{"id":"a"}', '{"timestamp":"t"}', json.dumps(OK) + " x",
    json.dumps(OK) + json.dumps(OK), json.dumps(OK) + "," + json.dumps(OK),
    json.dumps(OK) + "] x", json.dumps(OK) + "]", json.dumps(OK)[:-1] + ',"asset_tags":[{"a":1}] }]']


def test_not_a_record(spark):
    good, dead = parse_bronze(feed(spark, *NOT_RECORDS))
    assert good.count() == 0
    rows = dead.collect()
    assert [r.original_message for r in rows] == NOT_RECORDS
    assert all(r.error and r.stage == "parse" and r.topic == "bronze" for r in rows)


MISTYPED = [
    ("id", 5), ("id", None), ("source_port", 1.5), ("source_port", "x"), ("source_port", []),
    ("asset_tags", None), ("asset_tags", "x"), ("asset_tags", ["x", 1]), ("asset_tags", ["x", None]),
    ("threat_indicators", None), ("raw", None), ("raw", []), ("user", 5),
    ("log_metadata", "x"), ("log_metadata", {"collector": 5}),
    ("resource_utilization", {"cpu_percent": "hot"}), ("resource_utilization", {"process_id": 1.5})]


def test_mistyped_field(spark):
    good, dead = parse_bronze(feed(spark, *[json.dumps({**OK, f: v}) for f, v in MISTYPED]))
    assert good.count() == 0
    errors = [r.error for r in dead.collect()]
    assert [e.startswith(f) for e, (f, _) in zip(errors, MISTYPED)] == [True] * len(MISTYPED)


def test_accepted_spellings(spark):
    [row], dead = one(
        spark, source_port="443", destination_port=80.0, vlan_id=True, bytes_sent=" 12 ",
        unknown_key=1, policy_violation={}, log_metadata=None, threat_indicators=["a", 1, {"b": 2}],
        session_details=[1], raw={"x": 1}, resource_utilization={"cpu_percent": "12.5",
                                                                 "process_id": 7})
    assert dead == []
    assert (row.source_port, row.destination_port, row.vlan_id, row.bytes_sent) == (443, 80, 1, 12)
    assert row.policy_violation is not None and row.log_metadata is None
    assert row.threat_indicators == ["a", "1", '{"b":2}'] and row.asset_tags == []
    assert (row.resource_utilization.cpu_percent, row.resource_utilization.process_id) == (12.5, 7)


def test_repeated_key_keeps_last_value(spark):
    good, _ = parse_bronze(feed(spark, '{"id":"a","id":"b","timestamp":"t"}'))
    assert [r.id for r in good.collect()] == ["b"]


def test_bronze_schema(spark):
    good, dead = parse_bronze(feed(spark, json.dumps(OK)))
    schemas.assert_schema(good, "bronze")
    schemas.assert_schema(dead, "dead_letter")


def test_messages_are_decoded_once(spark):
    good, dead = parse_bronze(feed(spark, json.dumps(OK)))
    for split in (good, dead):
        plan = split._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parse_json(concat([") <= 1


def test_silver_round_trip(spark, sf_small):
    silver = pipeline.silver_table(spark, sf_small)
    back, dead = parse_silver(to_messages(silver, "silver", "id"))
    schemas.assert_schema(back, "silver")
    assert dead.count() == 0
    assert silver.exceptAll(back).count() == 0 and back.count() == silver.count()


def test_silver_dead_letters(spark):
    bad = ['{"id":"a"}', json.dumps({**OK, "original_id": "o", "event_time": "never",
                                     "event_type": "X", "severity": "INFO"}),
           json.dumps({"id": "a", "original_id": "o", "event_time": "2026-01-01T00:00:00Z",
                       "event_type": "X", "severity": "info"})]
    good, dead = parse_silver(feed(spark, *bad))
    assert good.count() == 0
    errors = [r.error for r in dead.collect()]
    assert "event_time: expected timestamp" in errors[1] and "severity" in errors[2]
    [topic] = dead_letter_messages(dead).select("topic").distinct().collect()
    assert topic[0] == "logs.dead.enrich-errors.v1"


def test_reply_entries(spark):
    replies = ['```json\n[{"id":"a","bytes_sent":1},{"id":5},{"id":"b","file_hash":"x"}]\n```',
               '{"id":"a"}', "sorry", '[{"id":"c"}', '[{"id":"d","log_metadata":{"collector":1}}]']
    rows = spark.createDataFrame([(r,) for r in replies], "reply string")
    got = [r.key for r in entry_messages(rows, "bronze").collect()]
    assert got == ["a", "b"]


@pytest.mark.parametrize("text,tier,narrative,tactic", [
    ('{"recommended_action":"page","narrative":"n","mitre_tactic":"T"}', "page", "n", "T"),
    ('```json\n{"recommended_action":"digest"}\n```', "digest", "No narrative generated.", None),
    ('Well: {"recommended_action":"what","narrative":null} ok', "ticket", None, None),
    ('{"mitre_tactic":"T"}', "ticket", "No narrative generated.", "T")])
def test_reply_reading(spark, text, tier, narrative, tactic):
    row = parse_replies(spark.createDataFrame([(text,)], "reply string")).first()
    assert (row.tier, row.narrative, row.mitre_tactic, row.error) == (tier, narrative, tactic, None)


def test_unreadable_reply(spark):
    texts = ["sorry", "[1,2]", "", None, "5", "{a} {b}"]
    rows = parse_replies(spark.createDataFrame([(x,) for x in texts], "reply string")).collect()
    assert all(r.tier is None and r.error for r in rows) and len(rows) == len(texts)


def test_apply_replies_options(spark):
    scored = spark.createDataFrame([("a", 90), ("b", 10), ("c", 50), ("d", 50)],
                                   "id string, threat_score int")
    replies = spark.createDataFrame(
        [("a", '{"recommended_action":"page"}'), ("b", '{"recommended_action":"page"}'),
         ("c", "sorry")], "id string, reply string")

    def actions(df):
        return {r.id: (r.recommended_action, r.error is not None) for r in df.collect()}

    assert actions(apply_replies(scored, replies)) == {
        "a": ("page", False), "b": (None, False), "c": (None, True), "d": ("ticket", False)}
    assert actions(apply_replies(scored, replies, on_error="ticket"))["c"] == ("ticket", False)
    assert actions(apply_replies(scored)) == {
        "a": ("contain", False), "b": (None, False), "c": ("ticket", False), "d": ("ticket", False)}


def test_findings_from_topics(spark):
    stats = {"current_count": 9, "rolling_average": 3, "multiplier": 3.0, "threshold": 3.0,
             "windows_in_baseline": 6}
    rows = [(WINDOWED, {"id": "v", "event_count": 10, "first_seen": "2024-01-01T00:00:00Z",
                        "severity": "HIGH"}),
            (CORRELATED, {"id": "c", "chain": {"success": {"id": "x"}}, "correlated": True}),
            (BASELINE, {"id": "b", "baseline_stats": stats, "triggering_event": None}),
            (BASELINE, {"id": "d", "chain": []}), (WINDOWED, {"event_count": 1})]
    df = spark.createDataFrame([(json.dumps(r), t) for t, r in rows], "value string, topic string")
    good, dead = parse_findings(df)
    schemas.assert_schema(good, "aggregation")
    got = {r.id: r for r in good.collect()}
    assert {k: r.aggregation_type for k, r in got.items()} == {
        "v": "velocity", "c": "cep_chain", "b": "baseline"}
    assert got["c"].chain == '{"success":{"id":"x"}}' and got["v"].first_seen.year == 2024
    assert got["b"].baseline_stats.rolling_average == 3.0 and got["c"].correlated
    assert sorted(r.error for r in dead.collect()) == ["chain: expected object", "id: expected text"]
