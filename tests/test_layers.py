"""Sample records through all layers, sinks that are run twice, lake reads."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from duskwatch import schemas
from duskwatch.operators import assess, enrich
from duskwatch.operators.clean import clean_event
from duskwatch.operators.parse import parse_bronze
from duskwatch.operators.score import with_threat_score
from duskwatch.plans import inputs, pipeline, views
from duskwatch.sinks import lake, rows, tables
from duskwatch.sources.lake import hour_range, read_lake

BASE = dt.datetime(2024, 1, 1)
META = {"source_type": "firewall"}

# Sample records, with the score each must get without any address feed.
SAMPLES = [
    (24, {"id": "web", "source_ip": "10.20.0.7", "action": "ALLOW", "severity": "INFO",
          "event_type": "HTTPS_CONNECTION", "user": "m.okafor", "device_name": "desk-17",
          "network_details": {"security_zone": "trusted"}, "tcp_flags": "SYN,ACK",
          "asset_tags": ["production", "floor_two"], "policy_violation": None}),
    (100, {"id": "ssh", "source_ip": "198.51.100.9", "action": "BLOCK", "severity": "HIGH",
           "event_type": "SSH_ATTEMPT", "user": None, "device_name": "edge-3",
           "network_details": {"security_zone": "untrusted"},
           "policy_violation": {"policy_severity": "high"},
           "asset_tags": ["DMZ_server", "rack_b"]}),
    (14, {"id": "git", "source_ip": "10.20.0.8", "action": "ALLOW", "severity": "INFO",
          "event_type": "HTTPS_CONNECTION", "user": "p.lindqvist",
          "device_name": "note-51", "network_details": {"security_zone": "trusted"},
          "resource_utilization": {"cpu_percent": 3.5, "process_name": "sync",
                                   "process_id": 4100},
          "asset_tags": ["floor_one"]}),
    (100, {"id": "brute", "source_ip": "203.0.113.77", "action": "BLOCK",
           "severity": "CRITICAL", "event_type": "BRUTE_FORCE", "user": "admin",
           "device_name": "login-2", "network_details": {"security_zone": "untrusted"},
           "policy_violation": {"policy_severity": "high"},
           "asset_tags": ["internet_facing"]}),
]


@pytest.fixture(scope="module")
def sample_gold(spark):
    stamp = {"timestamp": "2026-02-08T09:15:32.142Z", "log_metadata": META}
    messages = spark.createDataFrame([(json.dumps({**stamp, **r}), "b") for _, r in SAMPLES],
                                     "value string, topic string")
    good, dead = parse_bronze(messages)
    assert dead.count() == 0
    silver = clean_event(good)
    schemas.assert_schema(silver, "silver")
    empty = spark.createDataFrame([], schemas.layer_schema("ip_intel"))
    scored = with_threat_score(enrich.enrich(silver, empty, enrich.asset_dim(spark),
                                             enrich.identity_dim(spark)))
    gold, failed = assess.build_gold(scored)
    assert failed.count() == 0
    return gold.cache()


def test_sample_scores(sample_gold):
    got = {r.silver.original_id: r for r in sample_gold.collect()}
    assert {n: r.threat_score for n, r in got.items()} == {r["id"]: s for s, r in SAMPLES}
    assert got["git"].recommended_action is None and got["web"].recommended_action == "digest"
    assert got["brute"].score_breakdown["identity_risk"] == 16
    assert got["ssh"].ip_reputation.abuse_score == 0 and got["ssh"].identity_context is None
    assert got["web"].silver.cleaning_warnings == []


def test_gold_schema_and_wide_rows(sample_gold):
    schemas.assert_schema(sample_gold, "gold")
    wide = rows.events_wide(sample_gold)
    assert len(wide.columns) == 50
    row = wide.where("original_id = 'ssh'").first()
    assert row.identity_context == "null" and json.loads(row.score_breakdown)["composite"] == 100


def test_dispatch_lists(sample_gold):
    lists = assess.dispatch_lists(sample_gold)
    assert {k: v.count() for k, v in lists.items()} == {"ticket": 0, "page": 0, "contain": 2}


def test_findings_schema(spark, sf_small):
    schemas.assert_schema(pipeline.findings_table(spark, sf_small), "aggregation", partial=True)
    with pytest.raises(ValueError):
        schemas.assert_schema(spark.range(1), "silver")


def test_insert_ignore_twice(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = spark.createDataFrame([("a", BASE, 1), ("a", BASE, 1), ("b", BASE, 2), ("n", None, 3)],
                                  "k string, event_time timestamp, v int")
    for _ in range(2):
        tables.insert_ignore(batch, path, "k")
    later = spark.createDataFrame([("a", BASE, 9), ("c", BASE + dt.timedelta(1), 4)], batch.schema)
    tables.insert_ignore(later, path, "k")
    got = {(r.k, r.v) for r in spark.read.parquet(path).collect()}
    assert got == {("a", 1), ("b", 2), ("c", 4), ("n", 3)}
    assert spark.read.parquet(path).count() == 4


def test_upsert_twice(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k string, event_time timestamp, v int, version int"
    first = spark.createDataFrame([("a", BASE, 1, 1), ("b", BASE, 2, 1),
                                   ("z", BASE + dt.timedelta(9), 7, 1)], schema)
    second = spark.createDataFrame([("a", BASE, 5, 2), ("a", BASE, 6, 3), ("c", BASE, 3, 2)], schema)
    tables.upsert_latest(first, path, "k", ["version"])
    for _ in range(2):
        tables.upsert_latest(second, path, "k", ["version"])
    got = sorted((r.k, r.v) for r in spark.read.parquet(path).collect())
    assert got == [("a", 6), ("b", 2), ("c", 3), ("z", 7)]
    assert tables.expired_dates(spark, path, dt.date(2024, 1, 31), 25) == ["2024-01-01"]


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_lake_round_trip_and_pruning(spark, sf_small, tmp_path, fmt):
    path = str(tmp_path / "lake")
    silver = pipeline.silver_table(spark, sf_small)
    good, bad = lake.split_by_time(silver, "silver", "t")
    assert bad.count() == 0
    lake.write_lake(good, path, fmt, max_records=lake.profile("silver", "prod").records)
    start, end = dt.datetime(2024, 1, 3, 5), dt.datetime(2024, 1, 9, 17, 30)
    part = read_lake(spark, path, "silver", fmt, start, end)
    hours = silver.where((F.col("event_time") >= start)
                         & (F.col("event_time") < end.replace(hour=18, minute=0)))
    assert part.count() == hours.count() > 0
    assert part.drop("year", "month", "day", "hour").select("id", "event_time").exceptAll(
        hours.select("id", "event_time")).count() == 0
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_hour_range_is_exact(spark):
    hours = (spark.range(24 * 800).select(F.timestamp_seconds(
        F.lit(1690000000 // 3600 * 3600) + F.col("id") * 3600).alias("t")))
    start, end = dt.datetime(2023, 12, 30, 22), dt.datetime(2024, 2, 2, 3)
    got = lake.with_hours(hours, F.col("t")).where(hour_range(start, end))
    assert got.count() == hours.where((F.col("t") >= start) & (F.col("t") < end)).count()


def test_views_by_sql(spark, sf_small):
    events = rows.events_wide(pipeline.gold_table(spark, sf_small))
    views.register_views(spark, events, pipeline.aggregations_table(spark, sf_small), "1 day")
    top = spark.sql("SELECT source_ip, avg_score FROM v_top_threat_ips LIMIT 3").collect()
    assert len(top) == 3 and top[0].avg_score >= top[1].avg_score
    assert spark.sql("SELECT count(*) FROM v_ip_full_picture").first()[0] > events.count()
    assert spark.sql("SELECT count(*) FROM v_aggregation_enriched").first()[0] > 0


def test_top_ips_keep_missing_type(spark):
    events = spark.createDataFrame(
        [("a", None, None, 10, BASE), ("a", "X", "T", 21, BASE), ("a", "X", None, 20, BASE)],
        "source_ip string, event_type string, mitre_tactic string, threat_score int, "
        "event_time timestamp")
    row = views.top_threat_ips(events).first()
    assert row.event_types == ["X", None] and row.mitre_tactics == ["T"] and row.avg_score == 17


def test_filters_reach_the_scan(spark, sf_small):
    raw = inputs.table(spark, sf_small, "events").where("event_id > 5").select("event_id")
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(event_id,5)" in plan and "ReadSchema: struct<event_id:bigint>" in plan
    stored = views.events_where(rows.events_wide(pipeline.gold_table(spark, sf_small)),
                                severity="HIGH").select("silver_id")
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(silver.severity,HIGH)" in plan
    assert "cleaning_warnings" not in plan.split("ReadSchema")[1]


def test_one_sided_lake_ranges(spark, tmp_path):
    at = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    rows_ = spark.createDataFrame([(t, t.day) for t in at], "t timestamp, d int")
    lake.write_lake(lake.with_hours(rows_, F.col("t")), str(tmp_path / "l"), fmt="parquet")
    read = lambda **k: sorted(r.d for r in read_lake(spark, str(tmp_path / "l"), fmt="parquet", **k).collect())
    assert read(start=at[1]) == [2, 3] and read(end=at[1]) == [1] and read() == [1, 2, 3]


def test_all_pulses_are_read(spark):
    df = spark.sql("SELECT transform(sequence(1, 13), i -> named_struct('tags', array('t' || i))) AS p")
    got = df.select(enrich.pulse_terms(F.col("p"), "tags").alias("all"),
                    enrich.pulse_terms(F.col("p"), "tags", 10).alias("ten")).first()
    assert len(got["all"]) == 13 and len(got["ten"]) == 10


def test_dead_letters_of_two_streams_and_a_replay(spark, tmp_path):
    path = str(tmp_path / "dead")
    for topic, day in (("a", 1), ("b", 1), ("a", 2)):
        dead = spark.createDataFrame([("m", "e", "parse", dt.datetime(2024, 1, day), topic)],
                                     "original_message string, error string, stage string, "
                                     "timestamp timestamp, topic string")
        tables.insert_dead_letters(dead, path, "clean", timed=False)
    assert sorted(r.topic for r in spark.read.parquet(path).collect()) == ["a", "b"]


def test_lookup_reads_only_the_dates_of_a_batch(spark, tmp_path, monkeypatch):
    """A stray old date and a missing one do not open the folders in between."""
    path = str(tmp_path / "t")
    make = lambda days: spark.createDataFrame(
        [(f"k{d}", None if d is None else BASE + dt.timedelta(days=d)) for d in days],
        "k string, event_time timestamp")
    tables.insert_ignore(make([-19000, *range(30), None]), path, "k")
    batch = tables._dated(make([-19000, 29, None]), "event_time")
    wanted = tables._same_dates(spark.read.parquet(path), batch)
    assert {r.k for r in wanted.collect()} == {"k-19000", "k29", "kNone"}
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    for listed in (1000, 1):
        monkeypatch.setattr(tables, "LISTED", listed)
        tables.insert_ignore(make([-19000, 29, None]), path, "k")
        assert spark.read.parquet(path).count() == 32
