"""Streams over JSON-line files: batch results, late rows, replays."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from duskwatch import schemas
from duskwatch.operators import baseline, chains, velocity
from duskwatch.sources.messages import file_messages, record_time
from duskwatch.sources.topics import BRONZE, CORRELATED
from duskwatch.streaming import detectors, joins, runs

BASE = dt.datetime(2024, 1, 1)
SCHEMA = "id string, event_time timestamp, source_ip string, event_type string, action string, " \
         "destination_ip string, destination_port int, bytes_sent bigint"


def make_events(n, seed, late_by=0):
    r = random.Random(seed)
    out, t = [], 0.0
    for k in range(n):
        t += r.choice([0.5, 5, 20, 40])
        out.append((f"e{seed}-{k:05d}", BASE + dt.timedelta(seconds=t - r.random() * late_by),
                    r.choice(["1.1.1.1", "2.2.2.2", None]),
                    r.choice(["PORT_SCAN", "LOGIN", "LOGIN", "DNS"]),
                    r.choice(["ALLOW", "DROP", "BLOCK", None]), r.choice(["9.9.9.1", "9.9.9.2", None]),
                    r.choice([22, 443, None]), r.randint(0, 100)))
    return out


def write_files(folder, events, parts):
    folder.mkdir()
    size = -(-len(events) // parts)
    for p in range(parts):
        lines = [json.dumps({"id": e[0], "event_time": e[1].isoformat() + "Z", "source_ip": e[2],
                             "event_type": e[3], "action": e[4], "destination_ip": e[5],
                             "destination_port": e[6], "bytes_sent": e[7]})
                 for e in events[p * size:(p + 1) * size]]
        (folder / f"part-{p:03d}.json").write_text("\n".join(lines) + "\n")


@pytest.fixture()
def fed(spark, tmp_path):
    """Stream and batch over the same events, with a last event that closes all windows."""
    events = make_events(600, 7, late_by=20)
    end = max(e[1] for e in events)
    marker = [("end", end + dt.timedelta(hours=2), "0.0.0.0", "END", None, None, None, 0)]
    write_files(tmp_path / "in", events, 3)
    (tmp_path / "in" / "part-999.json").write_text(json.dumps(
        {"id": "end", "event_time": marker[0][1].isoformat() + "Z", "source_ip": "0.0.0.0",
         "event_type": "END", "bytes_sent": 0}) + "\n")
    stream = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
              .json(str(tmp_path / "in")))
    return stream, spark.createDataFrame(events + marker, SCHEMA)


def run(stream, tmp_path, name):
    out = []
    runs.start(stream, name, lambda b, n: out.extend(b.collect()), once=True,
               checkpoint_dir=str(tmp_path / f"cp-{name}")).awaitTermination(120)
    return out


def test_velocity_stream_equals_batch(fed, tmp_path):
    stream, batch = fed
    columns = ["velocity_key", "window_start", "event_count", "unique_dest_ips",
               "unique_dest_ports", "total_bytes_sent", "first_seen", "last_seen", "description"]
    live = detectors.velocity_stream(detectors.with_watermark(stream), "5 minutes", 3)
    got = sorted(tuple(r) for r in run(live.select(*columns), tmp_path, "velocity"))
    want = velocity.velocity_windows(batch.where("id <> 'end'"), "5 minutes", 3)
    assert got == sorted(tuple(r) for r in want.select(*columns).collect())
    assert len(got) > 20


def test_chain_stream_equals_batch(fed, tmp_path):
    stream, batch = fed
    live = detectors.chains_stream(detectors.with_watermark(stream), "10 minutes")
    got = sorted((r.source_ip or "None", r.scan_id, r.block_id, r.success_id, r.event_time)
                 for r in run(live, tmp_path, "chains"))
    want = chains.attack_chains(batch, "10 minutes").collect()
    assert got == sorted((r.source_ip, r.scan_id, r.block_id, r.success_id, r.event_time)
                         for r in want)
    assert len(got) > 10


def test_baseline_stream_equals_batch(fed, tmp_path):
    stream, batch = fed
    live = detectors.velocity_stream(detectors.with_watermark(stream), "5 minutes", 1)
    got = run(detectors.baseline_stream(live, 1.5).select("id", "description", "event_count"),
              tmp_path, "baseline")
    windows = velocity.velocity_windows(batch.where("id <> 'end'"), "5 minutes", 1)
    want = baseline.baseline_alerts(windows, 1.5).select("id", "description", "event_count")
    assert sorted(map(tuple, got)) == sorted(map(tuple, want.collect()))
    assert got


def test_late_rows_are_dropped(spark, tmp_path):
    early = [(f"a{i}", BASE + dt.timedelta(minutes=i), "1.1.1.1", "LOGIN", "ALLOW", None, None, 1)
             for i in range(0, 20, 2)]
    late = [("late", BASE + dt.timedelta(minutes=1), "1.1.1.1", "LOGIN", "ALLOW", None, None, 1),
            ("z", BASE + dt.timedelta(hours=2), "1.1.1.1", "END", None, None, None, 1)]
    folder = tmp_path / "in"
    write_files(folder, early, 1)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(folder))
    live = detectors.velocity_stream(detectors.with_watermark(stream), "5 minutes", 1)
    cp = tmp_path / "x"
    cp.mkdir()
    first = run(live.select("window_start", "event_count"), cp, "late")
    (folder / "part-500.json").write_text("\n".join(json.dumps(
        {"id": e[0], "event_time": e[1].isoformat() + "Z", "source_ip": e[2], "event_type": e[3],
         "bytes_sent": 1}) for e in late) + "\n")
    second = run(live.select("window_start", "event_count"), cp, "late")
    counts = {r.window_start: r.event_count for r in first + second}
    assert sum(counts.values()) == len(early)


def test_clean_stream_replays_without_copies(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    good = {"id": "log_1", "timestamp": "2026-02-08T09:15:32Z", "source_ip": "1.2.3.4"}
    lines = [json.dumps(good), json.dumps(good), '{"id": 5}', "{bad",
             json.dumps({**good, "id": "log_2", "timestamp": ""})]
    (folder / "a.txt").write_bytes("\n".join(lines).encode() + b"\n\xff\xfe\n")
    silver, dead = str(tmp_path / "silver"), str(tmp_path / "dead")
    for attempt in ("one", "two"):       # a lost checkpoint means a full replay
        stream = file_messages(spark, str(folder), BRONZE)
        runs.clean_stream(stream, silver, dead, once=True,
                          checkpoint_dir=str(tmp_path / attempt)).awaitTermination(120)
        assert spark.read.parquet(silver).count() == 2
        assert spark.read.parquet(dead).count() == 3


def test_stream_join_matches_batch_summary(spark, tmp_path):
    gold_rows = [(f"g{i}", BASE + dt.timedelta(seconds=20 * i), "1.1.1.1", "LOGIN", 10 + i % 7)
                 for i in range(60)]
    finding_rows = [(f"f{i}", "1.1.1.1" if i % 2 else "8.8.8.8", "LOGIN",
                     BASE + dt.timedelta(minutes=i, seconds=59), BASE + dt.timedelta(minutes=i))
                    for i in range(12)]
    for name, rows, schema in (
            ("g", gold_rows + [("gz", BASE + dt.timedelta(hours=9), "x", "x", 0)],
             "id string, at timestamp, ip string, kind string, threat_score int"),
            ("f", finding_rows + [("fz", "x", "x", BASE + dt.timedelta(hours=9),
                                   BASE + dt.timedelta(hours=9))],
             "id string, source_ip string, source_event_type string, event_time timestamp, "
             "first_seen timestamp")):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / name))
    none = F.lit(None).cast("string")

    def gold_of(df):
        return df.select(
            F.struct(F.col("id"), F.col("at").alias("event_time"), F.col("ip").alias("source_ip"),
                     F.col("kind").alias("event_type")).alias("silver"), "threat_score",
            none.alias("recommended_action"), none.alias("mitre_tactic"), none.alias("narrative"),
            none.alias("ip_reputation"), none.alias("asset_context"),
            none.alias("identity_context"))

    def findings_of(df):
        return df.withColumn("last_seen", F.col("event_time"))

    def read(name):
        plain = spark.read.parquet(str(tmp_path / name))
        return spark.readStream.schema(plain.schema).parquet(str(tmp_path / name))

    live = joins.enrich_findings_stream(findings_of(read("f")), gold_of(read("g")))
    got = {r.finding_id: (r.max_threat_score, r.avg_threat_score, r.gold_events_found,
                          list(r.source_event_ids)) for r in run(live, tmp_path, "join")}
    for name, ip, kind, last, first in finding_rows:
        hits = sorted([g for g in gold_rows if g[2] == ip and first <= g[1] <= last],
                      key=lambda g: (-g[4], g[1], g[0]))
        scores = [g[4] for g in hits]
        want = (max(scores), sum(scores) // len(scores), len(hits), [g[0] for g in hits]) \
            if hits else (None, None, 0, [])
        assert got[name] == want


def test_detector_streams_emit_messages(fed, tmp_path):
    stream, _ = fed
    seen = {}

    def emit(topic, messages, number):
        seen.setdefault(topic, []).extend(messages.collect())

    for query in runs.detector_streams(stream, emit, "5 minutes", 3, "10 minutes", 1.5, once=True,
                                       checkpoint_dir=str(tmp_path / "cp")):
        query.awaitTermination(120)
    assert len(seen) == 3 and all(seen.values())
    first = seen[CORRELATED][0]
    assert first.key.startswith("cep_") and json.loads(first.value)["correlated"] is True


def test_record_time_falls_back_to_broker_time(spark):
    row = spark.sql("select 'nope' as a, '2024-01-01T00:00:00Z' as b, timestamp'2025-01-01' as t")
    got = row.select(record_time(F.col("a"), F.col("t")).alias("a"),
                     record_time(F.col("b"), F.col("t")).alias("b")).first()
    assert (got.a.year, got.b.year) == (2025, 2024)


def test_layer_schemas_parse(spark):
    for layer in schemas.LAYERS:
        assert schemas.layer_schema(layer).fields


def test_gold_is_kept_for_a_whole_window(spark):
    with pytest.raises(ValueError, match="miss matches"):
        joins.enrich_findings_stream(None, None, window="2 hours", keep="30 minutes")


def test_archive_keeps_rows_without_a_time_as_dead_letters(spark, tmp_path):
    source = str(tmp_path / "in")
    rows_ = [("2024-01-01T00:00:00Z", "good"), ("no time", "bad")]
    spark.createDataFrame(rows_, "timestamp string, id string").write.parquet(source)
    stream = spark.readStream.schema("timestamp string, id string").parquet(source)
    runs.archive_stream(stream, "bronze", str(tmp_path / "lake"), "b", str(tmp_path / "dead"), once=True,
                        checkpoint_dir=str(tmp_path / "c")).awaitTermination()
    assert spark.read.json(str(tmp_path / "lake")).count() == 1
    assert "bad" in spark.read.parquet(str(tmp_path / "dead")).first().original_message


def test_replay_on_another_day_adds_no_row(spark, tmp_path):
    """A record without a readable time keeps the time of its message."""
    silver, dead = str(tmp_path / "silver"), str(tmp_path / "dead")
    source = str(tmp_path / "in")
    line = json.dumps({"id": "x", "timestamp": "", "source_ip": "1.2.3.4"})
    spark.createDataFrame([(line, "b", dt.datetime(2024, 5, 6, 23, 59))],
                          "value string, topic string, timestamp timestamp").write.parquet(source)
    for attempt in ("one", "two"):
        stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
        runs.clean_stream(stream, silver, dead, once=True,
                          checkpoint_dir=str(tmp_path / attempt)).awaitTermination(120)
    rows_ = spark.read.parquet(silver).select("event_time").collect()
    assert [r.event_time for r in rows_] == [dt.datetime(2024, 5, 6, 23, 59)]
