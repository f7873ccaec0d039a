"""Whole streams from files to tables, each run twice from the start."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from test_streaming import BASE, make_events, run, write_files

from duskwatch import schemas
from duskwatch.operators import enrich, interval, velocity
from duskwatch.operators.assess import build_gold
from duskwatch.operators.parse import parse_findings, parse_gold, parse_silver
from duskwatch.operators.score import with_threat_score
from duskwatch.sinks import lake, rows
from duskwatch.sinks.messages import to_messages
from duskwatch.sources import versions
from duskwatch.sources.lake import read_archive
from duskwatch.sources.messages import file_messages
from duskwatch.sources.topics import BRONZE, CORRELATED, GOLD, SILVER, WINDOWED
from duskwatch.streaming import detectors, runs


def silver_of(spark, events):
    """Silver records of (id, time, address, type, action, ...) tuples."""
    given = {"id": 0, "original_id": 0, "event_time": 1, "source_ip": 2, "event_type": 3, "action": 4, "destination_ip": 5,
             "destination_port": 6, "bytes_sent": 7}
    fields = schemas.layer_schema("silver")
    plain = {"severity": "HIGH", "bytes_received": 0, "packet_count": 0, "duration_ms": 0}
    data = [tuple(e[given[f.name]] if f.name in given else plain.get(f.name, [] if f.dataType.typeName() == "array"
                                                                     else None)
                  for f in fields) for e in events]
    return spark.createDataFrame(data, fields)


def writer(folder):
    """Messages as text files, one folder per topic, as a topic would carry them."""
    def emit(topic, messages, number):
        messages.select("value").write.mode("append").text(f"{folder}/{topic}")
    return emit


@pytest.fixture()
def lookups(spark, tmp_path):
    empty = spark.createDataFrame([], schemas.layer_schema("ip_intel"))
    versions.publish(empty, str(tmp_path / "intel"), 1)
    return lambda: {"ip_intel": versions.current(spark, str(tmp_path / "intel")),
                    "assets": enrich.asset_dim(spark), "identities": enrich.identity_dim(spark)}


def end_marker(events):
    return ("end", max(e[1] for e in events) + dt.timedelta(hours=9), "0.0.0.0", "END", None, None, None, 0)


def test_rate_findings_of_a_stream_equal_a_batch(spark, tmp_path):
    events = make_events(500, 3, late_by=20)
    whole = silver_of(spark, [*events, end_marker(events)])
    whole.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(whole.schema).parquet(str(tmp_path / "in"))
    live = detectors.velocity_findings_stream(detectors.with_watermark(stream), "5 minutes", 3)
    got = run(live, tmp_path, "rates")
    batch = whole.where("id <> 'end'")
    want = velocity.velocity_findings(velocity.velocity_windows(batch, "5 minutes", 3), batch)
    assert live.columns == want.columns
    assert sorted(map(str, got)) == sorted(map(str, want.collect())) and len(got) > 20


def test_detector_messages_find_their_gold(spark, tmp_path, lookups):
    """Detector -> message -> parse -> join finds the events a finding was made of."""
    events = make_events(400, 5)
    whole = silver_of(spark, [*events, end_marker(events)])
    whole.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(whole.schema).parquet(str(tmp_path / "in"))
    for query in runs.detector_streams(stream, writer(tmp_path / "topics"), "5 minutes", 3, "10 minutes", 1.5,
                                       once=True, checkpoint_dir=str(tmp_path / "cp")):
        query.awaitTermination(120)
    gold, _ = build_gold(with_threat_score(enrich.enrich(whole, **lookups())))
    messages = file_messages(spark, f"{tmp_path}/topics/{WINDOWED}", WINDOWED, stream=False)
    findings, dead = parse_findings(messages)
    assert dead.count() == 0
    linked = interval.enrich_findings(findings, gold).where("source_ip is not null").collect()
    assert linked and all(r.enrichment_summary.gold_events_found >= r.event_count for r in linked)


def test_enrichment_stream(spark, tmp_path, lookups):
    folder = tmp_path / "raw"
    folder.mkdir()
    good = [{"id": f"log_{i}", "timestamp": f"2026-02-08T09:{i:02d}:32Z", "source_ip": "1.2.3.4",
             "event_type": "MALWARE", "severity": "critical"} for i in range(20)]
    (folder / "a.txt").write_text("\n".join(map(json.dumps, good[:12])) + "\n{bad\n")
    (folder / "b.txt").write_text("\n".join(map(json.dumps, good[10:])) + "\n")
    path = {n: str(tmp_path / n) for n in ("silver", "gold", "dead", "events", "documents")}
    seen = []
    for attempt in ("one", "two"):            # a lost checkpoint means a full replay
        emit, cp = writer(tmp_path / "topics"), tmp_path / attempt
        runs.clean_stream(file_messages(spark, str(folder), BRONZE), path["silver"], path["dead"], once=True,
                          checkpoint_dir=str(cp / "clean"), emit=emit).awaitTermination(120)
        (tmp_path / "topics" / SILVER / f"bad-{attempt}.txt").write_text('{"id": "x"}\nnot json\n')
        silver = file_messages(spark, f"{tmp_path}/topics/{SILVER}", SILVER)
        runs.enrichment_stream(silver, lookups, path["gold"], path["dead"], emit=emit, once=True,
                               checkpoint_dir=str(cp / "enrich")).awaitTermination(120)
        table = spark.read.parquet(path["gold"])
        live = spark.readStream.schema(table.schema).parquet(path["gold"])
        runs.store_stream(live, path["events"], path["documents"], once=True,
                          checkpoint_dir=str(cp / "store")).awaitTermination(120)
        events = spark.read.parquet(path["events"]).orderBy("silver_id").collect()
        assert len(events) == len({e.silver_id for e in events}) == 20
        assert spark.read.parquet(path["documents"]).count() == 20
        stages = {r.stage: r.n for r in spark.read.parquet(path["dead"]).groupBy("stage").agg(
            F.count("*").alias("n")).collect()}
        assert stages == {"parse": 1, "enrich-parse": 2}
        seen.append(events)
    assert seen[0] == seen[1]
    back, dead = parse_gold(file_messages(spark, f"{tmp_path}/topics/{GOLD}", GOLD, stream=False))
    assert dead.count() == 0 and back.select("silver.id").distinct().count() == 20
    first = back.where(F.col("silver.id") == seen[0][0].silver_id).first()
    assert first.threat_score == seen[0][0].threat_score and first.silver.event_time == seen[0][0].event_time


def test_unreadable_replies_are_dead_letters(spark, tmp_path, lookups):
    silver = silver_of(spark, [("s1", BASE, "1.1.1.1", "MALWARE", "ALLOW", None, None, 1),
                               ("s2", BASE, "1.1.1.1", "MALWARE", "ALLOW", None, None, 1)])
    writer(tmp_path)(SILVER, to_messages(silver, SILVER, "id"), 0)
    replies = spark.createDataFrame([("s1", "no object"), ("s2", '{"recommended_action": "page"}')],
                                    "id string, reply string")
    runs.enrichment_stream(file_messages(spark, f"{tmp_path}/{SILVER}", SILVER), lookups, str(tmp_path / "g"),
                           str(tmp_path / "d"), lambda: replies, once=True,
                           checkpoint_dir=str(tmp_path / "c")).awaitTermination(120)
    assert [r.silver_id for r in spark.read.parquet(str(tmp_path / "g")).collect()] == ["s2"]
    dead = spark.read.parquet(str(tmp_path / "d")).collect()
    assert [r.stage for r in dead] == ["enrich"] and '"s1"' in dead[0].original_message


def test_new_lookup_version_counts_from_the_next_batch(spark, tmp_path, lookups):
    one = spark.createDataFrame([("1.1.1.1", 90, "XX", None, [], 0, [])], schemas.layer_schema("ip_intel"))
    path = str(tmp_path / "intel")
    one.write.parquet(f"{path}/data/version=7")          # written, never listed
    assert versions.current(spark, path).count() == 0
    versions.publish(one, path, 2)
    assert versions.current_version(spark, path) == 2
    assert lookups()["ip_intel"].first().abuse_score == 90
    with pytest.raises(ValueError, match="no version"):
        versions.current(spark, str(tmp_path / "none"))


def test_findings_stream(spark, tmp_path, lookups):
    events = make_events(400, 5)
    whole = silver_of(spark, [*events, end_marker(events)])
    scored = with_threat_score(enrich.enrich(whole, **lookups()))
    gold, _ = build_gold(scored)
    gold.coalesce(1).write.parquet(str(tmp_path / "gold"))
    batch = whole.where("id <> 'end'")
    found = velocity.velocity_findings(velocity.velocity_windows(batch, "5 minutes", 3), batch)
    last = found.limit(1).withColumn("id", F.lit("last")).withColumn(
        "event_time", F.lit(end_marker(events)[1])).withColumn("source_ip", F.lit("0.0.0.0"))
    topic = tmp_path / "topics" / WINDOWED
    for part in (found, found.limit(5), last):            # some are delivered twice
        writer(tmp_path / "topics")(WINDOWED, to_messages(part.drop("representative").coalesce(1), WINDOWED, "id"), 0)
    (topic / "bad.txt").write_text("{bad\n")
    path = {n: str(tmp_path / n) for n in ("aggregations", "documents", "dead")}
    want = {r.flink_id: r for r in rows.aggregations_wide(interval.enrich_findings(
        parse_findings(to_messages(found.drop("representative"), WINDOWED, "id"))[0], gold)).collect()}
    for attempt in ("one", "two"):
        live = spark.readStream.schema(gold.schema).parquet(str(tmp_path / "gold"))
        for query in runs.findings_stream(file_messages(spark, str(topic), WINDOWED), live, path["aggregations"],
                                          path["documents"], path["dead"], once=True,
                                          checkpoint_dir=str(tmp_path / attempt)):
            query.awaitTermination(180)
        got = {r.flink_id: r for r in spark.read.parquet(path["aggregations"]).drop("event_date").collect()}
        got.pop("last", None)
        assert got == want and len(want) > 20
        assert any(r.max_threat_score is not None for r in got.values())
        assert spark.read.parquet(path["aggregations"]).count() == spark.read.parquet(path["documents"]).count()
        assert [r.stage for r in spark.read.parquet(path["dead"]).collect()] == ["aggregate-parse"]


def test_findings_over_a_longer_span_than_kept_get_no_part_of_a_summary(spark, tmp_path, lookups):
    from duskwatch.streaming.joins import enrich_findings_stream
    events = [(f"e{i}", BASE + dt.timedelta(minutes=i), "1.1.1.1", "LOGIN", "ALLOW", None, None, 1)
              for i in range(60)]
    whole = silver_of(spark, [*events, end_marker(events)])
    build_gold(with_threat_score(enrich.enrich(whole, **lookups())))[0].coalesce(1).write.parquet(str(tmp_path / "g"))
    columns = "id string, source_ip string, source_event_type string, event_time timestamp, first_seen timestamp, " \
              "last_seen timestamp"
    ends = BASE + dt.timedelta(minutes=59)
    spark.createDataFrame(
        [("long", "1.1.1.1", "LOGIN", ends, BASE, ends),
         ("short", "1.1.1.1", "LOGIN", ends, ends - dt.timedelta(minutes=20), ends),
         ("last", "x", "x", ends + dt.timedelta(hours=9), None, None)], columns
    ).coalesce(1).write.parquet(str(tmp_path / "f"))
    read = lambda n: spark.readStream.schema(spark.read.parquet(str(tmp_path / n)).schema).parquet(
        str(tmp_path / n))
    got = {r.finding_id: r.gold_events_found for r in run(enrich_findings_stream(read("f"), read("g")), tmp_path, "j")}
    assert got["short"] == 21 and got["long"] == 0


def test_records_that_fit_no_document(spark, tmp_path, lookups):
    """A value beyond its field's type keeps a record out of the documents, not out of the table."""
    silver = silver_of(spark, [(f"s{i}", BASE, "1.1.1.1", "MALWARE", "ALLOW", None, 22, 1) for i in range(6)])
    big = 2 ** 31
    silver = (silver.withColumn("packet_count", F.when(F.col("id") == "s1", big).otherwise(big - 1).cast("bigint"))
              .withColumn("source_ip", F.when(F.col("id") == "s2", "host").when(F.col("id") == "s5", "2001:db8::1")
                          .otherwise(F.col("source_ip")))
              .withColumn("cpu_percent", F.when(F.col("id").isin("s2", "s3"), float("nan")).otherwise(1.5))
              .withColumn("bytes_sent", F.lit(2 ** 62)))
    build_gold(with_threat_score(enrich.enrich(silver, **lookups())))[0].write.parquet(str(tmp_path / "gold"))
    path = {n: str(tmp_path / n) for n in ("events", "documents", "dead")}
    for attempt in ("one", "two"):
        live = spark.readStream.schema(spark.read.parquet(str(tmp_path / "gold")).schema).parquet(str(tmp_path / "gold"))
        runs.store_stream(live, path["events"], path["documents"], once=True, dead_path=path["dead"],
                          checkpoint_dir=str(tmp_path / attempt)).awaitTermination(120)
        assert spark.read.parquet(path["events"]).count() == 6
        assert sorted(r.silver_id for r in spark.read.parquet(path["documents"]).collect()) == ["s0", "s4", "s5"]
        dead = spark.read.parquet(path["dead"]).collect()
        assert {r.stage for r in dead} == {"document"}
        assert sorted(r.error for r in dead) == [
            "silver.cpu_percent: not float", "silver.packet_count: not integer",
            "silver.source_ip: not ip; silver.cpu_percent: not float"]


def test_types_of_documents(spark):
    from duskwatch.sinks.documents import fits
    cases = [("date", "2024-01-01T00:00:00Z", True), ("date", "soon", False), ("integer", "5", True),
             ("integer", str(2 ** 31), False), ("integer", "5x", False), ("long", str(2 ** 31), True),
             ("long", str(2 ** 63), False), ("float", "1e3", True), ("float", "1e39", False), ("float", "x", False),
             ("ip", "1.2.3.4", True), ("ip", "1.2.3.400", False), ("ip", "::1", True), ("ip", "abcd", False),
             ("boolean", "true", True), ("boolean", "yes", False), ("object", '{"a": 1}', True), ("object", "[1]", False),
             ("object", "{", False)]
    text = schemas.T.StringType()
    row = spark.range(1).select(*[fits(F.lit(v), k, text).alias(f"c{i}") for i, (k, v, _) in enumerate(cases)]).first()
    assert [(k, v, row[i]) for i, (k, v, _) in enumerate(cases)] == cases


def test_dead_letters_of_two_writers(spark, tmp_path):
    """Concurrent writers keep to their folders; replays look at the dates of their batch."""
    from concurrent.futures import ThreadPoolExecutor

    from duskwatch.sinks import tables
    columns = "original_message string, error string, stage string, timestamp timestamp, topic string"
    path = str(tmp_path / "dead")

    def letters(writer, days):
        data = [(f"{i}", "e", writer, BASE + dt.timedelta(days=d), "t") for d in days for i in range(40)]
        return spark.createDataFrame(data + data[:5], columns)

    def write(writer):
        for days in ((0, 1), (0, 1), (1, 2)):
            tables.insert_dead_letters(letters(writer, days), path, writer)

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(write, ("clean", "enrich")))
    got = spark.read.parquet(path)
    assert {(r.writer, r.n) for r in got.groupBy("writer").agg(F.count("*").alias("n")).collect()} == {
        ("clean", 120), ("enrich", 120)}
    assert got.select("writer", "id", "event_date").distinct().count() == 240


def test_retried_archive_batch_adds_no_record(spark, tmp_path):
    path = str(tmp_path / "lake")
    data = silver_of(spark, make_events(50, 1))
    good, _ = lake.split_by_time(data, "silver", "t")
    for _ in range(2):
        lake.write_batch(good, path, "s", 0)
    lake.write_batch(good, path, "s", 1)
    lake.write_lake(good, f"{path}/stream=s/batch=2")     # lost before it was listed
    read = read_archive(spark, path, "silver")
    assert read.count() == 100
    assert read.where("batch = 0").select("id").distinct().count() == 50
    part = read_archive(spark, path, "silver", start=BASE, end=BASE + dt.timedelta(hours=1))
    assert "PartitionFilters: [" in part._jdf.queryExecution().toString()
    assert part.count() == 2 * sum(e[1] < BASE + dt.timedelta(hours=1) for e in make_events(50, 1))
