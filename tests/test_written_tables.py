"""Tables that are replaced by versions, and the search index, against plain forms."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from duskwatch.plans import pipeline, views
from duskwatch.sinks import rows, tables, textindex, versioned
from duskwatch.streaming.runs import store_stream

DAY = dt.datetime(2024, 3, 1, 12)
SCHEMA = "k string, event_time timestamp, v int, version int"


def held(spark, path):
    return sorted((r.k, r.v) for r in versioned.current(spark, path).collect())


def test_upsert_publishes_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versioned.current(spark, path) is None and versioned.superseded(spark, path).isEmpty()
    first = spark.createDataFrame([("a", DAY, 1, 1), ("b", DAY, 2, 1), ("n", None, 9, 1),
                                   ("z", DAY + dt.timedelta(9), 7, 1)], SCHEMA)
    second = spark.createDataFrame([("a", DAY, 5, 2), ("a", DAY, 6, 3), ("c", DAY, 3, 2),
                                    ("m", None, 8, 2)], SCHEMA)
    versioned.upsert(first, path, "k", ["version"])
    before = versioned.current(spark, path)
    for _ in range(2):
        versioned.upsert(second, path, "k", ["version"])
    assert held(spark, path) == [("a", 6), ("b", 2), ("c", 3), ("m", 8), ("n", 9), ("z", 7)]
    # A reader that began before the writes still finds all it needs.
    assert sorted((r.k, r.v) for r in before.collect()) == [("a", 1), ("b", 2), ("n", 9), ("z", 7)]
    old = sorted((str(r.event_date), r.table_version) for r in versioned.superseded(spark, path).collect())
    assert old == [("2024-03-01", 1), ("2024-03-01", 2), ("None", 1), ("None", 2)]


def test_unlisted_version_is_skipped_and_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("a", DAY, 1, 1)], SCHEMA)
    versioned.upsert(first, path, "k", ["version"])
    lost = tables.dated(spark.createDataFrame([("a", DAY, 99, 2), ("x", DAY, 99, 2)], SCHEMA), "event_time")
    lost.write.partitionBy("event_date").parquet(f"{path}/data/table_version=2")
    assert held(spark, path) == [("a", 1)]
    versioned.upsert(spark.createDataFrame([("b", DAY, 4, 2)], SCHEMA), path, "k", ["version"])
    versioned.upsert(first.limit(0), path, "k", ["version"])
    assert held(spark, path) == [("a", 1), ("b", 4)]


def test_upsert_equals_the_plain_form(spark, tmp_path):
    import random
    draw = random.Random(5)
    plain, by_version = str(tmp_path / "p"), str(tmp_path / "v")
    for number in range(4):
        batch = spark.createDataFrame(
            [(f"k{k}", DAY + dt.timedelta(k % 6), draw.randrange(100), number)
             for k in draw.sample(range(40), 15)], SCHEMA)
        tables.upsert_latest(batch, plain, "k", ["version"])
        versioned.upsert(batch, by_version, "k", ["version"])
    assert held(spark, by_version) == sorted((r.k, r.v) for r in spark.read.parquet(plain).collect())


def test_store_stream_into_versions(spark, sf_small, tmp_path):
    gold = str(tmp_path / "gold")
    pipeline.gold_table(spark, sf_small).limit(200).repartition(3).write.parquet(gold)
    schema = spark.read.parquet(gold).schema
    for turn in range(2):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(gold)
        query = store_stream(stream, str(tmp_path / "events"), str(tmp_path / "docs"), once=True,
                             checkpoint_dir=str(tmp_path / f"c{turn}"), upsert=versioned.upsert)
        query.awaitTermination()
        got = versioned.current(spark, str(tmp_path / "docs"))
        want = rows.events_wide(spark.read.parquet(gold)).select("silver_id")
        assert got.count() == want.distinct().count()
        assert got.select("silver_id").exceptAll(want.distinct()).isEmpty()


TEXTS = ["SSH attempt failed", "ssh-attempt, again: ssh", "attempts over ssh", "", None, "Straße 12 attempt",
         "x" * 5000 + " ssh attempt"]


@pytest.fixture
def records(spark):
    return spark.createDataFrame(
        [("event", str(i), None if i == 1 else DAY + dt.timedelta(i % 3), t) for i, t in enumerate(TEXTS * 3)],
        "record_type string, record_id string, event_time timestamp, text string")


@pytest.mark.parametrize("words", [["ssh"], ["ssh", "ATTEMPT"], ["12", "straße"], ["ssh", "ssh"], ["none"],
                                   ["ssh-attempt"]])
def test_index_names_the_same_records(spark, tmp_path, records, words):
    path = str(tmp_path / "index")
    for _ in range(2):                      # a batch that is indexed twice repeats rows
        textindex.write_index(records, path)
    got = textindex.indexed(records, spark.read.parquet(path), words)
    plain = records.where(" and ".join(
        f"array_contains(split(lower(text), '{textindex.BREAK}'), '{w.lower()}')".replace("\\", "\\\\")
        for w in words))
    assert sorted(r.record_id for r in got.collect()) == sorted(r.record_id for r in plain.collect())


def test_search_reads_the_words_and_dates_it_needs(spark, tmp_path, sf_small):
    path = str(tmp_path / "index")
    events = rows.events_wide(pipeline.gold_table(spark, sf_small))
    found = pipeline.aggregations_table(spark, sf_small)
    textindex.write_index(views.searchable(events, found), path)
    index = spark.read.parquet(path)
    plan = textindex.holders(index, ["ssh", "attempt"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(word, [attempt,ssh])" in plan
    word = index.groupBy("word").count().orderBy("count", "word").first()[0]
    got = views.text_search(events, found, [word], index).select("record_type", "record_id")
    want = views.text_search(events, found, [word]).select("record_type", "record_id")
    assert got.exceptAll(want).isEmpty() and got.count() == want.count() > 0
    with pytest.raises(ValueError):
        textindex.holders(index, [])
