"""Starting the pipeline's streams with idempotent sinks.

Each stream has its own checkpoint.  A batch that is run again after a failure
writes the same rows under the same keys, which the warm tables ignore.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from duskwatch.operators import assess, enrich
from duskwatch.operators.clean import clean_event
from duskwatch.operators.parse import parse_bronze, parse_findings, parse_silver
from duskwatch.operators.score import with_threat_score
from duskwatch.session import shared_dir
from duskwatch.sinks import documents, lake, rows, tables
from duskwatch.sinks.messages import to_messages
from duskwatch.sources.topics import GOLD, SILVER
from duskwatch.streaming import detectors, joins


def checkpoint(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/duskwatch/streams/{name}"


def start(stream: DataFrame, name: str, each_batch: Callable[[DataFrame, int], None],
          once: bool = False, interval: str = "30 seconds",
          checkpoint_dir: str | None = None) -> StreamingQuery:
    """Run ``each_batch`` on every micro-batch; ``once`` stops when caught up."""
    trigger = {"availableNow": True} if once else {"processingTime": interval}

    def guarded(batch: DataFrame, number: int) -> None:
        # The sinks below read a batch several times.
        batch.persist()
        try:
            each_batch(batch, number)
        finally:
            batch.unpersist()

    return (stream.writeStream.queryName(name).foreachBatch(guarded).trigger(**trigger)
            .option("checkpointLocation", checkpoint_dir or checkpoint(stream.sparkSession, name))
            .outputMode("append").start())


def stream_id(batch: DataFrame) -> str:
    """The running stream's id, which stays the same as long as its checkpoint does."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def clean_stream(messages: DataFrame, silver_path: str, dead_path: str, once: bool = False,
                 checkpoint_dir: str | None = None, env: str = "dev",
                 emit: Callable[[str, DataFrame, int], None] | None = None) -> StreamingQuery:
    """Bronze messages -> silver table, dead-letter table and, by ``emit``, the silver topic.

    A record without a readable time gets its message's time, which a replay on
    another day does not change, so its key stays in the same date folder.
    """
    def each(batch: DataFrame, number: int) -> None:
        good, dead = parse_bronze(batch, as_of=F.col("timestamp"), received="timestamp")
        silver = clean_event(good, as_of=F.coalesce("received_at", F.current_timestamp()))
        tables.insert_ignore(silver, silver_path, "id", order=["event_time"])
        tables.insert_dead_letters(dead, dead_path, "clean")
        if emit:
            emit(SILVER, to_messages(silver, SILVER, "id"), number)

    return start(messages, "clean", each, once, lake.profile("silver", env).interval,
                 checkpoint_dir)


def archive_stream(layer_rows: DataFrame, layer: str, path: str, topic: str, dead_path: str,
                   once: bool = False, checkpoint_dir: str | None = None,
                   env: str = "dev") -> StreamingQuery:
    """Rows of a layer -> its hour-partitioned archive; rows without a time -> dead letters.

    Each batch has a folder of its own, named by the stream and the batch's number, and is
    listed once it is complete.  A batch that is run again replaces its folder, so nothing
    is doubled; ``sources.lake.read_archive`` follows the list.
    """
    sizing = lake.profile(layer, env)

    def each(batch: DataFrame, number: int) -> None:
        good, bad = lake.split_by_time(batch, layer, topic)
        tables.insert_dead_letters(bad, dead_path, f"archive-{layer.replace('/', '-')}", timed=False)
        lake.write_batch(good, path, stream_id(batch), number, max_records=sizing.records)

    return start(layer_rows, f"archive-{layer.replace('/', '-')}", each, once, sizing.interval,
                 checkpoint_dir)


def detector_streams(silver: DataFrame, emit: Callable[[str, DataFrame, int], None],
                     window: str, threshold: int, within: str, multiplier: float,
                     once: bool = False, checkpoint_dir: str | None = None
                     ) -> list[StreamingQuery]:
    """The three detectors over one silver stream, each an independent query.

    ``emit(topic, messages, batch)`` receives keyed JSON messages.
    """
    from duskwatch.sources.topics import BASELINE, CORRELATED, WINDOWED

    events = detectors.with_watermark(silver)
    windows = detectors.velocity_stream(events, window, threshold)
    branches = {
        WINDOWED: detectors.velocity_findings_stream(events, window, threshold),
        CORRELATED: detectors.chains_stream(events, within),
        BASELINE: detectors.baseline_stream(windows, multiplier),
    }

    def emitter(topic):
        return lambda batch, number: emit(topic, to_messages(batch, topic, "id"), number)

    return [start(stream, topic, emitter(topic), once,
                  checkpoint_dir=f"{checkpoint_dir}/{topic}" if checkpoint_dir else None)
            for topic, stream in branches.items()]


def enrichment_stream(messages: DataFrame, lookups: Callable[[], dict[str, DataFrame]], gold_path: str,
                      dead_path: str, replies: Callable[[], DataFrame | None] = lambda: None,
                      emit: Callable[[str, DataFrame, int], None] | None = None, once: bool = False,
                      checkpoint_dir: str | None = None) -> StreamingQuery:
    """Silver messages -> gold table and, by ``emit``, the gold topic; both dead-letter stages.

    ``lookups`` gives the reference tables (``ip_intel``, ``assets``, ``identities`` and, if
    wanted, ``engines``) and is asked once per micro-batch, so a version published meanwhile
    (``sources.versions``) is used from the next batch on, and each batch sees one version
    throughout.  Gold records are kept once per silver id: deliveries and replays of a
    message add nothing.
    """
    def each(batch: DataFrame, number: int) -> None:
        good, unread = parse_silver(batch.select("value", "topic", "timestamp"), as_of=F.col("timestamp"))
        scored = with_threat_score(enrich.enrich(good, **lookups()))
        gold, failed = assess.build_gold(scored, replies(), topic=SILVER, as_of=F.col("event_time"))
        tables.insert_dead_letters(unread.unionByName(failed), dead_path, "enrich")
        keyed = gold.select("*", F.col("silver.id").alias("silver_id"),
                            F.col("silver.event_time").alias("event_time"))
        tables.insert_ignore(keyed, gold_path, "silver_id", order=["threat_score"])
        if emit:
            emit(GOLD, to_messages(gold, GOLD, "silver.id"), number)

    return start(messages, "enrich", each, once, checkpoint_dir=checkpoint_dir)


def findings_stream(messages: DataFrame, gold: DataFrame, aggregations_path: str, documents_path: str,
                    dead_path: str, window: str = "10 minutes", delay: str = "30 seconds",
                    once: bool = False, checkpoint_dir: str | None = None,
                    upsert: Callable[..., None] = tables.upsert_latest) -> list[StreamingQuery]:
    """Messages of the finding topics joined to gold -> ``aggregations`` table and documents.

    ``gold`` is a stream of nested gold records (``parse.parse_gold``, or the gold table).
    A finding is written once the watermark has passed all gold events it may match, with
    an empty summary if there are none.  Both sinks go by the finding's id.  A second
    query files unreadable messages.  ``upsert`` writes the documents: into plain date
    folders, or with ``versioned.upsert`` into versions that readers may follow meanwhile.
    """
    findings, _ = parse_findings(messages, received="timestamp")
    summaries = joins.enrich_findings_stream(findings, gold, window, delay=delay)

    def write(batch: DataFrame, number: int) -> None:
        records = joins.enriched_records(batch)
        tables.insert_ignore(rows.aggregations_wide(records), aggregations_path, "flink_id", order=["event_time"])
        good, bad = documents.conform(records, "aggregations", "findings")
        tables.insert_dead_letters(bad, dead_path, "findings-documents")
        upsert(rows.aggregations_wide(good).withColumn("version", F.lit(number)), documents_path,
               "flink_id", ["version"])

    def bury(batch: DataFrame, number: int) -> None:
        tables.insert_dead_letters(parse_findings(batch, as_of=F.col("timestamp"))[1], dead_path, "findings")

    return [start(stream, name, each, once,
                  checkpoint_dir=f"{checkpoint_dir}/{name}" if checkpoint_dir else None)
            for stream, name, each in ((summaries, "findings", write), (messages, "findings-dead", bury))]


def store_stream(gold: DataFrame, events_path: str, documents_path: str, once: bool = False,
                 checkpoint_dir: str | None = None, dead_path: str | None = None,
                 upsert: Callable[..., None] = tables.upsert_latest) -> StreamingQuery:
    """Gold records -> warm ``events`` table and hot documents.

    With ``dead_path``, records that do not fit the documents' field types go there
    instead of to the documents; the table takes all.  ``upsert`` as in ``findings_stream``.
    """
    def each(batch: DataFrame, number: int) -> None:
        wide = rows.events_wide(batch)
        tables.insert_ignore(wide, events_path, "silver_id", order=["event_time"])
        if dead_path:
            good, bad = documents.conform(batch, "events", GOLD)
            tables.insert_dead_letters(bad, dead_path, "store")
            wide = rows.events_wide(good)
        upsert(wide.withColumn("version", F.lit(number)), documents_path, "silver_id", ["version"])

    return start(gold, "store", each, once, checkpoint_dir=checkpoint_dir)
