"""Keyed JSON messages for topics or files."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from duskwatch.functions.text import json_text
from duskwatch.sources.topics import BRONZE, DEAD_CLEAN, DEAD_ENRICH, DEAD_PARSE, SILVER

# Delivery settings of the topic sink.
PRODUCER = {"kafka.acks": "all", "kafka.retries": "5", "kafka.retry.backoff.ms": "500"}

DEAD_TOPICS = {"parse": DEAD_PARSE, "clean": DEAD_CLEAN, "enrich-parse": DEAD_ENRICH,
               "enrich": DEAD_ENRICH}
STAGE_SOURCE = {"parse": BRONZE, "clean": BRONZE, "enrich-parse": SILVER, "enrich": SILVER}


def to_messages(rows: DataFrame, topic: str, key: str | None = None) -> DataFrame:
    """``(key, value, topic)`` with the whole record as JSON."""
    value = json_text(F.struct(*rows.columns))
    return rows.select((F.col(key) if key else F.lit(None)).cast("string").alias("key"),
                       value.alias("value"), F.lit(topic).alias("topic"))


def dead_letter_messages(dead: DataFrame) -> DataFrame:
    """Dead letters, each addressed to the topic of its stage."""
    stage, topic = F.col("stage"), F.lit(DEAD_PARSE)
    for name, target in DEAD_TOPICS.items():
        topic = F.when(stage == name, F.lit(target)).otherwise(topic)
    value = json_text(F.struct(*dead.columns))
    return dead.select(F.lit(None).cast("string").alias("key"), value.alias("value"),
                       topic.alias("topic"))


def write_kafka(rows: DataFrame, servers: str) -> None:
    """Batch write (also from ``foreachBatch``) of message rows to their topics."""
    (rows.write.format("kafka").option("kafka.bootstrap.servers", servers)
     .options(**PRODUCER).save())
