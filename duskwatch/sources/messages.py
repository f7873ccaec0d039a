"""Message sources: ``(key, value, topic, timestamp)`` rows, batch or stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MESSAGE = "value string, topic string, timestamp timestamp"


def decoded(payload: Column) -> Column:
    """Text of a binary payload; NULL when it is absent or not UTF-8."""
    return F.when(F.is_valid_utf8(payload), F.decode(payload, "UTF-8"))


def kafka_messages(spark: SparkSession, servers: str, topics: list[str], stream: bool = True,
                   **options: str) -> DataFrame:
    """Subscribe to topics from their start (needs the Kafka package on the classpath)."""
    reader = spark.readStream if stream else spark.read
    raw = (reader.format("kafka").option("kafka.bootstrap.servers", servers)
           .option("subscribe", ",".join(topics)).option("startingOffsets", "earliest")
           .options(**options).load())
    return raw.select(decoded(F.col("key")).alias("key"), decoded(F.col("value")).alias("value"),
                      "topic", "timestamp")


def file_messages(spark: SparkSession, path: str, topic: str, stream: bool = True,
                  **options: str) -> DataFrame:
    """One message per line of the text files in a folder, all of one topic."""
    if stream:
        lines = spark.readStream.format("text").options(**options).load(path)
    else:
        lines = spark.read.format("text").options(**options).load(path)
    value = F.col("value")
    return lines.select(
        F.lit(None).cast("string").alias("key"),
        F.when(F.is_valid_utf8(value), value).alias("value"), F.lit(topic).alias("topic"),
        F.col("_metadata.file_modification_time").alias("timestamp"))


def messages(spark: SparkSession, fmt: str, stream: bool = True, **where) -> DataFrame:
    """Source by format name: ``kafka`` or ``text``."""
    if fmt == "kafka":
        return kafka_messages(spark, stream=stream, **where)
    if fmt == "text":
        return file_messages(spark, stream=stream, **where)
    raise ValueError(f"unknown message format: {fmt}")


def record_time(text: Column, broker_time: Column) -> Column:
    """Event time of a record, else the time the broker got it."""
    return F.coalesce(F.try_to_timestamp(text), broker_time)
