"""Dead-letter records and their monitoring counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def dead_letters(failed: DataFrame, stage: str, message: str = "value", topic: str = "topic",
                 as_of: Column | None = None) -> DataFrame:
    """Turn failed rows (with an ``error`` column) into dead-letter records."""
    source = F.col(topic) if topic in failed.columns else F.lit(topic)
    return failed.select(
        F.col(message).alias("original_message"), F.col("error"), F.lit(stage).alias("stage"),
        (F.current_timestamp() if as_of is None else as_of).alias("timestamp"),
        source.alias("topic"))


def dead_letter_table(*splits: DataFrame) -> DataFrame:
    """All dead letters in the layout of the warm ``dead_letter`` table."""
    rows = reduce(DataFrame.unionByName, splits)
    return rows.select("stage", F.col("topic").alias("source_topic"), "error",
                       "original_message", F.col("timestamp").alias("received_at"))


def dead_letters_by_stage(table: DataFrame) -> DataFrame:
    return table.groupBy("stage", "source_topic").agg(F.count("*").alias("events"))
