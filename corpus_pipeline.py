"""The corpus pipeline: keep known languages, cut repeated lines, keep one of each group of
near copies, mix the sources to their weights, encode with dropout.

Every stage works on all its predecessor kept and takes (spark, docs, sf_dir).  ``run``
writes each stage's result to the shared folder and reads it back, so a lost executor
costs one stage at most.

Cases.  An empty table gives an empty result from every stage.  Null and empty texts have
no language and leave in the first stage; texts that the line stage empties stay, link
with nothing, and leave in the mix, which takes words only.  Of repeated rows and other ties
the n-gram stage keeps one; the mix takes rows alike in id, source and text as one.  Texts of
any length are worked on whole.  Extra columns pass through all stages but the last,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from duskwatch.llm import bpe, jaccard, langid, linededup, mixing
from duskwatch.llm.common import stored


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(langid.training_part(docs))
    return langid.with_known_language(docs, model)


def unique_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The text becomes what is left of it, n_chars its new length."""
    return (linededup.unique_lines(docs)
            .withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_per_component(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return (mixing.mixed_documents(docs)
            .withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs)


STAGES = [("language ID", known_language), ("line dedup", unique_lines),
          ("n-gram Jaccard join", one_of_near_copies), ("source mix", mixed),
          ("SentencePiece", encoded)]

# Learned predictions and keyed draws have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
