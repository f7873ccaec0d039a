"""An inverted index over texts: the records of each date that hold a word.

The index has one row per date, word and record, in date folders and sorted by word inside
each file, so that a search reads the row groups of its words only.  Rows follow from the
record alone; a batch that is indexed again repeats rows, which a search counts once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from duskwatch.sinks.tables import DATE

BREAK = r"[^\p{L}\p{N}]+"
KEY = ("record_type", "record_id")


def text_words(text: str = "text") -> Column:
    """The lower-cased words of a text."""
    return F.split(F.lower(text), BREAK)


def postings(records: DataFrame, at: str = "event_time") -> DataFrame:
    """(date, word, record) of records with ``record_type``, ``record_id`` and ``text``."""
    return (records.select(F.to_date(at).alias(DATE), *KEY,
                           F.explode(F.array_distinct(text_words())).alias("word"))
            .where("word <> ''"))


def write_index(records: DataFrame, path: str, at: str = "event_time") -> None:
    """Append the postings of a batch.

    Texts are dealt to the files, once each, before they become a row per word.  Ids are
    hashes, which repeat from word to word and hold half a byte a character: hence zstd.
    """
    dealt = records.select(F.to_date(at).alias(DATE), *KEY, "text").hint("rebalance", F.col(DATE))
    (postings(dealt, DATE).sortWithinPartitions(DATE, "word").write.mode("append")
     .option("compression", "zstd").partitionBy(DATE).parquet(path))


def holders(index: DataFrame, words: list[str]) -> DataFrame:
    """(date, record) of the records that hold all the words.

    Each word is one bit, and bits are or-ed inside the map tasks, so a word that stands in
    most records is reduced to a row per record before the shuffle, repeats included.
    """
    wanted = sorted({w.lower() for w in words})
    if not wanted:
        raise ValueError("a search needs at least one word")
    if len(wanted) > 63:
        raise ValueError("a search takes at most 63 words")
    bit = reduce(lambda c, i: c.when(F.col("word") == wanted[i], F.lit(1 << i)),
                 range(1, len(wanted)), F.when(F.col("word") == wanted[0], F.lit(1)))
    return (index.where(F.col("word").isin(wanted)).groupBy(DATE, *KEY)
            .agg(F.bit_or(bit.cast("bigint")).alias("bits"))
            .where(F.col("bits") == (1 << len(wanted)) - 1).drop("bits"))


def indexed(records: DataFrame, index: DataFrame, words: list[str], at: str = "event_time") -> DataFrame:
    """The records that hold all the words, by the index; no other text is looked at."""
    found = holders(index, words)
    same = reduce(lambda a, b: a & b, [records[c] == found[c] for c in KEY],
                  F.to_date(records[at]).eqNullSafe(found[DATE].cast("date")))
    return records.join(found, same, "left_semi")
