"""Line dedup across documents, as keep bitmaps.

Lines are told apart by two 64-bit hashes of their key.  Their rows are range-partitioned
on (hash, document descending, position) and sorted so within partitions: a line that
stands in a third of all documents is spread over many partitions.  The first row of a
line in this order is its kept occurrence (the largest document).  What the stream of one
line says as a whole, the number of documents and that first one, is pre-aggregated per
partition before it is shuffled, and goes back to the rows of lines that repeat.
The result is one bitmap per document that loses lines, not text.

Cases.  Null or empty text: one empty line, never dropped.  A null doc_id counts as one
document, smaller than all others.  Rows with one doc_id count as one document and are
each cut by their own text's bitmap.  Further columns pass through; those named like a
result column give way to it (``unique_lines`` keeps all columns).  Very long texts are
split whole, in their row.  Empty table: empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from duskwatch.llm.common import SPACE_CHARS, ascii_lower, id_key, stored, text_of

BITS = 64


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Per document that loses lines: id, text_hash, drops (word number, mask of dropped lines).

    Words of 64 lines without a drop are left out; all their lines are kept.
    """
    text = text_of()
    rows = (docs.select(id_key().alias("id"), F.xxhash64(text).alias("text_hash"),
                        F.posexplode(lines(text)).alias("pos", "line"))
            .where(F.char_length("line") >= min_chars)
            .withColumn("key", ascii_lower(F.trim(F.col("line"), F.lit(SPACE_CHARS))))
            .where(F.char_length("key") >= min_chars)
            .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"),
                    "id", "text_hash", "pos"))
    order = [F.col("h1"), F.col("h2"), F.col("id").desc()]
    rows = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order, "pos"), "lines")
    repeated = (rows.groupBy("h1", "h2", "id").agg(F.lit(1).alias("one"))
                .groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("id").alias("first"))
                .where(F.col("n") >= min_docs).drop("n"))
    return (rows.join(repeated, ["h1", "h2"]).where("id <> first")
            .groupBy("id", "text_hash", F.floor(F.col("pos") / BITS).cast("int").alias("word"))
            .agg(F.bit_or(F.expr(f"shiftleft(1L, pos % {BITS})")).alias("mask"))
            .groupBy("id", "text_hash")
            .agg(F.sort_array(F.collect_list(F.struct("word", "mask"))).alias("drops")))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Per row of docs: row (all its columns), n_lines, n_dropped and kept_text."""
    text = text_of()
    keyed = docs.select(F.struct("*").alias("row"), id_key().alias("id"),
                        F.xxhash64(text).alias("text_hash"))
    joined = keyed.join(bitmaps, ["id", "text_hash"], "left")
    text = F.coalesce(F.col("row.text"), F.lit(""))
    all_lines = lines(text)
    sparse = F.map_from_entries("drops")
    dense = F.transform(F.sequence(F.lit(0), F.floor((F.size(all_lines) - 1) / BITS).cast("int")),
                        lambda w: F.coalesce(F.try_element_at(sparse, w), F.lit(0).cast("long")))
    out = joined.select("row", all_lines.alias("lines"),
                        F.when(F.col("drops").isNotNull(), dense).alias("mask"))
    kept = F.filter("lines", lambda _, i: F.getbit(
        F.element_at("mask", F.floor(i / BITS).cast("int") + 1), i % BITS) == 0)
    bits = F.aggregate("mask", F.lit(0), lambda a, m: a + F.bit_count(m))
    return out.select(
        "row", F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(bits, F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("mask").isNull(), F.coalesce(F.col("row.text"), F.lit("")))
        .otherwise(F.array_join(kept, "\n")).alias("kept_text"))


def line_dedup(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """The rows of docs with n_lines, n_dropped and kept_text."""
    added = ("n_lines", "n_dropped", "kept_text")
    return apply_bitmaps(docs, keep_bitmaps(docs, min_chars, min_docs)).select(
        *[F.col("row")[c].alias(c) for c in docs.columns if c not in added], *added)


def unique_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """The rows of docs, all columns as they were, with the text cut where lines were dropped."""
    cut = apply_bitmaps(docs, keep_bitmaps(docs, min_chars, min_docs))
    text = F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("row.text"))
    return cut.select(*[text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
