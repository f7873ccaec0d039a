"""Mixing sources to target weights by drawing fixed-length blocks of words.

The words of a source, document after document, are packed into blocks of fixed length.
For each output shard the numbers of blocks per source are drawn from a multinomial whose
weights are what each source still has to give, so the totals meet the targets exactly.
The n-th slot of a source is mapped through a pseudorandom permutation of its block
numbers (a new one for each pass over the source), and slots meet blocks in a join by
number.  No block is drawn more often than the cap on a source's repeats, rounded up.

A source may hold any share of the rows: word offsets are prefix sums over buckets of
documents, and both sides of the join are spread by block number.  The driver holds one
row per source and the shard counts (shards x sources), never documents or blocks.

Cases.  Null text or text without words: size 0, nothing taken.  A null source is a source
of its own, ordered last; a null doc_id is a document like any other.  Repeated rows are
packed one after the other, each is a document of its own.  Empty table: empty result.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from duskwatch.llm.common import by_slices, id_key, mix64, stored, text_of, words

WORD = re.compile("[^\x20\x09-\x0d]+")
# Documents per prefix-sum bucket aimed at, and the most buckets of one source.
BUCKET_ROWS, BUCKETS = 2048, 4096
SLOTS_PER_TASK = 1 << 20


@dataclass(frozen=True)
class MixPlan:
    sources: list          # names in order, None last
    sizes: np.ndarray      # words of each
    targets: np.ndarray    # words wanted from each
    blocks: np.ndarray     # blocks of each
    draws: np.ndarray      # (shards, sources) blocks drawn
    block: int
    seed: int


def targets(sizes: Sequence[int], weights: Sequence[float], share: float, cap: float) -> np.ndarray:
    """Share of all words by weight; what exceeds ``cap`` times a size is shared out again."""
    sizes = np.asarray(sizes, float)
    limit, out = cap * sizes, np.zeros(len(sizes))
    w = np.array([weights[i % len(weights)] for i in range(len(sizes))], float)
    left, open_ = share * sizes.sum(), np.ones(len(sizes), bool)
    while open_.any():
        want = left * w / w[open_].sum()
        over = open_ & (want > limit)
        if not over.any():
            out[open_] = want[open_]
            break
        out[over] = limit[over]
        left -= limit[over].sum()
        open_ &= ~over
    return out


def draw(totals: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Blocks per (shard, source): multinomial in what is left of each source's total."""
    rng = np.random.default_rng(seed)
    left, out = totals.astype(np.int64).copy(), np.zeros((shards, len(totals)), np.int64)
    for s in range(shards):
        want = -(-left.sum() // (shards - s))
        while want > 0:
            got = np.minimum(rng.multinomial(want, left / left.sum()), left)
            out[s] += got
            left -= got
            want -= got.sum()
    return out


def permuted(i: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Position i of the keyed pseudorandom permutation of 0..n-1 (Feistel, cycle walking)."""
    i, n, key = (np.asarray(x).astype(np.uint64) for x in (i, n, key))
    half = np.ceil(np.log2(np.maximum(n.astype(float), 2)) / 2 + 1e-9).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = i.copy(), np.arange(len(i))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = out[todo] >> h, out[todo] & m
        for r in range(4):
            turn = mix64(right + mix64(k + np.uint64(r))) & m
            left, right = right, left ^ turn
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)


def sized(docs: DataFrame) -> DataFrame:
    """The narrow rows that a mix needs: id, source, text hash, number of words."""
    return stored(docs.select("doc_id", "source", F.xxhash64(text_of()).alias("text_hash"),
                              F.size(words(text_of())).cast("long").alias("size")), "sizes")


def plan(rows: DataFrame, weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0,
         block: int = 64, shards: int = 64, seed: int = 17) -> MixPlan:
    """One row per source comes to the driver."""
    got = [(r[0], r[1]) for r in rows.groupBy("source").agg(F.sum("size")).collect()]
    got.sort(key=lambda r: (r[0] is None, r[0] or ""))
    sizes = np.array([r[1] for r in got], np.int64)
    goal = targets(sizes, weights, share, cap)
    blocks = -(-sizes // block)
    totals = np.rint(goal * blocks / np.maximum(sizes, 1)).astype(np.int64)
    return MixPlan([r[0] for r in got], sizes, goal, blocks, draw(totals, shards, seed), block, seed)


def _with_source(rows: DataFrame, p: MixPlan) -> DataFrame:
    """Add the source's number; the table has one row per source of the plan."""
    names = rows.sparkSession.createDataFrame(
        [(s, i, int(z), float(t)) for i, (s, z, t) in enumerate(zip(p.sources, p.sizes, p.targets))],
        "name string, src int, source_size long, target double")
    return rows.join(F.broadcast(names), rows["source"].eqNullSafe(names["name"])).drop("name")


def packed(rows: DataFrame, p: MixPlan) -> DataFrame:
    """Each document with its number in its bucket (n) and its first word's place (first)."""
    buckets = int(min(BUCKETS, max(1, rows.count() // BUCKET_ROWS)))
    rows = _with_source(rows, p).withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)))
    key = ["src", "bucket"]
    before = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy(*key).agg(F.sum("size").alias("words"))
              .select(*key, F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start")))
    order = Window.partitionBy(*key).orderBy("doc_id", "text_hash", "size")
    within = order.rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("n", F.row_number().over(order))
            .withColumn("within", F.coalesce(F.sum("size").over(within), F.lit(0)))
            .join(starts, key).withColumn("first", F.col("start") + F.col("within"))
            .drop("start", "within"))


def slots(spark, p: MixPlan) -> DataFrame:
    """Output slots: shard, slot, src, pass number (round) and the block drawn."""
    counts = p.draws.ravel()
    ends, width = np.cumsum(counts), len(p.sources)
    first = (np.cumsum(p.draws, axis=0) - p.draws).ravel()
    total, blocks, seed = int(ends[-1]) if len(ends) else 0, p.blocks, p.seed

    def fill(batches):
        for pdf in batches:
            g = pdf["id"].to_numpy()
            cell = np.searchsorted(ends, g, side="right")
            src, at = cell % width, first[cell] + g - (ends[cell] - counts[cell])
            turn = at // blocks[src]
            key = mix64((np.uint64(seed) << np.uint64(32)) + (src.astype(np.uint64) << np.uint64(8))
                        + turn.astype(np.uint64))
            yield pd.DataFrame({"shard": cell // width, "slot": g, "src": src, "round": turn,
                                "block": permuted(at % blocks[src], blocks[src], key)})

    tasks = max(spark.sparkContext.defaultParallelism, -(-total // SLOTS_PER_TASK))
    return (spark.range(0, total, 1, tasks)
            .mapInPandas(fill, "shard int, slot long, src int, round int, block long"))


def mixed_pieces(docs_packed: DataFrame, p: MixPlan) -> DataFrame:
    """What the mix takes: one row per drawn block and document in it, all documents kept.

    Columns of the packed rows, and shard, slot, round, start (word within the document)
    and length; these are null for a document of which nothing was drawn.
    """
    b = F.lit(p.block)
    span = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("first") / b),
                                                F.floor((F.col("first") + F.col("size") - 1) / b)))
    cut = docs_packed.withColumn("block", F.explode_outer(span))
    cut = (cut.withColumn("start", F.greatest("first", F.col("block") * b) - F.col("first"))
           .withColumn("length", F.least(F.col("first") + F.col("size"), (F.col("block") + 1) * b)
                       - F.greatest("first", F.col("block") * b)))
    return cut.join(slots(docs_packed.sparkSession, p), ["src", "block"], "left")


def mix_sizes(docs: DataFrame, **how) -> DataFrame:
    """Per document: size, source_size, target, and taken words."""
    rows = sized(docs)
    p = plan(rows, **how)
    return (mixed_pieces(packed(rows, p), p)
            .groupBy("src", "bucket", "n", "doc_id", "size", "source_size", "target")
            .agg(F.sum(F.when(F.col("slot").isNotNull(), F.col("length"))).alias("taken"))
            .select("doc_id", "size", "source_size", "target",
                    F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def _cut(rows: dict, name: str) -> dict:
    out = []
    for text, parts in zip(rows["text"], rows[name]):
        spans, runs = [m.span() for m in WORD.finditer(text or "")], []
        for part in parts:
            turn, start, end = part["round"], part["start"], part["start"] + part["length"]
            if runs and runs[-1][0] == turn and runs[-1][2] == start:
                runs[-1][2] = end
            else:
                runs.append([turn, start, end])
        whole = [text if (a, b) == (0, len(spans)) else text[spans[a][0]:spans[b - 1][1]]
                 for _, a, b in runs]
        out.append("\n".join(whole))
    return rows | {"text": out}


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The mix by document: text is what was drawn, pass by pass, in the document's order.

    A document of which a pass draws all blocks stands there with its text unchanged; cut
    places and passes are parted by a line end.  Documents with nothing drawn are left
    out.  Rows alike in doc_id, source and text become one row with all their pieces.
    """
    rows = sized(docs)
    p = plan(rows, **how)
    key = ["k_id", "k_source", "text_hash"]

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumns({"k_id": id_key(), "k_source": F.coalesce("source", F.lit("\0"))})

    parts = (keyed(mixed_pieces(packed(rows, p), p).where("slot is not null")).groupBy(*key)
             .agg(F.sort_array(F.collect_list(F.struct("round", "n", "start", "length")))
                  .alias("parts")))
    texts = (keyed(docs.select(F.struct("*").alias("row"), "doc_id", "source",
                               F.xxhash64(text_of()).alias("text_hash")))
             .select("row", *key).dropDuplicates(key))
    name = "parts"
    while name in docs.columns:        # beside columns of any name
        name += "_"
    kept = texts.join(parts, key).select("row.*", F.col("parts").alias(name))
    return by_slices(kept, lambda rows: _cut(rows, name), docs.schema)
