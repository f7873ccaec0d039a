"""Helpers that several corpus operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from duskwatch.session import shared_dir

# The characters that part words, as a Java class and as a string.
SPACE = "[\\x20\\x09-\\x0D]"
SPACE_CHARS = " \t\n\x0b\f\r"

# Rows handed to Python code at a time; bounds the texts alive as Python objects.
SLICE = 256
# Edges that one task shrinks at a time.
CHUNK = 1 << 21

NO_ID = -(1 << 63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage.

    The folder is the one in ``spark.checkpoint.dir``, which all executors see; a
    later job can lose executors without running again what came before.
    """
    path = f"{shared_dir(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_key(column: Column | str = "doc_id") -> Column:
    """A document id to join on; a missing id counts as the smallest number."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(NO_ID))


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def words(text: Column) -> Column:
    """Words of a text: the runs between white space."""
    return F.array_remove(F.split(text, SPACE + "+"), "")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, all else as it is.  Plain ASCII takes the faster built-in."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
            .otherwise(F.translate(text, upper, upper.lower())))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Compute a value once and use it several times within one expression."""
    return F.transform(F.array(value), body)[0]


def by_slices(df: DataFrame, work: Callable[[dict], dict], schema) -> DataFrame:
    """Row-wise work on a few rows at a time: lists of columns in, lists of columns out.

    ``work`` may return another number of rows than it got.
    """
    target = df.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        out = to_arrow_schema(target)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                got = work(batch.slice(at, SLICE).to_pydict())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(got[f.name], type=f.type) for f in out], schema=out)

    return df.mapInArrow(run, target)


def mix64(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (a bijection with good avalanche)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _forest(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with a < b that join the same nodes, one star per component and task.

    A task's edges are taken up CHUNK at a time, so memory stays bounded.
    """
    def run(batches):
        held, size = [], 0

        def stars():
            ends, at = np.unique(np.concatenate(held), return_inverse=True)
            at, low = at.reshape(-1, 2), np.arange(len(ends))
            while True:                     # smallest number around each node, then jump to its own
                least = np.minimum(low[at[:, 0]], low[at[:, 1]])
                new = low.copy()
                np.minimum.at(new, low[at].ravel(), np.repeat(least, 2))
                new = new[new]
                new = new[low]
                if (new == low).all():
                    break
                low = new
            b = np.flatnonzero(low != np.arange(len(ends)))
            return pa.RecordBatch.from_pydict({"a": ends[low[b]], "b": ends[b]})

        for batch in batches:
            held.append(np.stack([batch["a"].to_numpy(), batch["b"].to_numpy()], 1).ravel())
            size += batch.num_rows
            if size >= CHUNK:
                yield stars()
                held, size = [], 0
        if held:
            yield stars()

    return edges.mapInArrow(run, "a long, b long")


def _is_forest(edges: DataFrame) -> bool:
    """Whether every component is a star around its smallest node."""
    roles = (edges.select(F.col("a").alias("node"), F.lit(0).alias("role"))
             .union(edges.select("b", F.lit(1))))
    bad = (roles.groupBy("node").agg(F.min("role").alias("lo"), F.sum("role").alias("s"))
           .where("s > 1 or (s = 1 and lo = 0)"))
    return not bad.head(1)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): rows (node, component), the smallest id.

    Each task first shrinks its edges to stars.  Then large-star and small-star steps
    alternate: each node points its larger (then its smaller) neighbours to the smallest
    one around it.  Per-node minima are aggregates, so a node with very many neighbours is
    combined before the shuffle, and joined back by a join whose hot keys Spark splits.
    Every round is stored in the shared folder, and the loop ends when all components are
    stars.  Under CHUNK edges, which a task takes up at a time anyway, one task makes the stars.
    """
    edges = stored(_forest(edges.where("a <> b").select("a", "b")).distinct(), "edges")
    while (few := edges.count() < CHUNK) or not _is_forest(edges):
        if few:
            edges = stored(_forest(edges.coalesce(1)), "edges")
            break
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = (both.where("b > a").join(low, "a").where("b <> m")
                 .select(F.col("m").alias("a"), "b").distinct())
        down = large.select(F.col("b").alias("a"), F.col("a").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (down.join(low, "a")
                 .select(F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("a").alias("b")),
                                           F.struct(F.col("m").alias("a"), "b"))).alias("e"))
                 .select("e.a", "e.b").where("a <> b"))
        edges = stored(_forest(small).distinct(), "edges")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
