"""Ranked lexical search by NRA: sorted reads only, score intervals per document.

A document's score for an item is the sum of its impacts on the item's terms.  Every term
has a list of (impact, document); lists are read from the largest impact down and no entry
is ever looked up by document.  What is not read yet of a term is at most its frontier,
the largest unread impact.  So a document's score lies between ``low``, the sum of what
was read of it, and ``low`` plus the frontiers of the item's terms not yet read for it.

* All lists of all terms are one table, range-partitioned and sorted by level, then impact.
  Levels follow the impact within a term (LEVELS per factor of two); between terms those of
  rarer ones come first, because their lists are short and lower the bounds most.  A round
  reads one slice of levels, for all items at once.  Slices grow by GROWTH, so there are
  logarithmically many.
* The table's histogram (term, level: count, largest impact) gives every frontier after
  every round beforehand.  A read entry therefore carries the frontiers that it will
  *not* add in later rounds, and a document's state stays a row of sums, however many
  terms an item has: ``upper = low + frontiers of the item - sums of those read``.
* After a round the k-th largest ``low`` of an item is its bar.  Documents whose upper
  bound is below the bar go; ties with it stay.  Once an unread document cannot reach the
  bar (the item's frontiers sum up to less), the item is closed: later slices are then
  joined to its remaining documents only.  It is finished when every remaining document's
  interval is a single number: membership, ties and scores are then all resolved.
* The bar comes from a per-task top k before the shuffle.  Rounds are written to the
  shared folder.

Scores are integers: term weight times a saturated frequency, see ``impacts``.

Cases.  A null text has no terms; documents without terms do not count.  Every row is a
document of its own, also if ids repeat or are null (a null id comes first among ties and
is returned as null).  Rows of one item id, null included, are one item.  Items or
documents without terms give no rows, nor do terms that no document has.  Texts are read
whole.  Empty tables give an empty result.  Extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from duskwatch.llm.common import NO_ID, SLICE, id_key, stored

LEVELS, GROWTH = 4, 3
# How much earlier the lists of rarer terms are read: a level is of impact * weight ** RARER.
RARER = 2
# Frontiers are rounded up to whole units, which keeps the sums that rows carry small.
UNIT = 1 << 20
# Entries per item in the first slice.
FIRST = 1000
# Distinct terms up to which tasks get the items' terms as a set; beyond it a join selects them.
IN_TASK = 200_000
# Bytes that part terms become spaces, A-Z become a-z, all else stays.
TABLE = bytes(32 if b < 0x30 or 0x39 < b < 0x41 or 0x5A < b < 0x61 or 0x7A < b < 0x80
              else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(TABLE).split()


def counted(texts: DataFrame, only: set[str] | None = None) -> DataFrame:
    """Per row: key (unique), id, n (terms with repeats), and its distinct terms with their counts.

    Keys are given out by task and row, so the result must be stored before it is used twice.
    """
    schema = texts.sparkSession.createDataFrame(
        [], "key long, id long, n long, terms array<string>, counts array<int>").schema
    wanted = None if only is None else {t.encode() for t in only}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema
        out, key = to_arrow_schema(schema), TaskContext.get().partitionId() << 40
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                rows = batch.slice(at, SLICE).to_pydict()
                found = [terms_of(t) for t in rows["text"]]
                every = [Counter(f) for f in found]
                if wanted is not None:
                    every = [{t: c[t] for t in c.keys() & wanted} for c in every]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(key, key + len(found)), pa.int64()), pa.array(rows["id"], pa.int64()),
                     pa.array([len(f) for f in found], pa.int64()),
                     pa.array([[t.decode("utf-8", "replace") for t in c] for c in every], out.field("terms").type),
                     pa.array([list(c.values()) for c in every], out.field("counts").type)], schema=out)
                key += len(found)

    return texts.mapInArrow(run, schema)


def impacts(found: DataFrame, weights: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """Rows (term, key, impact, level); entries without impact are left out."""
    entries = (found.where("n > 0")
               .select("key", F.expr(f"10 + (90 * n * {n_docs}L) div {n_terms}L").alias("m"),
                       F.explode(F.arrays_zip("terms", "counts")).alias("e"))
               .select("key", "m", F.col("e.terms").alias("term"), F.col("e.counts").cast("long").alias("tf")))
    return (entries.join(weights, "term")
            .select("term", "key", "w", F.expr("w * ((1000000000L * tf) div (1000L * tf + 8L * m))").alias("impact"))
            .where("impact > 0")
            .select("term", "key", "impact",
                    F.floor((F.log2("impact") + RARER * F.log2("w")) * LEVELS).cast("int").alias("level")))


def slices(by_level: list[tuple[int, int]], first: int) -> list[int]:
    """Lowest level of each round, the last one 0, from rows (level, entries)."""
    borders, total, limit = [], 0, first
    for level, n in sorted(by_level, reverse=True):
        total += n
        if total >= limit:
            borders.append(level)
            limit = GROWTH * total
    return [b for b in borders[:-1]] + [0] if borders else [0]


def _largest(rounds: list[int]) -> list[Column]:
    """Per round the largest impact that is still unread after it, in units."""
    units = F.ceil(F.col("top") / UNIT)
    return [F.coalesce(F.max(F.when(F.col("level") < low, units)), F.lit(0)).alias(f"f{k}")
            for k, low in enumerate(rounds)]


def top_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The k best documents (doc_id, text) of each item (item_id, text): item_id, rank, doc_id, score."""
    asked = (counted(items.select(id_key("item_id").alias("id"), "text"))
             .select(F.col("id").alias("item"), F.explode("terms").alias("term")).distinct())
    asked = stored(asked, "asked")
    terms = asked.select("term").distinct()
    few = terms.limit(IN_TASK + 1).collect()
    only = {r.term for r in few} if len(few) <= IN_TASK else None
    found = stored(counted(docs.select(id_key().alias("id"), "text"), only), "terms")
    size = found.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    n_docs, n_terms = size.docs, max(size.terms, 1)

    df = (found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
          .join(terms, "term", "left_semi"))
    weights = stored(df.select("term", F.floor(1000 * F.log((2 * F.lit(n_docs) + 2) / (2 * F.col("df") + 1)))
                               .alias("w")), "weights")
    postings = stored(impacts(found, weights, n_docs, n_terms)
                      .repartitionByRange(F.col("level").desc(), F.col("impact").desc(), "key")
                      .sortWithinPartitions(F.col("level").desc(), F.col("impact").desc()), "postings")
    heads = stored(postings.groupBy("term", "level")
                   .agg(F.count("*").alias("n"), F.max("impact").alias("top")), "levels")
    per_level = (heads.join(asked.groupBy("term").agg(F.count("*").alias("items")), "term")
                 .groupBy("level").agg(F.sum(F.col("n") * F.col("items")).alias("n")).collect())
    n_items = asked.select("item").distinct().count()
    rounds = slices([(r.level, r.n) for r in per_level], FIRST * n_items)

    ahead = [f"f{i}" for i in range(len(rounds))]
    entries = stored(asked.join(heads.groupBy("term").agg(*_largest(rounds)), "term"), "entries")
    bounds = stored(entries.groupBy("item").agg(*[F.sum(f).alias(f"bound{i}") for i, f in enumerate(ahead)])
                    .withColumn("closed", F.lit(False)).withColumn("finished", F.lit(False)), "bounds")
    state, high = None, None
    for i, low in enumerate(rounds):
        part = postings.where(F.col("level") >= low)
        if high is not None:
            part = part.where(F.col("level") < high)
        state, bounds = _read(part, state, entries, bounds, ahead[i:], i, k)
        high = low
        if not bounds.where("not finished").head(1):
            break
    return _ranked(state, found, k)


def _read(part: DataFrame, state: DataFrame | None, entries: DataFrame, bounds: DataFrame,
          ahead: list[str], i: int, k: int) -> tuple[DataFrame, DataFrame]:
    """One round: read a slice of the lists, then set bars, drop documents, close items."""
    sums = [F.sum(c).alias(c) for c in ("low", *ahead)]
    unread = entries.join(bounds.where("not closed").select("item"), "item", "left_semi")
    rows = (part.join(unread.drop("level"), "term")
            .select("item", "key", F.col("impact").alias("low"), *ahead))
    if state is not None:
        waiting = bounds.where("closed and not finished").select("item")
        held = state.join(waiting, "item", "left_semi").select("item", "key")
        more = (part.join(held, "key").join(entries, ["item", "term"])
                .select("item", "key", F.col("impact").alias("low"), *ahead))
        rows = rows.union(more).union(state.select("item", "key", "low", *ahead))
    state = stored(rows.groupBy("item", "key").agg(*sums), f"intervals{i}")
    best = Window.partitionBy("item").orderBy(F.col("low").desc())
    bars = (state.select("item", "low").withColumn("r", F.row_number().over(best)).where(F.col("r") <= k)
            .groupBy("item").agg(F.count("*").alias("n"), F.min("low").alias("bar"))
            .select("item", F.when(F.col("n") == k, F.col("bar")).otherwise(0).alias("bar")))
    bound = F.col(f"bound{i}")                # what an unread document can reach, in units
    judged = bounds.join(bars, "item", "left").withColumn("bar", F.coalesce("bar", F.lit(0)))
    judged = stored(judged.withColumn("closed", (bound == 0) | (bound * UNIT < F.col("bar"))), f"bars{i}")
    alive = (state.join(judged.select("item", "bar", bound), "item")
             .where(F.col("low") + (bound - F.col(ahead[0])) * UNIT >= F.col("bar")))
    loose = alive.where(bound > F.col(ahead[0])).select("item").distinct().withColumn("loose", F.lit(True))
    bounds = (judged.drop("bar").join(loose, "item", "left")
              .withColumn("finished", F.col("closed") & F.col("loose").isNull()).drop("loose"))
    return alive.drop("bar", f"bound{i}"), stored(bounds, f"bounds{i}")


def _ranked(state: DataFrame, found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("item").orderBy(F.col("low").desc(), "id", "key")
    return (state.where("low > 0").join(found.select("key", "id"), "key")
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select(F.nullif("item", F.lit(NO_ID)).alias("item_id"), F.col("rank").cast("int").alias("rank"),
                    F.nullif("id", F.lit(NO_ID)).alias("doc_id"), F.col("low").alias("score")))
