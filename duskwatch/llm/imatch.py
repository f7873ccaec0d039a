"""Document fingerprints: I-Match over several randomised lexicons.

Document frequencies of all terms are counted, and the lexicon keeps the terms whose
inverse document frequency lies in a band.  The band's lower edge in document share,
``low``, bounds the lexicon: it has at most (mean distinct terms per document) / low
entries however large the corpus, so it may come to the driver and stand in the plan.
A document keeps its distinct terms in the lexicon, sorted by their hashes.

The lexicon is split at random into ``FAMILIES`` parts, and each part into nested subsets of
falling density (1, 1/2, 1/4 ...).  These subsets are fixed by the terms' hashes alone.  A
document is hashed over all its terms in every one of them, down to the last density at which
it has any.  The terms outside the lexicon are hashed in the same way over ``SPARE`` parts.

Two fingerprints are compared at one density: the sparsest at which at least half of the
subsets hold a term of either document, so that short and long documents both meet in
subsets that a small edit often leaves alone.  Their likeness is the share of equal hashes
among those that either has.  All parts outside the lexicon together weigh as much as one
part of it, so they decide only where the lexicon says little.

Cases.  Null is like the empty text: no term, an empty fingerprint, likeness 1 to another
empty one and 0 to others.  Equal texts have equal fingerprints; very long texts have longer
ones, by the logarithm of their terms.  Equal ids are ordered by a hash of the text; null
ids come first.  A single document is its own next one.  Repeated rows are fingerprinted
alike.  Columns other than ``doc_id`` and ``text`` are not read.  Empty table: empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from duskwatch.llm.common import id_key, let, text_of, words

FAMILIES, SPARE, DIGITS = 16, 8, 6
EMPTY = "-" * DIGITS
# Neighbours are found in id ranges of about this many documents, at most this many ranges.
RANGE_ROWS, RANGES = 512, 1 << 16


def terms(text: Column) -> Column:
    """Hashes of the distinct lower-cased words, sorted."""
    return F.sort_array(F.array_distinct(F.transform(
        words(F.lower(text)), lambda w: F.xxhash64(w))))


def lexicon(docs: DataFrame, low: float = 0.005, high: float = 0.2) -> list[int]:
    """Term hashes in at least two documents and in a share of low to high of them."""
    counts = docs.select(F.explode(terms(text_of())).alias("term")).groupBy("term").count()
    n = docs.count()
    rows = counts.where((F.col("count") >= max(2, low * n)) & (F.col("count") <= high * n))
    return sorted(r[0] for r in rows.select("term").collect())


def _levels(h: Column, families: int) -> Column:
    """2 to the number of densities below the first to which a term belongs."""
    bits = F.shiftrightunsigned(h, families.bit_length() - 1)
    bits = bits.bitwiseAND(F.lit((1 << 30) - 1)).bitwiseOR(F.lit(1 << 30))
    return bits.bitwiseAND(-bits)


def _codes(terms: Column, families: int) -> Column:
    """The hashes of the terms in each subset, density by density, as one text."""
    def code(held: Column) -> Column:
        return F.when(F.size(held) > 0, F.right(
            F.lpad(F.hex(F.xxhash64(held)), 16, "0"), F.lit(DIGITS))).otherwise(EMPTY)

    deepest = F.array_max(F.transform(terms, lambda h: _levels(h, families)))
    ks = F.sequence(F.lit(0), F.lit(families - 1))

    def listed(levels: Column) -> Column:
        def part(k: Column) -> Column:
            mine = F.transform(F.filter(terms, lambda h: h.bitwiseAND(F.lit(families - 1)) == k),
                               lambda h: F.struct(h.alias("h"), _levels(h, families).alias("to")))
            return let(mine, lambda own: F.transform(levels, lambda level: code(
                F.filter(own, lambda x: x.to >= level).h)))

        return let(F.transform(ks, part), lambda rows: F.array_join(F.transform(
            levels, lambda _, i: F.array_join(F.transform(rows, lambda row: F.get(row, i)), "")), ""))

    powers = F.transform(F.sequence(F.lit(0), F.coalesce(F.round(F.log2(deepest)), F.lit(0)).cast("int")),
                         lambda i: F.pow(F.lit(2.0), i).cast("bigint"))
    text = let(powers, listed)
    return F.when(F.size(terms) > 0, text).otherwise("")


def with_fingerprint(df: DataFrame, text: str, name: str, band: list[int]) -> DataFrame:
    """Add the fingerprint of a text column: hashes inside the lexicon, a slash, those outside."""
    rest = df.columns
    listed = f"filter(__terms, h -> h IN ({', '.join(f'{h}L' for h in band)}))"
    inside = F.expr(listed) if band else F.array().cast("array<bigint>")
    own = (df.select("*", terms(text_of(text)).alias("__terms")).withColumn("__inside", inside)
           .withColumn("__outside", F.array_except("__terms", "__inside")))
    both = F.concat(_codes(F.col("__inside"), FAMILIES), F.lit("/"), _codes(F.col("__outside"), SPARE))
    return own.select(*rest, F.when(F.size("__terms") > 0, both).otherwise(EMPTY).alias(name))


def _shared(a: Column, b: Column, families: int) -> Column:
    """Subsets that either document uses and those equal in both, at the density that fits them."""
    width = families * DIGITS
    last = F.greatest(F.length(a), F.length(b)) / width - 1
    ks, none = F.sequence(F.lit(0), F.lit(families - 1)), (EMPTY, "")

    def at(level: Column) -> Column:
        def held(codes: Column) -> Column:
            return let(F.substring(codes, level * width + 1, F.lit(width)), lambda own: F.transform(
                ks, lambda k: F.substring(own, k * DIGITS + 1, F.lit(DIGITS))))

        pairs = F.zip_with(held(a), held(b), lambda x, y: F.struct(x.alias("a"), y.alias("b")))
        return let(pairs, lambda rows: F.struct(
            F.size(F.filter(rows, lambda p: ~p.a.isin(*none) | ~p.b.isin(*none))).alias("used"),
            F.size(F.filter(rows, lambda p: ~p.a.isin(*none) & (p.a == p.b))).alias("same")))

    counts = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0)).cast("int")), at)
    return let(counts, lambda all_: let(
        F.filter(all_, lambda c: c.used * 2 >= families),
        lambda full: F.when(F.size(full) > 0, F.element_at(full, -1)).otherwise(F.get(all_, F.lit(0)))))


def likeness(a: str, b: str) -> Column:
    """Likeness of two fingerprints, 0 to 1."""
    def side(number: int, families: int) -> Column:
        halves = F.struct(*[F.split_part(F.col(x), F.lit("/"), F.lit(number)).alias(n)
                            for x, n in ((a, "a"), (b, "b"))])
        return let(halves, lambda h: _shared(h.a, h.b, families))

    return let(F.struct(side(1, FAMILIES).alias("own"), side(2, SPARE).alias("spare")), lambda s: F.when(
        s.own.used + s.spare.used == 0, F.lit(1.0)).otherwise(
        (s.own.same + s.spare.same / SPARE) / (s.own.used + s.spare.used / SPARE)))


def ranged(docs: DataFrame) -> tuple[DataFrame, WindowSpec]:
    """Rows dealt by id range, and a window whose ``lead`` is the next document by id.

    After the last document comes the first.  Documents are dealt by ranges of ids; each range also gets a copy of the first
    document of the next range, so no task sees more than one range.
    """
    span = docs.agg(F.count("*"), F.min("doc_id"), F.max("doc_id")).first()
    rows = max(RANGE_ROWS, -(-span[0] // RANGES))
    width = max(1, -(-((span[2] or 0) - (span[1] or 0) + 1) * rows // max(span[0], 1)))
    docs = docs.withColumns({
        "__range": F.coalesce(F.floor(F.col("doc_id") / F.lit(float(width))), F.lit(-(1 << 62))),
        "__id": id_key(), "__hash": F.xxhash64(text_of())})
    firsts = docs.groupBy("__range").agg(F.min(F.struct("__id", "__hash")).alias("f"))
    order = Window.orderBy("__range")            # over at most about 2 x RANGES rows
    last = firsts.agg(F.max("__range")).first()[0]
    firsts = firsts.select("f.*", F.coalesce(F.lag("__range").over(order), F.lit(last).cast("long"))
                           .alias("__before"))
    copies = (docs.join(F.broadcast(firsts), ["__id", "__hash"])
              .withColumn("__range", F.col("__before")).select(*docs.columns, F.lit(1).alias("__copy")))
    return docs.withColumn("__copy", F.lit(0)).unionByName(copies), Window.partitionBy(
        "__range").orderBy("__copy", "__id", "__hash")


def edited_fingerprints(docs: DataFrame, low: float = 0.005, high: float = 0.2) -> DataFrame:
    """Fingerprints of all texts and of their edits, and likenesses to the edit and the next text.

    In the edit the last quarter of the code points gives way to as many from the start
    of the next document.
    """
    band = lexicon(docs, low, high)
    both, order = ranged(docs.select("doc_id", text_of().alias("text")))
    marked = with_fingerprint(both, "text", "fingerprint", band)
    joined = (marked.withColumns({"next_text": F.lead("text").over(order),
                                  "next_print": F.lead("fingerprint").over(order)})
              .where("__copy = 0"))
    cut = joined.withColumn("n_chars", F.char_length("text"))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    edited = cut.select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), "fingerprint",
                        "next_print",
                        F.concat(F.left("text", F.col("n_chars") - quarter),
                                 F.left("next_text", quarter)).alias("edited"))
    out = with_fingerprint(edited, "edited", "edited_fingerprint", band)
    return out.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                      "fingerprint", "edited_fingerprint",
                      likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
                      likeness("fingerprint", "next_print").alias("near_next"))
