"""Exact Jaccard links between documents' word n-gram sets, by a parity-sketch join.

Sketches.  A set is split by a hash into P parts, and each part is the XOR of the hashes
of its n-grams: adding or removing an n-gram changes one part.  The number of parts
that differ between two sets (their Hamming distance) is thus never more than the size of
the symmetric difference.  At similarity t a set of size n differs from its partner in
D = (n + n/t) (1-t) / (1+t) n-grams at most, so at least one of any D + 1 non-empty parts
of one set stands unchanged in the other (pigeonhole).  Taking the
first D + 1 non-empty parts of each set in one global order, two linked sets share a
part (the prefix principle on parts).  P follows a size band; a set close below the next
band is also cut in that band's way.  Small sets have one n-gram per part.

Order.  Parts that hold nothing but very frequent n-grams come last, so that passages
standing in many documents hardly ever bring strangers together.  An n-gram is frequent
from ``HOT_SHARE`` of the documents on, so there are at most mean set size / HOT_SHARE
of them: their list has a proven bound and is broadcast.

Candidates.  Documents with equal sets are one class, and only classes are joined.  The
members of a part's group are paired with its smallest member, never with each other.
Pairs are sifted by a parity bit sketch of about four bits per n-gram, and the rest
verified on the texts.  Where a group then still spans several components, each member is
paired with its nearest members of other components, by rounds: found links merge
components, and the number of neighbours rises from round to round (by RISE).  A round looks
again only at the parts where the one before left neighbours out; in all others every pair
has been verified.  The rounds end when every pair across components that shares a part and
passes the bit sketch has been verified, which makes the join exact (pairs within a
component need no test).

Groups of any size are split: within a task large groups shrink to their smallest member
before the shuffle, and joins leave hot keys to Spark's skew handling.

Cases.  Null text, or text without words: empty set, component is the document itself.
Fewer than five words: the whole sequence is the one n-gram.  Equal sets (copies, ties)
share a component.  A null doc_id is smaller than all others and comes back as null.
Rows with one doc_id and different texts are nodes of their own.  Empty table: empty
result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from duskwatch.llm.common import NO_ID, SLICE, by_slices, components, id_key, mix64, stored, text_of

WORDS, SIMILAR = 5, 0.75
HOT_SHARE, HOT_LEAST = 1 / 500, 100
# Sets below SMALL have one n-gram per part; above, bands grow by RATIO, with 3 parts per
# n-gram of the band's smallest set.
SMALL, RATIO, PARTS, SMALL_PARTS = 64, 4, 3, 1 << 20
# n-grams or parts gathered per task before they are combined, and the members of a part
# that one task passes on as they are.
CHUNK, LOCAL = 1 << 21, 16
# How many times more neighbours each round across components looks at, and the pairs of one
# part whose sketches are compared at a time.
RISE, AT_ONCE = 256, 1 << 18

_rng = np.random.default_rng(97)
_BYTE = _rng.integers(0, 1 << 64, 256, np.uint64, endpoint=False)
_BASE = np.uint64(0x9E3779B97F4A7C15)                  # odd, so it has an inverse mod 2^64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True


_powers: list[np.ndarray] = [np.ones(0, np.uint64)] * 2


def _power_tables(size: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse; the tables grow to the longest text seen."""
    if len(_powers[0]) < size:
        for i, base in enumerate((_BASE, _INVERSE)):
            table = np.full(1 << max(16, size.bit_length()), base)
            table[0] = 1
            _powers[i] = np.multiply.accumulate(table)
    return _powers


def ngram_set(text: str | None, k: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word n-grams of a text."""
    raw = np.frombuffer((text or "").encode("utf-8", "replace").translate(_LOWER), np.uint8)
    edge = np.diff(np.concatenate([[True], _GAP[raw], [True]]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = _power_tables(len(raw))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * up[:len(raw)])])
    word = mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    k = min(k, len(word))
    gram = np.full(len(word) - k + 1, k, np.uint64)
    for j in range(k):
        gram = gram * _BASE + word[j:len(word) - k + 1 + j]
    gram = np.sort(mix64(gram))
    return gram[np.concatenate([[True], gram[1:] != gram[:-1]])]


def reach(n: int, t: float = SIMILAR) -> int:
    """Most n-grams in which a set of size n can differ from a set at similarity t.

    The partner has n / t at most, and of n + m n-grams (1-t) / (1+t) may be unshared.
    """
    return int((n + n / t) * (1 - t) / (1 + t) + 1e-9)


def band(n: int) -> int:
    """0 for small sets, then 1, 2, ... for [SMALL, 4 SMALL), [4 SMALL, 16 SMALL), ..."""
    b = 0
    while n >= SMALL * RATIO**b:
        b += 1
    return b


def signatures(grams: np.ndarray, hot: np.ndarray, t: float = SIMILAR) -> np.ndarray:
    """The first D + 1 non-empty parts of a set, as hashes of (band, part, content)."""
    n, out = len(grams), []
    d = reach(n, t)
    if d == 0:
        return np.zeros(0, np.uint64)        # links with equal sets only
    at = np.searchsorted(hot, grams)
    is_hot = hot[np.minimum(at, len(hot) - 1)] == grams if len(hot) else np.zeros(n, bool)
    own = band(n)
    for b in {own, band(int(n / t + 1e-9))}:
        parts = SMALL_PARTS if b == 0 else PARTS * SMALL * RATIO ** (b - 1)
        salt = mix64(np.array([b + 1], np.uint64))
        token = mix64(grams ^ salt)
        part = token % np.uint64(parts)
        order = np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")
        part = part[order]
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        value = np.bitwise_xor.reduceat(token[order], first)
        frequent = np.logical_and.reduceat(is_hot[order], first)
        pick = np.concatenate([np.flatnonzero(~frequent), np.flatnonzero(frequent)])[:d + 1]
        out.append(mix64(value[pick] ^ mix64(part[first][pick] + (salt << np.uint64(1)))))
    return np.concatenate(out)


def bit_sketch(grams: np.ndarray) -> bytes:
    """Parity of the n-grams per bit, 2^k bits, about four to eight per n-gram."""
    bits = 1 << max(6, (4 * max(len(grams), 1)).bit_length())
    odd = np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def hamming(a: bytes, b: bytes) -> int:
    """Distance of two bit sketches; the longer one is folded to the length of the other."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def possible(n: int, m: int, distance: int, t: float = SIMILAR) -> bool:
    """Whether sets of these sizes and this sketch distance can be at similarity t."""
    return min(n, m) >= t * max(n, m) - 1e-9 and distance <= (n + m) * (1 - t) / (1 + t) + 1e-9


def linked(a: np.ndarray, b: np.ndarray, t: float = SIMILAR) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= round(100 * t) * (len(a) + len(b) - both)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


_FEATURES = ("kind int, id long, text_hash long, n long, s1 long, s2 long, sketch binary, "
             "gram long, count long")


def features(docs: DataFrame) -> DataFrame:
    """One pass: a row per document (kind 0), and rows for n-grams repeated in a task (kind 1)."""
    def run(batches):
        heap, size = [], 0

        def repeated():
            gram, n = np.unique(np.concatenate(heap) if heap else np.zeros(0, np.uint64),
                                return_counts=True)
            gram, n = gram[n >= 3], n[n >= 3]
            return pa.RecordBatch.from_pydict(
                {"kind": np.ones(len(gram), np.int32), **{c: pa.nulls(len(gram), pa.int64())
                 for c in ("id", "text_hash", "n", "s1", "s2")},
                 "sketch": pa.nulls(len(gram), pa.binary()), "gram": _signed(gram), "count": n})

        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                rows = batch.slice(at, SLICE)
                sets = [ngram_set(t) for t in rows["text"].to_pylist()]
                m = len(sets)
                mixed = [mix64(g) for g in sets]
                s1 = np.array([x.sum(dtype=np.uint64) for x in mixed], np.uint64)
                s2 = np.array([np.bitwise_xor.reduce(mix64(x + _BASE)) if len(x) else 0
                               for x in mixed], np.uint64)
                yield pa.RecordBatch.from_pydict(
                    {"kind": np.zeros(m, np.int32), "id": rows["id"], "text_hash": rows["text_hash"],
                     "n": np.array([len(g) for g in sets], np.int64), "s1": _signed(mix64(s1)),
                     "s2": _signed(s2), "sketch": [bit_sketch(g) for g in sets],
                     "gram": pa.nulls(m, pa.int64()), "count": pa.nulls(m, pa.int64())})
                heap += sets
                size += sum(map(len, sets))
                if size >= CHUNK:
                    yield repeated()
                    heap, size = [], 0
        yield repeated()

    return docs.select(id_key().alias("id"), F.xxhash64(text_of()).alias("text_hash"),
                       "text").mapInArrow(run, _FEATURES)


def frequent_ngrams(feats: DataFrame) -> np.ndarray:
    """Sorted hashes of the n-grams in at least HOT_SHARE of the documents (bounded)."""
    least = max(HOT_LEAST, feats.where("kind = 0").count() * HOT_SHARE)
    rows = (feats.where("kind = 1").groupBy("gram").agg(F.sum("count").alias("c"))
            .where(F.col("c") >= least).select("gram").toPandas())
    return np.sort(rows["gram"].to_numpy(np.int64).view(np.uint64))


def part_rows(docs: DataFrame, hot: np.ndarray) -> DataFrame:
    """Rows (kind, sig, node): parts of all sets, each once per task.

    Kind 0 goes to the join by part.  Of a part with more than LOCAL members in one task
    only the smallest goes there; the others are paired with it at once (kind 1, sig is
    the pair's other end) and remembered as members (kind 2).
    """
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches):
        sigs, nodes, size = [], [], 0

        def flush():
            if not sigs:
                return
            sig, node = np.concatenate(sigs), np.concatenate(nodes)
            order = np.lexsort((node, sig))
            sig, node = sig[order], node[order]
            new = np.concatenate([[True], (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])])
            sig, node = sig[new], node[new]
            first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
            size = np.diff(np.concatenate([first, [len(sig)]]))
            lead, many = np.repeat(first, size), np.repeat(size > LOCAL, size)
            rest = many & (np.arange(len(sig)) != lead)
            pairs = np.unique(np.stack([node[rest], node[lead[rest]]]), axis=1)
            for kind, a, b in ((0, sig[~rest], node[~rest]), (2, sig[many], node[many]),
                               (1, pairs[0].view(np.uint64), pairs[1])):
                for at in range(0, len(a), 1 << 16):
                    x, y = a[at:at + (1 << 16)], b[at:at + (1 << 16)]
                    yield pa.RecordBatch.from_pydict({"kind": np.full(len(x), kind, np.int32),
                                                      "sig": _signed(x), "node": y})

        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                for text in batch.slice(at, SLICE)["text"].to_pylist():
                    grams = ngram_set(text)
                    got = signatures(grams, shared.value)
                    node = _signed(mix64(mix64(grams).sum(dtype=np.uint64, keepdims=True)))
                    sigs.append(got)
                    nodes.append(np.broadcast_to(node, got.shape))
                    size += len(got)
            if size >= CHUNK:
                yield from flush()
                sigs, nodes, size = [], [], 0
        yield from flush()

    return docs.select("text").mapInArrow(run, "kind int, sig long, node long")


def _sift(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (x, y) of set hashes to pairs (a, b) of classes that the bit sketch lets pass."""
    def side(end: str, name: str) -> DataFrame:
        return classes.select(F.col("s1").alias(end), F.col("node").alias(name),
                              F.col("n").alias(f"n_{name}"), F.col("sketch").alias(f"sketch_{name}"))

    wide = (pairs.join(side("x", "a"), "x").where("n_a > 2").join(side("y", "b"), "y")
            .where(f"a <> b and least(n_a, n_b) >= {SIMILAR} * greatest(n_a, n_b) - 1e-9"))

    def work(rows: dict) -> dict:
        keep = [i for i, (n, m, s, r) in enumerate(zip(rows["n_a"], rows["n_b"], rows["sketch_a"],
                                                       rows["sketch_b"]))
                if possible(n, m, hamming(s, r))]
        return {c: [rows[c][i] for i in keep] for c in ("a", "b")}

    return by_slices(wide.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b"), work,
                     "a long, b long").distinct()


def _verify(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs of classes whose sets reach the similarity."""
    need = (pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
            .join(classes.select("node", "id", "text_hash"), "node"))
    texts = stored(docs.select(id_key().alias("id"), F.xxhash64(text_of()).alias("text_hash"), "text")
                   .join(need, ["id", "text_hash"]).dropDuplicates(["node"]).select("node", "text"),
                   "texts")
    both = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"))

    def work(rows: dict) -> dict:
        keep, last, last_set = [], None, None
        for i, (b, ta, tb) in enumerate(zip(rows["b"], rows["text_a"], rows["text_b"])):
            if b != last:
                last, last_set = b, ngram_set(tb)
            if linked(ngram_set(ta), last_set):
                keep.append(i)
        return {c: [rows[c][i] for i in keep] for c in ("a", "b")}

    return by_slices(both.select("a", "b", "text_a", "text_b"), work, "a long, b long")


def _near_pairs(sig, n, comp, sketches: list[bytes], most: int) -> tuple[np.ndarray, ...]:
    """For each member of a part the nearest ``most`` smaller ones of other components.

    Rows are sorted by part, then size.  Nearest by bit sketch, among those that it lets
    pass.  Gives the rows paired, and a row of each part in which there are more.
    """
    group = np.cumsum(np.concatenate([[0], sig[1:] != sig[:-1]]))
    key = group << 40 | n
    low = np.searchsorted(key, group << 40 | np.ceil(SIMILAR * n - 1e-9).astype(np.int64))
    length = np.array([len(x) for x in sketches])
    bits, at = {}, np.zeros(len(n), np.int64)
    for size in np.unique(length).tolist():
        own = np.flatnonzero(length == size)
        at[own] = np.arange(len(own))
        bits[size] = np.frombuffer(b"".join([sketches[i] for i in own]), np.uint64).reshape(len(own), -1)
    out, ends = [], np.cumsum(np.arange(len(n)) - low)
    first = 0
    while first < len(n):
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + AT_ONCE, "right")))
        many = np.arange(first, last) - low[first:last]
        j = np.repeat(np.arange(first, last), many)
        i = np.repeat(low[first:last] - np.cumsum(many) + many, many) + np.arange(len(j))
        other = comp[i] != comp[j]
        i, j, apart = i[other], j[other], np.zeros(np.count_nonzero(other), np.int64)
        for size in np.unique(length[j]).tolist():
            for mine in (size, size // 2):     # sets within reach have this sketch length or half
                if mine not in bits:
                    continue
                pairs = np.flatnonzero((length[j] == size) & (length[i] == mine))
                step = max(1, AT_ONCE * 8 // mine)
                for some in (pairs[x:x + step] for x in range(0, len(pairs), step)):
                    large = bits[size][at[j[some]]]
                    if mine < size:
                        half = large.shape[1] // 2
                        large = large[:, :half] ^ large[:, half:]
                    apart[some] = np.bitwise_count(bits[mine][at[i[some]]] ^ large).sum(1, dtype=np.int64)
        near = apart <= (n[i] + n[j]) * (1 - SIMILAR) / (1 + SIMILAR) + 1e-9
        i, j, apart = i[near], j[near], apart[near]
        order = np.lexsort((i, apart, j))
        i, j = i[order], j[order]
        rank = np.arange(len(j)) - np.searchsorted(j, j)
        out.append((i[rank < most], j[rank < most], j[rank == most]))
        first = last
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


def _across(members: DataFrame, classes: DataFrame, comp: DataFrame, most: int) -> DataFrame:
    """Pairs (a, b) that share a part but not a component and pass the bit sketch.

    Rows with a sig instead name the parts that have more.  A part with two members has had
    its only pair tested.
    """
    known = (members.join(classes.select(F.col("s1").alias("member"), "node", "n"), "member")
             .join(comp, "node", "left").withColumn("component", F.coalesce("component", "node")))
    mixed = (known.groupBy("sig").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                      F.count("*").alias("m"))
             .where("lo <> hi and m > 2").select("sig"))
    left = stored(known.join(mixed, "sig").select("sig", "node", "n", "component"), "across")
    left = (left.join(classes.select("node", "sketch"), "node").repartition("sig")
            .sortWithinPartitions("sig", "n", "node"))

    def run(batches):
        held = None
        for batch in batches:
            pdf = batch.to_pandas()
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            sig = pdf["sig"].to_numpy()
            cut = int(np.searchsorted(sig, sig[-1])) if len(sig) else 0
            held = pdf.iloc[cut:]               # the last part may go on in the next batch
            if cut:
                yield pairs_of(pdf.iloc[:cut])
        if held is not None and len(held):
            yield pairs_of(held)

    def pairs_of(pdf):
        sig, n, node, comp_ = (pdf[c].to_numpy() for c in ("sig", "n", "node", "component"))
        i, j, more = _near_pairs(sig, n, comp_, pdf["sketch"].tolist(), most)
        pairs = np.unique(np.stack([np.maximum(node[i], node[j]), np.minimum(node[i], node[j])]), axis=1)
        more = np.unique(sig[more])
        here, none = pa.array(pairs[0]), pa.nulls(len(more), pa.int64())
        return pa.RecordBatch.from_pydict({
            "a": pa.concat_arrays([here, none]), "b": pa.concat_arrays([pa.array(pairs[1]), none]),
            "sig": pa.concat_arrays([pa.nulls(len(here), pa.int64()), pa.array(more)])})

    return left.select("sig", "node", "n", "component", "sketch").mapInArrow(
        run, "a long, b long, sig long").distinct()


def _both(pairs: DataFrame) -> DataFrame:
    """Pairs with the larger end first."""
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def labelled_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows' features, and the classes of equal sets with their component."""
    feats = stored(features(docs), "features")
    classes = stored(feats.where("kind = 0 and n > 0").groupBy("s1", "s2", "n")
                     .agg(F.min(F.struct("id", "text_hash")).alias("rep"),
                          F.first("sketch").alias("sketch"))
                     .select("s1", "s2", "n", "rep.*", "sketch",
                             F.monotonically_increasing_id().alias("node")), "classes")
    group = Window.partitionBy("kind", "sig")
    parts = stored(part_rows(docs, frequent_ngrams(feats))
                   .withColumns({"lo": F.min("node").over(group), "hi": F.max("node").over(group)})
                   .where("kind <> 0 or lo <> hi").drop("hi"), "parts")
    first = (parts.where("kind = 0 and node <> lo").select(F.col("node").alias("x"), F.col("lo").alias("y"))
             .union(parts.where("kind = 1").select("sig", "node")).distinct())
    tested = stored(_sift(first, classes), "pairs")
    links = stored(_verify(tested, docs, classes), "links")
    comp = stored(components(links), "components")
    members = parts.where("kind <> 1").select("sig", F.col("node").alias("member")).distinct()
    members, tested = stored(members, "members"), _both(tested)
    # The first round looks at one part in 16: it merges most of what will be merged.
    at = first_parts = members.where(F.pmod("sig", F.lit(16)) == 0)
    most, more = 1, True
    while more:
        found = stored(_across(at, classes, comp, most), "pairs")
        fresh = stored(found.where("sig is null").select("a", "b").join(tested, ["a", "b"], "left_anti"),
                       "pairs")
        if fresh.head(1):
            tested = tested.union(fresh)
            links = stored(_verify(fresh, docs, classes), "links")
            if links.head(1):
                comp = stored(components(links.union(comp.select("node", "component"))), "components")
        if at is first_parts:
            at = members
        else:
            most *= RISE
            left_out = found.where("sig is not null").select("sig")
            more = bool(left_out.head(1))
            at = members.join(left_out, "sig", "left_semi")
    labels = (classes.join(comp, "node", "left")
              .select("s1", "s2", "n", "id", "text_hash",
                      F.coalesce("component", "node").alias("component")))
    least = labels.groupBy("component").agg(F.min(F.struct("id", "text_hash")).alias("least"))
    return feats.where("kind = 0"), labels.join(least, "component")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles and component_id, the smallest doc_id reachable by links."""
    rows, labels = labelled_classes(docs)
    found = rows.join(labels.select("s1", "s2", "n", "least"), ["s1", "s2", "n"], "left")
    number = F.coalesce("least.id", "id")
    return found.select(F.nullif("id", F.lit(NO_ID)).alias("doc_id"), F.col("n").alias("n_shingles"),
                        F.nullif(number, F.lit(NO_ID)).alias("component_id"))


def one_per_component(docs: DataFrame) -> DataFrame:
    """The row with the smallest doc_id of each component; of equal rows one stays."""
    rows, labels = labelled_classes(docs)
    keep = (labels.select("least.*").union(rows.where("n = 0").select("id", "text_hash")).distinct()
            .select(F.col("id").alias("__id"), F.col("text_hash").alias("__text_hash")))
    keyed = docs.select(F.struct("*").alias("__row"), id_key().alias("__id"),
                        F.xxhash64(text_of()).alias("__text_hash"))
    return (keyed.join(keep, ["__id", "__text_hash"], "left_semi")
            .dropDuplicates(["__id", "__text_hash"]).select("__row.*"))
