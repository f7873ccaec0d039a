"""Exact removal of byte strings that occur more than once, by hash-compared suffix sorts.

Task: find every window of ``LENGTH`` bytes that starts at another place as well.
Sorting all suffixes of a corpus would shuffle each byte many times.  Instead each window
is filed under its anchor, the one of its ``GRAM``-byte substrings with the smallest hash
(the first of equal ones).  Equal windows have equal anchors at equal places, and in
running text one place in about (LENGTH - GRAM) / 2 is an anchor.

1. Anchors are found per document from prefix polynomial hashes.  A row holds the anchor's
   hash and place, the range of windows filed under it, and a hash of the bytes these
   windows span.
2. Anchors whose hash occurs once are dropped.  Rows alike in all hashes form a class; in
   a class of two or more every window is repeated, and nothing has to be compared.
   Classes are aggregates, so thousands of copies are combined before the shuffle.
3. Among the classes of one anchor, the members of single-row classes are compared by
   suffixes: the bytes from the anchor on, and the bytes before it backwards, are each
   merge-sorted; a comparison finds the common extension by binary search on prefix
   hashes and is verified on the bytes.  A window that begins d bytes before the anchor is
   repeated if another member shares d bytes before it and LENGTH - d from it on, that is
   if both lie in one run of either sort; runs come from the common extensions of
   neighbours, so no pairs are formed.
4. An anchor with more than ``GROUP`` classes (a short passage in a great many contexts)
   goes another exact way: its windows' hashes are counted by an aggregate.
5. Repeated windows are joined to their documents and cut.

Cases.  Null text: like the empty text.  Texts below LENGTH bytes lose nothing.  Matches
within a document, overlapping ones too, count.  Repeated rows are copies of one another.
A null doc_id is a document like any other.  Empty table: empty result.
"""

from __future__ import annotations

from functools import cmp_to_key

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from duskwatch.llm.common import SLICE, by_slices, id_key, mix64, stored, text_of

LENGTH, GRAM = 400, 100
GROUP = 20_000
# Texts are worked on in pieces of this many bytes (pieces overlap by a window).
PIECE = 1 << 22
_AT = np.uint64((1 << 24) - 1)

_rng = np.random.default_rng(41)
_BYTE = _rng.integers(0, 1 << 64, 256, np.uint64, endpoint=False)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_powers: list[np.ndarray] = [np.ones(0, np.uint64)] * 2


def powers(size: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse mod 2^64; the tables grow when needed."""
    if len(_powers[0]) < size:
        for i, base in enumerate((int(_BASE), pow(int(_BASE), -1, 1 << 64))):
            table = np.full(1 << max(16, size.bit_length()), base, np.uint64)
            table[0] = 1
            _powers[i] = np.multiply.accumulate(table)
    return _powers


def prefix_hashes(raw: bytes) -> np.ndarray:
    """Sums of byte value times base^place over all prefixes."""
    b = np.frombuffer(raw, np.uint8)
    out = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTE[b] * powers(len(b))[0][:len(b)], out=out[1:])
    return out


def string_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the strings from start to end, alike for equal strings at any place."""
    return mix64((prefix[end] - prefix[start]) * powers(len(prefix))[1][start])


def anchors(raw: bytes, length: int = LENGTH, gram: int = GRAM):
    """Arrays of a text's anchors: (gram hash, span hash, place, first and last window)."""
    parts = [_anchors(raw[at:at + PIECE + length - 1], at, length, gram)
             for at in range(0, max(len(raw) - length + 1, 0), PIECE)]
    return [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, np.uint64)] * 5


def _anchors(raw: bytes, offset: int, length: int, gram: int):
    prefix = prefix_hashes(raw)
    starts = np.arange(len(raw) - gram + 1)
    hashed = string_hashes(prefix, starts, starts + gram)
    key = (hashed & ~_AT) | starts.astype(np.uint64)       # equal hashes: the first place
    width = length - gram + 1
    pad = -len(key) % width
    blocks = np.concatenate([key, np.full(pad, ~np.uint64(0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(raw) - length + 1
    best = (np.minimum(behind[:n], ahead[width - 1:width - 1 + n]) & _AT).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], best[1:] != best[:-1]]))
    last = np.concatenate([first[1:] - 1, [n - 1]])
    place = best[first]
    span = string_hashes(prefix, first, last + length)
    span = mix64(span ^ mix64(((place - first) * (length + 1) + (last - first)).astype(np.uint64)))
    return hashed[place], span, place + offset, first + offset, last + offset


def anchor_rows(docs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                rows = batch.slice(at, SLICE)
                found = [anchors((t or "").encode("utf-8", "replace")) for t in rows["text"].to_pylist()]
                many = np.array([len(f[0]) for f in found])
                gram, span, place, first, last = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_pydict({
                    "gram": gram.view(np.int64), "span": span.view(np.int64),
                    "id": np.repeat(rows["id"].to_numpy(), many),
                    "text_hash": np.repeat(rows["text_hash"].to_numpy(), many),
                    "place": place.astype(np.int64), "first": first.astype(np.int64),
                    "last": last.astype(np.int64)})
    return (docs.select(id_key().alias("id"), F.xxhash64(text_of()).alias("text_hash"), "text")
            .mapInArrow(run, "gram long, span long, id long, text_hash long, place long, first long, last long"))


def common_extension(a: bytes, b: bytes, ha: np.ndarray, hb: np.ndarray) -> int:
    """Length of the common prefix, by binary search on prefix hashes; verified on the bytes."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if ha[middle] == hb[middle]:
            low = middle
        else:
            high = middle - 1
    while a[:low] != b[:low]:              # two strings with one hash: step back
        low = next(i for i in range(low) if a[i] != b[i])
    return low


def sorted_runs(strings: list[bytes]) -> tuple[list[int], np.ndarray]:
    """Order of the strings by merge sort, and common extensions of neighbours in it."""
    hashes = [prefix_hashes(s) for s in strings]

    def compare(i: int, j: int) -> int:
        a, b = strings[i], strings[j]
        n = common_extension(a, b, hashes[i], hashes[j])
        if n == len(a) or n == len(b):
            return len(a) - len(b)
        return -1 if a[n] < b[n] else 1

    order = sorted(range(len(strings)), key=cmp_to_key(compare))
    shared = [common_extension(strings[i], strings[j], hashes[i], hashes[j])
              for i, j in zip(order, order[1:])]
    return order, np.array(shared, np.int64)


def repeated_offsets(before: list[bytes], after: list[bytes], length: int = LENGTH,
                     gram: int = GRAM) -> np.ndarray:
    """(members, offsets) true where a member's window d bytes before the anchor is repeated.

    ``before`` holds the bytes before each member's anchor, last byte first.
    """
    m, offsets = len(before), np.arange(length - gram + 1)
    left, shared_left = sorted_runs(before)
    right, shared_right = sorted_runs(after)
    out = np.zeros((m, len(offsets)), bool)
    step = max(1, (1 << 21) // m)
    for at in range(0, len(offsets), step):
        d = offsets[at:at + step, None]
        run_left, run_right = (np.zeros((len(d), m), np.int64) for _ in range(2))
        run_left[:, left[1:]] = np.cumsum(shared_left < d, axis=1)
        run_right[:, right[1:]] = np.cumsum(shared_right < length - d, axis=1)
        both = run_left * m + run_right
        order = np.argsort(both, axis=1, kind="stable")
        ordered = np.take_along_axis(both, order, 1)
        same = ordered[:, 1:] == ordered[:, :-1]
        twin = np.zeros((len(d), m), bool)
        twin[:, 1:] |= same
        twin[:, :-1] |= same
        hit = np.zeros_like(twin)
        np.put_along_axis(hit, order, twin, 1)
        # A window must lie within the member's own bytes.
        fits = (d <= [len(x) for x in before]) & (length - d <= [len(x) for x in after])
        out[:, at:at + step] = (hit & fits).T
    return out


_CONTEXT = "gram long, span long, n long, id long, text_hash long, place long, before binary, after binary"
_INTERVAL = "id long, text_hash long, start long, end long"


def _contexts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Bytes around the wanted anchors; one row of requests per document."""
    asked = (wanted.groupBy("id", "text_hash")
             .agg(F.collect_list(F.struct("gram", "span", "n", "place", "first", "last")).alias("asked")))
    texts = docs.select(id_key().alias("id"), F.xxhash64(text_of()).alias("text_hash"), "text")

    def work(rows: dict) -> dict:
        out: dict = {c.split()[0]: [] for c in _CONTEXT.split(", ")}
        for id_, hash_, text, asked_ in zip(rows["id"], rows["text_hash"], rows["text"], rows["asked"]):
            raw = text.encode("utf-8", "replace")
            for a in asked_:
                for c in ("gram", "span", "n", "place"):
                    out[c].append(a[c])
                out["id"].append(id_)
                out["text_hash"].append(hash_)
                out["before"].append(raw[a["first"]:a["place"]][::-1])
                out["after"].append(raw[a["place"]:a["last"] + LENGTH])
        return out

    return by_slices(texts.join(asked, ["id", "text_hash"]), work, _CONTEXT)


def _compared(contexts: DataFrame) -> DataFrame:
    """Intervals of repeated windows of single-row classes, anchor by anchor."""
    def intervals(pdf: pd.DataFrame) -> pd.DataFrame:
        gram, n, place = (pdf[c].to_numpy() for c in ("gram", "n", "place"))
        before, after, rows = pdf["before"].tolist(), pdf["after"].tolist(), []
        ends = np.flatnonzero(np.diff(gram)) + 1
        for lo, hi in zip([0, *ends], [*ends, len(gram)]):
            if hi - lo == 2:
                low, high = _two(before[lo:hi], after[lo:hi])
                if low <= high:
                    rows += [(i, place[i] - high, place[i] - low + LENGTH)
                             for i in (lo, lo + 1) if n[i] == 1]
                continue
            for i, hit in enumerate(repeated_offsets(before[lo:hi], after[lo:hi]), lo):
                if n[i] == 1 and hit.any():
                    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]])))
                    rows += [(i, place[i] - (b - 1), place[i] - a + LENGTH)
                             for a, b in zip(edge[::2], edge[1::2])]
        at = [r[0] for r in rows]
        return pd.DataFrame({"id": pdf["id"].to_numpy()[at], "text_hash": pdf["text_hash"].to_numpy()[at],
                             "start": [r[1] for r in rows], "end": [r[2] for r in rows]}).astype("int64")

    def run(frames):
        held = None
        for pdf in frames:
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            gram = pdf["gram"].to_numpy()
            cut = int(np.searchsorted(gram, gram[-1])) if len(gram) else 0
            held = pdf.iloc[cut:]           # the last anchor may go on in the next batch
            if cut:
                yield intervals(pdf.iloc[:cut])
        if held is not None and len(held):
            yield intervals(held)

    return (contexts.repartition("gram").sortWithinPartitions("gram", "span").mapInPandas(run, _INTERVAL))


def _two(before: list[bytes], after: list[bytes]) -> tuple[int, int]:
    """Least and largest offset of the windows that two members share (empty if least is larger)."""
    l, r = ([prefix_hashes(s) for s in x] for x in (before, after))
    return (max(0, LENGTH - common_extension(*after, *r)), common_extension(*before, *l))


def _counted(contexts: DataFrame) -> DataFrame:
    """The same for anchors with very many classes: windows are counted by their hashes."""
    def run(frames):
        for pdf in frames:
            for id_, hash_, place, before, after in zip(*(pdf[c] for c in (
                    "id", "text_hash", "place", "before", "after"))):
                prefix = prefix_hashes(before[::-1] + after)
                start = np.arange(len(prefix) - LENGTH)
                h = string_hashes(prefix, start, start + LENGTH)
                low = string_hashes(prefix, start, start + LENGTH // 2)
                yield pd.DataFrame({"h1": h.view(np.int64), "h2": low.view(np.int64), "id": id_,
                                    "text_hash": hash_, "start": start + place - len(before)})

    windows = contexts.mapInPandas(run, "h1 long, h2 long, id long, text_hash long, start long")
    windows = stored(windows, "windows")
    twice = windows.groupBy("h1", "h2").agg(F.count("*").alias("c")).where("c > 1").drop("c")
    return (windows.join(twice, ["h1", "h2"])
            .select("id", "text_hash", "start", (F.col("start") + LENGTH).alias("end")))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Intervals (id, text_hash, start, end) whose union is all that is repeated."""
    rows = stored(anchor_rows(docs), "anchors")
    shared = rows.groupBy("gram").agg(F.count("*").alias("c")).where("c > 1").drop("c")
    rows = stored(rows.join(shared, "gram"), "shared")
    classes = stored(rows.groupBy("gram", "span")
                     .agg(F.count("*").alias("n"),
                          F.min(F.struct("id", "text_hash", "place", "first", "last")).alias("r"))
                     .select("gram", "span", "n", "r.*"), "classes")
    whole = (rows.join(classes.where("n > 1").select("gram", "span"), ["gram", "span"])
             .select("id", "text_hash", F.col("first").alias("start"), (F.col("last") + LENGTH).alias("end")))
    mixed = (classes.groupBy("gram").agg(F.count("*").alias("m"), F.min("n").alias("least"))
             .where("m > 1 and least = 1").select("gram", "m"))
    wanted = classes.join(mixed, "gram")
    near = _compared(_contexts(docs, wanted.where(F.col("m") <= GROUP)))
    crowded = wanted.where(F.col("m") > GROUP)
    if crowded.head(1):
        near = near.union(_counted(_contexts(docs, crowded)))
    return whole.union(near)


def cut_repeated(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_bytes, kept (the bytes left) and spans removed (start, end)."""
    spans = (repeated_spans(docs).distinct().groupBy("id", "text_hash")
             .agg(F.collect_list(F.struct("start", "end")).alias("found")))
    texts = docs.select("doc_id", id_key().alias("id"), F.xxhash64(text_of()).alias("text_hash"), "text")

    def work(rows: dict) -> dict:
        out: dict = {"doc_id": rows["doc_id"], "n_bytes": [], "kept": [], "spans": []}
        for text, found in zip(rows["text"], rows["found"]):
            raw, merged = (text or "").encode("utf-8", "replace"), []
            for start, end in sorted((f["start"], f["end"]) for f in found or ()):
                if merged and start <= merged[-1][1]:
                    merged[-1][1] = max(end, merged[-1][1])
                else:
                    merged.append([start, end])
            edges = [0, *(x for pair in merged for x in pair), len(raw)]
            out["n_bytes"].append(len(raw))
            out["kept"].append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
            out["spans"].append([{"start": a, "end": b} for a, b in merged])
        return out

    return by_slices(texts.join(spans, ["id", "text_hash"], "left").select("doc_id", "text", "found"), work,
                     "doc_id long, n_bytes long, kept binary, spans array<struct<start: long, end: long>>")
