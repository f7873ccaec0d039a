"""Runs of words that repeat with a period, found by recursive frequency splitting.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical) that no neighbouring word extends and that is at least
max(MIN_WORDS, MIN_TURNS * q) words long.  Every word of a run occurs MIN_TURNS times in
it, so a word that is rarer than that within the segment at hand lies in no run and
splits the segment.  The pieces have fewer copies of each word, so this is repeated until
nothing splits any more; texts without runs mostly vanish here.  It is done for all texts
of a slice at once.

Segments that are left are scanned by lag.  A run with lag q holds three periods of words
equal to the word q later, hence two whole aligned blocks of q words equal to their next
ones.  Comparing only neighbouring aligned blocks, by prefix polynomial hashes, takes
n / q steps for lag q and n log n for all.  Every hit is extended and verified word by
word, so hash collisions change nothing.  A hit inside a run whose period divides the lag
is the same run again.

Every text is worked on whole in one task; nothing is shuffled.  Memory is a few numbers
per word of a slice of texts.

Cases.  Null and empty texts have no runs and collapse to the empty text.  Rows are
independent: repeated rows give equal results, null ids and extra columns do not matter.
Two runs may overlap; ties of start are ordered by period.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
from pyspark.sql import DataFrame

from duskwatch.llm.common import by_slices, mix64

MIN_WORDS, MIN_TURNS = 6, 4
BASE = np.uint64(0x9E3779B97F4A7C15)
# Block comparisons laid out at a time.
AT_ONCE = 1 << 20


def survivors(ids: np.ndarray, seg: np.ndarray) -> list[np.ndarray]:
    """Places, per segment, that no word too rare in its segment is part of."""
    at = np.arange(len(ids))
    span = int(ids.max()) + 1 if len(ids) else 1
    while len(at):
        _, inverse, counts = np.unique(seg * span + ids[at], return_inverse=True, return_counts=True)
        keep = counts[inverse] >= MIN_TURNS
        whole = keep.all()
        at, old = at[keep], seg[keep]
        if not len(at):
            break
        cut = (np.diff(at) != 1) | (np.diff(old) != 0)
        seg = np.concatenate([[0], np.cumsum(cut)])
        enough = np.bincount(seg)[seg] >= MIN_WORDS
        if whole and enough.all():
            return np.split(at, np.flatnonzero(cut) + 1)
        at, seg = at[enough], seg[enough]
    return []


def lag_scan(words: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of one segment of word numbers."""
    n = len(words)
    power = np.full(n + 1, BASE)
    power[0] = 1
    power = np.multiply.accumulate(power)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(mix64(words.astype(np.uint64) + np.uint64(1)) * power[:n], out=prefix[1:])
    starts, ends, periods = [], [], []
    first, last = 1, n // MIN_TURNS
    while first <= last:
        upto = min(last, first + max(1, AT_ONCE * first // n))
        lags = np.arange(first, upto + 1)
        first = upto + 1
        blocks = n // lags
        lag = np.repeat(lags, blocks)
        k = np.arange(len(lag)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        part = prefix[k * lag + lag] - prefix[k * lag]
        same = np.zeros(len(lag), bool)
        same[:-1] = (part[:-1] * power[lag[:-1]] == part[1:]) & (k[1:] > 0)
        # twice in a row: block k equals k + 1, and k + 1 equals k + 2
        hits = np.flatnonzero(same[:-1] & same[1:])
        if not len(hits):
            continue
        heads = np.flatnonzero(np.diff(hits, prepend=-2) != 1)
        sizes = np.diff(np.append(heads, len(hits)))
        for head, size in zip(hits[heads].tolist(), sizes.tolist()):
            q, block = int(lag[head]), int(k[head])
            lo, hi = max(0, (block - 1) * q), min(n - q, (block + size + 2) * q)
            known = len(periods) and (
                (np.array(starts) <= block * q) & (np.array(ends) >= (block + size + 2) * q)
                & (q % np.array(periods) == 0)).any()
            if known:
                continue
            equal = np.concatenate([[False], words[lo:hi] == words[lo + q:hi + q], [False]])
            edges = np.flatnonzero(np.diff(equal)).reshape(-1, 2)
            for a, b in edges[edges[:, 1] - edges[:, 0] >= max(MIN_WORDS - q, (MIN_TURNS - 1) * q)].tolist():
                starts.append(lo + a)
                ends.append(lo + b + q)
                periods.append(q)
    return [(a, b - a, q) for a, b, q in zip(starts, ends, periods)]


def runs_of(texts: list[str | None]) -> tuple[list[list[bytes]], list[list[tuple[int, int, int]]]]:
    """The words of each text and its runs, by start, then period."""
    words = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
    number: dict[bytes, int] = {}
    every = list(chain.from_iterable(words))
    ids = np.fromiter((number.setdefault(w, len(number)) for w in every), np.int64, len(every))
    sizes = np.array([len(w) for w in words], np.int64)
    offsets = np.cumsum(sizes) - sizes
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for at in survivors(ids, np.repeat(np.arange(len(texts)), sizes)):
        text = int(np.searchsorted(offsets, at[0], "right")) - 1
        base = int(at[0] - offsets[text])
        runs[text] += [(base + a, length, q) for a, length, q in lag_scan(ids[at])]
    return words, [sorted(found, key=lambda r: (r[0], r[2])) for found in runs]


def periodic_runs(texts: DataFrame) -> DataFrame:
    """doc_id, the runs of each text, and the text without a run's words after its first period."""
    def work(rows: dict) -> dict:
        words, runs = runs_of(rows["text"])
        kept = []
        for own, found in zip(words, runs):
            if found:
                drop = np.zeros(len(own), bool)
                for start, length, period in found:
                    drop[start + period:start + length] = True
                own = [own[i] for i in np.flatnonzero(~drop)]
            kept.append(b" ".join(own).decode("utf-8", "replace"))
        return {"doc_id": rows["doc_id"], "collapsed": kept,
                "runs": [[{"start": a, "length": n, "period": q} for a, n, q in found] for found in runs]}
    return by_slices(texts.select("doc_id", "text"), work,
                     "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
