"""Best-fit decreasing packing of token sequences into blocks of a fixed capacity.

Texts become tokens, texts longer than the capacity are cut into full pieces and a rest.
Pieces are then packed by best-fit decreasing over the *whole* table: longest first, each
into the open block with the least room that still holds it.

Only the lengths matter to the plan, and there are at most ``capacity`` of them.  Pieces
of one length are placed as one group: the tightest fitting amount of room is looked up in
a segment tree over the amounts of room (logarithmic in the capacity), and as many blocks
with that room as are needed are filled with that length, which is what placing the
pieces one by one does.  Blocks with equal room are kept as ranges of block numbers.  A
length opens or splits at most four ranges, and filling a range at least halves its room,
so the plan has at most about 4 * capacity * log2(capacity) rows whatever the number of
pieces.  It is the only thing the driver sees besides the counts per length.

1. Tokenizing numbers each piece within its task and length (a counter per length), and
   the pieces are written to the shared folder: from there on the numbers are fixed.
2. Counts per (task, length) are summed up by length in a window: a piece's number within
   its length over all tasks follows by a join.
3. The plan gives block and offset for each (length, number) by binary search.

Tokens of words are remembered per worker.  No token of the vocabulary used spans a space
or a line end, so a text's tokens are those of its parts between them.

Cases.  Null text: like the empty text, one piece with the end token.  Repeated rows and
null ids are packed like any others.  Very long texts are cut as said.  Ties: pieces of
one length are interchangeable; they take their places in order of task and row.  Empty
table: empty result.  Extra columns are not carried.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from duskwatch.llm.common import SLICE, stored

TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"
CAPACITY, END = 4096, 1
# Parts of a text remembered per worker; emptied when full, results stay the same.
REMEMBERED = 600_000
# Letters, then marks: the vocabulary parts them there, and the letters' case does not matter.
MARKS = ("", ".", ",", ";", ":", "!", "?", "...", "!!", "!!!", "??", "???")
PLAIN = re.compile(r"([A-Za-z]+)([.,;:!?]*)")
PIECES = "task int, number long, doc_id long, piece int, start long, length long, ids binary"


class Words:
    """Tokens of texts as little-endian 32-bit numbers, put together from their parts."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.parts: dict[str, bytes] = {}
        self.stems: dict[str, bytes] = {}
        self.marks = {m: array("I", self.tokenizer.encode(m, add_special_tokens=False).ids).tobytes()
                      for m in MARKS}

    def _plain(self, stem: str) -> bytes:
        """ASCII letters reach the model as one word as they are, so it is asked directly."""
        got = self.stems.get(stem)
        if got is None:
            got = self.stems[stem] = array("I", [t.id for t in self.model.tokenize(stem)]).tobytes()
        return got

    def _learn(self, new: list[str]) -> None:
        if len(self.stems) >= REMEMBERED:
            self.stems.clear()
        parts, marks, other = self.parts, self.marks, []
        for part in new:
            if (m := PLAIN.fullmatch(part)) and (tail := marks.get(m[2])) is not None:
                parts[part] = self._plain(m[1].lower()) + tail
            else:
                other.append(part)
        for part, got in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False)):
            parts[part] = array("I", got.ids).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        cut = [(t or "").replace("\n", " ").split(" ") for t in texts]
        every = set().union(*cut)
        if len(self.parts) >= REMEMBERED:
            self.parts.clear()
        parts = self.parts
        if new := [part for part in every if part not in parts]:
            self._learn(new)
        get = parts.__getitem__
        return [b"".join(map(get, own)) for own in cut]


@lru_cache(maxsize=2)
def words(path: str) -> Words:
    """The vocabulary, read once per Python worker."""
    return Words(path)


def token_pieces(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY,
                 end: int = END) -> DataFrame:
    """Pieces of at most ``capacity`` tokens, numbered within task and length; written once."""
    target = docs.sparkSession.createDataFrame([], PIECES).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema
        schema, task = to_arrow_schema(target), TaskContext.get().partitionId()
        vocabulary, last, size = words(tokenizer), np.uint32(end).tobytes(), 4 * capacity
        seen = [0] * (capacity + 1)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                rows = batch.slice(at, SLICE).to_pydict()
                out: list[tuple] = []
                for doc, ids in zip(rows["doc_id"], vocabulary.encode(rows["text"])):
                    ids += last
                    for piece, lo in enumerate(range(0, len(ids), size)):
                        own = ids[lo:lo + size]
                        n = len(own) // 4
                        out.append((task, seen[n], doc, piece, lo // 4, n, own))
                        seen[n] += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, type=f.type) for column, f in zip(zip(*out), schema)], schema=schema)

    return stored(docs.select("doc_id", "text").mapInArrow(run, target), "pieces")


class Room:
    """Segment tree over amounts of room: which of them some open block has."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.some = bytearray(2 * self.leaves)

    def set(self, room: int, some: bool) -> None:
        at = room + self.leaves
        self.some[at] = some
        while at > 1:
            at //= 2
            self.some[at] = self.some[2 * at] | self.some[2 * at + 1]

    def tightest(self, least: int) -> int:
        """The smallest amount of at least ``least``, or -1."""
        at = least + self.leaves
        if self.some[at]:
            return least
        while at > 1 and (at & 1 or not self.some[at + 1]):   # up, until there is more to the right
            at //= 2
        if at <= 1:
            return -1
        at += 1
        while at < self.leaves:
            at = 2 * at if self.some[2 * at] else 2 * at + 1
        return at - self.leaves


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """The plan: rows (length, first number, blocks' pieces, first block, offset).

    From the first number on, each block takes that many pieces of the length, at the offset.
    """
    room, plan, blocks = Room(capacity), [], 0
    ranges: dict[int, list[tuple[int, int]]] = {}

    def put(left: int, first: int, n: int) -> None:
        if left and n:
            if not ranges.setdefault(left, []):
                room.set(left, True)
            ranges[left].append((first, n))

    for length in sorted(counts, reverse=True):
        number, total = 0, counts[length]
        while number < total:
            left = room.tightest(length) if length < capacity else -1
            if left < 0:
                left, first, n = capacity, blocks, -(-(total - number) // (capacity // length))
                blocks += n
            else:
                first, n = ranges[left].pop()
                if not ranges[left]:
                    room.set(left, False)
            each = left // length
            full = min(n, (total - number) // each)
            if full:
                plan.append((length, number, each, first, capacity - left))
                put(left - each * length, first, full)
                number += full * each
            rest = min(total - number, each) if full < n else 0
            if rest:
                plan.append((length, number, rest, first + full, capacity - left))
                put(left - rest * length, first + full, 1)
                number += rest
            put(left, first + full + bool(rest), n - full - bool(rest))
    return plan


def placed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with sequence_id and offset."""
    counts = stored(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "lengths")
    totals = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()     # one row per length
    plan = np.array(best_fit_decreasing({r.length: r.n for r in totals}, capacity),
                    np.int64).reshape(-1, 5)
    # the plan by length and number, with the place where each length begins
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    lengths, begins = np.unique(plan[:, 0], return_index=True)
    ends = np.append(begins[1:], len(plan))
    own = {int(n): plan[a:b] for n, a, b in zip(lengths, begins, ends)}

    before = (Window.partitionBy("length").orderBy("task")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    offsets = counts.select("task", "length", (F.sum("n").over(before) - F.col("n")).alias("before"))
    rows = pieces.join(offsets, ["task", "length"]).withColumn("number", F.col("number") + F.col("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            block, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                if len(rows):
                    n, steps = int(length[rows[0]]), own[int(length[rows[0]])]
                    step = steps[np.searchsorted(steps[:, 1], number[rows], "right") - 1]
                    past = number[rows] - step[:, 1]
                    block[rows] = step[:, 3] + past // step[:, 2]
                    offset[rows] = step[:, 4] + past % step[:, 2] * n
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(block), pa.array(offset)],
                names=[*kept, "sequence_id", "offset"])

    kept = [c for c in pieces.columns if c not in ("task", "number")]
    schema = rows.select(*kept).schema.add("sequence_id", "long").add("offset", "long")
    return rows.mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Packed sequences as rows: doc_id, piece, start, length, ids, sequence_id, offset."""
    return placed(token_pieces(docs, tokenizer, capacity, end), capacity)
