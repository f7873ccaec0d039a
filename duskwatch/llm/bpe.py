"""Byte-pair encoding with SentencePiece vocabularies and seeded merge-dropout.

The vocabulary is a merge-type SentencePiece model with byte fallback, given by its path.
A text is cut before each run of spaces, since no piece spans such a place.  Within a
segment an agenda holds candidate merges by score, then position; each candidate taken
from it is skipped for good with the dropout rate.  The draws are keyed by (seed,
document, segment's place), one for each candidate in the order of the agenda, so every
occurrence of a word is cut on its own.  Retries give equal results.

Instead of a coin per candidate, the number of candidates up to the next skipped one is
drawn, which has the same distribution.

Queries encode many texts at once: a distinct segment's cut without dropout is remembered,
and each occurrence of which a candidate is skipped is merged anew.  Segments merge side by
side, as columns of one array, a candidate each per step.  ``encode`` is the plain form for
one text, with equal ids; it remembers a segment's cuts as a tree: a node stands for the
candidates skipped so far and holds the pieces that come out if no other is; its children
are by the next one skipped.  What is remembered saves work only.

Decoding joins the pieces; it gives back every text exactly.  A literal U+2581, which the
vocabulary uses for the space, is encoded by its bytes to keep that true.

Cases.  Null text: like the empty text, no pieces.  A null doc_id is hashed as text "".
Long segments without a space take n log n steps.  Repeated rows are encoded alike.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, count, repeat
from struct import pack

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from duskwatch.llm.common import by_slices, mix64

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE_PIECE = "▁"
SEGMENT = re.compile(r" +[^ \n]*|\n|[^ \n]+")
NONE = float("inf")
# Nodes or segments remembered per worker; the memory is emptied when full, results stay the same.
REMEMBERED = 500_000
# A draw looks this many candidates ahead; so many draws per segment are made at once.
AHEAD, DRAWS = 64, 3
PLACE, TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)
# Characters up to which the agenda is a plain list.
SHORT = 48
# Characters of texts encoded at once, and segments merged side by side: by length, so many.
TOGETHER, WIDTHS, COLUMNS = 1 << 20, (5, 8, 12, 20, SHORT), 1 << 14
# Symbols: pieces by id, then characters that are none, by code point; the end of a segment.
SYMBOL_BITS = 21
END, GONE = (1 << SYMBOL_BITS) - 1, -1
# Ranks of merges leave room for a place in the segment; this one is no merge.
PLACE_BITS, NO_MERGE = 6, 0x7FFFFFC0


class Gaps:
    """Draws of how many candidates are kept before one is skipped; AHEAD: none of so many is."""

    def __init__(self, dropout: float):
        keep, chance, bars = round((1 - dropout) * 2 ** 32), 2 ** 64, []
        for _ in range(AHEAD):
            chance = chance * keep >> 32
            bars.append(min(chance, 2 ** 64 - 1))
        self.bars = np.array(bars[::-1], np.uint64)

    def of(self, keys: np.ndarray, turns: np.ndarray) -> np.ndarray:
        return AHEAD - np.searchsorted(self.bars, mix64(keys ^ turns * TURN), "right")

    def after(self, key: int, turn: int) -> Iterator[int]:
        """A segment's draws from number ``turn`` on."""
        keys = np.array([key], np.uint64)
        for at in count(turn, AHEAD):
            yield from self.of(keys, np.arange(at, at + AHEAD, dtype=np.uint64)).tolist()

    def coins(self, key: int) -> Iterator[int]:
        """A segment's draws as one number per candidate: 0 for those skipped."""
        for gap in self.after(key, 0):
            yield from repeat(1, gap)
            if gap < AHEAD:
                yield 0


class Pieces:
    """A merge-type vocabulary: encode with dropout, and decode."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score, self.id_of, self.bytes_of, self.byte_id = {}, {}, [], {}
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[3:-1], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                self.bytes_of.append(b"")
            else:
                piece = piece.replace(SPACE_PIECE, " ")
                self.score[piece], self.id_of[piece] = -model.get_score(i), i
                self.bytes_of.append(piece.encode())
        self.memo: dict[str | tuple[str, bytes], tuple[int, bytes]] = {}
        self.gaps: dict[float, Gaps] = {}
        self.merges: Merges | None = None
        self.segment_number: defaultdict[str, int] = defaultdict()
        self.segment_number.default_factory = self.segment_number.__len__
        self._forget()

    def _forget(self) -> None:
        """No segment is known; by number: the place of its ids, how many, candidates taken."""
        self.segment_number.clear()
        self.first_id, self.n_ids, self.n_taken = (np.zeros(0, np.int64) for _ in range(3))
        self.known_ids = np.zeros(0, np.int32)

    def _merge_short(self, segment: str, coins: bytes, limit: int) -> list[str]:
        """The agenda as a list of scores that is scanned, for few characters.

        A candidate taken from the agenda uses up one coin; below the limit it is skipped.
        Where the coins have run out, none is.
        """
        taken, known = -1, len(coins)
        score, parts = self.score.get, list(segment)
        scores = [score(a + b, NONE) for a, b in zip(parts, parts[1:])]
        while scores:
            best = min(scores)
            if best == NONE:
                break
            i = scores.index(best)
            taken += 1
            if taken < known and coins[taken] < limit:
                scores[i] = NONE
                continue
            parts[i] += parts.pop(i + 1)
            del scores[i]
            if i:
                scores[i - 1] = score(parts[i - 1] + parts[i], NONE)
            if i < len(scores):
                scores[i] = score(parts[i] + parts[i + 1], NONE)
        return parts

    def _merge_long(self, segment: str, coins: Iterable[int], limit: int) -> list[str]:
        """The agenda as a heap of (score, place, merged text)."""
        coins = iter(coins)
        score, parts, n = self.score.get, list(segment), len(segment)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = [(got, i, parts[i] + parts[i + 1]) for i in range(n - 1)
                  if (got := score(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(agenda)
        skipped = set()
        while agenda:
            _, i, pair = heapq.heappop(agenda)
            if not parts[i] or (j := after[i]) >= n or parts[i] + parts[j] != pair \
                    or (i, len(parts[i]), len(pair)) in skipped:
                continue
            if next(coins, limit) < limit:
                skipped.add((i, len(parts[i]), len(pair)))
                continue
            parts[i], parts[j] = pair, ""
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] < n and (
                        got := score(parts[left] + parts[after[left]])) is not None:
                    heapq.heappush(agenda, (got, left, parts[left] + parts[after[left]]))
        return [x for x in parts if x]

    def _ids(self, parts: list[str]) -> bytes:
        out: list[int] = []
        for part in parts:
            if (got := self.id_of.get(part)) is not None:
                out.append(got)
            else:
                out += [self.byte_id[b] for b in part.encode("utf-8", "surrogatepass")]
        return pack(f"<{len(out)}i", *out)

    def _node(self, segment: str, coins: bytes = b"") -> tuple[int, bytes]:
        """The number of candidates taken and the ids, if only those with coin 0 are skipped."""
        key = (segment, coins) if coins else segment
        got = self.memo.get(key)
        if got is None:
            if len(self.memo) >= REMEMBERED:
                self.memo.clear()
            merge = self._merge_short if len(segment) <= SHORT else self._merge_long
            parts = merge(segment, coins, 1)
            got = len(segment) - len(parts) + coins.count(0), self._ids(parts)
            self.memo[key] = got
        return got

    def _walk(self, segment: str, taken: int, ids: bytes, gaps: Iterable[int]) -> bytes:
        """The ids of a segment whose candidates are skipped after each of the gaps."""
        coins = b""
        for gap in gaps:
            if len(coins) + gap >= taken:
                break
            coins += b"\1" * gap
            if gap < AHEAD:
                coins += b"\0"
                taken, ids = self._node(segment, coins)
        return ids

    def encode(self, text: str, document: int | str = 0, seed: int = 0,
               dropout: float = 0.0) -> np.ndarray:
        """The ids of a text as little-endian 32-bit numbers."""
        out = bytearray()
        if not text:
            return np.frombuffer(out, "<i4")
        segments = SEGMENT.findall(" " + text)
        if not dropout:
            for segment in segments:
                out += self._node(segment)[1]
            return np.frombuffer(out, "<i4")
        gaps, memo = self.gaps.get(dropout) or self.gaps.setdefault(dropout, Gaps(dropout)), self.memo
        base = np.uint64(xxhash.xxh3_64_intdigest(str(document), seed))
        keys = mix64(np.arange(len(segments), dtype=np.uint64) * PLACE + base)
        draws = gaps.of(keys, np.arange(DRAWS, dtype=np.uint64)[:, None]).tolist()
        for segment, key, first, *more in zip(segments, keys.tolist(), *draws):
            if len(segment) > SHORT:
                out += self._ids(self._merge_long(segment, gaps.coins(key), 1))
                continue
            taken, ids = memo.get(segment) or self._node(segment)
            if first < taken:
                ids = self._walk(segment, taken, ids, chain((first, *more), gaps.after(key, DRAWS)))
            out += ids
        return np.frombuffer(out, "<i4")

    def _merge_many(self, symbols: np.ndarray, start: np.ndarray, length: np.ndarray,
                    gaps: Gaps | None = None, keys: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
        """Number of parts and of ids of each segment, and the ids one after the other."""
        count, order, found = np.zeros(len(start), np.int64), [], []
        bucket = np.searchsorted(WIDTHS, length)
        for b in range(len(WIDTHS)):
            all_ = np.flatnonzero(bucket == b)
            for at in range(0, len(all_), COLUMNS):
                some = all_[at:at + COLUMNS]
                skips = Skips(gaps, keys[some]) if gaps else None
                count[some], left = merge_together(self.merges, symbols, start[some], length[some], skips)
                order.append(some)
                found.append(left)
        if not found:
            return count, count, np.zeros(0, np.int32)
        # back to the order asked for
        order, left = np.concatenate(order), np.concatenate(found)
        first = np.zeros(len(start), np.int64)
        first[order] = np.cumsum(count[order]) - count[order]
        left, parts = left[_ranges(first, count)], count
        if (odd := np.flatnonzero(left >= self.merges.first_char)).size:
            many, chars = np.ones(len(left), np.int64), []
            for i in odd.tolist():
                raw = chr(left[i] - self.merges.first_char).encode("utf-8", "surrogatepass")
                many[i] = len(raw)
                chars += [self.byte_id[x] for x in raw]
            by_bytes = np.repeat(left >= self.merges.first_char, many)
            segment = np.repeat(np.arange(len(start)), count)
            count = np.bincount(segment, many, len(start)).astype(np.int64)
            left = np.repeat(left, many)
            left[by_bytes] = chars
        return parts, count, left

    def encode_all(self, texts: list[str], documents: list[int | str], seed: int = 0,
                   dropout: float = 0.0) -> Iterator[np.ndarray]:
        """The ids of each text, equal to those of ``encode``; some texts at a time."""
        if self.merges is None:
            self.merges = Merges(self)
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= TOGETHER):
                size += len(texts[end]) + 1
                end += 1
            yield from self._encode_some(texts[at:end], documents[at:end], seed, dropout)
            at = end

    def _encode_some(self, texts, documents, seed, dropout) -> list[np.ndarray]:
        found = [SEGMENT.findall(" " + t) if t else [] for t in texts]
        segments, per_text = list(chain.from_iterable(found)), np.array([len(x) for x in found], np.int64)
        length = np.fromiter(map(len, segments), np.int64, len(segments))
        start = np.cumsum(length) - length
        symbols = self.merges.symbol_of[np.frombuffer(
            "".join(segments).encode("utf-32-le", "surrogatepass"), np.uint32)]
        long = length > SHORT
        if len(self.segment_number) >= REMEMBERED:
            self._forget()
        # A new segment gets the next number; long ones are not remembered.
        old, number_of = len(self.segment_number), self.segment_number.__getitem__
        number = np.fromiter(map(number_of, segments if not long.any() else
                                 ["" if x else s for x, s in zip(long.tolist(), segments)]),
                             np.int64, len(segments))
        if len(self.segment_number) > old:
            fresh = np.flatnonzero(number >= old)
            _, one = np.unique(number[fresh], return_index=True)
            one = fresh[one]
            own = np.where(long[one], 0, length[one])
            parts, count, ids = self._merge_many(symbols, start[one], own)
            self.n_taken = np.concatenate([self.n_taken, own - parts])
            self.first_id = np.concatenate([self.first_id, len(self.known_ids) + np.cumsum(count) - count])
            self.n_ids = np.concatenate([self.n_ids, count])
            self.known_ids = np.concatenate([self.known_ids, ids])
        first, count, ids = self.first_id[number], self.n_ids[number], [self.known_ids]
        keys, gaps = np.zeros(len(segments), np.uint64), None
        if dropout:
            gaps = self.gaps.get(dropout) or self.gaps.setdefault(dropout, Gaps(dropout))
            base = np.array([xxhash.xxh3_64_intdigest(str(d), seed) for d in documents], np.uint64)
            place = np.arange(len(segments)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
            keys = mix64(place.astype(np.uint64) * PLACE + np.repeat(base, per_text))
            anew = np.flatnonzero(gaps.of(keys, np.uint64(0)) < self.n_taken[number])
            _, many, merged = self._merge_many(symbols, start[anew], length[anew], gaps, keys[anew])
            first[anew], count[anew] = len(ids[0]) + np.cumsum(many) - many, many
            ids.append(merged)
        size = sum(map(len, ids))
        for i in np.flatnonzero(long).tolist():
            coins = gaps.coins(int(keys[i])) if gaps else ()
            merged = np.frombuffer(self._ids(self._merge_long(segments[i], coins, 1 if gaps else 0)), "<i4")
            first[i], count[i] = size, len(merged)
            size += len(merged)
            ids.append(merged)
        out = np.concatenate(ids).astype("<i4")[_ranges(first, count)]
        ends = np.cumsum(np.bincount(np.repeat(np.arange(len(texts)), per_text), count, len(texts)).astype(np.int64))
        return np.split(out, ends[:-1])

    def decode(self, ids: list[int]) -> str:
        table = self.bytes_of
        return b"".join([table[i] for i in ids]).decode("utf-8", "replace")[1:]


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers from each first on, so many, one range after the other."""
    return np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())


class Merges:
    """Which two symbols merge to which piece, and how early: an array with open addresses."""

    BITS, ODD = 20, np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, p: Pieces):
        self.first_char = len(p.bytes_of)
        self.symbol_of = np.arange(0x110000, dtype=np.int32) + self.first_char
        for text, i in p.id_of.items():
            if len(text) == 1:
                self.symbol_of[ord(text)] = i
        rank = {x: i for i, x in enumerate(sorted(set(p.score.values())))}
        known = lambda t: p.id_of.get(t, int(self.symbol_of[ord(t)]) if len(t) == 1 else None)
        rows = [(a << SYMBOL_BITS | b, rank[p.score[t]] << PLACE_BITS, i) for t, i in p.id_of.items()
                for at in range(1, len(t))
                if (a := known(t[:at])) is not None and (b := known(t[at:])) is not None]
        while len(rows) * 4 > 1 << self.BITS:
            self.BITS += 1
        self.keys = np.full(1 << self.BITS, -1, np.int64)
        self.ranks, self.merged = np.full(1 << self.BITS, NO_MERGE, np.int32), np.zeros(1 << self.BITS, np.int32)
        key, order, into = (np.array(x, np.int64) for x in zip(*rows)) if rows else [np.zeros(0, np.int64)] * 3
        slot, left = self._slots(key), np.arange(len(key))
        while len(left):
            free = left[self.keys[slot[left]] < 0]
            _, one = np.unique(slot[free], return_index=True)
            put = free[one]
            self.keys[slot[put]], self.ranks[slot[put]], self.merged[slot[put]] = key[put], order[put], into[put]
            left = left[self.keys[slot[left]] != key[left]]
            slot[left] = (slot[left] + 1) & ((1 << self.BITS) - 1)

    def _slots(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * self.ODD) >> np.uint64(64 - self.BITS)).view(np.int64)

    def of(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of the merges of symbols a and b; NO_MERGE where there is none."""
        key = a.astype(np.int64) << SYMBOL_BITS | b
        slot = self._slots(key)
        held = self.keys[slot]
        other = np.flatnonzero((held != key) & (held >= 0))
        while len(other):
            slot[other] = (slot[other] + 1) & ((1 << self.BITS) - 1)
            held = self.keys[slot[other]]
            other = other[(held != key[other]) & (held >= 0)]
        return self.ranks[slot], self.merged[slot]


class Skips:
    """For some segments the candidate that is skipped next, from keyed draws."""

    def __init__(self, gaps: Gaps, keys: np.ndarray):
        self.gaps, self.keys = gaps, keys
        self.turn, self.at = np.zeros(len(keys), np.uint64), np.zeros(len(keys), np.int64)
        self.draw(np.arange(len(keys)))

    def draw(self, which: np.ndarray) -> None:
        """``at`` is the first candidate not yet drawn for; a short segment has under 3 SHORT."""
        while len(which):
            gap = self.gaps.of(self.keys[which], self.turn[which])
            self.turn[which] += np.uint64(1)
            self.at[which] += gap
            which = which[(gap == AHEAD) & (self.at[which] < 3 * SHORT)]


def merge_together(merges: Merges, symbols: np.ndarray, start: np.ndarray, length: np.ndarray,
                   skips: Skips | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The number of symbols left of each segment, and these one after the other.

    A column is a segment, with an end before and after it; each step takes the best
    candidate of every column from the agenda.
    """
    n, width = len(start), int(length.max())
    place = np.arange(width + 2, dtype=np.int64)[:, None]
    inside = (place >= 1) & (place <= length)
    parts = np.where(inside, symbols[np.where(inside, start + place - 1, 0)], np.int32(END))
    after, before = (np.repeat(x, n, axis=1) for x in (place + 1, place - 1))
    ranks, into = merges.of(parts[:-1].ravel(), parts[1:].ravel())
    agenda, into = ranks.reshape(-1, n) | place[:-1].astype(np.int32), into.reshape(-1, n)
    flat_parts, flat_after, flat_before, flat_into = (x.reshape(-1) for x in (parts, after, before, into))
    columns, step = np.arange(n), 0
    while True:
        best = agenda.min(axis=0)
        live = np.flatnonzero(best < NO_MERGE)
        if not len(live):
            break
        if 4 * len(live) < 3 * len(columns):
            agenda, columns, best = agenda.take(live, axis=1), columns[live], best[live]
            live = np.arange(len(live))
        m, i, c = len(columns), (best[live] & ((1 << PLACE_BITS) - 1)).astype(np.int64), columns[live]
        flat = agenda.reshape(-1)
        if skips is not None:
            skip = skips.at[c] == step
            if skip.any():
                flat[i[skip] * m + live[skip]] = NO_MERGE
                hit = c[skip]
                skips.at[hit] += 1
                skips.draw(hit)
                live, i, c = live[~skip], i[~skip], c[~skip]
        step += 1
        here = i * n + c
        j = flat_after[here]
        there = j * n + c
        k, h = flat_after[there], flat_before[here]
        piece = flat_into[here]
        flat_parts[here], flat_parts[there] = piece, GONE
        flat_after[here], flat_before[k * n + c] = k, i
        flat[j * m + live] = NO_MERGE
        rank, merged = merges.of(flat_parts[h * n + c], piece)
        flat[h * m + live], flat_into[h * n + c] = rank | h.astype(np.int32), merged
        rank, merged = merges.of(piece, flat_parts[k * n + c])
        flat[i * m + live], flat_into[here] = rank | i.astype(np.int32), merged
    left = parts[1:-1].T
    stays = (left != GONE) & (left != END)
    return stays.sum(axis=1), left[stays]


@lru_cache(maxsize=4)
def pieces(path: str) -> Pieces:
    """The vocabulary, read once per Python worker."""
    return Pieces(path)


def _texts(rows: dict) -> tuple[list[str], list[int | str]]:
    """Texts and the documents that key their draws; missing ones are empty."""
    return [t or "" for t in rows["text"]], ["" if d is None else d for d in rows["doc_id"]]


def encode(docs: DataFrame, model: str = DEFAULT_MODEL, seed: int = 11, dropout: float = 0.1) -> DataFrame:
    """doc_id and the token ids of every row."""
    def work(rows: dict) -> dict:
        p = pieces(model)
        return {"doc_id": rows["doc_id"],
                "ids": [i.tolist() for i in p.encode_all(*_texts(rows), seed, dropout)]}
    return by_slices(docs.select("doc_id", "text"), work, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str = DEFAULT_MODEL) -> DataFrame:
    """doc_id and the text that the ids stand for."""
    def work(rows: dict) -> dict:
        p = pieces(model)
        return {"doc_id": rows["doc_id"], "text": [p.decode(i or ()) for i in rows["ids"]]}
    return by_slices(encoded.select("doc_id", "ids"), work, "doc_id long, text string")


def round_trip(docs: DataFrame, model: str = DEFAULT_MODEL, seed: int = 11,
               dropout: float = 0.1) -> DataFrame:
    """Encode and decode every text in one pass: token count and hashes of both sides.

    ids_sha256 is over the ids as little-endian 32-bit numbers.
    """
    def work(rows: dict) -> dict:
        p = pieces(model)
        out: dict = {k: [] for k in ("n_tokens", "ids_sha256", "decoded_sha256", "lossless")}
        texts, documents = _texts(rows)
        for text, ids in zip(texts, p.encode_all(texts, documents, seed, dropout)):
            back = p.decode(ids.tolist())
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(back.encode("utf-8", "replace")).hexdigest())
            out["lossless"].append(back == text)
        return {"doc_id": rows["doc_id"]} | out
    return by_slices(docs.select("doc_id", "text"), work,
                     "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, "
                     "lossless boolean")
