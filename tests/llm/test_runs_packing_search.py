"""Periodic runs, packing and ranked search against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from duskwatch.llm import catalog, packing, periodic, ranked

SF = "/root/testdata/sf0.01"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_runs(w):
    """Every maximal stretch per period, without those that a smaller period explains."""
    found, n = {}, len(w)
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q) and (i, length) not in found:
                found[i, length] = q
            i = j
    return sorted(((a, n, q) for (a, n), q in found.items()), key=lambda r: (r[0], r[2]))


def check_runs(words):
    got = periodic.runs_of([" ".join(w) for w in words])[1]
    assert got == [plain_runs(w) for w in words]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=60), max_size=4))
def test_runs_of_few_words(words):
    check_runs(words)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abcdefgh"), min_size=1, max_size=9), st.integers(1, 9)),
                max_size=6), st.integers(1, 40))
def test_runs_of_repeated_stretches(parts, at_once):
    before, periodic.AT_ONCE = periodic.AT_ONCE, at_once     # few comparisons at a time
    try:
        check_runs([[x for part, times in parts for x in part * times]])
    finally:
        periodic.AT_ONCE = before


def test_long_runs():
    rng = random.Random(4)
    period = [rng.choice("abcdef") for _ in range(700)]
    check_runs([period * 5 + ["x"] + period[:300], ["a"] * 3000, ["a", "b"] * 800 + ["a", "b", "c"] * 600,
                [rng.choice("abcdefghij") for _ in range(4000)]])


def brute_runs(doc, text):
    w = (text or "").encode().split()
    w = [x.decode() for x in w]
    n, h = len(w), zlib.crc32(str(doc).encode()) if doc is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    drop = {i for a, m, q in runs for i in range(a + q, a + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{a},{m},{q}\n" for a, m, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in drop)))


def as_rows(rows):
    return sorted((str(r[0]), *map(str, r[1:])) for r in rows)


def test_periodic_query(docs, rows, tmp_path, spark):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = catalog.op11_periodic_runs(spark, str(tmp_path)).collect()
    assert as_rows(got) == as_rows((r[0], *brute_runs(r[0], r[1])) for r in rows)
    data = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(150).collect()
    spark.createDataFrame(data).write.parquet(f"{tmp_path}/more/documents.parquet")
    got = catalog.op11_periodic_runs(spark, f"{tmp_path}/more").collect()
    assert as_rows(got) == as_rows((r[0], *brute_runs(r[0], r[1])) for r in data)
    assert sum(r.n_runs for r in got) > 0


def plain_best_fit(lengths, capacity):
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(room) if r >= n]
        if fits:
            room[min(fits)[1]] -= n
        else:
            room.append(capacity - n)
    return Counter(room)


def blocks_of(plan, counts):
    """Pieces of each block by the plan, as the query looks them up."""
    steps, blocks = {}, {}
    for length, number, each, first, offset in plan:
        steps.setdefault(length, []).append((number, each, first, offset))
    for length, total in counts.items():
        own = sorted(steps[length])
        assert own[0][0] == 0
        for number in range(total):
            at, each, first, offset = [s for s in own if s[0] <= number][-1]
            past = number - at
            blocks.setdefault(first + past // each, []).append((offset + past % each * length, length))
    return blocks


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 40).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=80))))
def test_best_fit_decreasing(case):
    capacity, lengths = case
    blocks = blocks_of(packing.best_fit_decreasing(dict(Counter(lengths)), capacity), Counter(lengths))
    for own in blocks.values():
        place = 0
        for offset, length in sorted(own):
            assert offset == place
            place += length
        assert place <= capacity
    left = Counter(capacity - sum(n for _, n in own) for own in blocks.values())
    assert left == plain_best_fit(lengths, capacity)


def test_plan_is_small_for_many_pieces():
    rng = np.random.default_rng(2)
    counts = {n: int(rng.integers(1, 10 ** 12)) for n in range(1, 4097)}
    plan = packing.best_fit_decreasing(counts, 4096)
    assert len(plan) < 4 * 4096 * 12
    taken = Counter()
    for length, number, *_ in plan:
        taken[length] = max(taken[length], number)
    assert all(taken[n] < counts[n] for n in counts)


def test_room():
    room, some = packing.Room(100), set()
    rng = random.Random(1)
    for _ in range(3000):
        n = rng.randint(0, 100)
        some ^= {n}
        room.set(n, n in some)
        least = rng.randint(0, 100)
        assert room.tightest(least) == min((x for x in some if x >= least), default=-1)


@pytest.mark.parametrize("remembered", [packing.REMEMBERED, 3])
def test_tokens_equal_the_library(rows, monkeypatch, remembered):
    from tokenizers import Tokenizer
    monkeypatch.setattr(packing, "REMEMBERED", remembered)
    library = Tokenizer.from_file(packing.TOKENIZER)
    texts = [r[1] for r in rows] + ["it's 'S can't!! (a),b x...y 3.14 <|endoftext|> <|ENDOFTEXT|>a ΑΣ. İ ß",
                                    "tab\tnb sp x ́y\x1ez á .'s ,'ll Word? WORD?!", "A.B. e.g. U.S.A.'s"]
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    w = packing.Words(packing.TOKENIZER)
    for _ in range(2):
        assert [np.frombuffer(b, "<u4").tolist() for b in w.encode(texts)] == want


def check_packed(got, texts, capacity):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(packing.TOKENIZER)
    want = []
    for doc, text in texts:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, lo in enumerate(range(0, len(ids), capacity)):
            own = ids[lo:lo + capacity]
            want.append((doc, piece, lo, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    assert as_rows((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == as_rows(want)
    blocks = {}
    for r in got:
        blocks.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in blocks.values():
        place = 0
        for offset, length in sorted(own):
            assert offset == place
            place += length
        assert place <= capacity
    assert len(blocks) == sum(plain_best_fit([w[3] for w in want], capacity).values())


def test_packing_query(spark):
    texts = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check_packed(catalog.op12_best_fit_packing(spark, SF).collect(), texts, 4096)


def test_packing_hard_rows(docs, rows):
    from pyspark.sql import functions as F
    got = packing.pack(docs.repartition(5), capacity=64).withColumn("ids_crc32", F.crc32("ids")).collect()
    check_packed(got, [(r[0], r[1]) for r in rows], 64)


def brute_ranks(docs, items, k=10):
    held = [(d, Counter(TERM.findall((t or "").translate(UPPER)))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    total, n_docs = sum(sum(c.values()) for _, c in held), len(held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(TERM.findall((text or "").translate(UPPER)))
    out = []
    for item, terms in asked.items():
        scores = []
        for d, c in held:
            m = 10 + 90 * sum(c.values()) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if score:
                scores.append((-score, d is not None, d or 0, d))
        out += [(item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return as_rows(out)


@pytest.mark.parametrize("first,in_task", [(1000, 200_000), (1, 0)])
def test_ranked_hard_rows(spark, docs, rows, first, in_task, monkeypatch):
    """Also with many small rounds, and with terms selected by the join alone."""
    monkeypatch.setattr(ranked, "FIRST", first)
    monkeypatch.setattr(ranked, "IN_TASK", in_task)
    monkeypatch.setattr(ranked, "GROWTH", 2)
    texts = [r[1] for r in rows]
    items = [(1, texts[6][:200]), (2, "nothing-of this"), (3, None), (4, ""), (5, "bra BRA cto! bra"), (5, "dmi"),
             (None, texts[9][:300]), (None, "one"), (6, "one two words 日本語 1234 X"), (7, texts[17][:4000])]
    data = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, term string")
    got = ranked.top_documents(docs.withColumn("term", docs.text), data).collect()
    assert as_rows(got) == brute_ranks([(r[0], r[1]) for r in rows], items)


def test_ranked_ties_and_empty(spark, no_docs):
    texts = [(i, "alpha beta") for i in range(30, 0, -1)] + [(100 + i, f"alpha gamma g{i}") for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha beta"), (2, "gamma"), (3, "g7 zeta")], "item_id long, text string")
    assert as_rows(ranked.top_documents(docs, items).collect()) == brute_ranks(
        texts, [(1, "alpha beta"), (2, "gamma"), (3, "g7 zeta")])
    assert ranked.top_documents(no_docs, items).count() == 0
    assert ranked.top_documents(docs, items.limit(0)).count() == 0


@pytest.mark.parametrize("work", [periodic.periodic_runs, packing.pack])
def test_empty_table(no_docs, work):
    assert work(no_docs).count() == 0
