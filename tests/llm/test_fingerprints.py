"""Fingerprints and likenesses against plain Python, on either side of every size."""

import random
import re
from collections import Counter

import pytest
import xxhash

from duskwatch.llm import imatch

WORD = re.compile("[^\x20\x09-\x0d]+")
MASK = 2 ** 64 - 1


def terms(text):
    return sorted({xxhash.xxh64_intdigest(w.encode(), 42) for w in WORD.findall((text or "").lower())},
                  key=lambda h: h - 2 ** 64 if h >> 63 else h)


def level(h, families):
    bits = (h >> (families.bit_length() - 1)) & (2 ** 30 - 1) | 2 ** 30
    return (bits & -bits).bit_length() - 1


def codes(held, families):
    """{(level, part): code} of all subsets that hold a term."""
    out = {}
    for at in range(31):
        for k in range(families):
            mine = [h for h in held if h % families == k and level(h, families) >= at]
            if mine:
                seed = 42
                for h in mine:
                    seed = xxhash.xxh64_intdigest(h.to_bytes(8, "little"), seed)
                out[at, k] = f"{seed:016x}"[-imatch.DIGITS:].upper()
    return out


def shared(a, b, families):
    best = None
    for at in range(31):
        used = {k for x in (a, b) for (lv, k) in x if lv == at}
        if best is None or 2 * len(used) >= families:
            best = len(used), sum(a.get((at, k)) == b.get((at, k)) for k in used)
    return best


def plain_likeness(a, b):
    (used, same), (more, equal) = (shared(x, y, f) for x, y, f in zip(a, b, (imatch.FAMILIES, imatch.SPARE)))
    if not used + more:
        return 1.0
    return (same + equal / imatch.SPARE) / (used + more / imatch.SPARE)


def parsed(fingerprint):
    """The codes that stand in a fingerprint."""
    out = []
    for text, families in zip(fingerprint.split("/") + [""], (imatch.FAMILIES, imatch.SPARE)):
        got = [text[i:i + imatch.DIGITS] for i in range(0, len(text), imatch.DIGITS)]
        out.append({divmod(i, families): c for i, c in enumerate(got) if c != imatch.EMPTY})
    return out


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(3)
    vocabulary = [f"Wort{i}" for i in range(400)]
    out = [" ".join(draw.choices(vocabulary, k=draw.choice([1, 5, 9, 40, 200]))) for _ in range(60)]
    out += [None, "", " \n", out[0], out[5] + "  ", "the a " * 3, " ".join(f"rare{i}" for i in range(30)),
            " ".join(vocabulary) + " " + " ".join(f"long{i}" for i in range(3000)), "x" * 100_000]
    return out


def test_against_plain_python(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    low, high = 0.02, 0.3
    counts = Counter(h for t in texts for h in terms(t))
    band = {h for h, n in counts.items() if max(2, low * len(texts)) <= n <= high * len(texts)}
    assert 0 < len(band) < len(counts)
    assert {h & MASK for h in imatch.lexicon(docs, low, high)} == band

    def plain(text):
        held = terms(text)
        return (codes([h for h in held if h in band], imatch.FAMILIES),
                codes([h for h in held if h not in band], imatch.SPARE))

    want = [plain(t) for t in texts]
    for r in imatch.edited_fingerprints(docs, low, high).collect():
        text, after = texts[r.doc_id] or "", texts[(r.doc_id + 1) % len(texts)] or ""
        edited = plain(text[:len(text) - len(text) // 4] + after[:len(text) // 4])
        assert tuple(parsed(r.fingerprint)) == want[r.doc_id]
        assert tuple(parsed(r.edited_fingerprint)) == edited
        assert r.near_next == pytest.approx(plain_likeness(want[r.doc_id], want[(r.doc_id + 1) % len(texts)]))
        assert r.near_edited == pytest.approx(plain_likeness(want[r.doc_id], edited))


@pytest.mark.parametrize("inside", [0, 1, 4, 7, 8, 9, 30, 300])
def test_one_word_less_changes_little(spark, inside):
    """No number of lexicon terms at which taking one word away changes the likeness abruptly."""
    full = [f"in{i}" for i in range(inside)] + [f"out{i}" for i in range(40)]
    band = [xxhash.xxh64_intdigest(w.encode(), 42) for w in full[:inside]]
    band = [h - 2 ** 64 if h >> 63 else h for h in band]
    rows = [(" ".join(full), " ".join(full[:i] + full[i + 1:])) for i in range(len(full))]
    both = spark.createDataFrame(rows, "a string, b string")
    got = imatch.with_fingerprint(imatch.with_fingerprint(both, "a", "fa", band), "b", "fb", band)
    scores = [r[0] for r in got.select(imatch.likeness("fa", "fb")).collect()]
    assert sum(scores) / len(scores) >= 0.75 and min(scores) >= (0.3 if inside != 1 else 0.0)
