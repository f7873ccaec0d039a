"""Corpus operators against brute force, on small hard cases and on given tables."""

import hashlib
import io
import re
import zipfile
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from compare import connect, differences
from duskwatch.llm import (bpe, catalog, common, imatch, jaccard, langid, linededup, mixing, quality,
                           rules, substrings, warc)
from duskwatch.llm.common import components

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


@pytest.fixture(scope="module")
def con(sf_small):
    return connect(sf_small)


@pytest.mark.parametrize("name", list(catalog.ORACLE))
def test_statement(spark, con, sf_small, name):
    assert differences(catalog.QUERIES[name](spark, sf_small), con, catalog.ORACLE[name]) == []


@pytest.mark.parametrize("work", [
    imatch.edited_fingerprints, mixing.mix_sizes, rules.quality_rules, bpe.round_trip,
    lambda d: langid.predict(d, langid.fit(d)), linededup.line_dedup, substrings.cut_repeated,
    jaccard.near_duplicates, jaccard.one_per_component, mixing.mixed_documents])
def test_empty_table(no_docs, work):
    assert work(no_docs).count() == 0


def test_fingerprints(docs, rows):
    got = imatch.edited_fingerprints(docs).collect()
    assert len(got) == len(rows)
    text_of = sorted(((-1, "") if r[0] is None else (r[0], "") for r in rows))
    by_id = {r.doc_id: r for r in got}
    assert by_id[6].fingerprint == by_id[7].fingerprint == by_id[40].fingerprint
    assert by_id[0].n_chars == 0 and set(by_id[0].fingerprint) == {"-"} and len(text_of) == len(rows)
    ordered = {r[0]: r[1] or "" for r in rows if r[0] is not None and r[0] not in (6, 40, 41, None)}
    for a in (8, 9, 10, 11, 17):
        n, nxt = len(ordered[a]), ordered[a + 1]
        edited = ordered[a][:n - n // 4] + nxt[:n // 4]
        assert by_id[a].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_mix(docs, rows):
    got = mixing.mix_sizes(docs).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted(
        (r[0] is None, r[0] or 0, len(words(r[1]))) for r in rows)
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    for key in {(r.source_size, r.target) for r in got}:
        assert abs(sum(r.taken for r in got if (r.source_size, r.target) == key) - key[1]) <= 128
    assert sorted(map(str, mixing.mix_sizes(docs).collect())) == sorted(map(str, got))
    total = sum(len(words(r[1])) for r in rows)
    assert sum(t for _, t in {(r.source_size, r.target) for r in got}) == pytest.approx(1.5 * total)


def test_permutation_is_one():
    for n in (1, 2, 3, 17, 1000):
        out = mixing.permuted(np.arange(n), np.full(n, n), np.full(n, 7))
        assert sorted(out.tolist()) == list(range(n))


def _repeat_words(w, width=8):
    at = Counter(tuple(w[i:i + width]) for i in range(len(w) - width + 1))
    return len({j for i in range(len(w) - width + 1) if at[tuple(w[i:i + width])] > 1
                for j in range(i, i + width)})


def test_base_rules(docs, rows):
    got = rules.quality_rules(docs).collect()
    want = []
    for r in rows:
        t, w = r[1] or "", words(r[1])
        lines = [x for x in t.split("\n") if words(x)]
        rep = _repeat_words(w)
        want.append((str(r[0]), len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"),
                     len(lines) - len(set(lines)), rep, len(w) < 20 or 100 * rep > 30 * len(w)))
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                   r.n_repeat_words, r.base_failed) for r in got) == sorted(want)
    assert not any(r.kept for r in got if r.base_failed)


def test_outliers_leave_clean_documents(spark, sf_small):
    got = rules.quality_rules(spark.read.parquet(f"{sf_small}/documents.parquet"))
    marked = got.join(spark.read.parquet(f"{sf_small}/labels.parquet"), "doc_id").where("not base_failed")
    assert marked.where("quality = 1 and not kept").count() == 0


def _plain(rng, n=200):
    """Lines of ten words each, a few of them with a capital or a mark."""
    w = ["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(2, 9))) for _ in range(n)]
    w = [x.capitalize() if rng.random() < 0.1 else x + "!" if rng.random() < 0.02 else x for x in w]
    return [" ".join(w[i:i + 10]) for i in range(0, n, 10)]


def test_each_statistic_rejects(spark):
    rng = np.random.default_rng(8)
    texts = [_plain(rng, int(rng.integers(15, 26)) * 10) for _ in range(300)]
    n = len(texts)
    per_word = lambda f: [" ".join(map(f, x.split(" "))) for x in _plain(rng)]
    repeated = _plain(rng, 1000)
    texts += [per_word(lambda w: w * 3), per_word(lambda w: w + "#" if rng.random() < 0.5 else w),
              [y for x in _plain(rng) for y in (x, "ok", "so")],
              [*repeated, " ".join(repeated[:14])],
              per_word(str.upper), per_word(lambda w: w + "?!")]
    docs = spark.createDataFrame([(i, "\n".join(t), "en", "s") for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in rules.quality_rules(docs).collect()}
    assert not any(r.base_failed for r in got.values())
    assert [k for k in range(n, n + 6) if got[k].kept] == []
    assert sum(not got[k].kept for k in range(n)) <= 3


def test_a_third_of_copies_is_no_centre(spark):
    rng = np.random.default_rng(9)
    junk = "\n".join(x.upper() + " ###" for x in _plain(rng))
    texts = ["\n".join(_plain(rng)) for _ in range(200)] + [junk] * 100
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in rules.quality_rules(docs).collect()}
    assert not any(got[k].kept for k in range(200, 300))
    assert sum(not got[k].kept for k in range(200)) <= 2


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = (catalog.op4_quality_classifier(spark, sf).where("held_out")
           .join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect())
    assert np.mean([r.predicted == r.quality for r in got]) > 0.9


def test_quality_without_labels(spark, docs, rows):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.quality_scores(docs, none, langid.held_out(5, 0)).collect()
    assert len(got) == len(rows) and {r.score for r in got} == {0.5}


def test_isotonic():
    assert quality.pool(np.array([1, 0, 3]), np.array([2, 2, 4])).tolist() == [0.25, 0.25, 0.75]


def test_pieces_match_library_and_decode(rows):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=bpe.DEFAULT_MODEL)
    p = bpe.pieces(bpe.DEFAULT_MODEL)
    for text in {r[1] or "" for r in rows}:
        if "▁" not in text:
            assert p.encode(text).tolist() == model.encode(text)
        for seed in (1, 2):
            assert p.decode(p.encode(text, 5, seed, 0.3).tolist()) == text
    long = rows[17][1]
    assert p.encode(long, 5, 1, 0.1).tolist() != p.encode(long, 5, 2, 0.1).tolist()
    coins = bytes(range(0, 256, 4))
    for word in set(words(long)):
        assert p._merge_short(word, coins, 60) == p._merge_long(word, coins, 60)


def test_dropout_cuts_every_occurrence_on_its_own():
    p = bpe.Pieces(bpe.DEFAULT_MODEL)
    cuts = Counter(p.encode("government", d, 3, 0.1).tobytes() for d in range(4000))
    whole = p.encode("government").tobytes()
    assert len(cuts) > 20 and cuts.most_common(1)[0][0] == whole
    coins = (np.random.default_rng(1).random((4000, 99)) >= 0.1).astype(np.uint8)
    want = Counter(p._ids(p._merge_short(" government", bytes(c), 1)) for c in coins)
    assert all(abs(cuts[k] - want[k]) < 160 for k in cuts | want)
    within = {p.encode("government " * 200, 1, 3, 0.1)[i:i + 3].tobytes() for i in range(200)}
    assert len(within) > 10
    gaps, text = bpe.Gaps(0.3), "government"
    for key in range(300):             # the remembered tree, a plain run and the heap agree
        coins = [c for c, _ in zip(gaps.coins(key), range(99))]
        plain = p._merge_short(text, bytes(coins), 1)
        assert plain == p._merge_long(text, coins, 1)
        assert p._walk(text, *p._node(text), gaps.after(key, 0)) == p._ids(plain)


def test_dropout_in_a_long_segment_does_not_repeat():
    p, gaps = bpe.pieces(bpe.DEFAULT_MODEL), bpe.Gaps(0.1)
    coins = np.array([c for c, _ in zip(gaps.coins(7), range(40000))])
    assert abs(1 - coins.mean() - 0.1) < 0.01
    for lag in (8, 64, 128):
        assert abs(np.corrcoef(coins[:-lag], coins[lag:])[0, 1]) < 0.03
    text = "abcdefgh" * 400
    ids = p.encode(text, 5, 1, 0.3).tolist()
    assert p.decode(ids) == text and ids != p.encode(text, 6, 1, 0.3).tolist()
    assert ids == bpe.Pieces(bpe.DEFAULT_MODEL).encode(text, 5, 1, 0.3).tolist()


@pytest.mark.parametrize("remembered", [bpe.REMEMBERED, 3])
def test_texts_at_once_equal_one_by_one(rows, remembered, monkeypatch):
    """Many texts are merged side by side, not segment by segment; ids and draws stay."""
    texts = [r[1] or "" for r in rows] + ["x\ny  z \n\n q", "a▁b", "漢字" * 40 + " 𐍈𐍈 漢字 ab\U0001f642cd", ""]
    names = ["" if r[0] is None else r[0] for r in rows] + [7, 8, 9, 10]
    plain, p = bpe.pieces(bpe.DEFAULT_MODEL), bpe.Pieces(bpe.DEFAULT_MODEL)
    cases = [(seed, dropout) for seed in (0, 11) for dropout in (0.0, 1e-9, 0.1, 0.5, 1.0)]
    want = [[plain.encode(t, d, *c).tolist() for t, d in zip(texts, names)] for c in cases]
    monkeypatch.setattr(bpe, "REMEMBERED", remembered)
    monkeypatch.setattr(bpe, "TOGETHER", 3000)
    monkeypatch.setattr(bpe, "COLUMNS", 50)
    monkeypatch.setattr(bpe.Pieces, "_merge_short", None)
    for c, ids in zip(cases, want):
        assert [x.tolist() for x in p.encode_all(texts, names, *c)] == ids


def test_round_trip(docs, rows):
    got = bpe.round_trip(docs).collect()
    assert len(got) == len(rows) and all(r.lossless for r in got)
    back = bpe.decode(bpe.encode(docs)).collect()
    assert sorted(r.text for r in back) == sorted(r[1] or "" for r in rows)


def test_language(spark, docs, rows):
    sf = "/root/testdata/sf0.01"
    got = (catalog.op6_language_id(spark, sf).where("held_out")
           .join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect())
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.98
    hard = langid.predict(docs, langid.fit(docs)).collect()
    none = [r[0] for r in rows if not any(c.isalpha() for c in r[1] or "")]
    assert sorted(r.doc_id for r in hard if r.lang_pred == "und") == sorted(none)
    for k in (2, 4, 9):
        code = langid.codewords(k)
        assert len({tuple(c) for c in code}) == k


def test_lines(docs, rows):
    keys = lambda t: [x.strip(" \t\n\x0b\f\r").translate(LOWER) for x in (t or "").split("\n")]
    holders = {}
    for r in rows:
        for k in keys(r[1]):
            if len(k) >= 20:
                holders.setdefault(k, set()).add(-1 if r[0] is None else r[0])
    want = []
    for r in rows:
        own, lines = -1 if r[0] is None else r[0], (r[1] or "").split("\n")
        kept = [x for x, k in zip(lines, keys(r[1])) if len(holders.get(k, ())) < 3 or own == max(holders[k])]
        want.append((str(r[0]), len(lines), len(lines) - len(kept), "\n".join(kept)))
    got = linededup.line_dedup(docs).collect()
    assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept_text) for r in got) == sorted(want)


@pytest.mark.parametrize("group", [substrings.GROUP, 1])
def test_substrings(docs, rows, group, monkeypatch):
    monkeypatch.setattr(substrings, "GROUP", group)
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    at = Counter(b[i:i + 400] for _, b in texts for i in range(len(b) - 399))
    want = []
    for doc, b in texts:
        hit = {j for i in range(len(b) - 399) if at[b[i:i + 400]] > 1 for j in range(i, i + 400)}
        want.append((str(doc), len(b), bytes(x for j, x in enumerate(b) if j not in hit),
                     sum(j - 1 not in hit for j in hit)))
    got = substrings.cut_repeated(docs).collect()
    assert sorted((str(r.doc_id), r.n_bytes, bytes(r.kept), len(r.spans)) for r in got) == sorted(want)


def test_near_duplicates(docs, rows):
    sets = []
    for r in rows:
        w = words((r[1] or "").translate(LOWER))
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    ids, parent = [-1 if r[0] is None else r[0] for r in rows], list(range(len(rows)))

    def find(i):
        return i if parent[i] == i else find(parent[i])

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i in range(len(rows)):
        least[find(i)] = min(ids[i], least.get(find(i), ids[i]))
    name = lambda x: None if x == -1 else x
    want = sorted(str((name(ids[i]), len(sets[i]), name(least[find(i)]))) for i in range(len(rows)))
    got = jaccard.near_duplicates(docs).collect()
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in got) == want
    kept = jaccard.one_per_component(docs)
    assert kept.columns == docs.columns and kept.where("doc_id in (6, 7, 8, 40)").count() == 1


def test_rounds_look_again_only_at_parts_left_open(spark, monkeypatch):
    """Texts just below the similarity share parts and pass the sketch; none is linked."""
    base = [f"w{i}" for i in range(400)]
    texts = [" ".join(base[:x] + [f"v{x}n{i}" for i in range(25)] + base[x + 25:]) for x in range(5, 360, 30)]
    looked, across = [], jaccard._across
    monkeypatch.setattr(jaccard, "_across", lambda at, *a: looked.append(at.count()) or across(at, *a))
    docs = spark.createDataFrame(list(enumerate([*texts, texts[0] + " end"])), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs).collect()}
    assert got == {i: i for i in range(len(texts))} | {len(texts): 0}
    assert len(looked) == 3 and 0 < looked[2] < looked[1]


def test_components_of_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert all(got[i] == 0 for i in range(1, 31)) and all(got[i] == 100 for i in range(101, 130))


def test_few_edges_need_no_rounds(spark, monkeypatch):
    """Under CHUNK edges one task makes the stars, however many tasks they came from."""
    monkeypatch.setattr(common, "_is_forest", None)
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long").repartition(20)
    assert dict(components(edges).collect()) == {i: 0 for i in range(1, 41)}


@pytest.mark.parametrize("chunk", [3, 1 << 20])
def test_components_of_random_edges(spark, chunk, monkeypatch):
    monkeypatch.setattr(common, "CHUNK", chunk)
    rng = np.random.default_rng(5)
    edges = rng.integers(0, 400, (250, 2)).tolist() + [(i * 7919 % 1009 + 1000, (i + 1) * 7919 % 1009 + 1000)
                                                       for i in range(200)]
    low = {x: x for e in edges for x in e}
    for _ in low:
        for a, b in edges:
            low[a] = low[b] = min(low[a], low[b])
    got = components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()
    assert sorted(map(tuple, got)) == sorted((x, y) for x, y in low.items() if x != y)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_packages(spark, tmp_path):
    big = "<p>é</p>" * 300
    pages = spark.createDataFrame(
        [(1, "u", None), (2, "u\r\nx", ""), (3, None, big), (5, "u", big), (5, "v", big), (None, "u", big),
         (7, "u", "small"), (8, "u", "small"), (9, "u", "x" * 70000)],
        "page_id long, url string, html string").withColumnsRenamed({}).repartition(2)
    folder = f"file://{tmp_path}/w"
    manifest = warc.write_packages(pages, folder)
    got = warc.with_referred_page(warc.read_packages(manifest, folder)).collect()
    assert sorted((str(r.page_id), r.record_type, str(r.refers_to), r.payload_bytes) for r in got) == sorted([
        ("1", "response", "None", 0), ("2", "response", "None", 0), ("3", "revisit", "5", 2700),
        ("5", "response", "None", 2700), ("5", "response", "None", 2700), ("None", "revisit", "5", 2700),
        ("7", "response", "None", 5), ("8", "response", "None", 5), ("9", "response", "None", 70000)])
    assert all(r.payload_digest == hashlib.sha1(r.payload).hexdigest() for r in got if r.payload is not None)
    assert warc.read_packages(manifest.limit(0), folder).count() == 0
    for path in (tmp_path / "w").iterdir():
        assert zipfile.ZipFile(path).testzip() is None


def test_zip64_and_compressed_members():
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        with z.open("archive/a", "w", force_zip64=True) as f:
            f.write(b"abc")
        z.writestr("archive/b", b"x" * 99, compress_type=zipfile.ZIP_DEFLATED)
    method, start, size = warc.members(raw, raw.getbuffer().nbytes)["archive/a"]
    assert (method, raw.getvalue()[start:start + size]) == (0, b"abc")
    with pytest.raises(ValueError, match="ranges"):
        list(warc.record_ranges(raw, raw.getbuffer().nbytes))


def test_pipeline(spark, docs, tmp_path):
    (docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet"))
    at = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, str(tmp_path))
        assert at.columns == docs.columns
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert got and all(r.lossless for r in got)
    assert sum(r.doc_id in (6, 7, 8, 40) for r in got) == 1
