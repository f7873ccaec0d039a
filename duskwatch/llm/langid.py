"""Language identification by error-correcting output codes.

Every language gets a codeword of bits.  One binary classifier per bit reads hashed letter
trigrams of the text and gives a margin; decoding adds up a loss of each margin against
each codeword and takes the codeword with the least loss.  A text whose best codewords
are nearly equal in loss is flagged ambiguous.

Training reads a bounded sample: ``per_language`` documents of each language at most (in
expectation), chosen by a hash of the document.  Trigram counts are summed by Spark; the
driver gets languages x ``DIMS`` counts, whatever the number of documents.

Cases.  Null text or text without a letter: ``und``, score 0, not ambiguous.  Null
languages teach nothing.  With one language all texts with letters get it; with none, all
texts get ``und``.  Repeated rows are predicted alike.  Empty table: empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np
from pyspark.sql import DataFrame, functions as F

from duskwatch.llm.common import by_slices

UNKNOWN = "und"
DIMS = 1 << 15
SMOOTHING = 0.5
# Margins are mean log-odds per trigram times this; losses saturate beyond LIMIT.
SCALE, LIMIT = 12.0, 12.0
# Most languages with exhaustive codes; more get random codewords.
EXHAUSTIVE = 7

# Letters stay, all other ASCII becomes a space; bytes of longer characters stay.
_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def trigrams(text: str) -> np.ndarray:
    """Hashed byte trigrams of the lower-cased letters of a text, spaces at both ends."""
    raw = b" ".join((" " + text.lower() + " ").encode("utf-8", "replace").translate(_LETTERS).split())
    b = np.frombuffer(b" " + raw + b" ", np.uint8).astype(np.uint32)
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return (code * np.uint32(2654435761)) >> np.uint32(17)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def codewords(k: int, seed: int = 5) -> np.ndarray:
    """(k, bits) of +1/-1.  All two-way splits for few languages, else random rows.

    Random codes: the one of 50 draws whose closest pair of rows is farthest apart.
    """
    if k < 2:
        return np.ones((k, 1))
    if k <= EXHAUSTIVE:
        rest = [c for c in product((1, -1), repeat=k - 1) if -1 in c]
        return np.array([(1,) * len(rest), *zip(*rest)], float)
    rng, bits = np.random.default_rng(seed), int(np.ceil(10 * np.log2(k)))
    best, apart = None, -1
    for _ in range(50):
        m = rng.choice((-1.0, 1.0), (k, bits))
        near = ((bits - m @ m.T) / 2 + bits * np.eye(k)).min()
        split = (abs(m.sum(0)) < k).all()
        if split and near > apart:
            best, apart = m, near
    return best


@dataclass(frozen=True)
class LanguageModel:
    languages: list
    code: np.ndarray      # (languages, bits)
    weights: np.ndarray   # (DIMS, bits) log-odds of a trigram

    def decode(self, text: str) -> tuple[str, float, bool]:
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, False
        margins = np.clip(SCALE * self.weights[trigrams(text)].mean(0), -LIMIT, LIMIT)
        loss = np.logaddexp(0, -self.code * margins).sum(1)
        chance = np.exp(loss.min() - loss)
        chance /= chance.sum()
        order = np.argsort(loss, kind="stable")
        unsure = len(order) > 1 and chance[order[0]] < 2 * chance[order[1]]
        return self.languages[order[0]], float(chance[order[0]]), bool(unsure)


def fit(labelled: DataFrame, per_language: int = 4000) -> LanguageModel:
    """Learn from rows (doc_id, text, lang) with a language."""
    labelled = labelled.where("lang is not null and text is not null")
    sizes = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], codewords(0), np.zeros((DIMS, 1), np.float32))
    whole = 1 << 30
    limit = F.create_map(*[F.lit(x) for name in languages
                           for x in (name, min(whole, whole * per_language // sizes[name]))])
    sample = labelled.where(F.pmod(F.xxhash64(F.lit("langid"), "doc_id", "text"), F.lit(whole))
                            < limit[F.col("lang")])

    def count(rows: dict) -> dict:
        out = {"lang": [], "gram": [], "n": []}
        for text, lang in zip(rows["text"], rows["lang"]):
            if has_letter(text):
                gram, n = np.unique(trigrams(text), return_counts=True)
                out["lang"] += [lang] * len(gram)
                out["gram"] += gram.tolist()
                out["n"] += n.tolist()
        return out

    sums = (by_slices(sample.select("text", "lang"), count, "lang string, gram int, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas())
    counts = np.full((len(languages), DIMS), SMOOTHING)
    counts[sums["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(int),
           sums["gram"].to_numpy(int)] += sums["n"].to_numpy()
    share = counts / counts.sum(1, keepdims=True)
    code = codewords(len(languages))
    weights = np.zeros((DIMS, code.shape[1]), np.float32)
    for bit in range(code.shape[1]):
        yes = code[:, bit] > 0
        if yes.any() and not yes.all():
            weights[:, bit] = np.log(share[yes].mean(0)) - np.log(share[~yes].mean(0))
    return LanguageModel(languages, code, weights)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score, ambiguous of every row; only the text is read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)   # languages and DIMS bound its size

    def work(rows: dict) -> dict:
        got = [shared.value.decode(t) for t in rows["text"]]
        return {"doc_id": rows["doc_id"], "lang_pred": [g[0] for g in got],
                "score": [g[1] for g in got], "ambiguous": [g[2] for g in got]}

    return by_slices(docs.select("doc_id", "text"), work,
                     "doc_id long, lang_pred string, score double, ambiguous boolean")


def with_known_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Drop rows without a recognisable or with an ambiguous language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(rows: dict) -> dict:
        got = [shared.value.decode(t) for t in rows["text"]]
        keep = [i for i, g in enumerate(got) if g[0] != UNKNOWN and not g[2]]
        return {c: [v[i] for i in keep] for c, v in rows.items()}

    return by_slices(docs, work, docs.schema)


def training_part(docs: DataFrame) -> DataFrame:
    """The part that queries learn from: crc32 of the id as text, mod 3, is not 1."""
    return docs.where(~held_out())


def held_out(parts: int = 3, rest: int = 1):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts == rest, F.lit(False))
