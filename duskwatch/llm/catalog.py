"""Queries over the corpus tables, one per operator, and their DuckDB statements."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from duskwatch.llm import (bpe, imatch, jaccard, langid, linededup, mixing, packing, periodic, quality,
                           ranked, rules, substrings, warc)
from duskwatch.llm.common import let, stored, table, text_of, words
from duskwatch.session import shared_dir


def op1_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.edited_fingerprints(table(spark, sf_dir, "documents"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = langid.held_out(5, 0)
    scores = quality.quality_scores(table(spark, sf_dir, "documents"),
                                    table(spark, sf_dir, "labels"), ~out)
    return scores.select("doc_id", out.alias("held_out"), "score", "predicted")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(langid.training_part(docs))
    return (langid.predict(docs, model)
            .select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "ambiguous"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = linededup.line_dedup(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines", "n_dropped",
                      F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.cut_repeated(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes",
                      (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/llm/warc-{uuid.uuid4().hex}"
    manifest = warc.write_packages(table(spark, sf_dir, "pages"), folder)
    records = stored(warc.read_packages(manifest, folder, payload=False).drop("payload", "url"), "records")
    return warc.with_referred_page(records).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document in ten is first made to repeat from a place on, as the contract says."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string"))
    own = words(text_of())
    n, g = F.size(own).cast("long"), F.floor(h / 10)
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    repeated = let(F.struct(own.alias("w"), a.alias("a"), p.alias("p")), lambda s: F.array_join(F.transform(
        s.w, lambda word, i: F.when(i < s.a, word).otherwise(
            F.get(s.w, (s.a + (i - s.a) % s.p).cast("int")))), " "))
    texts = docs.select("doc_id", F.when((h % 10 == 0) & (n > 0), repeated)
                        .otherwise(F.col("text")).alias("text"))
    # the longest run, the first of equal ones, then the shortest period
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n")
    found = periodic.periodic_runs(texts).withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"))
    packed = packing.placed(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_fingerprint, op2_source_mix, op3_quality_rules, op4_quality_classifier, op5_sentencepiece,
    op6_language_id, op7_line_dedup, op8_substring_dedup, op9_ngram_jaccard, op10_warc,
    op11_periodic_runs, op12_best_fit_packing, op13_ranked_search)}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# Fixed value: terms are runs of ASCII letters, digits and all characters beyond ASCII.
_TERM = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"

ORACLE = {
    "op7_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, u.i AS pos, parts[u.i] AS line FROM (
                SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
                unnest(range(1, len(parts) + 1)) AS u(i)),
        keyed AS (
            SELECT *, {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")}
                AS key FROM lines),
        repeated AS (
            SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20
            GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        marked AS (
            SELECT k.*, coalesce(k.doc_id <> r.last, false) AS dropped
            FROM keyed k LEFT JOIN repeated r USING (key))
        SELECT doc_id, count(*) AS n_lines,
            count(*) FILTER (WHERE dropped) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), ''))
                AS kept_sha256
        FROM marked GROUP BY doc_id""",
    "op10_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                sha1(coalesce(html, '')) AS payload_digest FROM pages),
        r AS (
            SELECT *, CASE WHEN payload_bytes >= 1000
                THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS largest FROM p)
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> largest THEN largest END AS refers_to
        FROM r""",
    "op13_ranked_search": f"""
        WITH terms AS (
            SELECT doc_id, {_LOWER.format("unnest(regexp_extract_all(text, " + _TERM + "))")} AS term FROM documents),
        asked AS (
            SELECT DISTINCT item_id, {_LOWER.format("unnest(regexp_extract_all(text, " + _TERM + "))")} AS term
            FROM benchmark),
        lengths AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
        size AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM lengths),
        held AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term),
        weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM held, size GROUP BY term, docs),
        scored AS (
            SELECT a.item_id, h.doc_id, CAST(sum(w * ((1000000000 * tf)
                // (1000 * tf + 8 * (10 + (90 * n * docs) // total)))) AS BIGINT) AS score
            FROM asked a JOIN held h USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), size
            GROUP BY a.item_id, h.doc_id),
        numbered AS (
            SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER)
                AS rank, doc_id, score FROM scored WHERE score > 0)
        SELECT * FROM numbered WHERE rank <= 10""",
}
