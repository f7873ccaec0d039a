"""Clashing column names, packages with several members, keys that many rows lack."""

import gzip
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from duskwatch.llm import linededup, mixing, warc


def clashing(docs):
    return docs.withColumns({n: F.lit("mine") for n in (
        "n_lines", "n_dropped", "kept_text", "row", "parts", "parts_", "text_hash", "drops", "mask", "lines")})


def test_lines_beside_any_column(docs):
    want = linededup.line_dedup(docs).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
    got = linededup.line_dedup(clashing(docs)).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert sorted(map(str, got)) == sorted(map(str, want))
    cut = linededup.unique_lines(clashing(docs))
    assert cut.columns == clashing(docs).columns
    assert {r.n_lines for r in cut.collect()} == {"mine"}
    kept = sorted((str(r.doc_id), r.kept_text) for r in want)
    assert sorted((str(r.doc_id), r.text or "") for r in cut.collect()) == kept


def test_mix_beside_any_column(docs):
    want = mixing.mixed_documents(docs).select("doc_id", "text").collect()
    got = mixing.mixed_documents(clashing(docs))
    assert got.columns == clashing(docs).columns
    assert {r.parts for r in got.select("parts").collect()} == {"mine"}
    assert sorted(map(str, got.select("doc_id", "text").collect())) == sorted(map(str, want))


def _package(compress, names, with_names=True):
    """Records per data member, one index for all of them."""
    raw, lines, want = io.BytesIO(), [], {}
    with zipfile.ZipFile(raw, "w") as z:
        for name, n in names:
            at, data = 0, b""
            for i in range(n):
                record = f"{name} {i} ".encode() * (i + 3)
                packed = gzip.compress(record)
                entry = {"offset": at, "length": len(packed)}
                lines.append(json.dumps(entry | ({"filename": name} if with_names else {})))
                data, at = data + packed, at + len(packed)
                want.setdefault(name, []).append(record)
            z.writestr(f"archive/{name}", data)
        z.writestr("indexes/index.cdxj", "".join(f"com,x)/ 2024 {x}\n" for x in lines), compress_type=compress)
    return raw, [r for records in want.values() for r in records]


@pytest.mark.parametrize("compress", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED])
@pytest.mark.parametrize("names", [[("a.warc.gz", 4)], [("a.warc.gz", 3), ("b.warc.gz", 5)]])
def test_members_and_indexes(compress, names):
    raw, want = _package(compress, names)
    got = []
    for start, lengths, n in warc.record_ranges(raw, raw.getbuffer().nbytes):
        assert lengths is not None
        got += list(warc._records(warc._range(raw, start, n), lengths))
    assert got == want


def test_entries_without_a_member():
    raw, want = _package(zipfile.ZIP_STORED, [("a.warc.gz", 4)], with_names=False)
    runs = list(warc.record_ranges(raw, raw.getbuffer().nbytes))
    assert [r for s, x, n in runs for r in warc._records(warc._range(raw, s, n), x)] == want
    raw, _ = _package(zipfile.ZIP_STORED, [("a.warc.gz", 1), ("b.warc.gz", 1)], with_names=False)
    with pytest.raises(ValueError, match="no data member"):
        list(warc.record_ranges(raw, raw.getbuffer().nbytes))


def test_no_pages(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    folder = f"file://{tmp_path}/w"
    manifest = warc.write_packages(none, folder)
    assert warc.with_referred_page(warc.read_packages(manifest, folder)).count() == 0


def test_responses_are_no_join_key(spark):
    columns = "page_id long, record_id string, record_type string, refers_to_id string"
    records = spark.createDataFrame(
        [(i, f"r{i}", "response", None) for i in range(50)] + [(90 + i, f"v{i}", "revisit", "r7") for i in range(5)],
        columns)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = warc.with_referred_page(records)
        rows = got.collect()
        assert "isnotnull(refers_to_id" in got._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted((r.page_id, r.refers_to) for r in rows if r.refers_to is not None) == [(90 + i, 7) for i in range(5)]
    assert len(rows) == 55
