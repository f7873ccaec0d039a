"""Cleaning rules on edge values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from duskwatch.functions import cleaning as c
from duskwatch.functions.text import given, outer_fences, strip_fences
from duskwatch.operators.clean import stable_id

AS_OF = dt.datetime(2030, 1, 1)


def apply(spark, rule, values, kind="string"):
    rows = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    made = rule(F.col("x"))
    pair = made if isinstance(made, c.Cleaned) else c.Cleaned(made, F.lit(None).cast("string"))
    return [(r[0], r[1]) for r in rows.select(pair.value, pair.warning).collect()]


@pytest.mark.parametrize("text,value,warning", [
    ("", AS_OF, "missing timestamp"), (None, AS_OF, "missing timestamp"),
    ("nope", AS_OF, "unparseable timestamp 'nope'"),
    ("2026-02-08 09:15:32", dt.datetime(2026, 2, 8, 9, 15, 32), "has no timezone"),
    ("2026-02-08T09:15:32-05:00", dt.datetime(2026, 2, 8, 14, 15, 32), None),
    ("2026-02-08T09:15:32.142Z", dt.datetime(2026, 2, 8, 9, 15, 32, 142000), None),
    ("2026/02/08 09:15:32", dt.datetime(2026, 2, 8, 9, 15, 32), "has no timezone"),
    ("08/Feb/2026:09:15:32 +0100", dt.datetime(2026, 2, 8, 8, 15, 32), None),
    ("20260208T091532", dt.datetime(2026, 2, 8, 9, 15, 32), "has no timezone"),
])
def test_timestamp(spark, text, value, warning):
    [(got, said)] = apply(spark, lambda x: c.clean_timestamp(x, F.lit(AS_OF)), [text])
    assert got == value
    assert (warning in said) if warning else said is None


def test_optional_timestamp_is_silent_when_absent(spark):
    got = apply(spark, lambda x: c.clean_optional_timestamp(x, F.lit(AS_OF)), [None, "", "nope"])
    assert got[:2] == [(None, None)] * 2 and got[2][0] == AS_OF and got[2][1]


def test_ip(spark):
    good = {"192.168.1.1:4444": "192.168.1.1", "1.2.3.4": "1.2.3.4", "0.0.0.0": "0.0.0.0"}
    for text, want in good.items():
        assert apply(spark, lambda x: c.clean_ip(x, "source_ip"), [text]) == [(want, None)]
    bad = ["01.2.3.4", "1.2.3.4.", "256.1.1.1", " 1.2.3.4", "::1", "::ffff:1.2.3.4", "[::1]",
           "1.2.3.4\n", "1.2.3"]
    for value, warning in apply(spark, lambda x: c.clean_ip(x, "source_ip"), bad):
        assert value is None and warning.startswith("invalid IP in source_ip")
    assert apply(spark, lambda x: c.clean_ip(x, "f"), ["::1"]) == [
        (None, "invalid IP in f: '' — set to null")]
    assert apply(spark, lambda x: c.clean_ip(x, "f"), ["", None]) == [(None, None)] * 2


def test_domain(spark):
    got = apply(spark, c.clean_domain, [" Docs.Google.COM\t", "a b", "x" * 254, "  ", "", None,
                                        "x" * 253])
    assert [v for v, _ in got] == ["docs.google.com", None, None, "", None, None, "x" * 253]
    assert [bool(w) for _, w in got] == [False, True, True, False, False, False, False]


def test_port(spark):
    got = apply(spark, c.clean_port, [0, 65535, -1, 65536, None], "bigint")
    assert got == [(0, None), (65535, None), (None, "invalid port -1 — set to null"),
                   (None, "invalid port 65536 — set to null"), (None, None)]


def test_severity_and_action(spark):
    got = apply(spark, c.clean_severity, [" Crit ", "med", None, "bogus", "  ", ""])
    assert [v for v, _ in got] == ["CRITICAL", "MEDIUM", "INFO", "INFO", "INFO", "INFO"]
    assert [(w or "").split(" ")[0] for _, w in got] == ["", "", "missing", "unknown", "unknown",
                                                         "missing"]
    got = apply(spark, c.clean_action, ["permit", "deny", "monitor", "bogus", None, "", " Drop\n"])
    assert [v for v, _ in got] == ["ALLOW", "BLOCK", "ALERT", None, None, None, "DROP"]
    assert [bool(w) for _, w in got] == [False, False, False, True, False, False, False]


def test_text_fields(spark):
    assert [v for v, _ in apply(spark, c.clean_tcp_flags, [" syn , ,ack", None, ""])] == [
        ["SYN", "ACK"], [], []]
    got = apply(spark, c.clean_event_type, [" ssh_attempt ", None, "  ", ""])
    assert [v for v, _ in got] == ["SSH_ATTEMPT", "UNKNOWN", "", "UNKNOWN"]
    assert [bool(w) for _, w in got] == [False, True, False, True]
    assert [v for v, _ in apply(spark, c.clean_user, [" Admin ", "  ", None])] == [
        "admin", None, None]
    assert [v for v, _ in apply(spark, c.counter, [None, -1, 5], "bigint")] == [0, 0, 5]


def test_given_keeps_order_and_repeats(spark):
    row = spark.range(1).select(given(F.lit("b"), F.lit(None).cast("string"), F.lit("a"),
                                      F.lit("b")).alias("x")).first()
    assert row.x == ["b", "a", "b"]


def test_fences(spark):
    got = spark.createDataFrame([("```json\n[1]\n```",), (" [1] ",), ("```[1]",)], "x string")
    assert [r[0] for r in got.select(outer_fences(F.col("x"))).collect()] == ["[1]"] * 3
    assert [r[0] for r in got.select(strip_fences(F.col("x"))).collect()] == ["[1]"] * 3


def test_records_that_differ_anywhere_have_different_ids(spark):
    schema = ("id string, timestamp string, source_ip string, action string, user string, "
              "bytes_sent bigint, asset_tags array<string>, log_metadata struct<collector:string>")
    base = ("a", "t", "1.1.1.1", "ALLOW", "u", 1, ["x"], ("c",))
    others = [("a|", "t", *base[2:]), ("a", "|t", *base[2:]), (*base[:3], "BLOCK", *base[4:]),
              (*base[:4], "v", *base[5:]), (*base[:5], None, *base[6:]),
              (*base[:6], ["x", "y"], base[7]), (*base[:6], [], base[7]), (*base[:6], None, base[7]),
              (*base[:7], ("d",)), (*base[:7], (None,)), (*base[:7], None)]
    rows = spark.createDataFrame([base, base, *others], schema)
    ids = [r[0] for r in rows.select(stable_id(rows)).collect()]
    assert ids[0] == ids[1] and len(set(ids)) == len(others) + 1
    moved = rows.select("user", *[x for x in rows.columns if x != "user"])
    assert moved.select(stable_id(moved)).first()[0] == ids[0]


def test_layout_families(spark):
    """Mail, system log, month name and 12-hour layouts; a missing year is that of as_of."""
    from datetime import datetime
    noon = datetime(2026, 2, 8, 21, 15, 32)
    cases = {
        "Sun, 08 Feb 2026 21:15:32 +0000": (noon, False),
        "Sun, 8 Feb 2026 22:15:32 +0100": (noon, False),
        "08 Feb 2026 21:15:32 GMT": (noon, False),
        "8 February 2026 21:15:32": (noon, True),
        "February 8, 2026 21:15:32": (noon, True),
        "Feb 8, 2026 9:15:32 PM": (noon, True),
        "8 Feb 2026 9:15:32 p.m.": (noon, True),
        "02/08/2026 09:15:32 PM": (noon, True),
        "2/8/2026 9:15 pm": (noon.replace(second=0), True),
        "Sun Feb  8 21:15:32 2026": (noon, True),
        "Feb  8 21:15:32": (noon.replace(year=2024), True),
        "Feb 29 01:02:03": (datetime(2024, 2, 29, 1, 2, 3), True),
        "Foo 8 21:15:32": (None, None), "Feb 30 21:15:32": (None, None), "32 Feb 2026 00:00:00": (None, None),
        "25/25/2026 09:15:32 PM": (None, None), "13:00 PM": (None, None)}
    as_of = datetime(2024, 5, 6)
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    rule = c.clean_timestamp(F.col("t"), F.lit(as_of))
    for r in df.select("t", rule.value.alias("value"), rule.warning.alias("warning")).collect():
        want, no_zone = cases[r.t]
        assert r.value == (want or as_of), r
        assert (r.warning or "").startswith("unparseable") == (want is None), r
        assert ("no timezone" in (r.warning or "")) == bool(no_zone), r
