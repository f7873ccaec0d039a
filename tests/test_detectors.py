"""Detectors and joins against plain restatements, and their plans under skew."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from duskwatch.operators import baseline, chain_blocks, chains, clean, interval, velocity
from duskwatch.operators.enrich import asset_dim
from duskwatch.operators.lookup import lookup_join, planned_bytes

BASE = dt.datetime(2024, 1, 1)
SCHEMA = ("source_ip string, event_time timestamp, id string, event_type string, action string")


def walk(rows, lookback):
    """The sequence detector as a fold over time-ordered events."""
    buffers, found = {}, []
    for ip, at, name, kind, action in sorted(rows, key=lambda r: (r[1], r[2])):
        ip = ip or "None"
        kept = [e for e in buffers.get(ip, []) if e[0] >= at - lookback]
        if kind in ("PORT_SCAN", "SSH_ATTEMPT"):
            kept.append((at, name, "scan"))
        elif action in ("BLOCK", "DROP"):
            kept.append((at, name, "block"))
        elif action == "ALLOW":
            scans = [e for e in kept if e[2] == "scan"]
            blocks = [e for e in kept if e[2] == "block"]
            if scans and blocks:
                found.append((ip, scans[0][1], blocks[0][1], name))
                kept = []
        buffers[ip] = kept
    return sorted(found)


@pytest.mark.parametrize("seed", range(4))
def test_chains_equal_fold(spark, seed):
    r = random.Random(seed)
    gap, rows = r.choice([5, 60, 300]), []
    for ip in ("a", "b", None):
        t, alternate = 0, r.random() < 0.5
        for k in range(700):
            t += r.choice([0, 1, gap, r.randint(0, gap)])
            # Alternating parts give one unbroken run of overlapping candidates.
            part = "SABA"[k % 4] if alternate and r.random() > 0.03 else r.choice("SBAAN")
            kind = {"S": "PORT_SCAN"}.get(part, "OTHER")
            action = {"S": "ALLOW", "B": "DROP", "A": "ALLOW", "N": None}[part]
            rows.append((ip, BASE + dt.timedelta(seconds=t), f"{ip}{r.random()}", kind, action))
    df = spark.createDataFrame(rows, SCHEMA)
    want = walk(rows, dt.timedelta(minutes=10))
    for slices in ("20 minutes", None):
        got = chains.attack_chains(df, "10 minutes", slices)
        assert sorted((x.source_ip, x.scan_id, x.block_id, x.success_id)
                      for x in got.collect()) == want
    assert len(want) > 20


def test_chain_windows_are_split_by_time(spark):
    """Windows over events run per (address, slice); per address only over slices."""
    df = spark.createDataFrame([], SCHEMA)
    plan = chains.attack_chains(df)._jdf.queryExecution().optimizedPlan().toString()
    specs = re.findall(r"windowspecdefinition\((.*?), specifiedwindow", plan)
    over_events = [s for s in specs if re.search(r"\bt#\d+", s)]
    assert over_events and all(re.match(r"ip#\d+, slice#\d+L?, t#", s) for s in over_events)


@pytest.mark.parametrize("seed", range(3))
def test_chains_of_a_hot_address_and_instant(spark, seed):
    """Nine tenths of the rows are of one address, most of them at one instant, some twice."""
    r, rows = random.Random(seed), []
    for k in range(3000):
        ip = "hot" if r.random() < 0.9 else r.choice("ab")
        at = BASE + dt.timedelta(minutes=30) if r.random() < 0.6 else BASE + dt.timedelta(
            microseconds=r.choice([r.randint(0, 900), r.randint(0, 10 ** 6), r.randint(0, 5 * 10 ** 9)]))
        part = "SABA"[k % 4] if seed == 1 else r.choice("SBAAN")
        kind = {"S": "PORT_SCAN"}.get(part, "OTHER")
        action = {"S": "ALLOW", "B": "DROP", "A": "ALLOW", "N": None}[part]
        rows += [(ip, at, f"{k:05d}" if seed == 1 else f"{r.random()}", kind, action)] * r.choice([1, 1, 2])
    df = spark.createDataFrame(rows, SCHEMA)
    want = walk(rows, dt.timedelta(minutes=10))
    for crowded in (20, 10 ** 6):
        got = chains.attack_chains(df, crowded=crowded).collect()
        assert sorted((x.source_ip, x.scan_id, x.block_id, x.success_id) for x in got) == want
    assert len(want) > 50
    plain, cut = (sorted(map(tuple, chains.attack_chain_candidates(df, crowded=c).collect()))
                  for c in (10 ** 6, 20))
    assert plain == cut and len(plain) > len(want)


def test_blocks_of_a_hot_instant_are_small(spark):
    rows = spark.range(50_000).selectExpr(
        "if(id % 10 = 0, 'cold', 'hot') AS ip", "if(id % 20 < 18, 5000000L, id * 100) AS t",
        "sha2(string(id), 256) AS id", "'scan' AS role")
    rows = rows.unionByName(rows)               # each record twice
    sizes = [x[0] for x in chain_blocks.blocks(rows, 2400 * 10 ** 6, 500, copies=False)
             .groupBy("ip", "slice").count().select("count").collect()]
    assert sum(sizes) == 50_000 and max(sizes) < 500 * 12 and len(sizes) > 60


def test_baseline_equals_walk(spark):
    r = random.Random(3)
    rows = []
    for key in ("a", "b"):
        for k in range(60):
            at = BASE + dt.timedelta(minutes=5 * k)
            rows.append((key, "X", f"{key}:X", r.choice([1, 2, 3, 9, 12]), at,
                         at + dt.timedelta(minutes=5), at, at, 5))
    df = spark.createDataFrame(rows, (
        "source_ip string, event_type string, velocity_key string, event_count int, "
        "window_start timestamp, window_end timestamp, first_seen timestamp, last_seen timestamp, "
        "window_minutes int"))
    want = []
    for key in ("a", "b"):
        past = []
        for row in (x for x in rows if x[0] == key):
            if len(past) >= 6 and row[3] >= 2.0 * sum(past) / len(past):
                mean = sum(past) / len(past)
                stamp = int(row[5].replace(tzinfo=dt.timezone.utc).timestamp() * 1000) - 1
                want.append((f"baseline_{key}:X_{stamp}", round(mean, 2), round(row[3] / mean, 2),
                             len(past)))
            past = (past + [row[3]])[-12:]
    got = [(x.id, x.baseline_stats.rolling_average, x.baseline_stats.multiplier,
            x.baseline_stats.windows_in_baseline)
           for x in baseline.baseline_alerts(df, 2.0).collect()]
    assert sorted(got) == sorted(want) and len(want) > 5


def test_interval_join_over_bucket_borders(spark):
    points = spark.createDataFrame(
        [("k", BASE + dt.timedelta(minutes=m), m) for m in range(0, 60, 3)],
        "key string, at timestamp, m int")
    spans = [(0, 0), (4, 27), (59, 59), (30, 20), (15, 45)]
    ranges = spark.createDataFrame(
        [("k", i, BASE + dt.timedelta(minutes=a), BASE + dt.timedelta(minutes=b))
         for i, (a, b) in enumerate(spans)] + [("k", 9, None, BASE)],
        "key string, r int, lo timestamp, hi timestamp")
    got = interval.interval_join(points, ranges, ["key"], "at", "lo", "hi", "5 minutes")
    assert sorted((x.r, x.m) for x in got.collect()) == sorted(
        (i, m) for i, (a, b) in enumerate(spans) for m in range(0, 60, 3) if a <= m <= b)


def test_interval_join_has_no_cartesian_product(spark):
    points = spark.range(10).selectExpr("'k' as key", "timestamp_seconds(id) as at")
    ranges = points.selectExpr("key", "at as lo", "at as hi")
    plan = interval.interval_join(points, ranges, ["key"], "at", "lo", "hi")._jdf
    text = plan.queryExecution().executedPlan().toString()
    assert "Cartesian" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("parts", [1, 4, 60])
def test_range_min_equals_brute_force(spark, parts):
    r = random.Random(parts)
    points = [(r.choice(["a", "a", "a", "b", None]), BASE + dt.timedelta(seconds=r.choice([r.randint(0, 3000), 900])),
               r.randint(0, 50)) for _ in range(400)]
    ranges = [(r.choice(["a", "b", "c", None]), i, BASE + dt.timedelta(seconds=r.choice([r.randint(0, 3000), 900])),
               BASE + dt.timedelta(seconds=r.randint(0, 3000)) if i % 9 else None) for i in range(400)]
    want = {i: min(hits) for key, i, lo, hi in ranges
            if key and hi and (hits := [v for k, at, v in points if k == key and lo <= at <= hi])}
    got = interval.range_min(
        spark.createDataFrame(points, "key string, at timestamp, v int"),
        spark.createDataFrame(ranges, "key string, r int, lo timestamp, hi timestamp"),
        ["key"], "at", "lo", "hi", F.col("v"), "r", "5 minutes", parts)
    assert {x.r: x.least for x in got.collect()} == want and len(want) > 50


def test_lookup_broadcasts_only_small_tables(spark):
    rows = spark.range(100).withColumnRenamed("id", "k")
    small = spark.sql("SELECT key, key AS v FROM VALUES (1L), (2L), (3L) AS t(key)")
    assert planned_bytes(small) < 10_000
    assert planned_bytes(asset_dim(spark)) < 10_000
    on = F.col("k") == F.col("key")
    hinted = lookup_join(rows, small, on)._jdf.queryExecution().analyzed().toString()
    plain = lookup_join(rows, small, on, limit=1)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in hinted and "broadcast" not in plain
    assert lookup_join(rows, small, on, limit=1).count() == 100


def test_dedup_keeps_earliest(spark):
    rows = spark.createDataFrame(
        [("a", BASE, "2", 1), ("a", BASE - dt.timedelta(1), "9", 2), ("a", BASE, "1", 3),
         ("b", BASE, "1", 4)], "original_id string, event_time timestamp, id string, n int")
    assert sorted((r.original_id, r.n) for r in clean.dedup(rows).collect()) == [("a", 2), ("b", 4)]


def test_velocity_counts_blank_destinations_once(spark):
    rows = spark.createDataFrame(
        [("1.1.1.1", "X", BASE, d, p, 5, f"e{i}") for i, (d, p) in enumerate(
            [("a", 1), ("b", 1), (None, None), (None, None), ("a", 2)])],
        "source_ip string, event_type string, event_time timestamp, destination_ip string, "
        "destination_port int, bytes_sent bigint, id string")
    [w] = velocity.velocity_windows(rows, "5 minutes", 5).collect()
    assert (w.event_count, w.unique_dest_ips, w.unique_dest_ports, w.total_bytes_sent) == (5, 3, 3, 25)
    [f] = velocity.velocity_findings(velocity.velocity_windows(rows, "5 minutes", 5), rows).collect()
    assert f.id == "agg_e4"
