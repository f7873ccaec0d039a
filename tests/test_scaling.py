"""Plans whose tasks and rows must not grow with the tables."""
import datetime as dt
import io
from contextlib import redirect_stdout

import pytest

from duskwatch.functions import plan
from duskwatch.operators import interval, velocity
from duskwatch.plans import catalog, pipeline as p
from duskwatch.sinks import textindex

MB = 1 << 20


def shown(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def few(spark, tmp_path_factory):
    """A folder with a few events, copies and missing keys among them, and one address."""
    path = str(tmp_path_factory.mktemp("few"))
    kinds = ("error", "signup", "purchase", "click", "view")
    base = dt.datetime(2024, 1, 5)
    rows = [(None if i == 999 else i - i % 2 if i > 900 else i, base + dt.timedelta(minutes=17 * (i // 3)),
             i % 7, kinds[i % 5], float(i % 300), None) for i in range(1000)]
    (spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, "
                                 "value double, props string")
     .coalesce(1).write.parquet(f"{path}/events.parquet"))
    (spark.createDataFrame([(3, "s", 1, 1.0)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double")
     .write.parquet(f"{path}/supplier.parquet"))
    return path


@pytest.mark.parametrize("cores", [6, 12])
def test_the_rows_of_a_task_do_not_grow_with_the_file(cores):
    """beyond a few MB a core the tasks were left to the file's row groups."""
    sizes = [n * MB for n in (1, 12, 47, 49, 120, 720)]
    tasks = [plan.spread_tasks(size, cores) for size in sizes]
    assert tasks == sorted(tasks) and tasks[0] == cores
    assert max(size / n for size, n in zip(sizes, tasks)) <= 2 * MB
    assert plan.spread_tasks(1 << 40, cores) >= (1 << 40) // plan.LARGEST_TASK_BYTES


def test_a_large_row_group_is_dealt_to_many_tasks(spark, few, monkeypatch):
    events = spark.read.parquet(f"{few}/events.parquet")
    monkeypatch.setattr(plan, "planned_bytes", lambda df: 120 * MB)
    dealt = plan.spread(events)
    assert dealt.rdd.getNumPartitions() == 120
    assert sorted(dealt.collect(), key=str) == sorted(events.collect(), key=str)


def test_gold_is_cleaned_once_where_silver_is_stored(spark, few):
    """findings store silver, and gold then started again from the events."""
    p._STORED.clear()
    plain = p.gold_table(spark, few)
    wanted = sorted(plain.select("silver.*", "threat_score", "narrative", "score_breakdown").collect(), key=str)
    p._STORED.clear()
    p.silver_table(spark, few)
    at_hand = p._gold_at_hand(spark, few)
    assert "/events.parquet" not in shown(at_hand)
    found = at_hand.select("silver.*", "threat_score", "narrative", "score_breakdown").collect()
    assert sorted(found, key=str) == wanted


def test_a_single_read_of_gold_stores_nothing(spark, few):
    p._STORED.clear()
    lazily = catalog.events_health(spark, few).first()
    catalog.agg_gold_interval_join(spark, few)
    assert not any(layer == "gold" for _, _, layer in p._STORED)
    p.gold_table(spark, few)
    assert catalog.events_health(spark, few).first() == lazily


def test_narrow_aggregations_gather_no_ids_and_no_contexts(spark, few):
    """lists of ids and context structs were gathered and then dropped."""
    narrow, whole = p.aggregations_table(spark, few, narrow=True), p.aggregations_table(spark, few)
    assert "collect_list" in shown(whole)
    for query in (catalog.v_aggregation_enriched, catalog.narrative_search, catalog.v_ip_full_picture):
        assert "collect_list" not in shown(query(spark, few))
    kept = [c for c in whole.columns if c not in ("source_event_ids", "ip_reputation", "asset_context",
                                                  "identity_context")]
    assert sorted(narrow.select(kept).collect(), key=str) == sorted(whole.select(kept).collect(), key=str)


def test_findings_take_narrow_records_to_their_representative(spark, few):
    """F16: whole records were shuffled to choose ids and times."""
    assert "process_name" not in shown(catalog.velocity_representative(spark, few))
    silver = p.silver_table(spark, few)
    windows = velocity.velocity_windows(silver, p.WINDOW, p.THRESHOLD)
    narrow = velocity.velocity_findings(windows, silver.select("id", "event_time", *velocity.KEYS))
    whole = velocity.velocity_findings(windows, silver)
    assert narrow.count() and sorted(narrow.drop("representative").collect(), key=str) == sorted(
        whole.drop("representative").collect(), key=str)


def test_dedup_chooses_among_the_shown_columns(spark, few):
    """the choice carried whole records through its sort."""
    assert "cleaning_version" not in shown(catalog.dedup_exact(spark, few))


def test_summaries_without_contexts_are_the_same(spark, few):
    found, gold = p.findings_table(spark, few), p.gold_table(spark, few)
    x = "enrichment_summary"
    names = ("max_threat_score", "avg_threat_score", "recommended_action", "mitre_tactic", "narrative",
             "gold_events_found", "source_event_ids")
    rows = [sorted(interval.enrichment_summary(found, g, p.WINDOW)
                   .select("finding_id", *[f"{x}.{n}" for n in names]).collect(), key=str)
            for g in (gold, p.without_contexts(gold))]
    assert rows[0] and rows[0] == rows[1]


def test_summary_query_gathers_the_contexts_of_its_top_events(spark, few, monkeypatch):
    """the query gave its operator null contexts, so none were gathered."""
    p._STORED.clear()
    seen, summary = [], interval.enrichment_summary
    monkeypatch.setattr(interval, "enrichment_summary", lambda *a, **k: seen.append(summary(*a, **k)) or seen[-1])
    query = catalog.enrichment_summary(spark, few)
    assert "ip_reputation, null" not in shown(query)
    names = ("ip_reputation", "asset_context", "identity_context")
    gold = {r["id"]: r for r in p.gold_table(spark, few).select("silver.id", *names).collect()}
    found = seen[0].select("finding_id", "enrichment_summary.*").collect()
    assert len(found) == query.count() > 0
    for n in names:
        assert any(r[n] for r in found)
        assert all(r[n] == gold[r["source_event_ids"][0]][n] for r in found)


def test_index_shuffles_a_text_once_not_a_row_per_word(spark, tmp_path, monkeypatch):
    """the row of each word went through the shuffle and was written uncoded."""
    seen = []
    posted = textindex.postings
    monkeypatch.setattr(textindex, "postings", lambda rows, at="event_time": seen.append(rows) or posted(rows, at))
    records = spark.createDataFrame(
        [("event", f"e{i}", dt.datetime(2024, 1, 1 + i % 3), text, "x") for i, text in enumerate(
            ["One two two", None, "", "two, THREE", "One two two", "..."])] + [("event", None, None, "four", "x")],
        "record_type string, record_id string, event_time timestamp, text string, source_ip string")
    textindex.write_index(records, str(tmp_path / "i"))
    dealt = seen[0]
    assert "REBALANCE" in shown(dealt) and set(dealt.columns) == {"event_date", "record_type", "record_id", "text"}
    columns = ["event_date", "record_type", "record_id", "word"]
    found = spark.read.parquet(str(tmp_path / "i")).select(*columns).collect()
    assert sorted(found, key=str) == sorted(posted(records).select(*columns).collect(), key=str)
    assert len(found) == 7 and list((tmp_path / "i").rglob("*.zstd.parquet"))
