"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the input folder, BENCH_CPUS the number of local cores.
Each query is run twice, the second run counts (results go to a null sink).  The
first run also builds the stored layers a query needs; it is listed as well.
"""

from __future__ import annotations

import contextlib
import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from duskwatch.plans.catalog import QUERIES  # noqa: E402
from duskwatch.session import build_session  # noqa: E402

HEADLINE = (
    "bronze_parse", "clean_event", "dedup_exact", "warning_breakdown", "threat_score",
    "assessment_parse", "gold_events", "velocity_windows", "velocity_representative",
    "attack_chains", "attack_chain_records", "baseline_alerts", "enrichment_summary",
    "events_wide", "aggregations_wide", "insert_ignore", "upsert_latest",
    "v_hourly_threat_trends", "v_top_threat_ips", "v_aggregation_enriched", "v_ip_full_picture",
    "narrative_search")


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.sql.shuffle.partitions": cpus, "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    times, first = {}, {}
    for name in HEADLINE:
        with contextlib.redirect_stdout(sys.stderr):
            first[name] = round(run(spark, name, sf_dir), 3)
            times[name] = round(run(spark, name, sf_dir), 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "first_run": first,
                      "sf": float(scale)}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
