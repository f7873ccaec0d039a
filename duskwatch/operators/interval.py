"""Interval joins between findings and gold events.

A range condition cannot be hashed, and an equi-join on the address alone would
put a hot address into one task.  Both sides are therefore joined on (keys, time
bucket): an event lies in one bucket, a finding is repeated for the buckets its
interval touches, and the exact range is checked on top.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from duskwatch.functions.text import json_text
from duskwatch.functions.timing import bucket_of, micros

BUCKET = "5 minutes"


def interval_join(points: DataFrame, ranges: DataFrame, keys: list[str], at: str,
                  start: str, end: str, bucket: str = BUCKET) -> DataFrame:
    """Inner join of ``points`` and ``ranges`` on equal keys and start <= at <= end.

    Ranges with a missing bound match nothing.  Besides the keys the two sides
    must not share column names.  Choose ``bucket`` near the usual range length.
    """
    spread = (ranges.where(F.col(start) <= F.col(end))
              .withColumn("__bucket", F.explode(F.sequence(
                  bucket_of(F.col(start), bucket), bucket_of(F.col(end), bucket)))))
    placed = points.withColumn("__bucket", bucket_of(F.col(at), bucket))
    return (placed.join(spread, [*keys, "__bucket"])
            .where(F.col(at).between(F.col(start), F.col(end))).drop("__bucket"))


def range_min(points: DataFrame, ranges: DataFrame, keys: list[str], at: str, start: str,
              end: str, value: Column, range_id: str, bucket: str = BUCKET,
              parts: int = 16) -> DataFrame:
    """(range_id, least): least ``value`` of the points with equal keys and start <= at <= end.

    Time is cut into cells, ``parts`` to a bucket.  Cells wholly inside a range give their
    least value, one row each; in the two edge cells points and range bounds are sorted
    together, and a running minimum stops at the bound.  So no rows are formed per (point,
    range), except for ranges that lie inside one cell.  Ranges without a point, or with a
    missing key or bound, are left out.
    """
    def cell(instant):
        return F.floor(F.unix_micros(instant) / max(1, micros(bucket) // parts)).cast("bigint")

    cells = points.dropna(subset=keys).select(*keys, F.col(at).alias("__at"), cell(F.col(at)).alias("__cell"),
                                                value.alias("__v"))
    spans = ranges.dropna(subset=keys).where(F.col(start) <= F.col(end)).select(
        *keys, F.col(range_id).alias("__id"), F.col(start).alias("__from"), F.col(end).alias("__to"),
        cell(F.col(start)).alias("__first"), cell(F.col(end)).alias("__last"))
    wide, within = spans.where("__first < __last"), spans.where("__first = __last")
    by_cell = [*keys, "__cell"]
    whole = (wide.where("__last - __first > 1")
             .withColumn("__cell", F.explode(F.sequence(F.col("__first") + 1, F.col("__last") - 1)))
             .join(cells.groupBy(*by_cell).agg(F.min("__v").alias("__v")), by_cell))

    def edge(bound, place, order):
        marks = wide.select(*keys, F.col(bound).alias("__at"), F.col(place).alias("__cell"), "__id")
        # At one instant the points come first, so that a bound counts them.
        so_far = (Window.partitionBy(*by_cell).orderBy(order, F.col("__id").isNotNull())
                  .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return (cells.unionByName(marks, allowMissingColumns=True)
                .withColumn("__v", F.min("__v").over(so_far))
                .where(F.col("__id").isNotNull() & F.col("__v").isNotNull()))

    short = (within.withColumnRenamed("__first", "__cell").join(cells, by_cell)
             .where(F.col("__at").between(F.col("__from"), F.col("__to"))))
    found = [rows.select("__id", "__v") for rows in (
        whole, edge("__to", "__last", F.asc("__at")), edge("__from", "__first", F.desc("__at")), short)]
    return (reduce(DataFrame.unionByName, found).groupBy(F.col("__id").alias(range_id))
            .agg(F.min("__v").alias("least")))


def gold_points(gold: DataFrame) -> DataFrame:
    """Columns of nested gold records that a finding can borrow."""
    return gold.select(
        F.col("silver.source_ip").alias("source_ip"),
        F.col("silver.event_type").alias("source_event_type"),
        F.col("silver.event_time").alias("gold_time"), F.col("silver.id").alias("silver_id"),
        "threat_score",
        F.struct("recommended_action", "mitre_tactic", "narrative", "ip_reputation",
                 "asset_context", "identity_context").alias("context"))


def finding_ranges(findings: DataFrame) -> DataFrame:
    """Join range of each finding; findings without address or type have none."""
    return (findings.where((F.col("source_ip") != "") & (F.col("source_event_type") != ""))
            .select(F.col("id").alias("finding_id"), "source_ip", "source_event_type",
                    F.coalesce("first_seen", "event_time").alias("range_start"),
                    F.coalesce("last_seen", "event_time").alias("range_end")))


def event_links(findings: DataFrame, gold: DataFrame, bucket: str = BUCKET) -> DataFrame:
    """One row per (finding, matching gold event)."""
    return interval_join(gold_points(gold), finding_ranges(findings),
                         ["source_ip", "source_event_type"], "gold_time",
                         "range_start", "range_end", bucket)


def enrichment_summary(findings: DataFrame, gold: DataFrame, bucket: str = BUCKET,
                       with_ids: bool = True) -> DataFrame:
    """Summary struct per finding id with at least one match.

    Scores, counts and the top event are combined inside the map tasks.  The id
    list is part of the record; where a single finding may cover more events
    than a row should hold, pass ``with_ids=False`` and write
    :func:`event_links` as its own table.
    """
    rank = F.struct((-F.col("threat_score")).alias("s"), F.col("gold_time").alias("t"),
                    F.col("silver_id").alias("i"))
    ids = F.transform(F.array_sort(F.collect_list(rank)), lambda r: r["i"])
    top = F.min_by("context", rank)
    grouped = event_links(findings, gold, bucket).groupBy("finding_id").agg(
        F.max("threat_score").alias("hi"), F.sum("threat_score").alias("total"),
        F.count("*").alias("n"), top.alias("top"),
        (ids if with_ids else F.lit(None).cast("array<string>")).alias("ids"))
    top = F.col("top")
    return grouped.select("finding_id", F.struct(
        F.col("hi").alias("max_threat_score"),
        F.floor(F.col("total") / F.col("n")).cast("int").alias("avg_threat_score"),
        top["recommended_action"].alias("recommended_action"),
        top["mitre_tactic"].alias("mitre_tactic"), top["narrative"].alias("narrative"),
        top["ip_reputation"].alias("ip_reputation"), top["asset_context"].alias("asset_context"),
        top["identity_context"].alias("identity_context"), F.col("ids").alias("source_event_ids"),
        F.col("n").cast("int").alias("gold_events_found")).alias("enrichment_summary"))


def enrich_findings(findings: DataFrame, gold: DataFrame, bucket: str = BUCKET,
                    with_ids: bool = True) -> DataFrame:
    """Findings with their ``enrichment_summary`` (NULL without a match)."""
    summary = enrichment_summary(findings, gold, bucket, with_ids)
    findings = findings.drop("enrichment_summary")
    return (findings.join(summary, findings["id"] == summary["finding_id"], "left")
            .drop("finding_id"))


def union_findings(*sets: DataFrame) -> DataFrame:
    """All detector outputs as one set of aggregation records."""
    columns = ("id", "aggregation_type", "source_ip", "source_event_type", "event_time",
               "description", "event_count", "first_seen", "last_seen", "window_minutes",
               "unique_dest_ips", "unique_dest_ports", "total_bytes_sent", "velocity_key",
               "baseline_stats", "triggering_event", "pattern", "chain", "aggregated",
               "correlated")
    out = None
    for rows in sets:
        # Nested events differ in shape by detector, so they travel as JSON.
        if "chain" in rows.columns:
            rows = rows.withColumn("chain", json_text("chain"))
        if "representative" in rows.columns:
            rows = rows.drop("representative")
        rows = rows.select(*[c for c in columns if c in rows.columns])
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    for name, kind in (("baseline_stats", None), ("triggering_event", "string"),
                       ("pattern", "string"), ("chain", "string")):
        if name not in out.columns and kind:
            out = out.withColumn(name, F.lit(None).cast(kind))
    return out


def aggregation_type(topic: Column) -> Column:
    """Kind of finding by the name of the topic it came from."""
    return (F.when(topic.contains("windowed"), "velocity")
            .when(topic.contains("correlated"), "cep_chain")
            .when(topic.contains("baseline"), "baseline").otherwise("unknown"))
