"""Composite threat score over enriched silver records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from duskwatch.functions import scoring as s

PARTS = ("severity_base", "event_type_boost", "action_modifier", "policy_violation",
         "security_zone", "ip_reputation", "asset_criticality", "identity_risk")


def with_threat_score(enriched: DataFrame) -> DataFrame:
    """Add ``threat_score`` (0-100) and ``score_breakdown``."""
    col = F.col
    parts = dict(zip(PARTS, (
        s.severity_points(col("severity")),
        s.event_type_points(col("event_type")),
        s.action_points(col("action"), col("severity")),
        s.policy_points(col("policy_violation")),
        s.zone_points(col("security_zone")),
        s.ip_points(col("ip_reputation")),
        s.asset_points(col("asset_context")),
        s.identity_points(col("identity_context")))))
    named = enriched.withColumn(
        "__parts", F.struct(*[F.coalesce(p, F.lit(0)).cast("int").alias(n)
                              for n, p in parts.items()]))
    total = sum((col(f"__parts.{n}") for n in PARTS[1:]), col(f"__parts.{PARTS[0]}"))
    score = F.least(total, F.lit(s.MAX_SCORE))
    breakdown = F.map_from_arrays(
        F.array(*[F.lit(n) for n in PARTS], F.lit("composite")),
        F.array(*[col(f"__parts.{n}") for n in PARTS], col("threat_score")))
    return (named.withColumn("threat_score", score)
            .withColumn("score_breakdown", breakdown).drop("__parts"))
