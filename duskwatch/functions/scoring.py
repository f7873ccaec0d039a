"""Threat score parts and the action ladder as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from duskwatch.functions.cleaning import lookup

# Points per severity.
SEVERITY_POINTS = {
    "INFO": 5,
    "LOW": 15,
    "MEDIUM": 35,
    "HIGH": 60,
    "CRITICAL": 85,
}
UNLISTED_SEVERITY_POINTS = 10

# Points per event type.
EVENT_TYPE_POINTS = {
    "FAILED_LOGIN": 5,
    "SSH_ATTEMPT": 10,
    "BRUTE_FORCE": 20,
    "PRIVILEGE_ESCALATION": 30,
    "LATERAL_MOVEMENT": 25,
    "DATA_EXFILTRATION": 35,
    "PORT_SCAN": 10,
    "MALWARE_DETECTED": 40,
    "CONFIG_CHANGE": 8,
    "NEW_ADMIN_USER": 20,
}

# Points per policy severity.
POLICY_POINTS = {
    "low": 5,
    "medium": 15,
    "high": 25,
}
UNLISTED_POLICY_POINTS = 5

# Lowest score of each action tier.
TIER_FLOORS = {
    "contain": 80,
    "page": 60,
    "ticket": 40,
    "digest": 20,
    "archive": 0,
}
TIERS = tuple(TIER_FLOORS)
ASSESSMENT_FLOOR = 15
MAX_SCORE = 100


def _points(condition: Column, points) -> Column:
    points = points if isinstance(points, Column) else F.lit(points)
    return F.when(condition, points).otherwise(F.lit(0))


def severity_points(severity: Column) -> Column:
    return F.coalesce(lookup(SEVERITY_POINTS, severity, "int"), F.lit(UNLISTED_SEVERITY_POINTS))


def event_type_points(event_type: Column) -> Column:
    return F.coalesce(lookup(EVENT_TYPE_POINTS, F.upper(event_type), "int"), F.lit(0))


def action_points(action: Column, severity: Column) -> Column:
    return _points((action == "ALLOW") & (severity != "INFO"), 5)


def policy_points(policy: Column) -> Column:
    listed = lookup(POLICY_POINTS, F.lower(policy["policy_severity"]), "int")
    return _points(policy.isNotNull(), F.coalesce(listed, F.lit(UNLISTED_POLICY_POINTS)))


def zone_points(zone: Column) -> Column:
    return _points(zone == "untrusted", 10)


def ip_points(reputation: Column) -> Column:
    halved = F.floor(reputation["abuse_score"] / 2).cast("int")
    return _points(reputation["is_malicious"], F.least(halved, F.lit(30)))


def asset_points(asset: Column) -> Column:
    base = F.coalesce((asset["criticality"] / 10 * 20).cast("int"), F.lit(0))
    return base + _points(asset["internet_facing"], 5)


def identity_points(identity: Column) -> Column:
    risk = F.coalesce(F.floor(identity["risk_score"] / 10).cast("int"), F.lit(0))
    return (_points(identity["recent_offboard"], 25)
            + _points(identity["is_privileged"], 10) + risk)


def action_tier(score: Column) -> Column:
    """Action tier of a composite score."""
    ladder = F
    for tier, floor in TIER_FLOORS.items():
        ladder = ladder.when(score >= floor, F.lit(tier))
    return ladder
