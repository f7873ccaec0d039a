"""Context columns from reference tables: address, asset, identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from duskwatch.functions.text import filled, null_if_empty
from duskwatch.operators.lookup import lookup_join

MALICIOUS_FROM = 25
REPUTATION_SOURCE = "abuseipdb,ipinfo"

# Abuse category labels by number.
CATEGORY_LABELS = {
    3: "fraud_orders",
    4: "ddos_attack",
    5: "ftp_brute_force",
    6: "ping_of_death",
    7: "phishing",
    8: "fraud_voip",
    9: "open_proxy",
    10: "web_spam",
    11: "email_spam",
    12: "blog_spam",
    13: "vpn_ip",
    14: "port_scan",
    15: "hacking",
    16: "sql_injection",
    17: "spoofing",
    18: "brute_force",
    19: "bad_web_bot",
    20: "exploited_host",
    21: "web_attack",
    22: "ssh_brute_force",
    23: "iot_targeted",
}

# Hosts and users with a known role.
PRODUCTION_HOSTS = ("auth-server-01", "db-primary", "payments-api")
INTERNET_HOSTS = ("web-proxy", "vpn-gateway", "FW-DMZ-PRIMARY")
PRIVILEGED_USERS = ("admin", "root", "svc-deploy", "svc-backup")
OFFBOARDED_USERS = ("john.doe.old", "contractor_expired")


def asset_dim(spark: SparkSession) -> DataFrame:
    """Default asset table; replace by an inventory export of the same columns."""
    rows = [(h, h in PRODUCTION_HOSTS, h in INTERNET_HOSTS)
            for h in PRODUCTION_HOSTS + INTERNET_HOSTS]
    return _listed(spark, rows, "host, is_prod, internet_facing")


def identity_dim(spark: SparkSession) -> DataFrame:
    """Default identity table; replace by a directory export of the same columns."""
    rows = [(u, u in PRIVILEGED_USERS, u in OFFBOARDED_USERS)
            for u in PRIVILEGED_USERS + OFFBOARDED_USERS]
    return _listed(spark, rows, "`user`, is_privileged, recent_offboard")


def _listed(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    """A short table as literal rows, whose size Catalyst knows exactly."""
    values = ", ".join(f"('{name}', {first}, {second})" for name, first, second in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")


def category_labels(ids: Column) -> Column:
    """Labels of abuse category numbers, unknown numbers left out."""
    labels = F.create_map(*[F.lit(x) for pair in CATEGORY_LABELS.items() for x in pair])
    return F.array_compact(F.transform(F.coalesce(ids, F.array().cast("array<int>")),
                                       lambda i: labels[i]))


def pulse_terms(pulses: Column, field: str, first: int | None = None) -> Column:
    """Distinct, sorted, non-blank terms of the pulses of a feed entry (or its first ones)."""
    lists = F.transform(pulses if first is None else F.slice(pulses, 1, first), lambda p: p[field])
    terms = F.array_distinct(F.flatten(F.filter(lists, lambda x: x.isNotNull())))
    if field == "attack_ids":
        terms = F.filter(terms, lambda x: x != "")
    return F.array_sort(F.array_compact(terms))


def with_ip_reputation(silver: DataFrame, ip_intel: DataFrame) -> DataFrame:
    """Add ``ip_reputation`` and ``ip_attack_ids`` from an address feed table.

    An address the feed lacks still gets a context with score 0; no address, no
    context.
    """
    feed = ip_intel.select([F.col(x).alias(f"__feed_{x}") for x in ip_intel.columns])
    f = {x: F.col(f"__feed_{x}") for x in ip_intel.columns}
    score = F.coalesce(f["abuse_score"], F.lit(0))
    labels = category_labels(f["category_ids"])
    threats = F.when(f["pulses"].isNotNull(), F.array_sort(F.array_union(
        labels, pulse_terms(f["pulses"], "tags")))).otherwise(labels)
    malicious = (score >= MALICIOUS_FROM) | (F.coalesce(f["pulse_count"], F.lit(0)) > 0)
    context = F.struct(
        F.col("source_ip").alias("ip"), malicious.alias("is_malicious"),
        threats.alias("threat_types"),
        F.coalesce(null_if_empty(f["country"]), f["geo_country"]).alias("country"),
        score.alias("abuse_score"), F.lit(REPUTATION_SOURCE).alias("source"))
    joined = lookup_join(silver, feed, F.col("source_ip") == f["ip"])
    return joined.select(
        *silver.columns,
        F.when(filled(F.col("source_ip")), context).alias("ip_reputation"),
        pulse_terms(f["pulses"], "attack_ids").alias("ip_attack_ids"))


def with_engine_count(silver: DataFrame, engines: DataFrame) -> DataFrame:
    """Add the second-opinion engine count, looked up for severe events only."""
    feed = engines.select(F.col("ip").alias("__engine_ip"),
                          F.col("malicious_engines").alias("engine_malicious_count"))
    severe = F.col("severity").isin("HIGH", "CRITICAL")
    return lookup_join(silver, feed, (F.col("source_ip") == F.col("__engine_ip")) & severe
                       ).drop("__engine_ip")


def with_asset_context(silver: DataFrame, assets: DataFrame) -> DataFrame:
    feed = assets.select(F.col("host").alias("__host"), F.col("is_prod").alias("__prod"),
                         F.col("internet_facing").alias("__facing"))
    host = F.coalesce(null_if_empty(F.col("device_name")), null_if_empty(F.col("destination_ip")))
    no = F.lit(False)
    prod = (F.coalesce(F.col("__prod"), no)
            | F.coalesce(F.array_contains("asset_tags", "production"), no))
    facing = (F.coalesce(F.col("__facing"), no)
              | F.coalesce(F.col("security_zone") == "untrusted", no))
    context = F.struct(
        host.alias("host"), F.when(prod, 9).otherwise(4).alias("criticality"),
        F.when(prod, F.lit("prod")).otherwise("dev").alias("environment"),
        F.when(prod, F.lit("platform-team")).otherwise("dev-team").alias("owner"),
        facing.alias("internet_facing"))
    return lookup_join(silver, feed, host == F.col("__host")).select(
        *silver.columns, F.when(host.isNotNull(), context).alias("asset_context"))


def with_identity_context(silver: DataFrame, identities: DataFrame) -> DataFrame:
    feed = identities.select(F.col("user").alias("__user"),
                             F.col("is_privileged").alias("__privileged"),
                             F.col("recent_offboard").alias("__offboard"))
    user = F.col("user")
    privileged = F.coalesce(F.col("__privileged"), F.lit(False))
    offboard = F.coalesce(F.col("__offboard"), F.lit(False))
    context = F.struct(
        user.alias("user"), privileged.alias("is_privileged"),
        user.startswith("svc-").alias("is_service_acct"), offboard.alias("recent_offboard"),
        F.when(offboard, 85).when(privileged, 60).otherwise(10).alias("risk_score"))
    return lookup_join(silver, feed, user == F.col("__user")).select(
        *silver.columns, F.when(filled(user), context).alias("identity_context"))


def enrich(silver: DataFrame, ip_intel: DataFrame, assets: DataFrame,
           identities: DataFrame, engines: DataFrame | None = None) -> DataFrame:
    """All contexts.  A missing lookup leaves its context at the defaults."""
    out = with_ip_reputation(silver, ip_intel)
    out = with_asset_context(out, assets)
    out = with_identity_context(out, identities)
    return with_engine_count(out, engines) if engines is not None else out
