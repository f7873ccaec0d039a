"""Assessment requests and replies as columns, routing, and the gold record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from duskwatch import schemas
from duskwatch.functions import scoring as s
from duskwatch.functions.plan import settled
from duskwatch.functions.text import json_text, strip_fences
from duskwatch.operators.deadletter import dead_letters
from duskwatch.operators.lookup import lookup_join

ENRICHMENT_VERSION = "1.0"

# Wording of a request and of the default narrative.
REQUEST_LEAD = "Assess this security event and respond with JSON only:\n\n"
NO_NARRATIVE = "No narrative generated."

REQUEST_FIELDS = (
    "id", "event_time", "event_type", "severity", "action", "source_ip", "destination_ip",
    "destination_domain", "destination_port", "protocol", "application", "user", "device_name",
    "security_zone", "policy_violation", "tcp_flags", "bytes_sent", "bytes_received",
    "process_name", "asset_tags", "cleaning_warnings")


def needs_assessment(score: Column) -> Column:
    return score >= s.ASSESSMENT_FLOOR


def request_document() -> Column:
    """Request text for one scored event: a lead line and a JSON document."""
    document = json_text(F.struct(
        F.struct(*REQUEST_FIELDS).alias("event"), "threat_score", "score_breakdown",
        "ip_reputation", "asset_context", "identity_context"))
    return F.concat(F.lit(REQUEST_LEAD), document)


def assessment_requests(scored: DataFrame) -> DataFrame:
    """One request per event that is worth assessing; low scores are left out first."""
    return (scored.where(needs_assessment(F.col("threat_score")))
            .select("id", "threat_score", request_document().alias("request")))


def _whole_json(text: Column) -> Column:
    """JSON value of a text that holds one value and nothing else."""
    boxed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    alone = F.try_variant_get(boxed, "$[1]", "variant").isNull()
    closed = F.when(text.rlike(r"\]"), F.try_parse_json(
        F.concat(F.lit('{"w":'), text, F.lit("}"))).isNotNull()).otherwise(F.lit(True))
    return F.when(alone & closed, F.try_variant_get(boxed, "$[0]", "variant"))


def parse_replies(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """Add ``tier``, ``narrative``, ``mitre_tactic`` and ``error`` to reply texts.

    The text may be fenced, or hold one object inside prose.  An unknown tier
    becomes ``ticket``; a reply without a JSON object is an error.
    """
    text = F.col("__text")
    block = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    docs = (replies.withColumn("__text", strip_fences(F.col(reply)))
            .withColumn("__reply", F.coalesce(_whole_json(text), _whole_json(block))))
    doc = F.col("__reply")
    kind = F.schema_of_variant(doc)
    ok = F.coalesce(kind.startswith("OBJECT"), F.lit(False))
    wanted = F.try_variant_get(doc, "$.recommended_action", "string")
    has_narrative = F.try_variant_get(doc, "$.narrative", "variant").isNotNull()
    narrative = F.when(has_narrative, F.try_variant_get(doc, "$.narrative", "string")
                       ).otherwise(F.lit(NO_NARRATIVE))
    tactic = F.try_variant_get(doc, "$.mitre_tactic", "string")
    tier = F.when(wanted.isin(*s.TIERS), wanted).otherwise(F.lit("ticket"))
    read = docs.select(
        *replies.columns,
        F.when(ok, tier).alias("tier"), F.when(ok, narrative).alias("narrative"),
        F.when(ok, tactic).alias("mitre_tactic"),
        F.when(~ok, F.lit("reply: no JSON object")).alias("error"))
    return settled(read, "tier", "narrative", "mitre_tactic", "error")


def apply_replies(scored: DataFrame, replies: DataFrame | None = None,
                  on_error: str = "dlq") -> DataFrame:
    """Add ``recommended_action``, ``narrative``, ``mitre_tactic`` and ``error``.

    ``replies(id, reply)`` holds one reply per assessed event.  Without replies,
    or for an assessed event that has none, the tier follows from the score.
    Events below the assessment floor stay unassessed.  ``on_error="ticket"``
    turns unreadable replies into tickets instead of errors.
    """
    assessed = needs_assessment(F.col("threat_score"))
    ladder = F.when(assessed, s.action_tier(F.col("threat_score")))
    if replies is None:
        nothing = F.lit(None).cast("string")
        return scored.select(*scored.columns, ladder.alias("recommended_action"),
                             nothing.alias("narrative"), nothing.alias("mitre_tactic"),
                             nothing.alias("error"))
    read = parse_replies(replies.select(F.col("id").alias("__reply_id"), "reply"))
    if on_error == "ticket":
        failed = F.col("error").isNotNull()
        read = read.select(
            "__reply_id", "reply", F.coalesce("tier", F.lit("ticket")).alias("tier"),
            F.when(failed, F.lit(NO_NARRATIVE)).otherwise(F.col("narrative")).alias("narrative"),
            "mitre_tactic", F.lit(None).cast("string").alias("error"))
    read = read.select("__reply_id", F.col("tier").alias("__tier"),
                       F.col("narrative").alias("__narrative"),
                       F.col("mitre_tactic").alias("__tactic"), F.col("error").alias("__error"))
    joined = lookup_join(scored, read, (F.col("id") == F.col("__reply_id")) & assessed)
    no_reply = F.col("__reply_id").isNull()
    return joined.select(
        *scored.columns,
        F.when(no_reply, ladder).otherwise(F.col("__tier")).alias("recommended_action"),
        F.col("__narrative").alias("narrative"), F.col("__tactic").alias("mitre_tactic"),
        F.col("__error").alias("error"))


def nest_gold(assessed: DataFrame, processing_time_ms: Column | None = None) -> DataFrame:
    """Nested gold record of assessed, flat records."""
    silver = [f.name for f in schemas.layer_schema("silver").fields]
    elapsed = F.lit(None) if processing_time_ms is None else processing_time_ms
    return assessed.select(
        F.struct(*silver).alias("silver"), "ip_reputation", "asset_context", "identity_context",
        "threat_score", "score_breakdown", "recommended_action", "narrative", "mitre_tactic",
        F.lit(ENRICHMENT_VERSION).alias("enrichment_version"),
        elapsed.cast("int").alias("processing_time_ms"), F.lit(True).alias("routed"))


def build_gold(scored: DataFrame, replies: DataFrame | None = None, on_error: str = "dlq",
               topic: str = "silver", as_of: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Scored records -> (gold records, dead letters of stage ``enrich``)."""
    assessed = apply_replies(scored, replies, on_error)
    silver = [f.name for f in schemas.layer_schema("silver").fields]
    failed = assessed.where(F.col("error").isNotNull()).select(
        "error", json_text(F.struct(*silver)).alias("value"), "event_time")
    dead = dead_letters(failed, stage="enrich", topic=topic, as_of=as_of)
    return nest_gold(assessed.where(F.col("error").isNull())), dead


def dispatch_tier(action: Column) -> Column:
    """Tier used for dispatch; an unassessed event is archived."""
    return F.coalesce(action, F.lit("archive"))


def dispatch_lists(gold: DataFrame) -> dict[str, DataFrame]:
    """The events each dispatch channel has to act on."""
    tier = dispatch_tier(F.col("recommended_action"))
    return {name: gold.where(tier == name) for name in ("ticket", "page", "contain")}


def route_counts(gold: DataFrame) -> DataFrame:
    return (gold.groupBy(dispatch_tier(F.col("recommended_action")).alias("tier"))
            .agg(F.count("*").alias("events")))
