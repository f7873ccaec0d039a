"""Event-rate detector: tumbling windows per source address and event type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from duskwatch.functions.text import message
from duskwatch.functions.timing import minutes_of

WINDOW = "5 minutes"
THRESHOLD = 10
WATERMARK = "30 seconds"

# Fixed value: wording of a finding.
DESCRIPTION = "VELOCITY: %s %s events from %s in %s minutes"

KEYS = ("source_ip", "event_type")


def none_text(text: Column) -> Column:
    """A missing address is a key of its own, spelled ``None``."""
    return F.coalesce(text, F.lit("None"))


def velocity_key() -> Column:
    return F.concat(none_text(F.col("source_ip")), F.lit(":"), F.col("event_type"))


def velocity_windows(silver: DataFrame, window: str = WINDOW, threshold: int = THRESHOLD,
                     with_record: bool = False) -> DataFrame:
    """Counters of every (address, type) window with at least ``threshold`` events.

    Reads six narrow columns.  Counts, sums, bounds and the distinct counts are
    combined inside the map tasks, so one hot key adds few rows to the shuffle.
    ``with_record`` (streams only) adds ``representative``, see :func:`rate_findings`;
    a batch adds it afterwards, for the windows found (:func:`with_representative`).
    """
    if with_record and not silver.isStreaming:
        raise ValueError("a batch takes its representatives from with_representative")
    slim = silver.select(
        "source_ip", "event_type", "event_time",
        F.coalesce("destination_ip", F.lit("")).alias("dest_ip"),
        F.coalesce("destination_port", F.lit(-1)).alias("dest_port"), "bytes_sent",
        *([F.struct(*silver.columns).alias("record")] if with_record else []))
    tumbling = F.window("event_time", window)
    counters = (_stream_counters if silver.isStreaming else _batch_counters)(slim, tumbling)
    extra = [F.col("representative")] if with_record else []
    return (counters.where(F.col("event_count") >= threshold)
            .select("window", F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"), *KEYS,
                    velocity_key().alias("velocity_key"),
                    F.col("event_count").cast("int").alias("event_count"),
                    F.col("unique_dest_ips").cast("int").alias("unique_dest_ips"),
                    F.col("unique_dest_ports").cast("int").alias("unique_dest_ports"),
                    "total_bytes_sent", "first_seen", "last_seen",
                    F.lit(minutes_of(window)).alias("window_minutes"),
                    message(DESCRIPTION, F.col("event_count"), F.col("event_type"),
                            none_text(F.col("source_ip")),
                            F.lit(minutes_of(window))).alias("description"), *extra))


def _batch_counters(slim: DataFrame, tumbling: Column) -> DataFrame:
    return slim.groupBy(tumbling.alias("window"), *KEYS).agg(
        F.count("*").alias("event_count"),
        F.count_distinct("dest_ip").alias("unique_dest_ips"),
        F.count_distinct("dest_port").alias("unique_dest_ports"),
        F.sum("bytes_sent").alias("total_bytes_sent"),
        F.min("event_time").alias("first_seen"), F.max("event_time").alias("last_seen"))


def _stream_counters(slim: DataFrame, tumbling: Column) -> DataFrame:
    """Exact distinct counts without distinct aggregates, which streams refuse.

    Every event becomes three rows: its measures, its address, its port.  The
    first aggregate keeps one row per value, spread over the state partitions;
    the second counts them.  No group collects its values in one place.  The record of
    the latest event, if wanted, is the state of a window's measures row: one record per
    window, replaced as later ones come, and given out when the window closes.
    """
    with_record = "record" in slim.columns
    latest = F.max_by(F.when(F.col("f.facet") == "event", F.col("record")),
                      F.struct("record.event_time", "record.id")) if with_record else None
    nothing = F.lit(None).cast("string")
    facets = F.array(
        F.struct(F.lit("event").alias("facet"), nothing.alias("value")),
        F.struct(F.lit("ip").alias("facet"), F.col("dest_ip").alias("value")),
        F.struct(F.lit("port").alias("facet"), F.col("dest_port").cast("string").alias("value")))
    values = (slim.withColumn("f", F.explode(facets))
              .groupBy(tumbling.alias("w"), *KEYS, "f.facet", "f.value")
              .agg(F.count("*").alias("n"), F.sum("bytes_sent").alias("bytes"),
                   F.min("event_time").alias("lo"), F.max("event_time").alias("hi"),
                   *([latest.alias("record")] if with_record else [])))

    def of(facet, value):
        return F.when(F.col("facet") == facet, value)

    return values.groupBy(F.col("w").alias("window"), *KEYS).agg(
        F.sum(of("event", F.col("n"))).alias("event_count"),
        F.count(of("ip", F.lit(1))).alias("unique_dest_ips"),
        F.count(of("port", F.lit(1))).alias("unique_dest_ports"),
        F.sum(of("event", F.col("bytes"))).alias("total_bytes_sent"),
        F.min(of("event", F.col("lo"))).alias("first_seen"),
        F.max(of("event", F.col("hi"))).alias("last_seen"),
        *([F.first(of("event", F.col("record")), ignorenulls=True).alias("representative")]
          if with_record else []))


def with_representative(windows: DataFrame, silver: DataFrame) -> DataFrame:
    """Add ``representative``: the full latest silver record of each window.

    Only windows over the threshold take part, so wide records never go through
    the window aggregate.  Ties on the latest instant fall to the greatest id.
    """
    latest = windows.select("velocity_key", "window_start", F.col("last_seen").alias("event_time"))
    fields = silver.columns
    keyed = silver.withColumn("velocity_key", velocity_key())
    chosen = (keyed.join(latest, ["velocity_key", "event_time"])
              .groupBy("velocity_key", "window_start")
              .agg(F.max_by(F.struct(*fields), "id").alias("representative")))
    return windows.join(chosen, ["velocity_key", "window_start"])


def velocity_findings(windows: DataFrame, silver: DataFrame) -> DataFrame:
    """Aggregation records of the rate detector over a batch."""
    return rate_findings(with_representative(windows, silver))


def rate_findings(windows: DataFrame) -> DataFrame:
    """Aggregation records of windows with their ``representative``, batch or stream.

    The representative is the latest silver record of a window, of equal instants the
    one with the greatest id; it gives a finding its id and event time.
    """
    rep = F.col("representative")
    return windows.select(
        F.concat(F.lit("agg_"), rep["id"]).alias("id"),
        F.lit("velocity").alias("aggregation_type"), "source_ip",
        F.col("event_type").alias("source_event_type"),
        rep["event_time"].alias("event_time"), "description", "event_count", "first_seen",
        "last_seen", "window_minutes", "unique_dest_ips", "unique_dest_ports",
        "total_bytes_sent", "velocity_key", F.lit(True).alias("aggregated"),
        F.lit(False).alias("correlated"), "representative")
