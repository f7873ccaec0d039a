"""Detectors over streams.

The rate detector is built from ordinary aggregates.  The sequence and deviation
detectors keep state per key; their Python only walks the few rows of one key,
Spark partitions, orders and stores the rest.  Events wait in state until the
watermark has passed them and are then taken in time order, so that a stream
gives the same chains as a batch over the same events.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from duskwatch import schemas
from duskwatch.functions.text import json_text, message
from duskwatch.functions.timing import micros, minutes_of
from duskwatch.operators import baseline, chains, velocity

WATERMARK = velocity.WATERMARK


def with_watermark(silver: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Event-time watermark; events behind it are dropped by the detectors."""
    return silver.withWatermark("event_time", delay)


def velocity_stream(silver: DataFrame, window: str = velocity.WINDOW,
                    threshold: int = velocity.THRESHOLD) -> DataFrame:
    """Rate findings of a watermarked stream, one per closed window."""
    return velocity.velocity_windows(silver, window, threshold)


def velocity_findings_stream(silver: DataFrame, window: str = velocity.WINDOW,
                             threshold: int = velocity.THRESHOLD) -> DataFrame:
    """Aggregation records of a watermarked stream, the same as a batch gives."""
    return velocity.rate_findings(velocity.velocity_windows(silver, window, threshold, with_record=True))


CHAIN_STATE = "t bigint, id string, role string, record string"
CHAIN_OUTPUT = """
    ip string, scan_id string, block_id string, success_id string, event_time timestamp,
    scan string, block string, success string
"""


class ChainProcessor(StatefulProcessor):
    """Walks the events of one address in time order (see ``operators.chains``)."""

    def __init__(self, lookback: int):
        self.lookback = lookback

    def init(self, handle):
        self.handle = handle
        self.waiting = handle.getListState("waiting", CHAIN_STATE)
        self.buffer = handle.getListState("buffer", CHAIN_STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            new = [(int(t), i, r, x) for t, i, r, x in
                   zip(frame["t"], frame["id"], frame["role"], frame["record"])]
            self.waiting.appendList(new)
        yield from self._advance(key, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._advance(key, timerValues.getCurrentWatermarkInMs())

    def _advance(self, key, watermark_ms):
        limit = watermark_ms * 1000
        waiting = sorted(self.waiting.get()) if self.waiting.exists() else []
        due = [e for e in waiting if e[0] <= limit]
        rest = waiting[len(due):]
        kept = list(self.buffer.get()) if self.buffer.exists() else []
        found = []
        for event in due:
            kept = [e for e in kept if e[0] >= event[0] - self.lookback]
            if event[2] != "success":
                kept.append(event)
                continue
            scan = next((e for e in kept if e[2] == "scan"), None)
            block = next((e for e in kept if e[2] == "block"), None)
            if scan and block:
                found.append((key[0], scan[1], block[1], event[1],
                              pd.Timestamp(event[0], unit="us"), scan[3], block[3], event[3]))
                kept = []
        kept = [e for e in kept if e[0] >= limit - self.lookback]
        self._store(self.waiting, rest)
        self._store(self.buffer, kept)
        # Wake up for the next waiting event, or to forget an idle address.
        wake = [e[0] for e in rest[:1]] + [e[0] + self.lookback for e in kept[-1:]]
        if wake:
            self.handle.registerTimer(max(min(wake) // 1000 + 1, watermark_ms + 1))
        if found:
            names = ["ip", "scan_id", "block_id", "success_id", "event_time", "scan", "block",
                     "success"]
            yield pd.DataFrame(found, columns=names)

    @staticmethod
    def _store(state, values):
        if values:
            state.put(values)
        else:
            state.clear()

    def close(self):
        pass


def chains_stream(silver: DataFrame, within: str = chains.WITHIN) -> DataFrame:
    """Chain findings of a watermarked stream."""
    steps = silver.select(
        velocity.none_text(F.col("source_ip")).alias("ip"), "event_time",
        F.unix_micros("event_time").alias("t"), "id", chains.chain_role().alias("role"),
        json_text(F.struct(*silver.columns)).alias("record")).where(F.col("role").isNotNull())
    found = steps.groupBy("ip").transformWithStateInPandas(
        ChainProcessor(micros(within)), CHAIN_OUTPUT, "Append", "EventTime")
    record = " ".join(schemas.SILVER.split())
    return found.select(
        F.concat(F.lit("cep_"), "scan_id").alias("id"),
        F.lit("cep_chain").alias("aggregation_type"),
        F.when(F.col("ip") != "None", F.col("ip")).alias("source_ip"), "event_time",
        "scan_id", "block_id", "success_id",
        F.lit("CORRELATED_ATTACK_CHAIN").alias("event_type"), F.lit("CRITICAL").alias("severity"),
        F.lit(minutes_of(within)).alias("window_minutes"),
        F.lit(chains.PATTERN).alias("pattern"),
        message(chains.DESCRIPTION, F.col("ip")).alias("description"),
        F.struct(F.from_json("scan", record).alias("port_scan"),
                 F.from_json("block", record).alias("blocked_attempt"),
                 F.from_json("success", record).alias("success")).alias("chain"),
        F.lit(True).alias("aggregated"), F.lit(True).alias("correlated"))


WINDOW_FIELDS = ("window_start timestamp, window_end timestamp, source_ip string, "
                 "event_type string, velocity_key string, event_count int, "
                 "first_seen timestamp, last_seen timestamp, window_minutes int")


class BaselineProcessor(StatefulProcessor):
    """Keeps the last window counts of one key and rates each new one."""

    def __init__(self, history: int):
        self.history = history

    def init(self, handle):
        self.counts = handle.getListState("counts", "n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows)).sort_values("window_start")
        past = [n for (n,) in self.counts.get()] if self.counts.exists() else []
        means, depths = [], []
        for count in frame["event_count"]:
            means.append(sum(past) / len(past) if past else 0.0)
            depths.append(len(past))
            past = (past + [int(count)])[-self.history:]
        self.counts.put([(n,) for n in past])
        names = [f.split()[0] for f in WINDOW_FIELDS.split(", ")]
        yield frame[names].assign(mean=means, depth=depths)

    def close(self):
        pass


def baseline_stream(windows: DataFrame, multiplier: float = baseline.MULTIPLIER,
                    history: int = baseline.HISTORY, min_depth: int | None = None) -> DataFrame:
    """Deviation alerts over the closed windows of :func:`velocity_stream`."""
    min_depth = history // 2 if min_depth is None else min_depth
    names = [f.split()[0] for f in WINDOW_FIELDS.split(", ")]
    rated = (windows.select(*names).groupBy("velocity_key").transformWithStateInPandas(
        BaselineProcessor(history), WINDOW_FIELDS + ", mean double, depth int", "Append", "None"))
    mean, count = F.col("mean"), F.col("event_count")
    return (rated.where((F.col("depth") >= min_depth) & (mean > 0) & (count >= mean * multiplier))
            .select(*baseline.alert_columns(count, mean, F.col("depth"), multiplier)))
