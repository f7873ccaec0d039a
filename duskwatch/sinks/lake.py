"""Archive sink: files in year/month/day/hour folders of the record's event time."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from duskwatch.functions.cleaning import instant
from duskwatch.functions.text import JSON_TIME, json_text
from duskwatch.operators.deadletter import dead_letters


class Profile(NamedTuple):
    """File sizing of an archive: records per file, trigger interval."""
    records: int
    interval: str


# Archive profiles by (environment, kind of layer).
PROFILES = {
    ("dev", "raw"): Profile(100, "30 seconds"),
    ("dev", "assessed"): Profile(50, "10 seconds"),
    ("prod", "raw"): Profile(5000, "300 seconds"),
    ("prod", "assessed"): Profile(1000, "60 seconds"),
}

# Time field and folder of each archived layer.
LAYER_TIME = {
    "bronze": "timestamp",
    "silver": "event_time",
    "gold": "silver.event_time",
    "aggregated/windowed": "event_time",
    "aggregated/correlated": "event_time",
    "aggregated/baseline": "event_time",
}
HOURS = ("year", "month", "day", "hour")


def profile(layer: str, env: str = "dev") -> Profile:
    return PROFILES[env, "raw" if layer in ("bronze", "silver") else "assessed"]


def with_hours(rows: DataFrame, at: Column) -> DataFrame:
    """Add the partition columns of an instant."""
    return rows.select("*", F.year(at).alias("year"), F.month(at).alias("month"),
                       F.day(at).alias("day"), F.hour(at).alias("hour"))


def split_by_time(rows: DataFrame, layer: str, topic: str,
                  as_of: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows with partition columns, dead letters for rows without a readable time)."""
    field = F.col(LAYER_TIME[layer])
    at = instant(field.cast("string")) if layer == "bronze" else field
    good = with_hours(rows.where(at.isNotNull()), at)
    bad = rows.where(at.isNull()).select(
        json_text(F.struct(*[c for c in rows.columns if c != "raw"])).alias("value"),
        F.lit(f"{LAYER_TIME[layer]}: no time to file the record under").alias("error"))
    return good, dead_letters(bad, stage="archive", topic=topic, as_of=as_of)


def write_batch(rows: DataFrame, path: str, stream: str, batch: int, fmt: str = "json",
                max_records: int | None = None) -> None:
    """Write a stream's batch to a folder of its own and list it as complete.

    Run again, the batch replaces what it wrote; ``sources.lake.read_archive`` skips unlisted
    folders.  The list's own folder is hidden from plain readers of the archive.
    """
    folder = f"stream={stream}/batch={batch}"
    write_lake(rows, f"{path}/{folder}", fmt, "overwrite", max_records, partitionOverwriteMode="static")
    listed = rows.sparkSession.range(1).select(F.current_timestamp().alias("completed_at"))
    (listed.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .parquet(f"{path}/_batches/{folder}"))


def write_lake(rows: DataFrame, path: str, fmt: str = "json", mode: str = "append",
               max_records: int | None = None, **options: str) -> None:
    """Write rows that carry the partition columns.

    The rebalance hint gathers each hour into few files and still splits an hour
    that is too large for one task.
    """
    writer = rows.hint("rebalance", *[F.col(h) for h in HOURS]).write.mode(mode).format(fmt).options(**options)
    if fmt == "json":
        writer = writer.option("timestampFormat", JSON_TIME)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.partitionBy(*HOURS).save(path)
