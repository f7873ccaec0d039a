"""Warm-table sinks that can be replayed: insert-ignore and upsert by key.

Tables are Parquet folders partitioned by event date.  A record's key fixes its
event date, so the lookup for known keys reads only the dates of the batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException

DATE = "event_date"
# Dates of a batch up to which they are listed in the lookup.
LISTED = 1000


def first_per_key(batch: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first record of each key; copies are reduced inside the map tasks."""
    rest = [c for c in batch.columns if c != key]
    kept = batch.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__r"))
    return kept.select(*[F.col(c) if c == key else F.col(f"__r.{c}").alias(c)
                         for c in batch.columns])


def latest_per_key(rows: DataFrame, key: str, version: list[str]) -> DataFrame:
    """The last version of each key."""
    rest = [c for c in rows.columns if c != key]
    kept = rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*version)).alias("__r"))
    return kept.select(*[F.col(c) if c == key else F.col(f"__r.{c}").alias(c)
                         for c in rows.columns])


def new_rows(batch: DataFrame, target: DataFrame | None, key: str,
             order: list[str]) -> DataFrame:
    """Rows an insert-ignore would add: first per key, key not yet in the target."""
    fresh = first_per_key(batch, key, order)
    if target is None:
        return fresh
    return fresh.join(target.select(key), key, "left_anti")


def merged(target: DataFrame | None, batch: DataFrame, key: str,
           version: list[str]) -> DataFrame:
    """Target after an upsert: the batch wins over the target, later over earlier."""
    ranked = batch.withColumn("__from", F.lit(1))
    if target is not None:
        ranked = ranked.unionByName(target.withColumn("__from", F.lit(0)))
    return latest_per_key(ranked, key, ["__from", *version]).drop("__from")


def existing(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path, or None before its first write."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def dated(batch: DataFrame, at: str) -> DataFrame:
    return batch.withColumn(DATE, F.to_date(at))


def same_dates(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Target rows of the batch's dates, null date included; reads only their folders.

    The dates are listed one by one, so that a stray one does not open all folders in
    between.  A batch of more than ``LISTED`` dates reads the whole span of them.
    """
    dates = [r[0] for r in batch.select(DATE).distinct().limit(LISTED + 1).collect()]
    if len(dates) <= LISTED:
        inside = F.col(DATE).isin([d for d in dates if d is not None])
        blank = None in dates
    else:
        low, high, blank = batch.agg(F.min(DATE), F.max(DATE), F.count_if(F.col(DATE).isNull())).first()
        inside = F.col(DATE).between(F.lit(low), F.lit(high))
    return target.where(inside | F.col(DATE).isNull() if blank else inside)


# The names these two had before other modules used them.
_dated, _same_dates = dated, same_dates


def insert_ignore(batch: DataFrame, path: str, key: str, at: str = "event_time",
                  order: list[str] | None = None) -> None:
    """Append the rows whose key the table lacks.  Writing a batch twice adds nothing."""
    spark = batch.sparkSession
    rows = dated(batch, at)
    target = existing(spark, path)
    if target is not None:
        target = same_dates(target, rows)
    fresh = new_rows(rows, target, key, order or [at])
    (fresh.hint("rebalance", F.col(DATE)).write.mode("append").partitionBy(DATE).parquet(path))


def upsert_latest(batch: DataFrame, path: str, key: str, version: list[str],
                  at: str = "event_time") -> None:
    """Rewrite the dates the batch touches with the latest version of each key."""
    spark = batch.sparkSession
    rows = dated(batch, at)
    target = existing(spark, path)
    if target is not None:
        dates = rows.select(DATE).distinct()
        target = same_dates(target, rows).join(
            dates, target[DATE].eqNullSafe(dates[DATE]), "left_semi")
    out = merged(target, rows, key, version)
    (out.hint("rebalance", F.col(DATE)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(DATE).parquet(path))


def append_jdbc(batch: DataFrame, url: str, table: str, key: str, at: str = "event_time",
                order: list[str] | None = None, **properties: str) -> None:
    """Insert-ignore into a relational table over JDBC.

    The table's keys of the batch's time range are read by push-down, the rest
    is appended; the table's own unique key guards against concurrent writers.
    """
    spark = batch.sparkSession
    low, high = batch.agg(F.min(at), F.max(at)).first()
    known = (spark.read.format("jdbc").options(url=url, dbtable=table, **properties).load()
             .where(F.col(at).between(F.lit(low), F.lit(high))))
    (new_rows(batch, known, key, order or [at]).write.format("jdbc")
     .options(url=url, dbtable=table, **properties).mode("append").save())


def hot_window(rows: DataFrame, as_of: Column, days: int, at: str = "event_time") -> DataFrame:
    """Rows of the hot layer: the last ``days`` days before ``as_of``."""
    return rows.where(F.col(at) >= as_of - F.make_interval(days=F.lit(days)))


def expired_dates(spark: SparkSession, path: str, as_of, days: int) -> list[str]:
    """Date folders of a table that lie wholly before the hot window."""
    dates = (spark.read.parquet(path).select(DATE).distinct()
             .where(F.col(DATE) < F.to_date(F.lit(as_of)) - days).orderBy(DATE))
    return [str(r[0]) for r in dates.collect()]


def insert_dead_letters(dead: DataFrame, path: str, writer: str, timed: bool = True) -> None:
    """Append dead letters by a hash of what failed, where and why; repeats add nothing.

    Each writing stream has a folder of its own, so that concurrent ones do not share a
    commit folder; reading the path gives all of them.  Within it folders follow the date
    of ``timestamp``.  If that is the message's own time (``timed``), a letter belongs to its
    date, and a replay looks it up in the dates of its batch only; otherwise the writer's
    whole history is searched.  Equal messages are one letter, so counts are of distinct
    letters, not of deliveries.
    """
    spark, own = dead.sparkSession, f"{path}/writer={writer}"
    what = F.to_json(F.struct("stage", "topic", "error", "original_message"))
    key = ["id", DATE] if timed else ["id"]
    rows = dated(dead.withColumn("id", F.sha2(what, 256)), "timestamp").dropDuplicates(key)
    target = existing(spark, own)
    if target is not None:
        rows = rows.join((same_dates(target, rows) if timed else target).select(*key), key, "left_anti")
    rows.hint("rebalance", F.col(DATE)).write.mode("append").partitionBy(DATE).parquet(own)
