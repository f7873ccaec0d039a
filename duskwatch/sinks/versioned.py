"""An upserted table whose date folders are replaced by new versions, never in place.

Each batch writes the dates it touches whole into a folder of its own and then lists them.
A reader takes the highest listed version of each date, so it never meets a half-written
date, a job never overwrites what it reads, and a writer that is lost leaves a version that
nobody lists and that the next attempt replaces.  One writer at a time per table.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from duskwatch.sinks.tables import DATE, dated, merged, same_dates

NUMBER = "table_version"


def _listed(spark: SparkSession, path: str) -> DataFrame | None:
    """(date, version) of all complete writes, None before the first."""
    try:
        return spark.read.schema(f"{DATE} date, {NUMBER} bigint").parquet(f"{path}/versions")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _of_dates(rows: DataFrame, dates: DataFrame, how: str) -> DataFrame:
    """Rows by version and date; ``dates`` has one row per date, so it is shipped."""
    same = (rows[NUMBER] == dates[NUMBER]) & rows[DATE].cast("date").eqNullSafe(dates[DATE])
    return rows.join(F.broadcast(dates), same, how)


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The table as of now, None before its first write."""
    listed = _listed(spark, path)
    if listed is None:
        return None
    newest = listed.groupBy(DATE).agg(F.max(NUMBER).alias(NUMBER))
    return _of_dates(spark.read.parquet(f"{path}/data"), newest, "left_semi").drop(NUMBER)


def upsert(batch: DataFrame, path: str, key: str, version: list[str], at: str = "event_time") -> None:
    """Publish the batch's dates anew with the latest version of each key.

    Of a key's rows the batch's win over the table's, then the highest ``version`` wins, so a
    batch that is delivered again gives the same rows.  An empty batch publishes nothing.
    """
    spark = batch.sparkSession
    rows = dated(batch, at)
    if rows.isEmpty():
        return
    listed = _listed(spark, path)
    number = 1 if listed is None else listed.agg(F.max(NUMBER)).first()[0] + 1
    target = current(spark, path)
    if target is not None:
        target = same_dates(target, rows)
        days = rows.select(DATE).distinct()
        target = target.join(days, target[DATE].cast("date").eqNullSafe(days[DATE]), "left_semi")
    out = merged(target, rows, key, version)
    (out.hint("rebalance", F.col(DATE)).write.mode("overwrite")
     .option("partitionOverwriteMode", "static").partitionBy(DATE).parquet(f"{path}/data/{NUMBER}={number}"))
    (rows.select(DATE).distinct().coalesce(1).write.mode("overwrite")
     .option("partitionOverwriteMode", "static").parquet(f"{path}/versions/{NUMBER}={number}"))


def superseded(spark: SparkSession, path: str) -> DataFrame:
    """(date, version) folders that a later version replaced; no new reader needs them."""
    listed = _listed(spark, path)
    if listed is None:
        return spark.createDataFrame([], f"{DATE} date, {NUMBER} bigint")
    newest = listed.groupBy(DATE).agg(F.max(NUMBER).alias("newest"))
    same = listed[DATE].eqNullSafe(newest[DATE]) & (listed[NUMBER] < newest["newest"])
    return listed.join(F.broadcast(newest), same, "left_semi")
