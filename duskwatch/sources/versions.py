"""Reference tables in versions: a new one is written whole, then listed, then read.

A reader takes the highest listed version.  One that is being written, or whose writer was
lost, is not listed; publishing it again replaces it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F


def publish(table: DataFrame, path: str, version: int) -> None:
    (table.write.mode("overwrite").option("partitionOverwriteMode", "static")
     .parquet(f"{path}/data/version={version}"))
    listed = table.sparkSession.range(1).select(F.current_timestamp().alias("published_at"))
    (listed.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .parquet(f"{path}/versions/version={version}"))


def current_version(spark: SparkSession, path: str) -> int | None:
    """The highest listed version, None before the first one."""
    try:
        listed = spark.read.schema("published_at timestamp, version bigint").parquet(f"{path}/versions")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return listed.agg(F.max("version")).first()[0]


def current(spark: SparkSession, path: str) -> DataFrame:
    """The table in its highest listed version."""
    version = current_version(spark, path)
    if version is None:
        raise ValueError(f"no version is published at {path}")
    return spark.read.parquet(f"{path}/data/version={version}")
