"""Reading the hour-partitioned archive with partition pruning."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from duskwatch import schemas

PARTITIONS = "year int, month int, day int, hour int"


def hour_range(start: datetime | None, end: datetime | None) -> Column:
    """Predicate on the partition columns for start <= time < end (UTC); None leaves a side open.

    Written as an ordered comparison of (year, month, day, hour), so that only
    the folders of the range are listed and read.
    """
    def at_least(t, strict):
        levels = [("year", t.year), ("month", t.month), ("day", t.day), ("hour", t.hour)]
        test = F.col("hour") > t.hour if strict else F.col("hour") >= t.hour
        for name, value in reversed(levels[:-1]):
            test = (F.col(name) > value) | ((F.col(name) == value) & test)
        return test

    inside = F.lit(True) if start is None else at_least(start, strict=False)
    if end is None:
        return inside
    # The last hour counts when the range reaches into it.
    last_full = (end.minute, end.second, end.microsecond) == (0, 0, 0)
    return inside & ~at_least(end, strict=not last_full)


def read_lake(spark: SparkSession, path: str, layer: str | None = None, fmt: str = "json",
              start: datetime | None = None, end: datetime | None = None,
              outer: str | None = None) -> DataFrame:
    """An archived layer, optionally only the hours of a time range.

    ``outer`` declares partition columns above the year, if there are any.

    JSON needs a declared schema: inferring one would read the whole archive.
    """
    reader = spark.read
    if layer is not None:
        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}"
                           for f in schemas.layer_schema(layer).fields)
        reader = reader.schema(", ".join([fields, *([outer] if outer else []), PARTITIONS]))
    rows = reader.format(fmt).load(path)
    return rows if start is None and end is None else rows.where(hour_range(start, end))


def read_archive(spark: SparkSession, path: str, layer: str | None = None, fmt: str = "json",
                 start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """The complete batches of a streamed archive (``sinks.lake.write_batch``).

    The list of batches is joined on partition columns, so the folders of a batch that was
    never finished are pruned like those outside the time range.
    """
    keys = ["stream", "batch"]
    listed = spark.read.schema("completed_at timestamp, stream string, batch bigint").parquet(f"{path}/_batches")
    rows = read_lake(spark, path, layer, fmt, start, end, "stream string, batch bigint")
    return rows.join(listed.select(*keys), keys, "left_semi")
