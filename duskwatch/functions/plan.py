"""Plan helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


# File bytes of a spread input that go to one task, and tasks a core gets of them before
# the tasks grow instead, up to the largest.
TASK_BYTES = 1 << 20
TASKS_A_CORE = 64
LARGEST_TASK_BYTES = 32 << 20


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan (file sizes, or exact for literal rows)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread_tasks(size: int, cores: int) -> int:
    """Tasks for an input of ``size`` file bytes: all cores are busy and no task is long."""
    return max(cores, min(-(-size // TASK_BYTES), TASKS_A_CORE * cores), -(-size // LARGEST_TASK_BYTES))


def spread(df: DataFrame) -> DataFrame:
    """Deal an input evenly to tasks before costly projections.

    A scan has no more busy tasks than its files have row groups: a small table often is
    one row group, a large one a few of a million rows.  The rows dealt are those of the
    files, narrow next to what is computed from them.
    """
    return df.repartition(spread_tasks(planned_bytes(df), df.sparkSession.sparkContext.defaultParallelism))


def settled(df: DataFrame, *columns: str) -> DataFrame:
    """Compute columns once, ahead of any later filter or join on them.

    Catalyst pushes a filter on a computed column below the computation and so
    evaluates it twice.  Nothing is pushed below a generator, so costly columns
    are led through one.
    """
    rest = [c for c in df.columns if c not in columns]
    packed = df.select(*rest, F.struct(*columns).alias("__settled"))
    return (packed.select(*rest, F.explode(F.array("__settled")).alias("__settled"))
            .select(*[F.col(f"__settled.{c}").alias(c) if c in columns else F.col(c)
                      for c in df.columns]))
