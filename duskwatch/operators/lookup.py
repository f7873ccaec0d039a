"""Left join to a reference table, broadcast only when it is known to be small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from duskwatch.functions.plan import planned_bytes

BROADCAST_BYTES = 64 << 20


def lookup_join(rows: DataFrame, table: DataFrame, on: Column,
                limit: int = BROADCAST_BYTES) -> DataFrame:
    """Left join ``rows`` to ``table``; no row of ``rows`` is lost.

    ``table`` must hold one row per key.  Up to ``limit`` bytes it is broadcast
    and ``rows`` is not shuffled.  Beyond that it is a shuffled join, in which
    AQE splits the partitions of hot keys.
    """
    if not table.isStreaming and planned_bytes(table) <= limit:
        table = F.broadcast(table)
    return rows.join(table, on, "left")
