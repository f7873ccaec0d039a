"""Durations written as text, and microsecond instants."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds(duration: str) -> int:
    """Seconds of a duration such as ``"10 minutes"``."""
    amount, unit = duration.split()
    return int(amount) * _UNIT_SECONDS[unit.rstrip("s")]


def micros(duration: str) -> int:
    return seconds(duration) * 1_000_000


def minutes_of(duration: str) -> int:
    return seconds(duration) // 60


def micros_of(instant: Column) -> Column:
    return F.unix_micros(instant)


def bucket_of(instant: Column, width: str) -> Column:
    """Number of the fixed-width time bucket an instant falls into."""
    return F.floor(F.unix_micros(instant) / F.lit(micros(width))).cast("bigint")
