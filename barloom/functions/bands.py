"""Traffic-light bands for health figures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band colours and the value each one starts at.
PCT_STEPS = (("red", None), ("yellow", -1), ("green", 0))
LATENCY_MS_STEPS = (("green", None), ("yellow", 60_000), ("red", 90_000))
RECORD_COUNT_STEPS = (("red", None), ("yellow", 5), ("green", 10))


def band(value: Column, steps: tuple[tuple[str, float | None], ...]) -> Column:
    """Name of the last step that ``value`` has reached; null stays null."""
    base, *higher = steps
    reached = reduce(
        lambda below, step: F.when(value >= step[1], F.lit(step[0])).otherwise(below),
        higher,
        F.lit(base[0]),
    )
    return F.when(value.isNotNull(), reached)


def pct_band(value: Column) -> Column:
    return band(value, PCT_STEPS)


def latency_band(value: Column) -> Column:
    return band(value, LATENCY_MS_STEPS)


def record_count_band(value: Column) -> Column:
    return band(value, RECORD_COUNT_STEPS)
