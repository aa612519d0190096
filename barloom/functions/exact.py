"""Aggregates whose result does not depend on the order rows arrive in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_mean(value: Column, scale: int) -> Column:
    """Mean of a decimal column, rounded once, half up, to ``scale`` digits.

    ``avg`` of a decimal keeps only four digits more than its input, and rounding
    that again can land on the wrong side of a half. Dividing the exact sum by the
    exact count leaves more than twenty digits to round from.
    """
    return F.round(F.sum(value) / F.count(value).cast("decimal(20,0)"), scale).cast(
        f"decimal(12,{scale})"
    )
