"""Which raw bars count, and how their gaps are filled."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ("symbol", "timestamp")
PRICES = ("open", "high", "low", "close")
#: Prices from here on do not fit the stored type of 12 digits, four of them decimals.
TOO_WIDE = 99_999_999.99995


def has_key() -> Column:
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in KEYS])


def fits(price: Column) -> Column:
    """Finite and within the stored type; false for NaN, which sorts above every number, and null for null."""
    return F.abs(price) < TOO_WIDE


def has_prices() -> Column:
    """All four prices are present; NaN is not null in Spark and is no price either."""
    return reduce(Column.__and__, [F.col(c).isNotNull() & ~F.isnan(c) for c in PRICES])


def prices_fit() -> Column:
    return reduce(Column.__and__, [F.coalesce(fits(F.col(c)), F.lit(False)) for c in PRICES])


def counts_fit(name: str) -> Column:
    """A count is missing or a number that can be stored as a whole one."""
    return F.col(name).isNull() | F.col(name).try_cast("bigint").isNotNull()


def usable() -> Column:
    return has_key() & prices_fit() & counts_fit("volume") & counts_fit("num_trades")


def fill(df: DataFrame) -> DataFrame:
    """Close stands in for a vwap that is missing or no number, zero for missing trades; counts become whole."""
    return df.withColumns(
        {
            "vwap": F.coalesce(F.when(fits(F.col("vwap")), F.col("vwap")), F.col("close")),
            "num_trades": F.coalesce(F.col("num_trades").try_cast("bigint"), F.lit(0)),
            "volume": F.col("volume").try_cast("bigint"),
        }
    )


def clean_bars(bronze: DataFrame) -> DataFrame:
    return fill(bronze.filter(usable()))


def unusable_bars(bronze: DataFrame) -> DataFrame:
    """The dead letters among bars: the rows :func:`clean_bars` leaves out, with the reason.

    ``key``: symbol or time is missing; ``prices``: a price is missing or NaN; ``range``: a price
    is infinite or too wide for the stored type; ``volume``, ``num_trades``: that count is NaN or too large.
    """
    reason = F.when(~has_key(), "key").when(~has_prices(), "prices").when(~prices_fit(), "range")
    reason = reason.when(~counts_fit("volume"), "volume").otherwise("num_trades")
    return bronze.filter(~usable()).withColumn("reason", reason)
