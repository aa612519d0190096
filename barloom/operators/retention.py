"""How long data stays, by age in days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Days after which data turns cold and after which it expires.
COLD_AFTER_DAYS = 7
EXPIRE_AFTER_DAYS = 30


def retention_tier(
    day: Column,
    as_of: Column,
    cold_after: int = COLD_AFTER_DAYS,
    expire_after: int = EXPIRE_AFTER_DAYS,
) -> Column:
    age = F.datediff(as_of, day)
    return (
        F.when(age >= expire_after, "expired").when(age >= cold_after, "cold").otherwise("hot")
    )


def retention_tiers(
    df: DataFrame,
    day: str = "trade_date",
    as_of: Column | None = None,
    cold_after: int = COLD_AFTER_DAYS,
    expire_after: int = EXPIRE_AFTER_DAYS,
) -> DataFrame:
    """Rows and tier of every day, counted from ``as_of`` or the latest day held."""
    per_day = df.groupBy(day).agg(F.count("*").alias("row_count"))
    if as_of is None:
        as_of = df.agg(F.max(day)).scalar()
    return per_day.select(
        day, "row_count", retention_tier(F.col(day), as_of, cold_after, expire_after).alias("tier")
    )


def unexpired(
    df: DataFrame, as_of: Column, day: str = "trade_date", expire_after: int = EXPIRE_AFTER_DAYS
) -> DataFrame:
    """Rows that have not expired; the filter is on the stored date, so it prunes the scan."""
    return df.filter(F.col(day) > F.date_sub(as_of, expire_after))
