"""The columns the silver table adds to a clean bar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom import functions as B


def add_time_columns(df: DataFrame) -> DataFrame:
    at = B.event_time(F.col("timestamp"))
    return df.withColumns(
        {
            "event_time": at,
            "trade_date": F.to_date(at),
            "hour": F.hour(at),
            "minute": F.minute(at),
        }
    )


def add_price_columns(df: DataFrame) -> DataFrame:
    o, h, lo, c = (F.col(n) for n in ("open", "high", "low", "close"))
    return df.withColumns(
        {
            "price_change": B.price_change(o, c),
            "price_change_pct": B.price_change_pct(o, c),
            "bar_range_pct": B.bar_range_pct(o, h, lo),
        }
    )


def add_session_column(df: DataFrame, mode: str = "utc_fixed") -> DataFrame:
    return df.withColumn("is_market_hours", B.is_market_hours(F.col("event_time"), mode))
