"""Columns computed from one bar. Everything here stays inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The trading session, as minutes of the day.
SESSION_UTC = (14 * 60 + 30, 21 * 60)
SESSION_EXCHANGE = (9 * 60 + 30, 16 * 60)
EXCHANGE_TZ = "America/New_York"


def event_time(epoch_ms: Column) -> Column:
    return F.timestamp_millis(epoch_ms)


def _minute_of_day(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def is_market_hours(ts: Column, mode: str = "utc_fixed") -> Column:
    """Whether a bar starts inside the session.

    ``utc_fixed`` compares with one UTC interval all year. ``exchange_tz`` goes
    by the exchange's own clock, so it moves with daylight saving.
    """
    if mode == "utc_fixed":
        start, end = SESSION_UTC
    elif mode == "exchange_tz":
        ts = F.from_utc_timestamp(ts, EXCHANGE_TZ)
        start, end = SESSION_EXCHANGE
    else:
        raise ValueError(f"unknown market-hours mode: {mode}")
    return _minute_of_day(ts).between(start, end - 1)


def price_change(open_: Column, close: Column) -> Column:
    return close - open_


def _percent_of(part: Column, whole: Column) -> Column:
    return F.coalesce(part / F.nullif(whole, F.lit(0.0)) * 100, F.lit(0.0))


def price_change_pct(open_: Column, close: Column) -> Column:
    """Close against open in percent; a bar that opens at zero counts as unchanged."""
    return _percent_of(close - open_, open_)


def bar_range_pct(open_: Column, high: Column, low: Column) -> Column:
    return _percent_of(high - low, open_)
