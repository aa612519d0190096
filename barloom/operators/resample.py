"""Ticks to bars, bars to longer bars, bars to days."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.clean import fits

# The bar lengths offered, in minutes.
INTERVALS = {"1m": 1, "5m": 5, "1h": 60, "1d": 1440}

# Prices carry four decimals, so a price times this is a whole number.
PRICE_UNITS = 10_000


def _units(price: Column) -> Column:
    return F.round(price * PRICE_UNITS).cast("bigint")


def vwap_of() -> Column:
    return F.col("notional_units") / F.nullif(F.col("volume"), F.lit(0)) / PRICE_UNITS


def usable_tick(ts: str, price: str, size: str) -> Column:
    """A tick counts if its time, price and size are known, the price is a number within the stored type,
    and price times size is a whole number that can be added up."""
    units = F.when(fits(F.col(price)), _units(F.col(price)))
    return F.col(ts).isNotNull() & F.try_multiply(units, F.col(size)).isNotNull()


def unusable_ticks(
    ticks: DataFrame, ts: str = "event_time", price: str = "price", size: str = "size"
) -> DataFrame:
    """The dead letters among ticks: what :func:`resample_ohlcv` leaves out, with the reason."""
    missing = F.col(price).isNull() | F.isnan(price)
    reason = (
        F.when(F.col(ts).isNull(), "time").when(missing, "price").when(F.col(size).isNull(), "size").otherwise("range")
    )
    return ticks.filter(~usable_tick(ts, price, size)).withColumn("reason", reason)


def tick_order(ts: str = "event_time", tie_breaker: str | None = None) -> Column:
    """What "first" and "last" tick mean: by time, then by a non-negative id.

    Time and id are packed into one decimal because that type can live in a hash
    aggregation's buffer. A struct cannot, and would turn the aggregation into a
    sort of every tick.
    """
    if tie_breaker is None:
        return F.col(ts)
    micros = F.unix_micros(F.col(ts)).cast("decimal(19,0)")
    return (micros * F.lit(Decimal(10**19)) + F.col(tie_breaker)).cast("decimal(38,0)")


def bar_start(ts: Column, minutes: int) -> Column:
    """Start of the bar a moment falls into; bars are counted from the epoch in UTC."""
    micros = F.unix_micros(ts)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(minutes * 60_000_000).cast("bigint")))


def aggregate_ticks(price: str, size: str, order: str) -> list[Column]:
    """The aggregates of a bar. Sums are of integers, so order never changes them."""
    return [
        F.min_by(price, order).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, order).alias("close"),
        F.sum(size).alias("volume"),
        F.count("*").alias("num_trades"),
        F.sum(_units(F.col(price)) * F.col(size)).alias("notional_units"),
    ]


BAR = ["bar_start", "open", "high", "low", "close", "volume", "num_trades"]


def resample_ohlcv(
    ticks: DataFrame,
    minutes: int,
    *,
    key: str = "symbol",
    ts: str = "event_time",
    price: str = "price",
    size: str = "size",
    tie_breaker: str | None = None,
) -> DataFrame:
    """Bars of ``minutes`` from ticks; works on a batch or, with a watermark, a stream.

    One scan, one partial aggregation per map task, one shuffle of bars. A busy
    symbol is reduced to its bars before the shuffle. A stream groups by ``window``, which
    tells Spark when a bar is complete; a batch groups by the bar's start, a plain number.
    Ticks that :func:`unusable_ticks` names are left out.
    """
    ordered = ticks.filter(usable_tick(ts, price, size)).select(
        key, ts, price, size, tick_order(ts, tie_breaker).alias("_nth")
    )
    if ticks.isStreaming:
        bars = (
            ordered.groupBy(key, F.window(ts, f"{minutes} minutes").alias("_w"))
            .agg(*aggregate_ticks(price, size, "_nth"))
            .withColumn("bar_start", F.col("_w.start"))
        )
    else:
        bars = (
            ordered.groupBy(key, bar_start(F.col(ts), minutes).alias("bar_start"))
            .agg(*aggregate_ticks(price, size, "_nth"))
        )
    return bars.select(key, *BAR, vwap_of().alias("vwap"), "notional_units")


def rollup_bars(bars: DataFrame, minutes: int, *, key: str = "symbol") -> DataFrame:
    """Longer bars from shorter ones; same result as resampling the ticks.

    The longer interval must be a multiple of the shorter. Bar starts are unique per
    key, so opens and closes need no tie breaker.
    """
    rolled = bars.groupBy(key, bar_start(F.col("bar_start"), minutes).alias("_start")).agg(
        F.min_by("open", "bar_start").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "bar_start").alias("close"),
        F.sum("volume").alias("volume"),
        F.sum("num_trades").alias("num_trades"),
        F.sum("notional_units").alias("notional_units"),
    )
    return rolled.withColumnRenamed("_start", "bar_start").select(
        key, *BAR, vwap_of().alias("vwap"), "notional_units"
    )


def daily_summary(silver: DataFrame) -> DataFrame:
    """One row per symbol and day: first open, extremes, last close, volume."""
    return silver.groupBy("symbol", "trade_date").agg(
        F.min_by("open", "timestamp_ms").alias("day_open"),
        F.max("high").alias("day_high"),
        F.min("low").alias("day_low"),
        F.max_by("close", "timestamp_ms").alias("day_close"),
        F.sum("volume").alias("day_volume"),
    )
