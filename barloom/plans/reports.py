"""The named reports. Each takes a silver (or gold) table and returns a DataFrame.

``as_of`` picks the day; left out, it is the latest day in the table, found by a
scalar subquery that the scan uses as a partition or row-group filter.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom import functions as B
from barloom.operators.resample import bar_start
from barloom.operators.resample import daily_summary as collapse_days
from barloom.operators.rolling import DAY_MS, trailing_mean
from barloom.schemas import FOLDER_OF, ONLY_DATE

Day = date | str | None

# Report sizes and the spike factor.
SPIKE_FACTOR = 2
SLOWEST_ROWS = 20
HISTORY_ROWS = 30
LOAD_CHECK_DAYS = 10
SUMMARY_DAYS = 7


def _day(bars: DataFrame, as_of: Day) -> Column:
    if as_of is None:
        folder = FOLDER_OF["trade_date"]
        if folder not in bars.columns:
            return bars.agg(F.max("trade_date")).scalar()
        as_of = bars.schema[folder].metadata.get(ONLY_DATE)
        if as_of is None:
            return bars.agg(F.max(folder)).scalar()
    return F.lit(as_of).cast("date")


def on_day(bars: DataFrame, as_of: Day = None) -> DataFrame:
    """Bars of one day; of a table in date folders, only that folder is read."""
    day = _day(bars, as_of)
    rows = bars.filter(F.col("trade_date") == day)
    folder = FOLDER_OF["trade_date"]
    return rows.filter(F.col(folder) == day) if folder in bars.columns else rows


# --- bars ---------------------------------------------------------------------


def bars_for_date(bars: DataFrame, as_of: Day = None) -> DataFrame:
    """Every bar of the day, newest first within a symbol."""
    return (
        on_day(bars, as_of)
        .orderBy("symbol", F.col("event_time").desc())
        .select(
            "symbol", "trade_date", "open", "high", "low", "close",
            "volume", "vwap", "price_change_pct", "is_market_hours",
        )
    )


def latest_bar_per_symbol(bars: DataFrame) -> DataFrame:
    """The newest bar of each symbol.

    Every column is the value at the largest timestamp, which is unique per symbol, so
    all come from one row; the aggregation keeps one row per symbol on the map side.
    """
    columns = [
        "trade_date", "event_time", "open", "high", "low", "close",
        "volume", "vwap", "price_change_pct", "is_market_hours",
    ]
    return bars.groupBy("symbol").agg(
        *[F.max_by(c, "timestamp_ms").alias(c) for c in columns]
    ).orderBy("symbol")


def close_by_symbol(bars: DataFrame, as_of: Day = None) -> DataFrame:
    close = F.col("close").cast("double")
    return on_day(bars, as_of).select("symbol", close.alias("close")).orderBy(F.desc("close"))


def close_series(bars: DataFrame, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
    """Closes over time, from ``since`` up to but without ``until``; of a table in date folders only those in between are read."""
    folder = FOLDER_OF["trade_date"]
    days = [c for c in ("trade_date", folder) if c in bars.columns]
    if since is not None:
        bars = bars.filter(F.col("event_time") >= F.lit(since))
        for day in days:
            bars = bars.filter(F.col(day) >= F.to_date(F.lit(since)))
    if until is not None:
        bars = bars.filter(F.col("event_time") < F.lit(until))
        for day in days:
            bars = bars.filter(F.col(day) <= F.to_date(F.lit(until)))
    return bars.select("symbol", "event_time", F.col("close").cast("double").alias("close")).orderBy("symbol", "event_time")


def symbol_history(bars: DataFrame, symbol: str, rows: int = HISTORY_ROWS) -> DataFrame:
    """The latest bars of one symbol, newest first; the symbol is a value and never part of a query's text."""
    prices = [F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close")]
    newest = bars.filter(F.col("symbol") == F.lit(symbol)).orderBy(F.desc("trade_date"), F.desc("event_time")).limit(rows)
    return newest.select("trade_date", *prices, "volume")


# --- movers -------------------------------------------------------------------


def _mover_stats(bars: DataFrame) -> DataFrame:
    pct = F.col("price_change_pct")
    return bars.groupBy("symbol").agg(
        F.max(pct).alias("max_gain_pct"),
        F.min(pct).alias("max_loss_pct"),
        B.exact_mean(pct, 4).alias("avg_change_pct"),
        F.sum("volume").alias("total_volume"),
        F.count("*").alias("bar_count"),
    )


def top_movers(bars: DataFrame, as_of: Day = None) -> DataFrame:
    """Movers by the size of their largest gain (a symbol that only fell ranks low)."""
    return _mover_stats(on_day(bars, as_of)).orderBy(F.abs("max_gain_pct").desc(), "symbol")


def top_movers_abs(bars: DataFrame, as_of: Day = None) -> DataFrame:
    """Movers by their largest move in either direction."""
    moved = F.greatest(F.abs("max_gain_pct"), F.abs("max_loss_pct"))
    return (
        _mover_stats(on_day(bars, as_of))
        .withColumn("max_move_pct", moved)
        .orderBy(F.desc("max_move_pct"), "symbol")
    )


def top_movers_gain(bars: DataFrame, as_of: Day = None) -> DataFrame:
    return (
        _mover_stats(on_day(bars, as_of))
        .select("symbol", "max_gain_pct", "max_loss_pct", "total_volume")
        .orderBy(F.desc("max_gain_pct"), "symbol")
    )


def top_movers_panel(bars: DataFrame, as_of: Day = None) -> DataFrame:
    """Distinct (close, change) pairs per symbol with their volume and colour band."""
    return (
        on_day(bars, as_of)
        .groupBy("symbol", "close", "price_change_pct")
        .agg(F.sum("volume").alias("total_volume"))
        .select(
            "symbol",
            F.col("close").cast("double").alias("close"),
            F.col("price_change_pct").cast("double").alias("price_change_pct"),
            "total_volume",
        )
        .orderBy(F.desc("price_change_pct"), "symbol", "close")
    )


def mover_bands(bars: DataFrame, as_of: Day = None) -> DataFrame:
    panel = top_movers_panel(bars, as_of)
    return panel.withColumn("pct_band", B.pct_band(F.col("price_change_pct")))


# --- volume -------------------------------------------------------------------


def volume_by_symbol(bars: DataFrame, as_of: Day = None) -> DataFrame:
    return (
        on_day(bars, as_of)
        .groupBy("symbol")
        .agg(F.sum("volume").alias("total_volume"))
        .orderBy(F.desc("total_volume"), "symbol")
    )


def volume_spikes(bars: DataFrame, as_of: Day = None, all_days: bool = False) -> DataFrame:
    """Bars above twice the stored trailing mean, on one day or on all of them."""
    mean = F.col("avg_volume_10bar")
    return (
        (bars if all_days else on_day(bars, as_of))
        .filter(mean.isNotNull() & (F.col("volume") > SPIKE_FACTOR * mean))
        .select(
            "symbol",
            "event_time",
            "volume",
            F.round(mean, 0).cast("decimal(18,0)").alias("trailing_avg_volume"),
            F.round(F.col("volume") / F.nullif(mean, F.lit(0)), 2)
            .try_cast("decimal(18,2)")
            .alias("volume_ratio"),
        )
        .hint("rebalance")  # the sort samples its input first: the spikes, not the means once more
        .orderBy(F.desc("volume_ratio"), "symbol", "event_time")
    )


def volume_spikes_intraday(
    bars: DataFrame, as_of: Day = None, bucket_ms: int = DAY_MS
) -> DataFrame:
    """As above, with the mean taken over the day's own bars only."""
    today = on_day(bars, as_of).select("symbol", "event_time", "timestamp_ms", "volume")
    rolled = trailing_mean(today, order="timestamp_ms", out="avg_vol", bucket_ms=bucket_ms)
    return rolled.filter(F.col("volume") > SPIKE_FACTOR * F.col("avg_vol")).select(
        "symbol", "event_time", "volume", "avg_vol"
    )


# --- days ---------------------------------------------------------------------


def _last_days(bars: DataFrame, as_of: Day, days: int) -> DataFrame:
    """Bars of the last days; of a table in date folders, only their folders are read."""
    since = F.date_sub(_day(bars, as_of), days)
    rows = bars.filter(F.col("trade_date") >= since)
    folder = FOLDER_OF["trade_date"]
    return rows.filter(F.col(folder) >= since) if folder in bars.columns else rows


def daily_summary(bars: DataFrame, as_of: Day = None, days: int = SUMMARY_DAYS) -> DataFrame:
    return collapse_days(_last_days(bars, as_of, days)).orderBy("symbol", F.desc("trade_date"))


def daily_summary_as_written(
    bars: DataFrame, as_of: Day = None, days: int = SUMMARY_DAYS
) -> DataFrame:
    """One row per bar: its own extremes and volume beside the day's open and close.

    Open and close of the day come from an aggregate of one row per symbol and day
    that is joined back, so a busy day is never gathered into one window partition.
    """
    recent = _last_days(bars, as_of, days)
    rows = recent.groupBy("symbol", "trade_date", "open", "close", "event_time").agg(
        F.max("high").alias("day_high"),
        F.min("low").alias("day_low"),
        F.sum("volume").alias("day_volume"),
    )
    ends = recent.groupBy("symbol", "trade_date").agg(
        F.min_by("open", "event_time").alias("day_open"),
        F.max_by("close", "event_time").alias("day_close"),
    )
    return (
        rows.join(ends, ["symbol", "trade_date"])
        .orderBy("symbol", F.desc("trade_date"), "event_time")
        .select(
            "symbol", "trade_date", "day_open", "day_high", "day_low", "day_close", "day_volume"
        )
    )


def completeness(bars: DataFrame) -> DataFrame:
    return (
        bars.groupBy("trade_date", "symbol")
        .agg(
            F.count("*").alias("bar_count"),
            F.min("event_time").alias("first_bar"),
            F.max("event_time").alias("last_bar"),
        )
        .orderBy(F.desc("trade_date"), "symbol")
    )


def load_check(bars: DataFrame, days: int = LOAD_CHECK_DAYS) -> DataFrame:
    """Rows and symbols of the latest days.

    Counting per (day, symbol) first keeps the distinct count to one row per pair.
    """
    return (
        bars.groupBy("trade_date", "symbol")
        .agg(F.count("*").alias("n"))
        .groupBy("trade_date")
        .agg(F.sum("n").alias("row_count"), F.count("symbol").alias("symbol_count"))
        .orderBy(F.desc("trade_date"))
        .limit(days)
    )


# --- pipeline health ------------------------------------------------------------


def _latency() -> Column:
    return F.col("ingestion_time") - F.col("timestamp_ms")


def _mean_latency() -> Column:
    return F.sum(_latency()) / F.nullif(F.count(_latency()), F.lit(0))


def latency_top(bars: DataFrame, as_of: Day = None, rows: int = SLOWEST_ROWS) -> DataFrame:
    return (
        on_day(bars, as_of)
        .select(
            "symbol", "event_time", "timestamp_ms", "ingestion_time",
            _latency().alias("latency_ms"),
            F.round(_latency().cast("decimal(19,0)") / 1000, 1)
            .cast("decimal(20,1)")
            .alias("latency_sec"),
        )
        .orderBy(F.desc("latency_ms"), "symbol", "timestamp_ms")
        .limit(rows)
    )


def avg_latency(bars: DataFrame, as_of: Day = None) -> DataFrame:
    return on_day(bars, as_of).agg(_mean_latency().alias("avg_latency_ms"))


def record_count(bars: DataFrame, as_of: Day = None) -> DataFrame:
    return on_day(bars, as_of).agg(F.count("*").alias("record_count"))


def health_bands(bars: DataFrame, as_of: Day = None) -> DataFrame:
    """Average latency and record count of the day with their bands."""
    figures = on_day(bars, as_of).agg(
        _mean_latency().alias("avg_latency_ms"), F.count("*").alias("record_count")
    )
    return figures.withColumns(
        {
            "latency_band": B.latency_band(F.col("avg_latency_ms")),
            "record_count_band": B.record_count_band(F.col("record_count")),
        }
    )


def ingest_lag(bronze: DataFrame, minutes: int = 60) -> DataFrame:
    """How far ingestion ran behind the bars, per period of ingestion time."""
    lag = F.col("ingestion_time") - F.col("timestamp")
    period = bar_start(F.timestamp_millis("ingestion_time"), minutes)
    return bronze.groupBy(period.alias("period_start")).agg(
        F.max(lag).alias("max_lag_ms"), F.count("*").alias("record_count")
    )
