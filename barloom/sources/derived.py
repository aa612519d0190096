"""Market-bar inputs derived from the given event and order tables."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.resample import aggregate_ticks, resample_ohlcv
from barloom.schemas import BRONZE
from barloom.sources.envelopes import REFUSED, VENDOR_NAMES
from barloom.sources.messages import encode_messages, to_base64

DAY_MS = 86_400_000


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ticks_from(events: DataFrame) -> DataFrame:
    """Events as ticks: the type is the symbol, the value the price, ``k`` the size."""
    return events.select(
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("size"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("event_id").alias("tick_id"),
    )


def ticks_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_from(load(spark, sf_dir, "events"))


def bronze_from_ticks(ticks: DataFrame, bar_minutes: int = 60) -> DataFrame:
    """Raw bars with planted gaps and late copies, so that every cleaning rule has work.

    All choices hang on ``hx``, the number of the bar since the epoch.
    """
    bar_ms = bar_minutes * 60_000
    bars = resample_ohlcv(ticks, bar_minutes, tie_breaker="tick_id")
    hx = F.expr(f"timestamp div {bar_ms}")
    first = F.col("timestamp") + (hx * 7919 + F.col("num_trades")) % 150_000
    arrivals = F.when(hx % 5 == 0, F.array(first, first + 10_000)).otherwise(F.array(first))
    return (
        bars.withColumn("timestamp", F.unix_millis("bar_start"))
        .withColumn("ingestion_time", F.explode(arrivals))
        .select(
            "symbol",
            F.when((hx % 11 != 0) | (F.col("symbol") != "view"), F.col("open")).alias("open"),
            "high",
            "low",
            "close",
            F.col("volume").cast("double").alias("volume"),
            F.when(hx % 6 != 0, F.col("vwap")).alias("vwap"),
            "timestamp",
            F.when(hx % 7 != 0, F.col("num_trades").cast("double")).alias("num_trades"),
            "ingestion_time",
        )
    )


def bronze_from_events(spark: SparkSession, sf_dir: str, bar_minutes: int = 60) -> DataFrame:
    return bronze_from_ticks(ticks_from_events(spark, sf_dir), bar_minutes)


def faulty_bronze(bronze: DataFrame, bar_minutes: int = 60) -> DataFrame:
    """Raw bars some of which miss their key or hold prices that cannot be stored."""
    hx = F.expr(f"timestamp div {bar_minutes * 60_000}")
    return bronze.withColumns(
        {
            "open": F.when(hx % 19 == 0, F.lit(float("inf"))).otherwise(F.col("open")),
            "high": F.when(hx % 31 == 0, F.lit(float("nan"))).otherwise(F.col("high")),
            "close": F.when(hx % 29 == 0, F.lit(123_456_789.0)).otherwise(F.col("close")),
            "symbol": F.when(hx % 23 != 0, F.col("symbol")),
            "volume": F.when(hx % 37 == 0, F.lit(1e300)).when(hx % 41 == 0, F.lit(float("nan"))).otherwise(F.col("volume")),
            "num_trades": F.when(hx % 43 == 0, F.lit(float("-inf"))).otherwise(F.col("num_trades")),
        }
    )


def breached_bronze(bronze: DataFrame, bar_minutes: int = 60) -> DataFrame:
    """Raw bars with a fault for every rule of the contract: too wide, missing, and symbols too long."""
    hx = F.expr(f"timestamp div {bar_minutes * 60_000}")
    wide = lambda name, n, value: F.when(hx % n == 0, F.lit(value)).otherwise(F.col(name))
    return bronze.withColumns(
        {
            "symbol": F.when(hx % 53 == 0, F.lit(None)).when(hx % 47 == 0, F.concat("symbol", F.lit("-of-many-letters"))).otherwise(F.col("symbol")),
            "open": F.when(hx % 17 == 0, F.lit(1e-9)).otherwise(wide("open", 59, 1e12)),
            "high": F.when(hx % 103 == 0, F.lit(None)).otherwise(wide("high", 61, float("nan"))),
            "low": F.when(hx % 107 == 0, F.lit(None)).otherwise(wide("low", 67, float("-inf"))),
            "close": F.when(hx % 109 == 0, F.lit(None)).otherwise(wide("close", 71, 4e8)),
            "vwap": wide("vwap", 73, 2e9),
            "volume": F.when(hx % 79 == 0, F.lit(None)).when(hx % 101 == 0, F.lit(1e300)).otherwise(wide("volume", 13, 9e17)),
            "timestamp": F.when(hx % 83 == 0, F.lit(None)).otherwise(F.col("timestamp")),
            "num_trades": wide("num_trades", 89, 1e300),
        }
    )


def faulty_ticks(ticks: DataFrame) -> DataFrame:
    """Ticks some of which miss a price or a size or hold a price that cannot be stored."""
    n = F.col("tick_id")
    return ticks.withColumns(
        {
            "price": F.when(n % 41 == 0, F.lit(float("nan")))
            .when(n % 43 == 0, F.lit(None))
            .when(n % 47 == 0, F.lit(1e12))
            .otherwise(F.col("price")),
            "size": F.when(n % 53 != 0, F.col("size")),
        }
    )


def bars_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily raw bars per supplier: many symbols, one bar a day.

    Lines of a day have no time, so their order is (order, line, part), packed into one
    decimal: 16 digits of order key, 2 of line number, 19 of part key.
    """
    nth = (
        F.col("l_orderkey").cast("decimal(16,0)") * F.lit(Decimal(10**21))
        + F.col("l_linenumber").cast("decimal(2,0)") * F.lit(Decimal(10**19))
        + F.col("l_partkey").cast("decimal(19,0)")
    )
    lines = load(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_suppkey")).alias("symbol"),
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("timestamp"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").cast("bigint").alias("size"),
        nth.cast("decimal(38,0)").alias("nth"),
    )
    bars = lines.groupBy("symbol", "timestamp").agg(
        *aggregate_ticks("price", "size", "nth")
    )
    vwap = F.col("notional_units") / F.nullif(F.col("volume"), F.lit(0)) / 10_000
    day = F.expr(f"timestamp div {DAY_MS}")
    return bars.select(
        "symbol", "open", "high", "low", "close",
        F.col("volume").cast("double").alias("volume"),
        vwap.alias("vwap"),
        "timestamp",
        F.col("num_trades").cast("double").alias("num_trades"),
        (F.col("timestamp") + (day * 7919 + F.col("num_trades")) % 150_000).alias("ingestion_time"),
    ).select(*BRONZE.fieldNames())


def transport_from_bronze(
    bronze: DataFrame, bar_minutes: int = 60, planted: bool = True
) -> DataFrame:
    """Bars as transport records; if ``planted``, some are not base64 and some not JSON."""
    hx = F.expr(f"timestamp div {bar_minutes * 60_000}")
    extras = {
        "sequenceNumber": F.concat_ws("-", "symbol", "timestamp", "ingestion_time"),
        "approximateArrivalTimestamp": F.col("ingestion_time") / 1000,
        "hx": hx,
    }
    messages = encode_messages(bronze.withColumns(extras), keep=tuple(extras))
    data = to_base64(F.col("value"))
    if planted:
        data = (
            F.when(F.col("hx") % 13 == 0, F.lit("?? no letters of that code ??"))
            .when(F.col("hx") % 17 == 0, to_base64(F.lit("[ cut off here")))
            .otherwise(data)
        )
    return messages.select(
        "key", data.alias("data"), "sequenceNumber", "approximateArrivalTimestamp"
    )


def prev_answers_from_bronze(bronze: DataFrame, bar_minutes: int = 60) -> DataFrame:
    """One-bar vendor answers, some refused and some empty."""
    hx = F.expr(f"timestamp div {bar_minutes * 60_000}")
    bar = F.struct(*[F.col(name).alias(short) for short, name in VENDOR_NAMES.items()])
    answer = F.struct(
        F.when(hx % 13 == 0, REFUSED).otherwise("OK").alias("status"),
        F.when(hx % 17 == 0, 0).otherwise(1).alias("resultsCount"),
        F.array(bar).alias("results"),
    )
    return bronze.select("symbol", F.to_json(answer).alias("body"))


def snapshot_answers_from_bronze(bronze: DataFrame) -> DataFrame:
    """Vendor snapshots of two tickers each, the second one without a bar."""

    def ticker(name, with_bar: bool):
        day = F.struct(
            *[
                (F.col(n) if with_bar else F.lit(None).cast("double")).alias(s)
                for s, n in VENDOR_NAMES.items()
                if s != "t"
            ]
        )
        last = F.struct(F.col("timestamp").alias("t"))
        return F.struct(name.alias("ticker"), day.alias("day"), last.alias("lastTrade"))

    tickers = F.array(ticker(F.col("symbol"), True), ticker(F.lit("IDLE"), False))
    answer = F.struct(F.lit("OK").alias("status"), tickers.alias("tickers"))
    return bronze.select(F.to_json(answer).alias("body"))
