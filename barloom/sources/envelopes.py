"""Bars from the JSON documents a market-data vendor answers with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.schemas import BRONZE, conform

# The vendor's field names and what they are called here.
VENDOR_NAMES = {
    "o": "open",
    "h": "high",
    "l": "low",
    "c": "close",
    "v": "volume",
    "vw": "vwap",
    "t": "timestamp",
    "n": "num_trades",
}
_PREV = (
    "status STRING, resultsCount BIGINT, results ARRAY<STRUCT<o: DOUBLE, h: DOUBLE, "
    "l: DOUBLE, c: DOUBLE, v: DOUBLE, vw: DOUBLE, t: BIGINT, n: DOUBLE>>"
)
_SNAPSHOT = (
    "status STRING, tickers ARRAY<STRUCT<ticker: STRING, "
    "day: STRUCT<o: DOUBLE, h: DOUBLE, l: DOUBLE, c: DOUBLE, v: DOUBLE, vw: DOUBLE, n: DOUBLE>, "
    "lastTrade: STRUCT<t: BIGINT>>>"
)
REFUSED = "NOT_AUTHORIZED"


def parse_prev_envelope(
    answers: DataFrame, ingestion_ms: Column, symbol: str = "symbol", body: str = "body"
) -> DataFrame:
    """Raw bars from one-symbol answers; ``symbol`` names whom each answer is about.

    Refused, empty and unreadable answers give no rows.
    """
    doc = answers.select(
        F.col(symbol).alias("symbol"),
        ingestion_ms.alias("ingestion_time"),
        F.from_json(body, _PREV).alias("doc"),
    )
    bars = (
        doc.filter(
            (F.coalesce("doc.status", F.lit("")) != REFUSED) & (F.col("doc.resultsCount") > 0)
        )
        .select("symbol", "ingestion_time", F.inline("doc.results"))
        .withColumnsRenamed(VENDOR_NAMES)
    )
    return conform(bars, BRONZE)


def unusable_answers(answers: DataFrame, body: str = "body") -> DataFrame:
    """The dead letters among one-symbol answers: what :func:`parse_prev_envelope` gives no bar for, with the reason.

    ``unreadable``: no JSON object of that form; ``refused``: the vendor declined; ``empty``: no results.
    """
    doc = F.from_json(body, _PREV)
    reason = (
        F.when(F.coalesce(doc["status"], doc["resultsCount"].cast("string")).isNull() & doc["results"].isNull(), "unreadable")
        .when(doc["status"] == REFUSED, "refused")
        .when(F.coalesce(doc["resultsCount"], F.lit(0)) <= 0, "empty")
        .when(F.coalesce(F.size(doc["results"]), F.lit(0)) <= 0, "empty")
    )
    return answers.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def parse_snapshot_envelope(
    answers: DataFrame, ingestion_ms: Column, body: str = "body"
) -> DataFrame:
    """Raw bars from many-symbol snapshots; symbols without a bar today are left out."""
    rows = answers.select(
        ingestion_ms.alias("ingestion_time"), F.inline(F.from_json(body, _SNAPSHOT)["tickers"])
    )
    bars = (
        rows.filter(F.col("day.o").isNotNull())
        .select(
            F.col("ticker").alias("symbol"),
            "ingestion_time",
            "day.*",
            F.col("lastTrade.t").alias("t"),
        )
        .withColumnsRenamed(VENDOR_NAMES)
    )
    return conform(bars, BRONZE)
