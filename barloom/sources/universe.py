"""Which symbols are tracked."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The tracked tickers.
TRACKED = ("AAPL", "MSFT", "GOOGL", "AMZN", "TSLA", "META", "NVDA", "JPM", "V", "JNJ")


def parse_symbols(text: str) -> list[str]:
    """Symbols from a comma-separated setting; white space around them and empty entries do not count."""
    return [symbol for part in text.split(",") if (symbol := part.strip())]


def symbols_in(settings: DataFrame, column: str) -> DataFrame:
    """The distinct symbols (column symbol) of comma-separated settings, one a row."""
    parts = settings.select(F.explode(F.split(column, ",")).alias("part"))
    return parts.select(F.trim("part").alias("symbol")).where("symbol <> ''").distinct()


def restrict_to(df: DataFrame, symbols: Sequence[str] | DataFrame = TRACKED) -> DataFrame:
    """Rows of tracked symbols.

    A list becomes a predicate, which reaches the scan. A table is semi-joined; Spark
    broadcasts it only if its measured size allows.
    """
    if isinstance(symbols, DataFrame):
        return df.join(symbols.select("symbol"), "symbol", "left_semi")
    return df.filter(F.col("symbol").isin(*symbols))
