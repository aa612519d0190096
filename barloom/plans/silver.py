"""Bronze to silver as one declarative plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from barloom.operators.clean import fill, usable
from barloom.operators.dedup import first_arrival
from barloom.operators.derive import add_price_columns, add_session_column, add_time_columns
from barloom.operators.rolling import DAY_MS, trailing_mean
from barloom.schemas import BRONZE, SILVER, conform


def distinct_bars(bronze: DataFrame) -> DataFrame:
    """Usable raw bars, one per key, gaps filled.

    Unusable rows go before deduplication, so a copy without prices never displaces a
    good one.
    """
    return fill(first_arrival(bronze.select(*BRONZE.fieldNames()).filter(usable())))


def widened(
    bars: DataFrame,
    *,
    rolling: bool = True,
    market_hours: str = "utc_fixed",
    bucket_ms: int = DAY_MS,
    history: DataFrame | None = None,
) -> DataFrame:
    """Silver's columns before they are cast: what the contract is checked on.

    The trailing mean comes before the derived columns: its shuffle then carries raw
    columns only. ``rolling=False`` leaves ``avg_volume_10bar`` out for readers that do
    not need it.
    """
    if rolling:
        bars = trailing_mean(bars, bucket_ms=bucket_ms, history=history)
    bars = bars.transform(add_time_columns).transform(add_price_columns)
    return add_session_column(bars, market_hours).withColumnRenamed("timestamp", "timestamp_ms")


def finish(bars: DataFrame, *, schema: StructType = SILVER, **options) -> DataFrame:
    """Derive and type the columns of distinct bars; options as for :func:`widened`.

    ``schema`` may hold columns of ``bars`` beyond silver's.
    """
    return conform(widened(bars, **options), schema)


def silver(bronze: DataFrame, **options) -> DataFrame:
    """Clean, deduplicate, derive and type raw bars; options as for :func:`widened`."""
    return finish(distinct_bars(bronze), **options)
