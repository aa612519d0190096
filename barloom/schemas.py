"""Table schemas of the three layers and the contract of the gold table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names, order and types of the stored tables.
BRONZE = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("vwap", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("num_trades", T.DoubleType()),
        T.StructField("ingestion_time", T.LongType()),
    ]
)

PRICE = T.DecimalType(12, 4)
PERCENT = T.DecimalType(8, 4)
MEAN_VOLUME = T.DecimalType(18, 2)

SILVER = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("open", PRICE),
        T.StructField("high", PRICE),
        T.StructField("low", PRICE),
        T.StructField("close", PRICE),
        T.StructField("volume", T.LongType()),
        T.StructField("vwap", PRICE),
        T.StructField("timestamp_ms", T.LongType()),
        T.StructField("num_trades", T.LongType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("trade_date", T.DateType()),
        T.StructField("price_change", PRICE),
        T.StructField("price_change_pct", PERCENT),
        T.StructField("bar_range_pct", PERCENT),
        T.StructField("is_market_hours", T.BooleanType()),
        T.StructField("avg_volume_10bar", MEAN_VOLUME),
        T.StructField("ingestion_time", T.LongType()),
    ]
)

GOLD = SILVER

# Names of the folders a partitioned silver table may be split by.
FOLDER_OF = {"trade_date": "by_date", "symbol": "by_symbol"}

#: Says in a date column's metadata which date all rows of a table have.
ONLY_DATE = "only_date"


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto ``schema``: absent columns become null, extra ones are dropped.

    A value the target type cannot hold becomes null instead of failing the job.
    """
    present = set(df.columns)

    def column(f: T.StructField) -> Column:
        if f.name not in present:
            return F.lit(None).cast(f.dataType).alias(f.name)
        if df.schema[f.name].dataType == f.dataType:
            return F.col(f.name)
        return F.col(f.name).try_cast(f.dataType).alias(f.name)

    return df.select(*[column(f) for f in schema.fields])


@dataclass(frozen=True)
class Contract:
    """What a table promises: required columns, defaults, key, widths."""

    schema: T.StructType
    required: tuple[str, ...]
    key: tuple[str, ...]
    defaults: dict[str, object] = field(default_factory=dict)
    max_length: dict[str, int] = field(default_factory=dict)
    #: Whole-number columns whose source may be wider than their type.
    counts: tuple[str, ...] = ()


# The gold table's constraints.
GOLD_CONTRACT = Contract(
    schema=GOLD,
    required=(
        "symbol", "open", "high", "low", "close", "volume",
        "timestamp_ms", "num_trades", "event_time", "trade_date",
    ),
    key=("symbol", "timestamp_ms"),
    defaults={"volume": 0, "num_trades": 0, "is_market_hours": False},
    max_length={"symbol": 10},
    counts=("volume", "num_trades"),
)
