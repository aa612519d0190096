"""Hand-made rows."""

from pyspark.sql import Row

from barloom.schemas import BRONZE

# The four raw bars every deduplication and cleaning case starts from.
RAW = [
    ("AAPL", 150.0, 155.0, 148.0, 153.5, 1000000.0, 152.0, 1700000000000, 5000.0, 1700000010000),
    ("AAPL", 150.0, 155.0, 148.0, 153.5, 1000000.0, 152.0, 1700000000000, 5000.0, 1700000020000),
    ("MSFT", 300.0, 310.0, 295.0, 305.0, 500000.0, None, 1700000060000, None, 1700000070000),
    ("TSLA", None, None, None, None, 0.0, None, 1700000120000, 0.0, 1700000130000),
]


def bronze(spark, rows):
    return spark.createDataFrame(rows, BRONZE)


def bar(symbol="AAPL", timestamp=1_700_000_000_000, **changes):
    values = dict(
        symbol=symbol, open=10.0, high=12.0, low=9.0, close=11.0, volume=100.0, vwap=10.5,
        timestamp=timestamp, num_trades=7.0, ingestion_time=timestamp + 1000,
    )
    values.update(changes)
    return tuple(values[n] for n in BRONZE.fieldNames())


def utc_ms(text):
    from datetime import datetime, timezone

    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp() * 1000)


def as_dicts(df):
    return [r.asDict() if isinstance(r, Row) else r for r in df.collect()]
