"""Writing bronze and silver, and how gold is laid out."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.schemas import BRONZE, FOLDER_OF, SILVER, conform


def day_folders(at) -> dict:
    """year, month and day of a UTC time as zero-padded folder names."""
    return {
        "year": F.date_format(at, "yyyy"),
        "month": F.date_format(at, "MM"),
        "day": F.date_format(at, "dd"),
    }


def write_bronze(
    df: DataFrame,
    path: str,
    now: datetime | None = None,
    batch: str | None = None,
    at: str | None = None,
) -> None:
    """Append raw bars under the year/month/day on which they are processed.

    The day is that of ``now``, or of the column ``at``. With ``batch`` the files sit one
    folder deeper and a repeat of the batch replaces them. The batch is written as it is
    partitioned, so one day's files are spread over all tasks. An empty batch writes
    nothing.
    """
    if at is None:
        moment = (now or datetime.now(timezone.utc)).astimezone(timezone.utc)
        folders = day_folders(F.lit(moment.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp"))
        rows = conform(df, BRONZE).withColumns(folders)
    else:
        folders = day_folders(F.col(at))
        rows = df.withColumns(folders)
        rows = conform(rows, T.StructType([*BRONZE.fields, *(T.StructField(c, T.StringType()) for c in folders)]))
    by = list(folders)
    writer = rows.write.mode("append")
    if batch is not None:
        by.append("batch")
        writer = (
            rows.withColumn("batch", F.lit(batch))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
        )
    writer.partitionBy(*by).option("compression", "snappy").parquet(path)


def write_silver(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "append"
) -> None:
    """Append typed bars. Partition folders are copies: all columns stay in the files.

    Rows are gathered per partition before writing. The gathering is a rebalance, not a
    repartition, so Spark splits a partition that is too big for one task and packs
    small ones together.
    """
    rows = conform(df, SILVER)
    if not partition_by:
        rows.write.mode(mode).parquet(path)
        return
    folders = {FOLDER_OF[c]: F.col(c) for c in partition_by}
    rows = rows.withColumns(folders).hint("rebalance", *folders)
    rows.write.mode(mode).partitionBy(*folders).parquet(path)


def layout_gold(df: DataFrame) -> DataFrame:
    """Bars of a symbol side by side, in time order within each file.

    Ranges over (symbol, date, time) rather than a hash of the symbol: a symbol with a
    third of all rows becomes many neighbouring files instead of one.
    """
    return df.repartitionByRange("symbol", "trade_date", "event_time").sortWithinPartitions(
        "symbol", "trade_date", "event_time"
    )
