"""Deduplication, resampling and trailing means over streams of bars or ticks."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from barloom.operators.resample import bar_start, resample_ohlcv, usable_tick
from barloom.operators.rolling import DAY_MS, trailing_mean
from barloom.sinks.versions import VersionedTable
from barloom.streaming.held import late_rows
from barloom.streaming.means import BY, MeanTable, TailStore, date_of
from barloom.streaming.runs import batch_mark

def stream_dedup(bars: DataFrame, delay: str = "1 day") -> DataFrame:
    """Drop a bar that was seen within ``delay`` of event time."""
    return (
        bars.withColumn("event_time", F.timestamp_millis("timestamp"))
        .withWatermark("event_time", delay)
        .dropDuplicatesWithinWatermark(["symbol", "timestamp"])
    )


def stream_first_arrival(bars: DataFrame, delay: str = "1 day") -> DataFrame:
    """The first-arriving copy of each bar, emitted once no copy can still come.

    Unlike :func:`stream_dedup` it is exact about which copy is kept, and copies are
    reduced before the shuffle, so a bar repeated without end costs one row per task.
    """
    keys = ["symbol", "timestamp"]
    rest = [c for c in bars.columns if c not in (*keys, "ingestion_time")]
    row = F.struct(F.col("ingestion_time").isNull().alias("_unknown"), "ingestion_time", *rest)
    kept = (
        bars.withColumn("event_time", F.timestamp_millis("timestamp"))
        .withWatermark("event_time", delay)
        .groupBy(*keys, "event_time")
        .agg(F.min(row).alias("_first"))
    )
    return kept.select(
        *[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in bars.columns]
    )


def stream_resample(
    ticks: DataFrame, minutes: int, delay: str | None = None, tie_breaker: str | None = None
) -> DataFrame:
    """Bars from a stream of ticks; a bar is emitted once no tick can still change it.

    State holds one row per open (symbol, bar). ``delay`` defaults to one bar.
    """
    ticks = ticks.withWatermark("event_time", delay or f"{minutes} minutes")
    return resample_ohlcv(ticks, minutes, tie_breaker=tie_breaker)


def late_ticks(spark: SparkSession, checkpoint: str, schema: T.StructType, minutes: int, after: int = -1) -> DataFrame:
    """Ticks that :func:`stream_resample` read after batch ``after`` and left out, as their bar was closed by then.

    Together with the bars and :func:`~barloom.operators.resample.unusable_ticks` they are all ticks.
    """
    end = bar_start(F.col("event_time"), minutes) + F.make_dt_interval(mins=F.lit(minutes))
    late = late_rows(spark, checkpoint, schema, end, after)
    return late.filter(usable_tick("event_time", "price", "size"))


def start_to_parquet(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def stream_rolling_volume(
    bars: DataFrame,
    path: str,
    state: str,
    checkpoint: str,
    rows: int = 10,
    bucket_ms: int = DAY_MS,
) -> StreamingQuery:
    """Add the trailing mean to a stream of clean bars, across micro-batches.

    Each micro-batch runs the batch operator with the last bars before it as history,
    so a busy symbol is spread over tasks here too. If bars come after later bars of
    their symbol, they are placed among the stored ones and the means that they change are
    written anew; so the table (:func:`read_means`) always equals the batch result. A batch becomes visible
    at once or not at all.
    """
    tails = TailStore(state, rows)

    def complete(new: DataFrame, history: DataFrame | None) -> DataFrame:
        means = trailing_mean(new.drop("_gone", BY), rows=rows, bucket_ms=bucket_ms, history=history)
        return means.withColumn(BY, date_of("timestamp"))

    def process(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        mark = batch_mark(session, checkpoint, batch_id)
        table = MeanTable(session, path, _with_mean(bars.schema), complete, tails, order="timestamp", bucket_ms=bucket_ms)
        version = table.table.current()
        if version.has(mark):
            return
        fresh = batch.withColumns({BY: date_of("timestamp"), "_gone": F.lit(False)}).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            table.apply(version, fresh, mark)
        finally:
            fresh.unpersist()

    return (
        bars.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _with_mean(bars: T.StructType) -> T.StructType:
    return T.StructType([*bars.fields, T.StructField("avg_volume_10bar", T.DoubleType())])


def read_means(spark: SparkSession, path: str, bars: T.StructType) -> DataFrame:
    """What :func:`stream_rolling_volume` has stored at ``path`` for bars of that schema."""
    return VersionedTable(spark, path, BY).read(_with_mean(bars)).drop("write", BY)
