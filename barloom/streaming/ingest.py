"""Messages to bronze, as a stream."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from barloom.sinks.tables import write_bronze
from barloom.sources.messages import decode_messages, split_good_bad
from barloom.streaming.runs import batch_mark

TRANSPORT = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("data", T.StringType()),
        T.StructField("sequenceNumber", T.StringType()),
        T.StructField("approximateArrivalTimestamp", T.DoubleType()),
    ]
)


def read_messages(
    spark: SparkSession, path: str, max_files: int | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Transport records arriving as files; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.schema(TRANSPORT)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.format(fmt).load(path)


def observed(records: DataFrame, name: str = "ingest") -> DataFrame:
    """Decode and count on the way: the figures appear in the query's progress."""
    event_time = F.timestamp_millis("bar.timestamp")
    return decode_messages(records).observe(
        name,
        F.count("*").alias("received"),
        F.count_if(F.col("failure").isNull()).alias("written"),
        F.count_if(F.col("failure").isNotNull()).alias("decode_failures"),
        F.max(F.unix_millis(F.current_timestamp()) - F.unix_millis(event_time)).alias("max_lag_ms"),
    )


def stream_bronze(
    records: DataFrame, bronze: str, quarantine: str, checkpoint: str
) -> StreamingQuery:
    """Write readable records to bronze and the others, as they came, to quarantine.

    A micro-batch is parsed once and kept while both parts are written. Both writes
    replace what an earlier try of the same batch left and nothing else: folders are named after
    the run and the batch, and the day is the one on which the batch was first
    planned, which the checkpoint remembers. A failing write fails the query, and the
    batch runs again from the checkpoint.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        mark = batch_mark(batch.sparkSession, checkpoint, batch_id)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good, bad = split_good_bad(batch, keep=["_planned"])
            write_bronze(good, bronze, at="_planned", batch=mark)
            (
                bad.drop("_planned").withColumn("batch", F.lit(mark))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("batch")
                .parquet(quarantine)
            )
        finally:
            batch.unpersist()

    return (
        observed(records)
        .withColumn("_planned", F.current_timestamp())
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
