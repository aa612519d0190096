"""What a stopped stream has not given out: the rows its state still holds and those that came too late for it.

A query that waits for a watermark keeps the newest keys for ever if its source ends. They can be read from the
checkpoint, so a result is whole without a last row from the far future. Rows behind the watermark are dropped by
Spark without a trace but a number; here they are found again in the files the query read.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators.resample import BAR, vwap_of
from barloom.sources.files import children


def _state(spark: SparkSession, checkpoint: str, names: list[str]) -> DataFrame:
    """key and value of the aggregation's state after the last batch; the parts of the value are named by position."""
    state = spark.read.format("statestore").load(checkpoint)
    kinds = [f.dataType for f in state.schema["value"].dataType.fields]
    value = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)])
    return state.select("key", F.col("value").cast(value).alias("value"))


def held_bars(spark: SparkSession, checkpoint: str, key: str = "symbol") -> DataFrame:
    """The bars that :func:`~barloom.streaming.bars.stream_resample` still holds, as they are so far."""
    names = ["open", "_first", "high", "low", "close", "_last", "volume", "num_trades", "notional_units"]
    state = _state(spark, checkpoint, names).select(f"key.{key}", F.col("key.window.start").alias("bar_start"), "value.*")
    return state.select(key, *BAR, vwap_of().alias("vwap"), "notional_units")


def held_first_copies(spark: SparkSession, checkpoint: str, columns: list[str]) -> DataFrame:
    """The first copies that :func:`~barloom.streaming.bars.stream_first_arrival` still holds."""
    state = _state(spark, checkpoint, ["first"])
    keys = state.schema["key"].dataType.fieldNames()
    return state.select(*[F.col(f"key.{c}" if c in keys else f"value.first.{c}").alias(c) for c in columns])


def with_held(spark: SparkSession, path: str, held: DataFrame) -> DataFrame:
    """All a stream has to say once its source has ended: what it wrote to ``path`` and what it still holds.

    For a query that has stopped. If it goes on later, keys it held come out of it in the end, so the union is
    taken anew and never written next to its output.
    """
    return spark.read.schema(held.schema).parquet(path).unionByName(held)


class LogGone(RuntimeError):
    """The checkpoint no longer says with which watermark a batch ran."""


def batches(spark: SparkSession, checkpoint: str, after: int = -1) -> DataFrame:
    """file, batch and watermark_ms for every file that a query over files has read after batch ``after``.

    The watermark is the one by which rows were too late: that of the batch before, as Spark lets a batch's own
    watermark count from the next batch on. A checkpoint keeps the last hundred batches by default
    (``spark.sql.streaming.minBatchesToRetain``), so ask at least that often; a gap is an error.
    """
    known = {int(n) for n in children(spark, f"{checkpoint}/offsets") if n.isdigit()}
    first = after + 1
    if not children(spark, f"{checkpoint}/sources/0"):
        return spark.createDataFrame([], "file string, batch int, watermark_ms bigint")
    if not known or not set(range(max(first - 1, 0), max(known) + 1)) <= known:
        raise LogGone(f"{checkpoint}: batches from {first} on are no longer logged; read late rows more often")
    number = F.regexp_extract("_metadata.file_path", r"/(\d+)$", 1).cast("int")
    lines = spark.read.text(f"{checkpoint}/offsets", pathGlobFilter="[0-9]*").select(number.alias("batch"), "value")
    offsets = lines.groupBy("batch").agg(
        F.max(F.get_json_object("value", "$.batchWatermarkMs").cast("bigint")).alias("own_ms"),
        F.max(F.get_json_object("value", "$.logOffset").cast("bigint")).alias("upto"),
    )
    before = offsets.select((F.col("batch") + 1).alias("batch"), F.col("own_ms").alias("watermark_ms"), F.col("upto").alias("from"))
    spans = offsets.join(before, "batch", "left").select(
        "batch", "upto", F.coalesce("from", F.lit(-1)).alias("from"), F.coalesce("watermark_ms", F.lit(0)).alias("watermark_ms")
    )
    files = spark.read.text(f"{checkpoint}/sources/0").where("value LIKE '{%'").select(
        F.get_json_object("value", "$.path").alias("file"), F.get_json_object("value", "$.batchId").cast("bigint").alias("place")
    ).distinct()
    # a batch that read files moved the source's own log on by one
    met = files.join(spans.where(F.col("upto") > F.col("from")), F.col("place") == F.col("upto"))
    return met.where(F.col("batch") >= first).select("file", "batch", "watermark_ms")


def late_rows(
    spark: SparkSession, checkpoint: str, schema: T.StructType, until: Column, after: int = -1, fmt: str = "parquet"
) -> DataFrame:
    """Rows of the files read after batch ``after`` that came behind the watermark, with watermark_ms.

    ``until`` is the moment up to which a row's key waits: the end of its window, or its event time. Only the
    files of those batches that had a watermark are read.
    """
    found = batches(spark, checkpoint, after).where("watermark_ms > 0").groupBy("watermark_ms")
    told = found.agg(F.collect_list("file").alias("files")).collect()  # names of files, as in any listing
    out = spark.createDataFrame([], schema).withColumn("watermark_ms", F.lit(0).cast("bigint"))
    for watermark, files in told:
        rows = spark.read.schema(schema).format(fmt).load([unquote(f) for f in files])
        out = out.unionByName(rows.withColumn("watermark_ms", F.lit(watermark).cast("bigint")))
    return out.where(F.unix_micros(until) <= F.col("watermark_ms") * 1000)
