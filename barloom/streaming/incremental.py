"""Bronze to silver, reading each bronze file once."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators.clean import fill, usable
from barloom.operators.dedup import arrival_order, first_usable
from barloom.operators.rolling import DAY_MS
from barloom.plans.silver import finish
from barloom.schemas import BRONZE, SILVER
from barloom.sinks.versions import VersionedTable
from barloom.streaming.means import BY, MeanTable, TailStore, date_of
from barloom.streaming.runs import batch_mark

_RAW = T.StructType([f for f in BRONZE.fields if f.name not in ("symbol", "timestamp", "ingestion_time")])
#: Silver as it is stored here: with the raw values beside the typed ones, as copies that arrive at the same moment
#: are told apart by them.
STORED = T.StructType([*SILVER.fields, T.StructField("raw", _RAW)])


def silver_table(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, path, BY, counted="symbol")


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """The silver table at ``path``, with its folder column by_date."""
    return VersionedTable(spark, path, BY).read(SILVER).drop("write")


@dataclass
class RunCounts:
    """What a run did. The first four are those of :func:`~barloom.operators.dedup.stage_counts`, added up over its batches."""

    rows_read: int = 0
    rows_after_dedup: int = 0
    duplicates_removed: int = 0
    rows_final: int = 0
    #: Rows that miss a key or a price, or whose price cannot be stored.
    set_aside: int = 0
    #: Keys that silver did not hold, keys whose stored copy was replaced, other bars whose mean changed.
    added: int = 0
    replaced: int = 0
    mended: int = 0

    def __iadd__(self, other: RunCounts) -> RunCounts:
        for name, n in asdict(other).items():
            setattr(self, name, getattr(self, name) + n)
        return self


def changes(bars: DataFrame, stored: DataFrame | None) -> DataFrame:
    """The bars that ``stored`` lacks or holds in a copy that arrived later, with ``_gone`` for the latter."""
    if stored is None:
        return bars.withColumn("_gone", F.lit(False))
    known = stored.select("symbol", F.col("timestamp_ms").alias("timestamp"), arrival_order("ingestion_time", "raw").alias("_known"))
    met = bars.join(known, ["symbol", "timestamp"], "left")
    better = F.col("_known").isNull() | (arrival_order("ingestion_time", "raw") < F.col("_known"))
    return met.filter(better).withColumn("_gone", F.col("_known").isNotNull()).drop("_known")


def run_incremental(
    spark: SparkSession,
    bronze: str,
    silver: str,
    state: str,
    checkpoint: str,
    *,
    max_files: int | None = None,
    market_hours: str = "utc_fixed",
    bucket_ms: int = DAY_MS,
) -> RunCounts:
    """Process the bronze files that no earlier run has seen.

    Which files are done is in the checkpoint. Keys that silver already holds are left out, whichever run wrote them,
    unless the new copy arrived before the stored one, which it then replaces: silver is what one batch over all
    deliveries would give. Only the dates that the new bars fall on are looked up. The trailing mean continues from the stored last
    bars of each symbol; bars that come after later ones, or replace some, change the means stored for those. All of it
    becomes visible at once, and a batch that is run again after that changes nothing. Another run that publishes
    meanwhile makes this one fail and try again.
    """
    tails = TailStore(state)
    counts = RunCounts()

    def complete(bars: DataFrame, history: DataFrame | None) -> DataFrame:
        rows = finish(bars, history=history, market_hours=market_hours, bucket_ms=bucket_ms, schema=STORED)
        return rows.withColumn(BY, F.col("trade_date"))

    def process(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        mark = batch_mark(session, checkpoint, batch_id)
        table = MeanTable(session, silver, STORED, complete, tails, order="timestamp_ms", bucket_ms=bucket_ms)
        version = table.table.current()
        if version.has(mark):
            return
        seen, kept = Observation(), Observation()
        rows = batch.select(*BRONZE.fieldNames())
        rows = rows.observe(seen, F.count("*").alias("rows_read"), F.count_if(~usable()).alias("set_aside"))
        bars = first_usable(rows, usable(), kept)
        bars = fill(bars.withColumn("raw", F.struct(*_RAW.fieldNames())))
        bars = bars.withColumn(BY, date_of("timestamp")).persist(StorageLevel.MEMORY_AND_DISK)
        fresh = None
        try:
            dates = [r[0] for r in bars.select(BY).distinct().collect()]  # days
            met = version.on(map(str, dates))
            fresh = changes(bars, table.stored(version, dates) if met else None).persist(StorageLevel.MEMORY_AND_DISK)
            change = table.apply(version, fresh, mark)
            told = kept.get
            nonlocal counts
            counts += RunCounts(
                **seen.get, **told, duplicates_removed=seen.get["rows_read"] - told["rows_after_dedup"], **asdict(change)
            )
        finally:
            if fresh is not None:
                fresh.unpersist()
            bars.unpersist()

    reader = spark.readStream.schema(BRONZE).option("recursiveFileLookup", "true")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    (
        reader.parquet(bronze)
        .writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return counts
