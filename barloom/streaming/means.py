"""A stored table of bars with trailing means that stays right when bars come late or are replaced.

The table is versioned by folder lists (:mod:`barloom.sinks.versions`): what a batch adds and what it mends become visible
together, and a batch that died halfway has changed nothing. Beside each write lies an index of how many bars a symbol
has on each date. From it follows which dates a late or replaced bar concerns: its own, those after it whose frames
reach back to it, and those before it that fill their frames. Only their folders are read, and only folders that
hold a row that changes are written anew.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators.rolling import trailing_mean
from barloom.session import shared_path
from barloom.sinks.versions import Folder, Version, VersionedTable
from barloom.sources.files import complete_folders, exists, remove

BY = "by_date"
TAIL = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("volume", T.LongType()),
    ]
)


def date_of(ms: str) -> F.Column:
    return F.to_date(F.timestamp_millis(ms))


def last_bars(bars: DataFrame, rows: int = 10, order: str = "timestamp") -> DataFrame:
    """The last ``rows`` bars of each symbol. Ranks are cut on the map side first."""
    latest_first = Window.partitionBy("symbol").orderBy(F.col(order).desc())
    return (
        bars.select("symbol", order, "volume")
        .withColumn("_rank", F.row_number().over(latest_first))
        .filter(F.col("_rank") <= rows)
        .drop("_rank")
    )


class TailStore:
    """The last bars of every symbol after each batch, as one small folder per batch.

    Which folder belongs to a version of the table is in its list, so a batch that was not published leaves no trace.
    Size: a few rows per symbol, however long the stream; old folders are removed.
    """

    KEPT = 10

    def __init__(self, path: str, rows: int = 10):
        self.path = path.rstrip("/")
        self.rows = rows

    def read(self, spark: SparkSession, place: str | None) -> DataFrame | None:
        found = place and exists(spark, f"{place}/_SUCCESS")
        return spark.read.schema(TAIL).parquet(place) if found else None

    def save(self, bars: DataFrame, earlier: DataFrame | None, mark: str) -> str:
        """Write the last bars once ``bars`` have joined or replaced the earlier ones; returns the folder."""
        slim = bars.select("symbol", "timestamp", "volume")
        if earlier is not None:
            slim = slim.unionByName(earlier.join(slim, ["symbol", "timestamp"], "left_anti"))
        place = f"{self.path}/batch={mark}"
        last_bars(slim, self.rows).write.mode("overwrite").parquet(place)
        for name in complete_folders(bars.sparkSession, self.path)[: -self.KEPT]:
            remove(bars.sparkSession, f"{self.path}/{name}")
        return place


def late_symbols(new: DataFrame, tails: DataFrame) -> DataFrame:
    """Symbols with a new bar (symbol, timestamp) that is not after the last one known."""
    last = tails.groupBy("symbol").agg(F.max("timestamp").alias("_last"))
    return new.join(last, "symbol").filter("timestamp <= _last").select("symbol").distinct()


def reach(counts: DataFrame, touched: DataFrame, rows: int) -> DataFrame:
    """symbol, by_date and ``inner`` of the dates that changes on the dates ``touched`` (symbol, by_date) concern.

    counts: symbol, by_date, rows. Inner dates may hold bars whose mean changes: the touched ones and those after them,
    as long as fewer than ``rows`` bars lie between. The others, before a touched date, only fill frames. The
    window orders the dates of a symbol, of which there are as many as days.
    """
    known = counts.unionByName(touched.withColumn("rows", F.lit(0).cast("bigint")))
    marked = touched.select("symbol", BY, F.lit(True).alias("_touched"))
    days = known.groupBy("symbol", BY).agg(F.sum("rows").alias("bars")).join(marked, ["symbol", BY], "left")
    by_date = Window.partitionBy("symbol").orderBy(BY)
    so_far = F.sum("bars").over(by_date.rowsBetween(Window.unboundedPreceding, 0))
    days = days.withColumn("_upto", so_far)
    last = F.max(F.when(F.col("_touched"), F.col("_upto"))).over(by_date.rowsBetween(Window.unboundedPreceding, -1))
    following = F.min(F.when(F.col("_touched"), F.col("_upto") - F.col("bars"))).over(by_date.rowsBetween(1, Window.unboundedFollowing))
    inner = F.coalesce(F.col("_touched"), F.col("_upto") - F.col("bars") - last < rows, F.lit(False))
    outer = F.coalesce(following - F.col("_upto") < rows, F.lit(False))
    return days.select("symbol", BY, inner.alias("inner"), outer.alias("_outer")).filter("inner OR _outer").drop("_outer")


@dataclass
class Change:
    """What a batch did to the table."""

    added: int = 0
    replaced: int = 0
    mended: int = 0


class MeanTable:
    """Bars of ``schema`` with a trailing mean ``out`` at ``path``; ``order`` is the time column in milliseconds.

    complete: makes rows of the schema out of new bars (symbol, timestamp, volume and what else it needs) and the
    bars around them (symbol, timestamp, volume).
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        complete: Callable[[DataFrame, DataFrame | None], DataFrame],
        tails: TailStore,
        *,
        order: str,
        bucket_ms: int,
        out: str = "avg_volume_10bar",
    ):
        self.spark = spark
        self.table = VersionedTable(spark, path, BY, counted="symbol")
        self.schema = schema
        self.complete = complete
        self.tails = tails
        self.order = order
        self.bucket_ms = bucket_ms
        self.out = out
        self.scratch: list[str] = []

    def _between(self, purpose: str) -> str:
        """A folder for the time of one change."""
        self.scratch.append(shared_path(self.spark, purpose))
        return self.scratch[-1]

    def stored(self, version: Version, dates: list) -> DataFrame:
        """The stored rows of some dates, with their folder."""
        return self.table.read(self.schema, version.on(map(str, dates)))

    def apply(self, version: Version, fresh: DataFrame, mark: str) -> Change:
        """Publish the version after ``version`` with the bars ``fresh`` in it.

        fresh: symbol, timestamp, volume, by_date and what ``complete`` needs, and ``_gone``, true where the bar
        replaces the stored one of its key. It is read several times, so it should be persisted.
        """
        change = Change(*fresh.agg(F.count_if(~F.col("_gone")), F.count_if("_gone")).first())
        earlier = self.tails.read(self.spark, version.notes.get("tails"))
        if earlier is None and version.folders:  # the state was lost
            earlier = last_bars(self.table.read(self.schema, version.folders).select("symbol", F.col(self.order).alias("timestamp"), "volume"), self.tails.rows)
        symbols = late_symbols(fresh, earlier).persist(StorageLevel.MEMORY_AND_DISK) if earlier is not None else None
        try:
            if symbols is None or symbols.isEmpty():
                rows, gone = self.complete(fresh, earlier), []
            else:
                rows, gone, change.mended = self._mended(version, fresh, earlier, symbols)
            added = self.table.add(rows.select(*self.schema.fieldNames(), BY))
            place = self.tails.save(fresh, earlier, mark)
            self.table.commit(version, added, gone, mark, tails=place)
        finally:
            while self.scratch:
                remove(self.spark, self.scratch.pop())
            if symbols is not None:
                symbols.unpersist()
        return change

    def _mended(self, version: Version, fresh: DataFrame, earlier: DataFrame, symbols: DataFrame):
        """All rows to write, the folders they stand for, and how many stored means change."""
        late = fresh.join(symbols, "symbol", "left_semi")
        touched = late.select("symbol", BY).distinct()
        counts = self.table.counts(version).join(symbols, "symbol", "left_semi")
        around = reach(counts, touched, self.tails.rows).persist(StorageLevel.MEMORY_AND_DISK)
        dates = [r[0] for r in around.select(BY).distinct().collect()]  # days
        near = self.stored(version, dates).select("symbol", F.col(self.order).alias("timestamp"), "volume", F.col(self.out).alias("_was"), "write", BY)
        replaced = fresh.filter("_gone").select("symbol", "timestamp")
        near = near.join(around, ["symbol", BY])
        kept = near.join(replaced, ["symbol", "timestamp"], "left_anti").persist(StorageLevel.MEMORY_AND_DISK)
        slim = ["symbol", "timestamp", "volume"]
        try:
            again = trailing_mean(
                kept.filter("inner").drop("inner"), rows=self.tails.rows, out="_mean", bucket_ms=self.bucket_ms,
                history=late.select(*slim).unionByName(kept.filter("NOT inner").select(*slim)),
            )
            kind = self.schema[self.out].dataType
            again = again.withColumn("_mean", F.col("_mean").try_cast(kind)).filter(~F.col("_mean").eqNullSafe(F.col("_was")))
            gone_rows = near.join(replaced, ["symbol", "timestamp"], "left_semi").select("symbol", "timestamp", F.lit(None).cast(kind).alias("_mean"), "write", BY, F.lit(True).alias("_away"))
            marks = self._between("changed-bars")
            again.select("symbol", "timestamp", "_mean", "write", BY, F.lit(False).alias("_away")).unionByName(gone_rows).write.parquet(marks)
            changed = self.spark.read.schema(f"symbol string, timestamp bigint, _mean {kind.simpleString()}, write string, {BY} date, _away boolean").parquet(marks)
            folders = [Folder(str(r[0]), r[1]) for r in changed.select(BY, "write").distinct().collect()]
            mended = changed.filter("NOT _away").count()
            fixed = (
                self.table.read(self.schema, folders)
                .join(changed.select("symbol", F.col("timestamp").alias(self.order), "_mean", "_away"), ["symbol", self.order], "left")
                .filter("_away IS NULL OR NOT _away")
                .withColumn(self.out, F.when(F.col("_away").isNotNull(), F.col("_mean")).otherwise(F.col(self.out)))
                .select(*self.schema.fieldNames(), BY)
            )
            history = kept.select(*slim).unionByName(earlier.join(symbols, "symbol", "left_anti"))
            between = self._between("batch-rows")  # cut here: the frames' inputs are let go below
            self.complete(fresh, history).select(*self.schema.fieldNames(), BY).write.parquet(between)
            rows = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField(BY, T.DateType())])).parquet(between)
            return rows.unionByName(fixed), folders, mended
        finally:
            kept.unpersist()
            around.unpersist()
