"""Reading stored layers."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators.contract import evolution_errors
from barloom.schemas import BRONZE, FOLDER_OF, ONLY_DATE, SILVER
from barloom.sinks.versions import VersionedTable, is_versioned
from barloom.sources.files import children

# How recent a file has to be for a run to be worth starting.
FRESH_WITHIN_S = 7_200


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Raw bars with their year/month/day folders as columns that prune the scan.

    With the schema given, no file is opened to plan the query.
    """
    folders = [T.StructField(c, T.IntegerType()) for c in ("year", "month", "day")]
    return spark.read.schema(T.StructType(BRONZE.fields + folders)).parquet(path)


def fresh_files(
    spark: SparkSession,
    path: str,
    now: datetime | None = None,
    within_s: int = FRESH_WITHIN_S,
) -> DataFrame:
    """(path, modified, bytes) of the data files written lately. Contents are not read."""
    since = (now or datetime.now(timezone.utc)) - timedelta(seconds=within_s)
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .option("modifiedAfter", since.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S"))
        .option("timeZone", "UTC")
        .load(path)
        .select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))
    )


def read_fresh_bronze(
    spark: SparkSession, path: str, now: datetime | None = None, within_s: int = FRESH_WITHIN_S
) -> DataFrame:
    """Raw bars of the files written lately; older files are not opened."""
    since = (now or datetime.now(timezone.utc)) - timedelta(seconds=within_s)
    reader = spark.read.schema(BRONZE).option("recursiveFileLookup", "true").option("timeZone", "UTC")
    return reader.option("modifiedAfter", since.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")).parquet(path)


def latest_day(spark: SparkSession, path: str, schema: T.StructType = SILVER) -> DataFrame:
    """The bars of the newest date of a table in date folders, which are all that is listed and read.

    The date is known from the list of folders, so a report over it needs no subquery: it is noted
    in the metadata of the column by_date, where :func:`~barloom.plans.reports.on_day` finds it. A table without
    a date gives no rows.
    """
    by = FOLDER_OF["trade_date"]
    if is_versioned(spark, path):
        version = VersionedTable(spark, path, by).current()
        newest = max(version.dates(), default=None)
        bars = VersionedTable(spark, path, by).read(schema, version.on([newest])).drop("write")
    else:
        names = [n for n in children(spark, path) if n.startswith(f"{by}=") and not n.endswith("__HIVE_DEFAULT_PARTITION__")]
        newest = max(names, default=None)
        full = T.StructType([*schema.fields, T.StructField(by, T.DateType())])
        found = newest and spark.read.schema(full).option("basePath", path).parquet(f"{path}/{newest}")
        bars = found if newest else spark.createDataFrame([], full)
        newest = newest and newest.split("=", 1)[1]
    return bars.withMetadata(by, {ONLY_DATE: newest}) if newest else bars


def has_new_data(spark: SparkSession, path: str, now: datetime | None = None) -> bool:
    return not fresh_files(spark, path, now).isEmpty()


def register_table(
    spark: SparkSession,
    path: str,
    name: str,
    known: T.StructType | None = None,
    merge: bool = True,
) -> DataFrame:
    """Make a folder of Parquet files queryable under ``name``.

    Files may have gained columns over time, so their schemas are merged, which opens
    every file's footer once; ``merge=False`` takes one file's word for all. If ``known``
    is given, a table that lost or retyped one of its columns is refused.
    """
    if is_versioned(spark, path):
        table = VersionedTable(spark, path)
        files = [table.place(f) for f in table.current().folders]
        df = spark.read.option("mergeSchema", str(merge).lower()).option("basePath", path).parquet(*files).drop("write")
    else:
        df = spark.read.option("mergeSchema", str(merge).lower()).parquet(path)
    errors = evolution_errors(known, df.schema) if known is not None else []
    if errors:
        raise ValueError(f"{name}: " + "; ".join(errors))
    df.createOrReplaceTempView(name)
    return df
