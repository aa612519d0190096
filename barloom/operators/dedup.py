"""One row per key, within a run and across runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from barloom.schemas import BRONZE

# The timestamp leads: rows are sorted by the key on the way, and numbers that differ
# are told apart faster than symbols that mostly agree.
KEY = ("timestamp", "symbol")


def first_arrival(
    df: DataFrame, keys: Sequence[str] = KEY, arrival: str = "ingestion_time"
) -> DataFrame:
    """Keep the copy of each key that arrived first.

    The whole row is the minimum of a struct led by the arrival time: copies are
    reduced before the shuffle, so a key that makes up a third of the input sends
    one row per map task, and ties fall the same way in every run. An unknown
    arrival time counts as latest.
    """
    rest = [c for c in df.columns if c not in (*keys, arrival)]
    row = F.struct(
        F.col(arrival).isNull().alias("_unknown"), F.col(arrival), *[F.col(c) for c in rest]
    )
    kept = df.groupBy(*keys).agg(F.min(row).alias("_first"))
    return kept.select(
        *[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns]
    )


def arrival_order(arrival: str, row: str) -> Column:
    """What the copies of a key are ordered by, first the one to keep: arrival (unknown is last), then its values."""
    return F.struct(F.col(arrival).isNull().alias("_unknown"), F.col(arrival), F.col(row))


def first_usable(bronze: DataFrame, valid: Column, counted: Observation) -> DataFrame:
    """As :func:`first_arrival` over the rows that are ``valid``, counting keys on the way.

    The keys of rows that are not valid go through the same aggregation, so that ``counted`` learns
    rows_after_dedup (all keys) and rows_final (keys with a valid copy) without another pass.
    """
    rest = [c for c in bronze.columns if c not in (*KEY, "ingestion_time")]
    order = F.struct(F.col("ingestion_time").isNull().alias("_unknown"), "ingestion_time", *rest)
    kept = bronze.groupBy(*KEY).agg(F.min(F.when(valid, order)).alias("_first"))
    kept = kept.observe(counted, F.count("*").alias("rows_after_dedup"), F.count("_first").alias("rows_final"))
    kept = kept.filter(F.col("_first").isNotNull())
    return kept.select(*[F.col(c) if c in KEY else F.col(f"_first.{c}").alias(c) for c in bronze.columns])


def any_copy(df: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Keep an arbitrary copy of each key."""
    return df.dropDuplicates(list(keys))


def append_new_only(
    new: DataFrame,
    existing: DataFrame,
    keys: Sequence[str] = ("symbol", "timestamp_ms"),
    within: str | None = "trade_date",
) -> DataFrame:
    """Rows of ``new`` whose key ``existing`` lacks.

    ``within`` is a column the key determines. The existing table is cut down to the
    range of it that the new rows cover before it is joined, so a small batch reads a
    few dates of a large table. Both bounds are scalar subqueries that reach the
    scan as partition or row-group filters.
    """
    if within is not None:
        low = new.agg(F.min(within)).scalar()
        high = new.agg(F.max(within)).scalar()
        existing = existing.filter(F.col(within).between(low, high))
    return new.join(existing.select(*keys), list(keys), "left_anti")


def duplicate_keys(df: DataFrame, keys: Sequence[str] = ("symbol", "timestamp_ms")) -> DataFrame:
    """Keys that occur more than once, with the number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def stage_counts(bronze: DataFrame, valid) -> DataFrame:
    """Rows read, distinct keys, copies removed and rows kept, in one shuffle.

    The shuffle carries one row of two counters per key and map task. ``valid`` is
    the condition a row must meet to be kept; a key is kept if any copy meets it.
    """
    per_key = bronze.groupBy(*KEY).agg(
        F.count("*").alias("copies"), F.count_if(valid).alias("usable")
    )
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_read"),
        F.count("*").alias("rows_after_dedup"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates_removed"),
        F.count_if(F.col("usable") > 0).alias("rows_final"),
    )


assert set(KEY) <= set(BRONZE.fieldNames())
