"""The batch job: a folder of raw bars in, typed bars appended."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from barloom.operators.clean import fill, usable
from barloom.operators.dedup import first_usable
from barloom.operators.rolling import DAY_MS
from barloom.plans.silver import finish
from barloom.schemas import BRONZE
from barloom.sinks.tables import write_silver
from barloom.sources.tables import has_new_data, read_bronze


@dataclass(frozen=True)
class Written:
    """What a job did; the first four counts are those of :func:`~barloom.operators.dedup.stage_counts`."""

    rows_read: int
    rows_after_dedup: int
    duplicates_removed: int
    rows_final: int
    set_aside: int
    rows: int
    first_date: object
    last_date: object


def run_transform(
    spark: SparkSession,
    bronze: str,
    silver_path: str,
    *,
    partition_by: Sequence[str] = (),
    market_hours: str = "utc_fixed",
    bucket_ms: int = DAY_MS,
    only_if_fresh: bool = False,
) -> Written | None:
    """Transform the whole bronze folder and append the result to silver.

    Everything is counted while it passes, not by another scan. With ``only_if_fresh`` nothing happens
    unless a bronze file is recent.
    """
    if only_if_fresh and not has_new_data(spark, bronze):
        return None
    seen, kept, out = Observation(), Observation(), Observation()
    rows = read_bronze(spark, bronze).select(*BRONZE.fieldNames())
    rows = rows.observe(seen, F.count("*").alias("rows_read"), F.count_if(~usable()).alias("set_aside"))
    bars = finish(fill(first_usable(rows, usable(), kept)), market_hours=market_hours, bucket_ms=bucket_ms)
    bars = bars.observe(
        out,
        F.count("*").alias("rows"),
        F.min("trade_date").alias("first_date"),
        F.max("trade_date").alias("last_date"),
    )
    write_silver(bars, silver_path, partition_by)
    read, left = seen.get, kept.get
    removed = read["rows_read"] - left["rows_after_dedup"]
    return Written(**read, **left, duplicates_removed=removed, **out.get)
