"""Trailing mean over the last bars of a symbol, without one task per symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DAY_MS = 86_400_000


def _tails(points: DataFrame, key: str, order: str, value: str, rows: int) -> DataFrame:
    """Per (key, bucket), its last ``rows`` points in order, as one short array.

    The rank filter is applied on the map side first, so at most ``rows`` points per
    map task and bucket are shuffled.
    """
    latest_first = Window.partitionBy("_bucket", key).orderBy(F.col(order).desc())
    return (
        points.withColumn("_rank", F.row_number().over(latest_first))
        .filter(F.col("_rank") <= rows)
        .groupBy("_bucket", key)
        .agg(F.sort_array(F.collect_list(F.struct(order, value)), asc=False).alias("_tail"))
    )


def trailing_mean(
    bars: DataFrame,
    *,
    key: str = "symbol",
    order: str = "timestamp",
    value: str = "volume",
    rows: int = 10,
    out: str = "avg_volume_10bar",
    bucket_ms: int = DAY_MS,
    history: DataFrame | None = None,
) -> DataFrame:
    """Mean of ``value`` over the ``rows`` bars before each bar of the same key.

    Equal to ``avg(value)`` over ``partition by key order by order rows between
    rows preceding and 1 preceding``. That window puts a whole symbol into one task;
    here the window is per (key, time bucket), and each bucket also receives the
    bars before its first one that its frames reach back to.

    ``(key, order)`` is unique and ``order`` is in milliseconds, so a bucket holds at
    most ``bucket_ms`` bars (1,440 a day for one-minute bars). Choose ``bucket_ms`` well
    above ``rows`` bars and small enough to sort in one task. A bucket that exists
    holds at least one bar, so the ``rows`` buckets before it are enough to fill a
    frame. The only step done per key handles one short array per bucket: its size
    follows the time span, not the number of bars.

    ``history`` holds earlier bars (key, order, value) that count for the frames but
    are not returned; the last ``rows`` per key suffice.
    """
    bucket = F.expr(f"`{order}` div {bucket_ms}")
    bars = bars.withColumn("_bucket", bucket)

    points = bars.select(key, "_bucket", order, value)
    if history is not None:
        earlier = history.select(
            key,
            bucket.alias("_bucket"),
            F.col(order),
            F.col(value).cast(points.schema[value].dataType).alias(value),
        )
        points = points.unionByName(earlier)
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(-rows, -1)
    halo = (
        _tails(points, key, order, value, rows)
        .select(
            key,
            "_bucket",
            F.slice(
                F.flatten(F.reverse(F.collect_list("_tail").over(before))), 1, rows
            ).alias("_halo_points"),
        )
        .select(key, "_bucket", F.inline("_halo_points").alias(order, value))
        .withColumn("_halo", F.lit(True))
    )
    if history is not None:
        # Earlier bars may share the bucket that the first new bars fall into.
        halo = halo.unionByName(earlier.withColumn("_halo", F.lit(True)))

    frame = Window.partitionBy("_bucket", key).orderBy(order).rowsBetween(-rows, -1)
    return (
        bars.withColumn("_halo", F.lit(False))
        .unionByName(halo, allowMissingColumns=True)
        .withColumn(out, F.avg(value).over(frame))
        .filter(~F.col("_halo"))
        .drop("_bucket", "_halo")
    )
