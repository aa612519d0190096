"""Threshold alarms over any event or metric table."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_COMPARE = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le}
_STATISTIC = {"sum": F.sum, "max": F.max, "min": F.min, "avg": F.avg}


# Periods laid out at once.
_STRETCH = 1_440


@dataclass(frozen=True)
class Rule:
    """``statistic`` per ``period_s`` compared with ``threshold``, ``periods`` in a row."""

    statistic: str
    period_s: int
    compare: str
    threshold: int
    periods: int = 1


# The six pipeline alarms.
ERRORS = Rule("sum", 60, ">=", 1)
LAG_MS = Rule("max", 60, ">", 60_000, periods=2)
THROTTLES = Rule("sum", 60, ">=", 1)
DEAD_LETTERS = Rule("sum", 300, ">=", 1)
FAILED_TASKS = Rule("sum", 60, ">", 0)


def _inside(ts: str, within: tuple[datetime, datetime]) -> Column:
    at = F.col(ts).cast("timestamp")
    return (at >= F.lit(within[0])) & (at < F.lit(within[1]))


def strays(df: DataFrame, ts: str, within: tuple[datetime, datetime]) -> DataFrame:
    """The samples that an alarm over ``within`` does not count: their time is unknown or lies outside."""
    return df.filter(~F.coalesce(_inside(ts, within), F.lit(False)))


def eval_alarm(
    df: DataFrame,
    ts: str,
    value: Column,
    rule: Rule,
    dims: Sequence[str] = (),
    within: tuple[datetime, datetime] | None = None,
) -> DataFrame:
    """State of an alarm at every period between the first and the last one seen.

    ``within`` (from, up to but without) bounds the periods, so that a stray time stamp cannot stretch them over
    years; what lies outside is left to :func:`strays`.

    Returns ``dims, period_start, metric, in_alarm``. A period without data has a null
    metric and does not breach.

    "``periods`` in a row" is counted instead of ordered: each breaching period votes
    for itself and the periods after it that it can still hold in alarm, and a period
    with a full count of votes is in alarm. That is a hash aggregation, so there is
    no window that would draw a whole series into one task.
    """
    dims = list(dims)
    if within is not None:
        df = df.filter(_inside(ts, within))
    step = F.lit(rule.period_s).cast("bigint")
    second = F.unix_seconds(F.col(ts).cast("timestamp"))
    metric = df.groupBy(*dims, (second - F.pmod(second, step)).alias("_second")).agg(
        _STATISTIC[rule.statistic](value).alias("metric")
    )
    breaches = _COMPARE[rule.compare](F.col("metric"), F.lit(rule.threshold))
    reach = F.when(breaches, rule.periods).otherwise(1).cast("bigint") - 1
    votes = metric.select(
        *dims,
        F.explode(F.sequence(F.lit(0).cast("bigint"), reach)).alias("_later"),
        "_second",
        breaches.cast("int").alias("_vote"),
        "metric",
    ).select(
        *dims,
        (F.col("_second") + F.col("_later") * step).alias("_second"),
        "_vote",
        F.when(F.col("_later") == 0, F.col("metric")).alias("metric"),
    )
    # The grid is one row per period and series, laid out from its two end points, a
    # stretch at a time so that no long array is built. A series counts its metrics so
    # that both branches read the same shuffle.
    stretch = step * _STRETCH
    grid = (
        metric.groupBy(*dims)
        .agg(
            F.min("_second").alias("_lo"),
            F.max("_second").alias("_hi"),
            F.count("metric").alias("_periods"),
        )
        .filter("_periods > 0")
        .select(*dims, "_hi", F.explode(F.sequence("_lo", "_hi", stretch)).alias("_from"))
        .withColumn("_to", F.least(F.col("_hi"), F.col("_from") + stretch - step))
        .repartition(*dims, "_from")  # one series' stretches are laid out by many tasks
        .select(*dims, F.explode(F.sequence("_from", "_to", step)).alias("_second"))
        .withColumn("_on_grid", F.lit(True))
    )
    return (
        votes.unionByName(grid, allowMissingColumns=True)
        .groupBy(*dims, "_second")
        .agg(
            F.max("metric").alias("metric"),
            (F.coalesce(F.sum("_vote"), F.lit(0)) >= rule.periods).alias("in_alarm"),
            F.max("_on_grid").alias("_on_grid"),
        )
        .filter("_on_grid")
        .select(
            *dims, F.timestamp_seconds("_second").alias("period_start"), "metric", "in_alarm"
        )
    )
