import random
from decimal import Decimal

from fixtures import bar, bronze
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barloom.operators.resample import INTERVALS, daily_summary, resample_ohlcv, rollup_bars
from barloom.plans.silver import silver

TICKS = "symbol string, event_time timestamp, price double, size long, tick_id long"


def ticks(spark, rows):
    df = spark.createDataFrame(rows, "symbol string, s long, price double, size long, tick_id long")
    return df.withColumn("event_time", F.timestamp_seconds("s")).drop("s")


def brute(rows, seconds):
    groups = {}
    for row in rows:
        groups.setdefault((row[0], row[1] // seconds * seconds), []).append(row)
    out = {}
    for key, group in groups.items():
        group.sort(key=lambda r: (r[1], r[4]))
        prices, volume = [r[2] for r in group], sum(r[3] for r in group)
        notional = sum(round(r[2] * 10000) * r[3] for r in group)
        out[key] = (
            prices[0], max(prices), min(prices), prices[-1], volume, len(group),
            notional / volume / 10000 if volume else None,
        )
    return out


def collected(df):
    rows = df.select(
        "symbol", F.unix_seconds("bar_start").alias("s"),
        "open", "high", "low", "close", "volume", "num_trades", "vwap",
    ).collect()
    return {(r.symbol, r.s): tuple(r)[2:] for r in rows}


def test_every_interval_equals_brute_force(spark):
    rng = random.Random(5)
    rows = [
        (rng.choice("AAAB"), rng.randrange(-90_000, 200_000), rng.randrange(1, 9999) / 100, rng.randrange(5), i)
        for i in range(800)
    ]
    df = ticks(spark, rows)
    for minutes in INTERVALS.values():
        assert collected(resample_ohlcv(df, minutes, tie_breaker="tick_id")) == brute(rows, minutes * 60)


def test_ties_in_time_follow_the_tie_breaker(spark):
    rows = [("A", 60, p, 1, i) for i, p in enumerate((5.0, 9.0, 1.0, 7.0))]
    got = collected(resample_ohlcv(ticks(spark, rows).repartition(4), 1, tie_breaker="tick_id"))
    assert got[("A", 60)][:4] == (5.0, 9.0, 1.0, 7.0)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("AB"), st.integers(0, 20_000), st.integers(1, 500), st.integers(0, 9)), min_size=1, max_size=40))
def test_rollup_equals_resampling_and_keeps_volume(spark, drawn):
    rows = [(s, t, p / 100, v, i) for i, (s, t, p, v) in enumerate(drawn)]
    df = ticks(spark, rows)
    direct = collected(resample_ohlcv(df, 60, tie_breaker="tick_id"))
    rolled = collected(rollup_bars(resample_ohlcv(df, 1, tie_breaker="tick_id"), 60))
    assert rolled == direct
    assert sum(b[4] for b in direct.values()) == sum(r[3] for r in rows)
    assert all(b[2] <= min(b[0], b[3]) and max(b[0], b[3]) <= b[1] for b in direct.values())


def test_daily_summary(spark):
    rows = [
        bar(timestamp=0, open=1.0, close=2.0, high=5.0, low=0.5, volume=10.0),
        bar(timestamp=60_000, open=2.0, close=3.0, high=4.0, low=0.25, volume=20.0),
        bar(timestamp=86_400_000, open=9.0, close=9.0, high=9.0, low=9.0, volume=1.0),
    ]
    got = sorted(tuple(r) for r in daily_summary(silver(bronze(spark, rows))).drop("symbol", "trade_date").collect())
    d = Decimal
    assert got == [
        (d("1.0000"), d("5.0000"), d("0.2500"), d("3.0000"), 30),
        (d("9.0000"), d("9.0000"), d("9.0000"), d("9.0000"), 1),
    ]


def test_resampling_is_a_hash_aggregation_with_one_shuffle(spark, sf_dir):
    from barloom.sources.derived import ticks_from_events

    bars = resample_ohlcv(ticks_from_events(spark, sf_dir), 5, tie_breaker="tick_id")
    plan = bars._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan
    assert plan.count("Exchange") == 1
    assert "user_id" not in plan.split("ReadSchema")[1]
