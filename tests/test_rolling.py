"""The bucketed trailing mean against the plain window it stands for."""

import random

import pytest
from fixtures import bar, bronze
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from barloom.operators.rolling import trailing_mean
from barloom.plans.silver import silver

SCHEMA = "symbol string, timestamp long, volume long"


def plain(df, rows=10):
    frame = Window.partitionBy("symbol").orderBy("timestamp").rowsBetween(-rows, -1)
    return df.withColumn("avg_volume_10bar", F.avg("volume").over(frame))


def bag(df):
    return sorted(map(tuple, df.select("symbol", "timestamp", "volume", "avg_volume_10bar").collect()), key=repr)


@pytest.mark.parametrize("bucket_ms", [1, 7, 100, 10_000])
def test_equals_plain_window_with_a_hot_symbol(spark, bucket_ms):
    rng = random.Random(3)
    rows = [("HOT", t, rng.choice([None, rng.randrange(1000)])) for t in rng.sample(range(-500, 4000), 1500)]
    for s in range(20):
        rows += [(f"S{s}", t, rng.randrange(50)) for t in rng.sample(range(4000), 30)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert bag(trailing_mean(df, bucket_ms=bucket_ms)) == bag(plain(df))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.dictionaries(
        st.tuples(st.sampled_from("AB"), st.integers(0, 60)),
        st.one_of(st.none(), st.integers(0, 9)),
        max_size=40,
    ),
    st.integers(1, 40),
    st.integers(1, 4),
)
def test_equals_plain_window_on_any_bars(spark, bars, bucket_ms, rows):
    df = spark.createDataFrame([(s, t, v) for (s, t), v in bars.items()], SCHEMA)
    assert bag(trailing_mean(df, bucket_ms=bucket_ms, rows=rows)) == bag(plain(df, rows))


@pytest.mark.parametrize("cut", [1, 5, 17, 30])
def test_history_continues_the_series(spark, cut):
    rows = [("A", t * 3, t * t) for t in range(31)] + [("B", t * 50, t) for t in range(cut, 20)]
    df = spark.createDataFrame(rows, SCHEMA)
    old, new = df.filter(F.col("timestamp") < cut * 3), df.filter(F.col("timestamp") >= cut * 3)
    want = [r for r in bag(plain(df)) if r[1] >= cut * 3]
    assert bag(trailing_mean(new, bucket_ms=10, history=old)) == want


def test_the_frame_is_ten_bars(spark):
    rows = [bar(timestamp=i * 60_000, volume=float(2**i)) for i in range(12)]
    got = {r.timestamp_ms: r.avg_volume_10bar for r in silver(bronze(spark, rows)).collect()}
    assert got[0] is None
    assert float(got[60_000]) == 1
    assert float(got[11 * 60_000]) == round(sum(2**i for i in range(1, 11)) / 10, 2)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_window_over_bars_is_partitioned_by_symbol_alone(spark):
    df = spark.range(1000).selectExpr("CAST(id % 3 AS STRING) AS symbol", "id AS timestamp", "id AS volume")
    plan = plan_of(trailing_mean(df))
    frames = [line for line in plan.splitlines() if "Window [" in line]
    per_symbol = [line for line in frames if "_bucket" not in line.split("], [")[1]]
    assert len(per_symbol) == 1 and "_tail" in per_symbol[0]


def test_silver_scans_its_input_once(spark, tmp_path):
    path = str(tmp_path / "bronze")
    bronze(spark, [bar(timestamp=i * 1000) for i in range(200)]).write.parquet(path)
    out = silver(spark.read.parquet(path))
    out.collect()
    plan = plan_of(out)
    final = plan[plan.index("Final Plan") : plan.index("Initial Plan")]
    assert final.count("FileScan") == 1 and final.count("ReusedExchange") == 1
    assert "CartesianProduct" not in final and "BroadcastNestedLoop" not in final
