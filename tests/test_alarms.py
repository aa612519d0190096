import random

from pyspark.sql import functions as F

from barloom.operators.alarms import LAG_MS, Rule, eval_alarm


def series(spark, rows):
    df = spark.createDataFrame(rows, "name string, s long, value long")
    return df.withColumn("at", F.timestamp_seconds("s"))


def states(df, *dims):
    rows = df.select(*dims, F.unix_seconds("period_start").alias("s"), "metric", "in_alarm").collect()
    return {tuple(r)[:-2]: tuple(r)[-2:] for r in rows}


def test_two_periods_in_a_row_and_gaps(spark):
    rows = [("a", s, v) for s, v in ((0, 70_000), (61, 80_000), (125, 1), (180, 99_000), (300, 99_000), (359, 5), (360, 60_001))]
    got = states(eval_alarm(series(spark, rows), "at", F.col("value"), LAG_MS))
    assert got == {
        (0,): (70_000, False),
        (60,): (80_000, True),
        (120,): (1, False),
        (180,): (99_000, False),
        (240,): (None, False),
        (300,): (99_000, False),
        (360,): (60_001, True),
    }


def test_no_data_no_states(spark):
    assert eval_alarm(series(spark, []), "at", F.col("value"), LAG_MS).count() == 0
    assert eval_alarm(series(spark, []), "at", F.col("value"), LAG_MS, dims=["name"]).count() == 0


def test_against_brute_force_per_series(spark):
    rng = random.Random(1)
    rows = [(rng.choice("xxxy"), rng.randrange(-2000, 6000), rng.randrange(10)) for _ in range(150)]
    rule = Rule("sum", 60, ">=", 9, periods=3)
    want = {}
    for name in "xy":
        sums = {}
        for n, s, v in rows:
            if n == name:
                sums[s // 60 * 60] = sums.get(s // 60 * 60, 0) + v
        for s in range(min(sums), max(sums) + 1, 60):
            held = all(sums.get(s - k * 60, 0) >= 9 for k in range(3))
            want[(name, s)] = (sums.get(s), held)
    got = states(eval_alarm(series(spark, rows), "at", F.col("value"), rule, dims=["name"]), "name")
    assert got == want


def test_the_metric_is_scanned_once(spark, tmp_path):
    path = str(tmp_path / "t")
    series(spark, [("a", 1, 2), ("b", 90, 3)]).write.parquet(path)
    out = eval_alarm(spark.read.parquet(path), "at", F.col("value"), LAG_MS, dims=["name"])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("Final Plan") : plan.index("Initial Plan")]
    assert final.count("FileScan") == 1
