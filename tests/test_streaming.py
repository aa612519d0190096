import json
import random
from pathlib import Path

import pytest
from fixtures import bar, bronze
from pyspark.sql import Window
from pyspark.sql import functions as F
from test_messages import BAD, PAYLOAD, b64

from barloom.operators.dedup import first_arrival
from barloom.operators.resample import resample_ohlcv
from barloom.plans.silver import distinct_bars, silver
from barloom.schemas import BRONZE, SILVER
from barloom.sinks.tables import write_bronze
from barloom.sources.tables import read_bronze
from barloom.streaming.bars import (
    late_ticks,
    read_means,
    start_to_parquet,
    stream_dedup,
    stream_first_arrival,
    stream_resample,
    stream_rolling_volume,
)
from barloom.streaming.held import LogGone, held_bars, held_first_copies, with_held
from barloom.streaming.incremental import RunCounts, read_silver, run_incremental
from barloom.streaming.ingest import TRANSPORT, read_messages, stream_bronze

HOUR = 3_600_000
T0 = 1_700_000_000_000


def deliver(df, path):
    df.coalesce(1).write.mode("append").parquet(str(path))


def messages(spark, *data):
    return spark.createDataFrame([("k", d, str(i), 0.0) for i, d in enumerate(data)], TRANSPORT)


def ingest(spark, tmp_path):
    q = stream_bronze(
        read_messages(spark, str(tmp_path / "in"), max_files=1),
        str(tmp_path / "bronze"), str(tmp_path / "bad"), str(tmp_path / "cp"),
    )
    q.awaitTermination()
    return q


def test_ingest_splits_counts_and_remembers(spark, tmp_path):
    deliver(messages(spark, b64(json.dumps(PAYLOAD)), *BAD), tmp_path / "in")
    q = ingest(spark, tmp_path)
    seen = q.lastProgress["observedMetrics"]["ingest"]
    assert (seen["received"], seen["written"], seen["decode_failures"]) == (len(BAD) + 1, 1, len(BAD))
    assert seen["max_lag_ms"] > 0
    deliver(messages(spark, b64(json.dumps({**PAYLOAD, "symbol": "MSFT"}))), tmp_path / "in")
    ingest(spark, tmp_path)
    ingest(spark, tmp_path)
    assert sorted(r.symbol for r in read_bronze(spark, str(tmp_path / "bronze")).collect()) == ["AAPL", "MSFT"]
    bad = spark.read.parquet(str(tmp_path / "bad"))
    assert bad.count() == len(BAD) and {"data", "sequenceNumber", "failure"} <= set(bad.columns)


def test_only_bad_records_write_no_bronze(spark, tmp_path):
    deliver(messages(spark, *BAD), tmp_path / "in")
    ingest(spark, tmp_path)
    assert not list((tmp_path / "bronze").rglob("*.parquet"))


def test_a_failing_write_fails_the_query_and_is_tried_again(spark, tmp_path):
    deliver(messages(spark, b64(json.dumps(PAYLOAD))), tmp_path / "in")
    (tmp_path / "bronze").write_text("in the way")
    with pytest.raises(Exception):
        ingest(spark, tmp_path)
    (tmp_path / "bronze").rename(tmp_path / "elsewhere")
    ingest(spark, tmp_path)
    assert read_bronze(spark, str(tmp_path / "bronze")).count() == 1


def bronze_stream(spark, path, max_files=1):
    return spark.readStream.schema(BRONZE).option("maxFilesPerTrigger", max_files).parquet(str(path))


def test_dedup_across_batches(spark, tmp_path):
    rows = [bar(timestamp=T0 + i) for i in range(14)]
    rows += [bar(timestamp=T0 + i, ingestion_time=1) for i in (0, 3, 9)]
    deliver(bronze(spark, rows[:10]), tmp_path / "in")
    deliver(bronze(spark, rows[10:]), tmp_path / "in")
    out = str(tmp_path / "out")
    start_to_parquet(stream_dedup(bronze_stream(spark, tmp_path / "in")), out, str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(out).count() == 14


def test_first_arrival_across_batches(spark, tmp_path):
    rows = [bar(timestamp=T0 + i * HOUR, ingestion_time=T0 + a) for i in range(60) for a in (500, 100)]
    random.Random(0).shuffle(rows)
    deliver(bronze(spark, rows[:70]), tmp_path / "in")
    deliver(bronze(spark, rows[70:]), tmp_path / "in")
    out = str(tmp_path / "out")
    start_to_parquet(
        stream_first_arrival(bronze_stream(spark, tmp_path / "in"), "100 hours"), out, str(tmp_path / "cp")
    ).awaitTermination()
    assert spark.read.schema(BRONZE).parquet(out).count() == 0
    whole = with_held(spark, out, held_first_copies(spark, str(tmp_path / "cp"), BRONZE.fieldNames()))
    assert sorted(whole.collect()) == sorted(first_arrival(bronze(spark, rows)).collect())
    deliver(bronze(spark, [bar(symbol="LATE", timestamp=T0 + 500 * HOUR)]), tmp_path / "in")
    start_to_parquet(
        stream_first_arrival(bronze_stream(spark, tmp_path / "in"), "100 hours"), out, str(tmp_path / "cp")
    ).awaitTermination()
    got = sorted(spark.read.schema(BRONZE).parquet(out).collect())
    assert got == sorted(first_arrival(bronze(spark, rows)).collect())


def test_resampling_drops_nothing_before_the_watermark(spark, tmp_path):
    rng = random.Random(2)
    rows = sorted((rng.randrange(40_000), rng.choice("AB"), rng.randrange(1, 900) / 100, rng.randrange(9)) for _ in range(300))
    schema = "s long, symbol string, price double, size long, tick_id long"
    parts = [[(*r, i) for i, r in enumerate(rows)][lo:hi] for lo, hi in ((0, 150), (150, 300))]
    for part in parts:
        rng.shuffle(part)
        deliver(spark.createDataFrame(part, schema).withColumn("event_time", F.timestamp_seconds("s")), tmp_path / "in")
    batch = spark.read.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    start_to_parquet(
        stream_resample(stream, 60, tie_breaker="tick_id"), out, str(tmp_path / "cp")
    ).awaitTermination()
    newest = batch.agg(F.max("s")).first()[0]
    closed = resample_ohlcv(batch, 60, tie_breaker="tick_id").filter(
        F.unix_seconds("bar_start") + 3600 <= newest - 3600
    )
    assert closed.count() > 10
    assert sorted(spark.read.parquet(out).collect()) == sorted(closed.collect())


def test_closed_held_and_late_are_all_ticks(spark, tmp_path):
    rng = random.Random(3)
    schema = "s long, symbol string, price double, size long, tick_id long"
    source, out, cp = (str(tmp_path / n) for n in ("a b", "out", "cp"))
    seconds = [[rng.randrange(lo, hi) for _ in range(40)] for lo, hi in ((0, 20_000), (15_000, 60_000), (0, 70_000), (30_000, 90_000), (0, 90_000))]
    rows = [[(s, rng.choice("AB"), None if rng.random() < 0.1 else 1.5, 2, 100 * i + j) for j, s in enumerate(part)] for i, part in enumerate(seconds)]
    seen, dropped = -1, 0
    late = []
    for i in range(0, 5, 2):  # runs of two deliveries, a batch each
        for part in rows[i : i + 2]:
            deliver(spark.createDataFrame(part, schema).withColumn("event_time", F.timestamp_seconds("s")), source)
        kind = spark.read.parquet(source).schema
        stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(source)
        query = start_to_parquet(stream_resample(stream, 60, tie_breaker="tick_id"), out, cp)
        query.awaitTermination()
        dropped += sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress if p["stateOperators"])
        late += late_ticks(spark, cp, kind, 60, after=seen).collect()
        seen = query.lastProgress["batchId"]
    ticks = spark.read.parquet(source)
    bars = with_held(spark, out, held_bars(spark, cp))
    assert dropped > 0 and len({r.tick_id for r in late}) == len(late) >= dropped
    assert held_bars(spark, cp).count() > 0
    gone = [r.tick_id for r in late]
    want = resample_ohlcv(ticks.filter(~F.col("tick_id").isin(gone)), 60, tie_breaker="tick_id")
    assert sorted(bars.collect()) == sorted(want.select(*bars.columns).collect())


def test_late_rows_need_the_log(spark, tmp_path):
    rows = [(i, "A", 1.0, 1, i) for i in range(3)]
    schema = "s long, symbol string, price double, size long, tick_id long"
    deliver(spark.createDataFrame(rows, schema).withColumn("event_time", F.timestamp_seconds("s")), tmp_path / "in")
    kind = spark.read.parquet(str(tmp_path / "in")).schema
    stream = spark.readStream.schema(kind).parquet(str(tmp_path / "in"))
    start_to_parquet(stream_resample(stream, 60), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert late_ticks(spark, str(tmp_path / "cp"), kind, 60).count() == 0
    assert late_ticks(spark, str(tmp_path / "none"), kind, 60).count() == 0
    (tmp_path / "cp/offsets/0").unlink()
    with pytest.raises(LogGone):
        late_ticks(spark, str(tmp_path / "cp"), kind, 60)


def test_rolling_volume_across_batches(spark, tmp_path):
    rows = [(s, t * 60_000, t * t % 97) for t in range(45) for s in ("A", "B") if t % 2 or s == "A"]
    schema = "symbol string, timestamp long, volume long"
    out = str(tmp_path / "out")
    for lo, hi in ((0, 7), (7, 8), (8, 30), (30, 45)):
        part = [r for r in rows if lo <= r[1] // 60_000 < hi]
        deliver(spark.createDataFrame(part, schema), tmp_path / "in")
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        stream_rolling_volume(stream, out, str(tmp_path / "st"), str(tmp_path / "cp"), bucket_ms=600_000).awaitTermination()
    frame = Window.partitionBy("symbol").orderBy("timestamp").rowsBetween(-10, -1)
    want = spark.createDataFrame(rows, schema).withColumn("avg_volume_10bar", F.avg("volume").over(frame))
    got = read_means(spark, out, spark.createDataFrame([], schema).schema).select(*want.columns)
    assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr)


def test_incremental_equals_one_batch_and_a_rerun_adds_nothing(spark, tmp_path):
    day = 24 * HOUR
    rows = [bar(symbol=s, timestamp=t * 5 * HOUR, volume=float(t % 7)) for t in range(60) for s in "AB"]
    rows += [bar(symbol="A", timestamp=10 * 5 * HOUR, ingestion_time=0, volume=3.0), bar(timestamp=1, open=None)]
    args = [str(tmp_path / n) for n in ("raw", "silver", "state", "cp")]
    first = [r for r in rows if r[7] < 4 * day]
    write_bronze(bronze(spark, first), args[0])
    assert run_incremental(spark, *args).added == len({(r[0], r[7]) for r in first if r[1] is not None})
    write_bronze(bronze(spark, rows[-40:] + rows), args[0])
    added = run_incremental(spark, *args, max_files=100).added
    assert added == len({(r[0], r[7]) for r in rows if r[7] >= 4 * day})
    assert run_incremental(spark, *args) == RunCounts()
    got = read_silver(spark, args[1]).select(*SILVER.fieldNames())
    want = silver(bronze(spark, rows))
    assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr)
    assert {p.name for p in Path(args[1]).rglob("by_date=*")} and distinct_bars(bronze(spark, rows)).count() == got.count()


def test_two_runs_into_one_silver(spark, tmp_path):
    rows = [bar(symbol=s, timestamp=t * 5 * HOUR, volume=float(t % 7)) for t in range(60) for s in "AB"]
    raw, out = str(tmp_path / "raw"), str(tmp_path / "silver")
    parts = [rows[0::3], rows[1::3], rows]
    for i, part in enumerate(parts):  # a new checkpoint and no state each time, late bars in the second and third
        write_bronze(bronze(spark, part), raw)
        run_incremental(spark, raw, out, str(tmp_path / f"state{i}"), str(tmp_path / f"cp{i}"))
    got = read_silver(spark, out).select(*SILVER.fieldNames())
    assert sorted(got.collect(), key=repr) == sorted(silver(bronze(spark, rows)).collect(), key=repr)


def test_a_late_bar_mends_the_means_after_it(spark, tmp_path):
    rows = [bar(timestamp=T0 + i * 60_000, volume=float(i)) for i in range(30)]
    args = [str(tmp_path / n) for n in ("raw", "silver", "state", "cp")]
    for part in ([r for i, r in enumerate(rows) if i not in (0, 5)], [rows[5]], [rows[0]]):
        write_bronze(bronze(spark, part), args[0])
        assert run_incremental(spark, *args).added == len(part)
    got = read_silver(spark, args[1]).select(*SILVER.fieldNames())
    assert sorted(got.collect(), key=repr) == sorted(silver(bronze(spark, rows)).collect(), key=repr)


def test_a_batch_keeps_its_day_when_it_is_tried_again(spark, tmp_path):
    deliver(messages(spark, b64(json.dumps(PAYLOAD)), *BAD), tmp_path / "in")
    (tmp_path / "bad").write_text("in the way")
    with pytest.raises(Exception):
        ingest(spark, tmp_path)  # bronze is written, quarantine is not
    day = {p.relative_to(tmp_path) for p in (tmp_path / "bronze").rglob("batch=*")}
    (tmp_path / "bad").rename(tmp_path / "elsewhere")
    ingest(spark, tmp_path)
    assert {p.relative_to(tmp_path) for p in (tmp_path / "bronze").rglob("batch=*")} == day
    assert read_bronze(spark, str(tmp_path / "bronze")).count() == 1
