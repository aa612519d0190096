import os
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal
from pathlib import Path

import pytest
from fixtures import RAW, as_dicts, bar, bronze
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators.contract import apply_defaults, check_contract, evolution_errors
from barloom.operators.retention import retention_tier, unexpired
from barloom.plans.catalog import catalog
from barloom.plans.reports import daily_summary, on_day, top_movers
from barloom.plans.silver import silver
from barloom.schemas import BRONZE, GOLD, SILVER
from barloom.sinks.gold import GoldTable, gold_rows
from barloom.sinks.tables import layout_gold, write_bronze, write_silver
from barloom.sinks.upkeep import Plan, apply_retention
from barloom.sinks.versions import VersionedTable
from barloom.sources.envelopes import parse_prev_envelope, unusable_answers
from barloom.sources.tables import fresh_files, has_new_data, latest_day, read_bronze, register_table
from barloom.sources.universe import parse_symbols

NOON = datetime(2024, 1, 5, 14, 30, tzinfo=timezone.utc)
DAY = 86_400_000


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bronze_folders_and_pruning(spark, tmp_path):
    path = str(tmp_path / "raw")
    write_bronze(bronze(spark, RAW), path, NOON)
    folder = Path(path, "year=2024", "month=01", "day=05")
    files = list(folder.glob("*.parquet"))
    assert files and all("snappy" in f.name for f in files)
    write_bronze(bronze(spark, [bar()]), path, NOON + timedelta(days=30))
    df = read_bronze(spark, path)
    assert df.count() == 5
    one = df.filter("year = 2024 AND month = 2")
    assert one.count() == 1
    assert "PartitionFilters: [isnotnull(year" in plan_of(one)


def test_an_empty_batch_writes_no_bronze(spark, tmp_path):
    path = str(tmp_path / "raw")
    write_bronze(bronze(spark, []), path, NOON, batch="0")
    assert not list(Path(path).rglob("*.parquet"))


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "raw")
    for rows in ([bar()], [bar(), bar(symbol="B")]):
        write_bronze(bronze(spark, rows), path, NOON, batch="7")
    write_bronze(bronze(spark, [bar(symbol="C")]), path, NOON, batch="8")
    assert sorted(r.symbol for r in read_bronze(spark, path).collect()) == ["AAPL", "B", "C"]


@pytest.fixture()
def bars(spark):
    rows = [bar(symbol=s, timestamp=d * DAY + m * 60_000) for s in "AB" for d in (1, 2, 3) for m in range(5)]
    return silver(bronze(spark, rows))


@pytest.mark.parametrize("by", [(), ("trade_date",), ("trade_date", "symbol")])
def test_silver_keeps_all_columns_in_its_files(spark, tmp_path, bars, by):
    path = str(tmp_path / "silver")
    write_silver(bars, path, by)
    write_silver(bars.limit(0), path, by)
    files = [str(p) for p in Path(path).rglob("*.parquet")]
    back = spark.read.parquet(*files)
    assert back.schema.simpleString() == SILVER.simpleString()
    assert sorted(back.collect()) == sorted(bars.collect())
    assert {p.name for p in Path(path).glob("by_date=*")} == (
        {f"by_date=1970-01-0{d}" for d in (2, 3, 4)} if by else set()
    )


def test_silver_append(spark, tmp_path, bars):
    path = str(tmp_path / "silver")
    write_silver(bars, path)
    write_silver(bars, path)
    assert spark.read.parquet(path).count() == 2 * bars.count()


def test_gold_full_refresh_leaves_the_old_version_readable(spark, tmp_path, bars):
    gold = GoldTable(spark, str(tmp_path / "gold"), "gold_t")
    first = gold.refresh_full(bars.filter("symbol = 'A'"))
    old, shown = gold.read(), spark.table("gold_t")
    second = gold.refresh_full(bars)
    assert not first.folders & second.folders
    assert old.count() == shown.count() == 15 and spark.table("gold_t").count() == 30
    assert spark.table("gold_t").columns == GOLD.fieldNames()
    pruned = spark.table("gold_t").filter(F.col("trade_date") == F.lit("1970-01-03").cast("date"))
    assert pruned.count() == 10 and "PartitionFilters: [isnotnull(trade_date" in plan_of(pruned)


def test_gold_date_refresh_touches_one_date(spark, tmp_path, bars):
    gold = GoldTable(spark, str(tmp_path / "gold"), "gold_d")
    before = gold.refresh_full(bars)
    after = gold.refresh_date(bars.withColumn("volume", F.lit(1).cast("bigint")), date(1970, 1, 3))
    for table in (gold.read(), spark.table("gold_d"), spark.newSession().table("gold_d")):
        got = table.groupBy("trade_date").agg(F.sum("volume").alias("v")).collect()
        assert {r.trade_date.day: r.v for r in got} == {2: 1000, 3: 10, 4: 1000}
    assert {f.date for f in before.folders ^ after.folders} == {"1970-01-03"}


def test_a_load_that_fails_moves_nothing(spark, tmp_path, bars):
    gold = GoldTable(spark, str(tmp_path / "gold"), "gold_f")
    gold.refresh_full(bars)
    broken = bars.withColumn("volume", F.raise_error(F.lit("broken")).cast("bigint"))
    with pytest.raises(Exception, match="broken"):
        gold.refresh_date(broken, "1970-01-03")
    assert spark.table("gold_f").count() == gold.read().count() == 30


def test_bucketed_gold_groups_by_symbol_without_a_shuffle(spark, tmp_path, bars):
    gold = GoldTable(spark, str(tmp_path / "gold"), "gold_b", buckets=3)
    gold.refresh_full(bars)
    gold.refresh_date(bars.filter("symbol = 'A'"), "1970-01-03")
    sums = spark.table("gold_b").groupBy("symbol").agg(F.sum("volume").alias("v"))
    assert "Exchange" not in plan_of(sums)
    assert {r.symbol: r.v for r in sums.collect()} == {"A": 1500, "B": 1000}
    assert sorted(spark.table("gold_b").collect()) == sorted(gold.read().collect())


def test_create_gold_shows_what_lies_there(spark, tmp_path, bars):
    empty = GoldTable(spark, str(tmp_path / "none's"), "ohlcv_t")
    for _ in range(2):
        empty.create()
        assert spark.table("ohlcv_t").count() == 0
    assert set(spark.table("ohlcv_t").columns) == set(GOLD.fieldNames())
    plain = str(tmp_path / "it's plain")
    gold_rows(bars).write.partitionBy("trade_date").parquet(plain)
    GoldTable(spark, plain, "ohlcv_t").create()
    assert spark.table("ohlcv_t").count() == 30
    mine = GoldTable(spark, str(tmp_path / "it's mine"))
    mine.refresh_full(bars.filter("symbol = 'A'"))
    again = GoldTable(spark, str(tmp_path / "it's mine"), "ohlcv_t")
    again.create()
    assert spark.table("ohlcv_t").count() == 15
    again.create()
    assert spark.newSession().table("ohlcv_t").count() == 15


def test_layout_sorts_and_splits_a_hot_symbol(spark, tmp_path):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 > 0, "HOT").otherwise(F.concat(F.lit("S"), F.col("id") % 50)).alias("symbol"),
        F.timestamp_seconds(F.col("id") * 977).alias("event_time"),
    ).withColumn("trade_date", F.to_date("event_time"))
    laid = layout_gold(df).withColumn("p", F.spark_partition_id())
    rows = laid.withColumn("i", F.monotonically_increasing_id()).orderBy("i").collect()
    by_part = {}
    for r in rows:
        by_part.setdefault(r.p, []).append(r)
    for part in by_part.values():
        keys = [(r.symbol, r.trade_date, r.event_time) for r in part]
        assert keys == sorted(keys)
    hot_parts = [p for p, rs in by_part.items() if any(r.symbol == "HOT" for r in rs)]
    assert len(rows) == 20_000
    assert len(hot_parts) > 1 or len(by_part) == 1


def test_fresh_files(spark, tmp_path):
    path = str(tmp_path / "raw")
    write_bronze(bronze(spark, RAW).coalesce(1), path, NOON)
    now = datetime.now(timezone.utc)
    assert has_new_data(spark, path, now)
    assert not has_new_data(spark, path, now + timedelta(hours=3))
    old = next(Path(path).rglob("*.parquet"))
    stamp = (now - timedelta(hours=5)).timestamp()
    os.utime(old, (stamp, stamp))
    assert not has_new_data(spark, path, now)
    assert [r.bytes for r in fresh_files(spark, path, now, within_s=6 * 3600).collect()] == [old.stat().st_size]


def test_register_merges_new_columns_and_refuses_lost_ones(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("A", 1)], "symbol string, volume long").write.parquet(path)
    known = register_table(spark, path, "reg_t").schema
    spark.createDataFrame([("B", 2, 3)], "symbol string, volume long, extra int").write.mode("append").parquet(path)
    assert register_table(spark, path, "reg_t", known).columns == ["symbol", "volume", "extra"]
    assert spark.sql("SELECT count(extra), count(*) FROM reg_t").first()[:] == (1, 2)
    lost = T.StructType([*known.fields, T.StructField("gone", T.StringType())])
    with pytest.raises(ValueError, match="gone"):
        register_table(spark, path, "reg_t", lost)
    retyped = T.StructType([T.StructField("symbol", T.LongType())])
    assert evolution_errors(retyped, known) == ["column symbol changed from bigint to string"]


def test_contract(spark):
    good = apply_defaults(silver(bronze(spark, [bar(volume=None), bar(symbol="B")])))
    assert good.filter("volume = 0").count() == 1
    assert {r.violations for r in check_contract(good).collect()} == {0}
    broken = silver(bronze(spark, [bar(volume=None), bar(symbol="MUCHTOOLONGNAME")]))
    broken = broken.unionByName(broken.limit(1)).withColumn("high", F.lit(10**9).cast("decimal(20,4)"))
    got = {r.rule: r.violations for r in check_contract(broken).collect() if r.violations}
    assert got.pop("volume_not_null") in (1, 2)
    assert got.pop("symbol_max_length") in (1, 2)
    assert got == {"high_in_range": 3, "key_unique": 1}


def test_retention(spark):
    df = spark.createDataFrame([(date(2024, 2, 1) - timedelta(days=n),) for n in (0, 6, 7, 29, 30)], "trade_date date")
    as_of = F.lit("2024-02-01").cast("date")
    got = [r.t for r in df.select(retention_tier(F.col("trade_date"), as_of).alias("t")).collect()]
    assert got == ["hot", "hot", "cold", "cold", "expired"]
    assert unexpired(df, as_of).count() == 4


def test_an_emptied_date_leaves_gold(spark, tmp_path, bars):
    gold = GoldTable(spark, str(tmp_path / "gold"), "gold_to_empty")
    gold.refresh_full(bars)
    gold.refresh_date(bars.filter("trade_date <> '1970-01-03'"), "1970-01-03")
    left = {str(r.trade_date) for r in spark.table("gold_to_empty").select("trade_date").distinct().collect()}
    assert left == {"1970-01-02", "1970-01-04"}


@pytest.mark.parametrize("as_of", [None, "1970-01-03"])
def test_a_day_of_partitioned_silver_is_one_folder(spark, tmp_path, bars, as_of):
    path = str(tmp_path / "silver")
    write_silver(bars, path, ["trade_date"])
    day = on_day(register_table(spark, path, "silver_to_prune"), as_of)
    assert {str(r.trade_date) for r in day.collect()} == {as_of or "1970-01-04"} and day.count() == 10
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(by_date" in plan


def test_every_rule_of_the_contract_has_a_planted_fault(spark, sf_dir):
    got = {r.rule: r.violations for r in catalog()["contract_before_cast"](spark, sf_dir).collect()}
    assert len(got) == 23 and min(got.values()) > 0, got


@pytest.mark.parametrize("versioned", [False, True])
def test_the_latest_day_is_one_scan_of_one_folder(spark, tmp_path, bars, versioned):
    path = str(tmp_path / "silver")
    if versioned:
        table = VersionedTable(spark, path)
        table.commit(table.current(), table.add(bars.withColumn("by_date", F.col("trade_date"))))
    else:
        write_silver(bars, path, ["trade_date"])
    report = top_movers(latest_day(spark, path))
    want = top_movers(register_table(spark, path, "silver_latest"))
    assert sorted(report.collect()) == sorted(want.collect()) and report.count() == 2
    plan = plan_of(top_movers(latest_day(spark, path)))
    assert plan.count("FileScan") == 1 and "ubquery" not in plan
    assert {Path(f).parent.name for f in latest_day(spark, path).inputFiles()} == {"by_date=1970-01-04"}
    assert latest_day(spark, str(tmp_path / "none")).count() == 0


def test_last_days_prune_folders(spark, tmp_path, bars):
    path = str(tmp_path / "silver")
    write_silver(bars, path, ["trade_date"])
    days = daily_summary(register_table(spark, path, "silver_days"), as_of="1970-01-04", days=1)
    assert days.count() == 4
    assert "PartitionFilters: [isnotnull(by_date" in plan_of(days)


def test_retention_drops_packs_and_leaves_what_is_packed(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), counted="symbol")
    schema = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("n", T.IntegerType())])
    days = [date(2024, 1, 1) + timedelta(days=d) for d in (0, 1, 20, 29, 30, 31)]
    for k in range(3):
        rows = spark.createDataFrame([(s, k, d) for s in "AB" for d in days], "symbol string, n int, by_date date").repartition(4)
        table.commit(table.current(), table.add(rows))
    as_of = date(2024, 2, 1)
    before = table.read(schema).select("symbol", "n", "by_date").filter(F.col("by_date") > F.lit(days[1])).collect()
    todo = apply_retention(table, schema, as_of, most_folders=2)
    assert (todo.expired, todo.cold, todo.crowded) == (
        ("2024-01-01", "2024-01-02"), ("2024-01-21",), ("2024-01-30", "2024-01-31", "2024-02-01"),
    )
    now = table.current()
    assert sorted(table.read(schema).select("symbol", "n", "by_date").collect()) == sorted(before)
    assert [f.date for f in sorted(now.folders)] == [str(d) for d in days[2:]]
    assert {len(list(Path(table.place(f)).glob("*.parquet"))) for f in now.folders} == {1}
    assert {f.date for f in now.folders if f.write.startswith("cold-")} == {"2024-01-21"}
    assert "zstd" in next(Path(table.place(now.on(["2024-01-21"])[0])).glob("*.parquet")).name
    assert {(r.symbol, str(r.by_date)): r.rows for r in table.counts(now).collect()} == {(s, str(d)): 3 for s in "AB" for d in days[2:]}
    assert apply_retention(table, schema, as_of, most_folders=2) == Plan((), (), ()) and table.current() == now
    table.vacuum(keep=1)
    assert sorted(table.read(schema).select("symbol", "n", "by_date").collect()) == sorted(before)
    assert len(list(Path(table.path).rglob("*.parquet"))) < 20


def test_answers_without_bars_are_told_apart(spark):
    good = '{"status":"OK","resultsCount":1,"results":[{"o":1,"h":1,"l":1,"c":1,"v":1,"vw":1,"t":1,"n":1}]}'
    bodies = [good, '{"status":"NOT_AUTHORIZED"}', '{"status":"OK","resultsCount":0}', '{"status":"OK","resultsCount":2}', "[1", None, "{}"]
    answers = spark.createDataFrame([(str(i), b) for i, b in enumerate(bodies)], "symbol string, body string")
    got = {r.symbol: r.reason for r in unusable_answers(answers).collect()}
    assert got == {"1": "refused", "2": "empty", "3": "empty", "4": "unreadable", "5": "unreadable", "6": "unreadable"}
    assert parse_prev_envelope(answers, F.lit(1)).count() == 1
    assert parse_symbols(" A,B ,, C") == ["A", "B", "C"]
