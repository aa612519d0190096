"""Report details the SQL twins do not reach."""

from datetime import date
from decimal import Decimal

import pytest
from fixtures import bar, bronze
from pyspark.sql import functions as F

from barloom.plans import reports as R
from barloom.plans.silver import silver
from barloom.sinks.gold import GoldTable

DAY = 86_400_000


@pytest.fixture(scope="module")
def bars(spark):
    rows = [
        bar("UP", 2 * DAY, open=100.0, close=110.0, volume=10.0),
        bar("UP", 2 * DAY + 60_000, open=110.0, close=109.0, volume=90.0),
        bar("DOWN", 2 * DAY, open=100.0, close=50.0, volume=5.0, ingestion_time=2 * DAY + 95_000),
        bar("FLAT", DAY, open=1.0, close=1.0),
    ]
    return silver(bronze(spark, rows)).cache()


def first(df):
    return [r[0] for r in df.collect()]


def test_the_day_is_the_latest_unless_given(bars):
    assert first(R.record_count(bars)) == [3]
    assert first(R.record_count(bars, date(1970, 1, 2))) == [1]
    assert first(R.record_count(bars, "1999-01-01")) == [0]


def test_movers_rank_by_gain_or_by_size_of_move(bars):
    assert first(R.top_movers(bars)) == ["DOWN", "UP"]
    assert first(R.top_movers_gain(bars)) == ["UP", "DOWN"]
    assert first(R.top_movers_abs(bars)) == ["DOWN", "UP"]
    up = R.top_movers(bars).filter("symbol = 'UP'").first()
    assert up.avg_change_pct == Decimal("4.5455") and up.total_volume == 100 and up.bar_count == 2


def test_spikes(bars):
    got = R.volume_spikes(bars).collect()
    assert [(r.symbol, r.volume, r.volume_ratio) for r in got] == [("UP", 90, Decimal("9.00"))]
    assert [r.symbol for r in R.volume_spikes_intraday(bars).collect()] == ["UP"]


def test_health(bars):
    row = R.health_bands(bars).first()
    assert row.record_count == 3 and row.record_count_band == "red" and row.latency_band == "green"
    assert R.latency_top(bars).first().latency_sec == Decimal("95.0")
    empty = R.health_bands(bars, "1999-01-01").first()
    assert empty.avg_latency_ms is None and empty.latency_band is None
    bands = {(r.symbol, r.pct_band) for r in R.mover_bands(bars).collect()}
    assert bands == {("UP", "green"), ("UP", "yellow"), ("DOWN", "red")}


def test_latest_and_history(bars):
    latest = {r.symbol: r.close for r in R.latest_bar_per_symbol(bars).collect()}
    assert latest == {"UP": Decimal("109.0000"), "DOWN": Decimal("50.0000"), "FLAT": Decimal("1.0000")}
    assert [r.close for r in R.symbol_history(bars, "UP").collect()] == [109.0, 110.0]
    assert R.symbol_history(bars, "UP' OR '1'='1").count() == 0
    assert R.symbol_history(bars, "UP", rows=1).count() == 1


def test_order_of_rows(bars):
    assert [(r.symbol, r.trade_date.day) for r in R.daily_summary(bars).collect()] == [("DOWN", 3), ("FLAT", 2), ("UP", 3)]
    assert [r.trade_date.day for r in R.load_check(bars).collect()] == [3, 2]
    assert first(R.close_by_symbol(bars)) == ["UP", "UP", "DOWN"]


def test_the_latest_day_prunes_partitions_of_a_stored_table(spark, tmp_path, bars):
    GoldTable(spark, str(tmp_path / "gold"), "gold_prune").refresh_full(bars)
    out = R.volume_by_symbol(spark.table("gold_prune"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "volume" in line)
    assert "PartitionFilters: [isnotnull(trade_date" in scan and "Subquery" in scan
    assert "open" not in scan.split("ReadSchema")[1]


def test_latest_bar_is_reduced_before_the_shuffle(spark, tmp_path, bars):
    gold = GoldTable(spark, str(tmp_path / "gold"))
    gold.refresh_full(bars)
    plan = R.latest_bar_per_symbol(gold.read())._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan and "SortAggregate" not in plan


def test_top_k_needs_no_full_sort(bars):
    for df in (R.latency_top(bars), R.load_check(bars), R.symbol_history(bars, "UP")):
        assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()


def test_symbol_column_is_untouched(bars):
    assert bars.select(F.max(F.length("symbol"))).first()[0] == 4


def test_spikes_are_sorted_without_a_second_pass_over_the_means(spark, sf_dir):
    from compare import connect, differences, run_sql

    import oracles
    from barloom.plans.catalog import catalog

    got = catalog()["volume_spikes_daily"](spark, sf_dir)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.index("rangepartitioning") < plan.index("REBALANCE_PARTITIONS") < plan.index("Window")
    assert not differences(got.toArrow(), run_sql(connect(sf_dir), oracles.oracle_sql()["volume_spikes_daily"]))
