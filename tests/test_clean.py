import math
from decimal import Decimal

import pytest
from fixtures import RAW, as_dicts, bar, bronze, utc_ms
from pyspark.sql import functions as F

from barloom.functions import band, is_market_hours
from barloom.functions.bands import LATENCY_MS_STEPS
from barloom.operators.clean import clean_bars, unusable_bars
from barloom.operators.dedup import any_copy, append_new_only, first_arrival, stage_counts
from barloom.operators.clean import usable
from barloom.plans.silver import silver
from barloom.schemas import SILVER


def test_dedup_keeps_one_row_per_key(spark):
    for dedup in (first_arrival, any_copy):
        kept = dedup(bronze(spark, RAW))
        assert kept.count() == 3
        assert {"AAPL", "MSFT"} <= {r.symbol for r in kept.collect()}


def test_first_arrival_wins_and_unknown_arrival_loses(spark):
    rows = [
        bar(ingestion_time=None, close=1.0),
        bar(ingestion_time=30, close=2.0),
        bar(ingestion_time=20, close=3.0),
    ]
    assert [r.close for r in first_arrival(bronze(spark, rows)).collect()] == [3.0]
    only = first_arrival(bronze(spark, [bar(ingestion_time=None, close=1.0)])).collect()
    assert [(r.close, r.ingestion_time) for r in only] == [(1.0, None)]


def test_first_arrival_is_the_same_in_any_order(spark):
    rows = [bar(ingestion_time=5, close=c, vwap=v) for c, v in ((3.0, None), (2.0, 1.0), (2.0, None))]
    results = {
        first_arrival(bronze(spark, order).repartition(3)).collect()[0]
        for order in (rows, rows[::-1], rows[1:] + rows[:1])
    }
    assert len(results) == 1


def test_vwap_trades_and_prices(spark):
    rows = {r.symbol: r for r in clean_bars(first_arrival(bronze(spark, RAW))).collect()}
    assert set(rows) == {"AAPL", "MSFT"}
    assert rows["MSFT"].vwap == rows["MSFT"].close
    assert rows["MSFT"].num_trades == 0
    assert rows["AAPL"].num_trades == 5000


def test_a_copy_without_prices_does_not_displace_a_good_one(spark):
    rows = [bar(ingestion_time=1, close=None), bar(ingestion_time=2, close=8.0)]
    assert [r.close for r in silver(bronze(spark, rows)).collect()] == [Decimal("8.0000")]


def test_unusable_rows_are_told_apart(spark):
    rows = [
        bar(),
        bar(close=math.nan),
        bar(symbol=None),
        bar(timestamp=1, open=None),
        bar(timestamp=1)[:7] + (None, 1.0, 1),
    ]
    df = bronze(spark, rows)
    assert clean_bars(df).count() == 1
    assert sorted(r.reason for r in unusable_bars(df).collect()) == ["key", "key", "prices", "prices"]


@pytest.mark.parametrize("price", [math.inf, -math.inf, 123_456_789.0, -1e300, 99_999_999.99996])
def test_prices_that_silver_cannot_hold_are_dead_letters(spark, price):
    df = bronze(spark, [bar(open=price), bar(timestamp=2, high=price), bar(timestamp=3)])
    assert [r.reason for r in unusable_bars(df).collect()] == ["range", "range"]
    rows = silver(df).collect()
    assert len(rows) == 1 and rows[0].open is not None


@pytest.mark.parametrize("vwap", [math.nan, math.inf, 1e12, None])
def test_close_stands_in_for_a_vwap_that_is_no_price(spark, vwap):
    row = silver(bronze(spark, [bar(vwap=vwap)])).first()
    assert row.vwap == row.close


def test_silver_columns(spark):
    out = silver(bronze(spark, RAW))
    assert out.schema.simpleString() == SILVER.simpleString()
    rows = {r.symbol: r for r in out.collect()}
    assert set(rows) == {"AAPL", "MSFT"}
    assert rows["AAPL"].price_change == Decimal("3.5000")
    assert rows["AAPL"].price_change_pct == Decimal("2.3333")
    assert rows["AAPL"].bar_range_pct == Decimal("4.6667")
    assert rows["AAPL"].event_time is not None and rows["AAPL"].trade_date is not None
    assert rows["AAPL"].ingestion_time == 1700000010000
    assert rows["AAPL"].avg_volume_10bar is None


def test_milliseconds_are_kept(spark):
    out = silver(bronze(spark, [bar(timestamp=1_700_000_000_123)]))
    assert out.select(F.date_format("event_time", "SSS")).first()[0] == "123"


def test_zero_open_and_overflow(spark):
    rows = [
        bar(timestamp=1000, open=0.0),
        bar(timestamp=2000, open=0.0001, close=50.0, high=60.0),
        bar(timestamp=3000, volume=None),
    ]
    got = {r.timestamp_ms: r for r in silver(bronze(spark, rows)).collect()}
    assert got[1000].price_change_pct == got[1000].bar_range_pct == Decimal("0.0000")
    assert got[2000].price_change_pct is None and got[2000].bar_range_pct is None
    assert got[2000].price_change == Decimal("49.9999")
    assert got[3000].volume is None


SESSION = [
    # moment (UTC), by the fixed UTC session, by the exchange's clock
    ("2024-01-15T14:29:00", False, False),
    ("2024-01-15T14:30:00", True, True),
    ("2024-01-15T20:59:59", True, True),
    ("2024-01-15T21:00:00", False, False),
    ("2024-07-01T13:29:00", False, False),
    ("2024-07-01T13:30:00", False, True),
    ("2024-07-01T20:00:00", True, False),
    ("2024-03-10T14:00:00", False, True),
    ("2024-11-03T14:00:00", False, False),
    ("2024-01-15T02:00:00", False, False),
]


@pytest.mark.parametrize("mode, column", [("utc_fixed", 1), ("exchange_tz", 2)])
def test_market_hours(spark, mode, column):
    df = spark.createDataFrame([(i, utc_ms(m[0])) for i, m in enumerate(SESSION)], "i int, ms long")
    got = df.select("i", is_market_hours(F.timestamp_millis("ms"), mode).alias("open")).collect()
    assert {r.i: r.open for r in got} == {i: m[column] for i, m in enumerate(SESSION)}


def test_unknown_mode():
    with pytest.raises(ValueError):
        is_market_hours(None, "always")


def test_bands(spark):
    df = spark.createDataFrame([(v,) for v in (0, 59_999, 60_000, 89_999, 90_000, None)], "v long")
    got = [r.b for r in df.select(band(F.col("v"), LATENCY_MS_STEPS).alias("b")).collect()]
    assert got == ["green", "green", "yellow", "yellow", "red", None]


def test_stage_counts(spark):
    got = as_dicts(stage_counts(bronze(spark, RAW), usable()))
    assert got == [
        {"rows_read": 4, "rows_after_dedup": 3, "duplicates_removed": 1, "rows_final": 2}
    ]


def test_append_new_only(spark):
    old = silver(bronze(spark, [bar(timestamp=t * 86_400_000) for t in (1, 2, 3)]))
    new = silver(bronze(spark, [bar(timestamp=t * 86_400_000) for t in (3, 4)]))
    for within in ("trade_date", None):
        got = append_new_only(new, old, within=within).collect()
        assert [r.timestamp_ms for r in got] == [4 * 86_400_000]
    assert append_new_only(new, old.limit(0)).count() == 2
    assert append_new_only(new.limit(0), old).count() == 0
