import base64
import json

import pytest
from fixtures import RAW, as_dicts, bronze
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barloom.schemas import BRONZE, SILVER, conform
from barloom.sources.envelopes import parse_prev_envelope, parse_snapshot_envelope
from barloom.sources.messages import (
    decode_messages,
    decode_stats,
    encode_messages,
    split_good_bad,
    to_base64,
)
from barloom.sources.universe import TRACKED, parse_symbols, restrict_to

# A valid message.
PAYLOAD = {
    "symbol": "AAPL", "open": 150.0, "high": 155.0, "low": 148.0, "close": 153.5,
    "volume": 1000000.0, "vwap": 152.0, "timestamp": 1700000000000, "num_trades": 5000.0,
    "ingestion_time": 1700000010000,
}


def b64(text):
    return base64.b64encode(text if isinstance(text, bytes) else text.encode()).decode()


def decode(spark, *data):
    df = spark.createDataFrame([(d, str(i)) for i, d in enumerate(data)], "data string, sequenceNumber string")
    return decode_messages(df)


def test_valid_record(spark):
    good, bad = split_good_bad(decode(spark, b64(json.dumps(PAYLOAD))))
    assert as_dicts(good) == [PAYLOAD]
    assert good.schema == BRONZE
    assert bad.count() == 0


def test_nulls_missing_and_extra_fields(spark):
    nulls = {**PAYLOAD, "vwap": None, "num_trades": None}
    fewer = {"symbol": "MSFT", "close": 300.0, "exchange": "X"}
    good, _ = split_good_bad(decode(spark, *(b64(json.dumps(p)) for p in (nulls, fewer, {}))))
    rows = as_dicts(good)
    assert rows[0] == nulls
    assert rows[1]["symbol"] == "MSFT" and rows[1]["close"] == 300.0 and rows[1]["open"] is None
    assert "exchange" not in rows[1]
    assert set(rows[2].values()) == {None}


BAD = [
    "%% neither letters nor digits %%",
    None,
    "",
    b64("a sentence, not a document"),
    b64(b"\xff\xfe{}"),
    b64("5"),
    b64("null"),
    b64('[{"symbol": "A"}]'),
    b64('{"symbol": "A", "open": "high"}'),
    b64('{"symbol": "A", "timestamp": 17.0}'),
    b64('{"symbol": "A"'),
]


def test_a_bad_record_fails_alone(spark):
    decoded = decode(spark, *BAD, b64(json.dumps(PAYLOAD)))
    good, bad = split_good_bad(decoded)
    assert as_dicts(good) == [PAYLOAD]
    kept = bad.orderBy(F.col("sequenceNumber").cast("int")).collect()
    assert [r.data for r in kept] == BAD
    assert as_dicts(decode_stats(decoded)) == [
        {"received": len(BAD) + 1, "written": 1, "decode_failures": len(BAD)}
    ]


def test_a_record_is_parsed_once(spark):
    good, _ = split_good_bad(decode(spark, b64("{}")))
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_messages_are_keyed_by_symbol(spark):
    rows = encode_messages(bronze(spark, RAW)).collect()
    assert [r.key for r in rows] == [r[0] for r in RAW]
    assert json.loads(rows[2].value)["vwap"] is None


finite = st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False))
whole = st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.one_of(st.none(), st.text(st.characters(exclude_categories=["Cs"]))), *[finite] * 6, whole, finite, whole), min_size=1, max_size=5))
def test_encode_then_decode_gives_the_bar_back(spark, rows):
    df = bronze(spark, rows)
    records = encode_messages(df).select(to_base64(F.col("value")).alias("data"))
    good, bad = split_good_bad(decode_messages(records))
    assert bad.count() == 0
    assert sorted(map(repr, good.collect())) == sorted(map(repr, df.collect()))


def test_conform(spark):
    df = spark.createDataFrame([("A", "12.34567", "x", 1)], "symbol string, open string, close string, extra int")
    got = conform(df, SILVER)
    assert got.columns == SILVER.fieldNames()
    row = got.first()
    assert str(row.open) == "12.3457" and row.close is None and row.volume is None


def test_prev_envelope(spark):
    bar_ = {"v": 1e6, "vw": 152.0, "o": 150.0, "c": 153.5, "h": 155.0, "l": 148.0, "t": 1700000000000, "n": 5000}
    answers = [
        ("AAPL", json.dumps({"status": "OK", "resultsCount": 1, "results": [bar_], "ticker": "AAPL", "adjusted": True})),
        ("MSFT", json.dumps({"status": "NOT_AUTHORIZED", "message": "no", "resultsCount": 1, "results": [bar_]})),
        ("TSLA", json.dumps({"status": "OK", "resultsCount": 0})),
        ("META", json.dumps({"status": "OK"})),
        ("V", "<html>"),
        ("JNJ", json.dumps({"resultsCount": 2, "results": [bar_, {"c": 1.0}]})),
    ]
    df = spark.createDataFrame(answers, "symbol string, body string")
    got = parse_prev_envelope(df, F.lit(42))
    assert got.schema.simpleString() == BRONZE.simpleString()
    rows = sorted(as_dicts(got), key=lambda r: (r["symbol"], r["open"] is None))
    assert [r["symbol"] for r in rows] == ["AAPL", "JNJ", "JNJ"]
    assert rows[0] == {**PAYLOAD, "ingestion_time": 42}
    assert rows[2]["close"] == 1.0 and rows[2]["timestamp"] is None


def test_snapshot_envelope(spark):
    tickers = [
        {"ticker": "ZED", "day": {"o": 2.5, "h": 4.0, "l": 2.25, "c": 3.75, "v": 640, "vw": 3.125, "n": 16}, "prevDay": {"o": 1.0}, "lastTrade": {"t": 86400000}},
        {"ticker": "QUIET", "day": {}, "lastTrade": {"t": 77}},
    ]
    df = spark.createDataFrame([(json.dumps({"tickers": tickers, "status": "OK"}),), ("{}",)], "body string")
    got = as_dicts(parse_snapshot_envelope(df, F.lit(42)))
    assert got == [
        {"symbol": "ZED", "open": 2.5, "high": 4.0, "low": 2.25, "close": 3.75, "volume": 640.0, "vwap": 3.125,
         "timestamp": 86_400_000, "num_trades": 16.0, "ingestion_time": 42}
    ]


def test_universe(spark, tmp_path):
    df = spark.createDataFrame([(s,) for s in ("AAPL", "V", "IBM", "AAPL")], "symbol string")
    assert [r.symbol for r in restrict_to(df, TRACKED).collect()] == ["AAPL", "V", "AAPL"]
    table = spark.createDataFrame([("IBM",), ("IBM",)], "symbol string")
    assert [r.symbol for r in restrict_to(df, table).collect()] == ["IBM"]
    assert parse_symbols("A,B") == ["A", "B"]
    path = str(tmp_path / "t")
    df.write.parquet(path)
    plan = restrict_to(spark.read.parquet(path), ["V", "IBM"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(symbol" in plan
