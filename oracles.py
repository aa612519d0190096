"""The catalogue's queries once more, as SQL for DuckDB over the same tables."""

from __future__ import annotations


def _dec(expr: str, p: int, s: int) -> str:
    """A double as a decimal, rounded half up on its shortest decimal form, or null."""
    return f"TRY_CAST(CAST({expr} AS VARCHAR) AS DECIMAL({p},{s}))"


def _half_up(num: str, den: str) -> str:
    """num / den as a whole number, rounded half away from zero, on integers."""
    return f"(SIGN({num}) * ((2 * ABS({num}) + ({den})) // (2 * ({den}))))"


TICKS = """
ticks AS (
  SELECT event_type AS symbol, value AS price,
         CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS size,
         ts AS event_time, event_id AS tick_id
  FROM events)"""


def bars(minutes: int) -> str:
    ms = minutes * 60_000
    return f"""
bars AS (
  SELECT symbol, epoch_us(event_time) // {ms * 1000} * {ms} AS ms,
         arg_min(price, (event_time, tick_id)) AS open, MAX(price) AS high,
         MIN(price) AS low, arg_max(price, (event_time, tick_id)) AS close,
         CAST(SUM(size) AS BIGINT) AS volume, COUNT(*) AS num_trades,
         CAST(SUM(CAST(ROUND(price * 10000) AS BIGINT) * size) AS DOUBLE)
           / NULLIF(CAST(SUM(size) AS DOUBLE), 0) / 10000::DOUBLE AS vwap
  FROM ticks GROUP BY ALL)"""


def bronze(minutes: int = 60) -> str:
    ms = minutes * 60_000
    return f"""{TICKS},{bars(minutes)},
bronze AS (
  SELECT symbol,
         CASE WHEN hx % 11 = 0 AND symbol = 'view' THEN NULL ELSE open END AS open,
         high, low, close, CAST(volume AS DOUBLE) AS volume,
         CASE WHEN hx % 6 <> 0 THEN vwap END AS vwap,
         ms AS timestamp,
         CASE WHEN hx % 7 <> 0 THEN CAST(num_trades AS DOUBLE) END AS num_trades,
         UNNEST(CASE WHEN hx % 5 = 0 THEN [arrived, arrived + 10000]
                     ELSE [arrived] END) AS ingestion_time
  FROM (SELECT *, ms // {ms} AS hx, ms + (ms // {ms} * 7919 + num_trades) % 150000 AS arrived
        FROM bars))"""


DAILY_BRONZE = """
bronze AS (
  SELECT symbol, open, high, low, close, CAST(volume AS DOUBLE) AS volume,
         CAST(notional AS DOUBLE) / NULLIF(CAST(volume AS DOUBLE), 0) / 10000::DOUBLE AS vwap,
         ms AS timestamp, CAST(n AS DOUBLE) AS num_trades,
         ms + (ms // 86400000 * 7919 + n) % 150000 AS ingestion_time
  FROM (SELECT 'S' || l_suppkey AS symbol, epoch_us(l_shipdate) // 1000 AS ms,
               arg_min(l_extendedprice, (l_orderkey, l_linenumber, l_partkey)) AS open,
               MAX(l_extendedprice) AS high, MIN(l_extendedprice) AS low,
               arg_max(l_extendedprice, (l_orderkey, l_linenumber, l_partkey)) AS close,
               CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS volume, COUNT(*) AS n,
               SUM(CAST(ROUND(l_extendedprice * 10000) AS BIGINT)
                   * CAST(l_quantity AS BIGINT)) AS notional
        FROM lineitem GROUP BY ALL))"""

USABLE = """symbol IS NOT NULL AND timestamp IS NOT NULL AND open IS NOT NULL
    AND high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL"""

_FILLED = """
         COALESCE(vwap, close) AS vwap, timestamp,
         COALESCE(CAST(TRUNC(num_trades) AS BIGINT), 0) AS num_trades, ingestion_time"""

CLEAN = f"""
clean AS (
  SELECT symbol, open, high, low, close, CAST(TRUNC(volume) AS BIGINT) AS volume,{_FILLED}
  FROM bronze WHERE {USABLE}),
kept AS (
  SELECT * FROM clean
  QUALIFY row_number() OVER (PARTITION BY symbol, timestamp ORDER BY ingestion_time) = 1)"""


def typed(source: str, rolling: bool = True) -> str:
    mean = (
        """AVG(volume) OVER (PARTITION BY symbol ORDER BY timestamp
             ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)"""
        if rolling
        else "CAST(NULL AS DOUBLE)"
    )
    return f"""
silver AS (
  SELECT symbol, {_dec('open', 12, 4)} AS open, {_dec('high', 12, 4)} AS high,
         {_dec('low', 12, 4)} AS low, {_dec('close', 12, 4)} AS close, volume,
         {_dec('vwap', 12, 4)} AS vwap, timestamp AS timestamp_ms, num_trades,
         event_time, CAST(event_time AS DATE) AS trade_date,
         {_dec('(close - open)', 12, 4)} AS price_change,
         {_dec('COALESCE((close - open) / NULLIF(open, 0) * 100, 0)', 8, 4)} AS price_change_pct,
         {_dec('COALESCE((high - low) / NULLIF(open, 0) * 100, 0)', 8, 4)} AS bar_range_pct,
         hour(event_time) * 60 + minute(event_time) BETWEEN 870 AND 1259 AS is_market_hours,
         {_dec('mean', 18, 2)} AS avg_volume_10bar, ingestion_time
  FROM (SELECT *, make_timestamp(timestamp * 1000) AS event_time, {mean} AS mean
        FROM {source}))"""


HOURLY = f"WITH {bronze()}"
KEPT = f"{HOURLY},{CLEAN}"
SILVER = f"{KEPT},{typed('kept')}"
DAILY = f"WITH {DAILY_BRONZE},{CLEAN},{typed('kept')}"
DAY = "trade_date = (SELECT MAX(trade_date) FROM silver)"
UNCHECKED = f"""{HOURLY},
filled AS (
  SELECT symbol, open, high, low, close, CAST(TRUNC(volume) AS BIGINT) AS volume,{_FILLED}
  FROM bronze),{typed('filled', rolling=False)}"""
RECORDS = """
records AS (
  SELECT *, CASE WHEN timestamp // {ms} % 13 = 0 THEN 'encoding'
                 WHEN timestamp // {ms} % 17 = 0 THEN 'json' END AS failure
  FROM bronze)"""

BRONZE_COLUMNS = (
    "symbol, open, high, low, close, volume, vwap, timestamp, num_trades, ingestion_time"
)
HISTORY_MEAN = """AVG(volume) OVER (PARTITION BY symbol ORDER BY timestamp
    ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)"""


def _ohlcv(minutes: int, where: str = "TRUE") -> str:
    return f"""WITH {TICKS},{bars(minutes)}
SELECT symbol, make_timestamp(ms * 1000) AS bar_start, open, high, low, close,
       volume, num_trades, vwap
FROM bars WHERE {where}"""


LATE = f"""WITH {TICKS},
told AS (
  SELECT *, epoch_us(event_time) // 1000 AS ms,
         tick_id % 41 <> 0 AND tick_id % 43 <> 0 AND tick_id % 47 <> 0 AND tick_id % 53 <> 0
           AND price IS NOT NULL AND size IS NOT NULL AS usable,
         CAST(event_time AS DATE) < DATE '2024-01-16' AND tick_id % 3 <> 0 AS early
  FROM ticks),
judged AS (
  SELECT *, NOT early AND (ms // 3600000 + 1) * 3600000
         <= (SELECT MAX(ms) FROM told WHERE early) - 3600000 AS late
  FROM told)"""


def _spikes(base: str, where: str) -> str:
    ratio = _half_up("(CAST(volume AS HUGEINT) * 10000)", "CAST(avg_volume_10bar * 100 AS HUGEINT)")
    return f"""{base}
SELECT symbol, event_time, volume,
       CAST(ROUND(avg_volume_10bar, 0) AS DECIMAL(18,0)) AS trailing_avg_volume,
       CASE WHEN avg_volume_10bar <> 0
            THEN CAST({ratio} AS DECIMAL(18,0)) * 0.01::DECIMAL(3,2) END AS volume_ratio
FROM silver
WHERE avg_volume_10bar IS NOT NULL AND volume > 2 * avg_volume_10bar AND {where}"""


_MEAN_PCT = (
    "CAST(CAST("
    + _half_up("CAST(SUM(price_change_pct) * 10000 AS HUGEINT)", "COUNT(price_change_pct)")
    + " AS DECIMAL(12,0)) * 0.0001::DECIMAL(5,4) AS DECIMAL(12,4))"
)

_MOVERS = f"""{SILVER},
movers AS (
  SELECT symbol, MAX(price_change_pct) AS max_gain_pct, MIN(price_change_pct) AS max_loss_pct,
         {_MEAN_PCT} AS avg_change_pct,
         CAST(SUM(volume) AS BIGINT) AS total_volume, COUNT(*) AS bar_count
  FROM silver WHERE {DAY} GROUP BY symbol)"""

_BAR = """symbol, trade_date, event_time, open, high, low, close, volume, vwap,
       price_change_pct, is_market_hours"""

_PANEL = f"""SELECT symbol, CAST(close AS DOUBLE) AS close,
       CAST(price_change_pct AS DOUBLE) AS price_change_pct,
       CAST(SUM(volume) AS BIGINT) AS total_volume
FROM silver WHERE {DAY} GROUP BY symbol, silver.close, silver.price_change_pct"""

_SUMMARY = """SELECT symbol, trade_date, arg_min(open, timestamp_ms) AS day_open,
       MAX(high) AS day_high, MIN(low) AS day_low,
       arg_max(close, timestamp_ms) AS day_close, CAST(SUM(volume) AS BIGINT) AS day_volume
FROM silver WHERE {where} GROUP BY symbol, trade_date"""

_LAST_7 = "trade_date >= (SELECT MAX(trade_date) FROM silver) - 7"
_MEAN_LATENCY = "CAST(SUM(ingestion_time - timestamp_ms) AS DOUBLE) / COUNT(*)"


def _violations() -> str:
    required = [
        "symbol", "open", "high", "low", "close", "volume",
        "timestamp_ms", "num_trades", "event_time", "trade_date",
    ]
    rules = [(f"{c}_not_null", f"{c} IS NULL") for c in required]
    rules.append(("symbol_max_length", "LENGTH(symbol) > 10"))
    widths = {
        "open": 8, "high": 8, "low": 8, "close": 8, "vwap": 8, "price_change": 8,
        "price_change_pct": 4, "bar_range_pct": 4, "avg_volume_10bar": 16,
    }
    rules += [(f"{c}_in_range", f"ABS({c}) >= {10**w}") for c, w in widths.items()]
    rules += [(f"{c}_in_range", "FALSE") for c in ("volume", "num_trades")]  # whole numbers already
    parts = [
        f"SELECT '{name}' AS rule, COUNT(*) FILTER (WHERE {cond}) AS violations FROM silver"
        for name, cond in rules
    ]
    parts.append(
        "SELECT 'key_unique', CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) FROM "
        "(SELECT COUNT(*) AS n FROM silver GROUP BY symbol, timestamp_ms)"
    )
    return UNCHECKED + "\n" + "\nUNION ALL ".join(parts)


_ORDER = "ORDER BY ingestion_time NULLS LAST, " + ", ".join(
    f"{c} NULLS FIRST" for c in ("open", "high", "low", "close", "volume", "vwap", "num_trades")
)
#: Raw bars with a fault for every rule, first copies only, with the columns of silver before any cast.
BREACHED = f"""{HOURLY},
planted AS (
  SELECT CASE WHEN hx % 53 = 0 THEN NULL WHEN hx % 47 = 0 THEN symbol || '-of-many-letters' ELSE symbol END AS symbol,
         CASE WHEN hx % 17 = 0 THEN 1e-9 WHEN hx % 59 = 0 THEN 1e12 ELSE open END AS open,
         CASE WHEN hx % 103 = 0 THEN NULL WHEN hx % 61 = 0 THEN 'nan'::DOUBLE ELSE high END AS high,
         CASE WHEN hx % 107 = 0 THEN NULL WHEN hx % 67 = 0 THEN '-infinity'::DOUBLE ELSE low END AS low,
         CASE WHEN hx % 109 = 0 THEN NULL WHEN hx % 71 = 0 THEN 4e8 ELSE close END AS close,
         CASE WHEN hx % 73 = 0 THEN 2e9 ELSE vwap END AS vwap,
         CASE WHEN hx % 79 = 0 THEN NULL WHEN hx % 101 = 0 THEN 1e300 WHEN hx % 13 = 0 THEN 9e17 ELSE volume END AS volume,
         CASE WHEN hx % 83 = 0 THEN NULL ELSE timestamp END AS timestamp,
         CASE WHEN hx % 89 = 0 THEN 1e300 ELSE num_trades END AS num_trades, ingestion_time
  FROM (SELECT *, timestamp // 3600000 AS hx FROM bronze)),
once AS (
  SELECT * REPLACE (COALESCE(vwap, close) AS vwap)
  FROM (SELECT * FROM planted QUALIFY row_number() OVER (PARTITION BY symbol, timestamp {_ORDER}) = 1)),
wide AS (
  SELECT *, timestamp AS timestamp_ms, make_timestamp(timestamp * 1000) AS event_time,
         CAST(make_timestamp(timestamp * 1000) AS DATE) AS trade_date, close - open AS price_change,
         COALESCE((close - open) / NULLIF(open, 0) * 100, 0) AS price_change_pct,
         COALESCE((high - low) / NULLIF(open, 0) * 100, 0) AS bar_range_pct,
         AVG(volume) OVER (PARTITION BY symbol ORDER BY timestamp NULLS FIRST
                           ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS avg_volume_10bar
  FROM once),
judged AS (SELECT * FROM wide UNION ALL SELECT * FROM wide WHERE timestamp_ms // 3600000 % 97 = 0)"""


def _rules_before_cast() -> list[tuple[str, str]]:
    required = [
        "symbol", "open", "high", "low", "close", "volume",
        "timestamp_ms", "num_trades", "event_time", "trade_date",
    ]
    rules = [(f"{c}_not_null", f"{c} IS NULL") for c in required]
    rules.append(("symbol_max_length", "LENGTH(symbol) > 10"))
    kinds = {c: (12, 4) for c in ("open", "high", "low", "close", "vwap", "price_change")}
    kinds |= {"price_change_pct": (8, 4), "bar_range_pct": (8, 4), "avg_volume_10bar": (18, 2)}
    rules += [  # a decimal's first value too wide is half a unit of its last place below the power of ten
        (f"{c}_in_range", f"(isnan({c}) OR abs({c}) >= {10 ** (p - s)}::DOUBLE - {5 / 10 ** (s + 1)}::DOUBLE)")
        for c, (p, s) in kinds.items()
    ]
    rules += [(f"{c}_in_range", f"({c} IS NOT NULL AND TRY_CAST({c} AS BIGINT) IS NULL)") for c in ("volume", "num_trades")]
    return rules


def _breached_counts() -> str:
    parts = [f"SELECT '{name}' AS rule, COUNT(*) FILTER ({cond}) AS violations FROM judged" for name, cond in _rules_before_cast()]
    parts.append(
        "SELECT 'key_unique', CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) FROM "
        "(SELECT COUNT(*) AS n FROM judged GROUP BY symbol, timestamp_ms)"
    )
    return BREACHED + "\n" + "\nUNION ALL ".join(parts)


def _breached_rows() -> str:
    names = ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in sorted(_rules_before_cast()))
    return f"""{BREACHED}
SELECT * FROM (SELECT symbol, timestamp_ms, ingestion_time, concat_ws(',', {names}) AS broken FROM judged) WHERE broken <> ''"""


FAULTY = f"""{HOURLY},
planted AS (
  SELECT CASE WHEN hx % 23 <> 0 THEN symbol END AS symbol, timestamp, ingestion_time,
         CASE WHEN hx % 19 = 0 THEN 'infinity'::DOUBLE ELSE open END AS open,
         CASE WHEN hx % 31 = 0 THEN 'nan'::DOUBLE ELSE high END AS high, low,
         CASE WHEN hx % 29 = 0 THEN 123456789.0 ELSE close END AS close,
         CASE WHEN hx % 37 = 0 THEN 1e300 WHEN hx % 41 = 0 THEN 'nan'::DOUBLE ELSE volume END AS volume,
         CASE WHEN hx % 43 = 0 THEN '-infinity'::DOUBLE ELSE num_trades END AS num_trades
  FROM (SELECT *, timestamp // 3600000 AS hx FROM bronze)),
reasons AS (
  SELECT *, CASE WHEN symbol IS NULL THEN 'key'
                 WHEN open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL OR isnan(open) OR isnan(high)
                      OR isnan(low) OR isnan(close) THEN 'prices'
                 WHEN isinf(open) OR abs(close) >= 100000000 THEN 'range'
                 WHEN volume = 1e300 OR isnan(volume) THEN 'volume'
                 WHEN isinf(num_trades) THEN 'num_trades' END AS reason
  FROM planted)"""


def _alarm(samples: str, stat: str, seconds: int, breach: str, periods: int, dims: str = "") -> str:
    """``samples`` has columns seen, value (and dims)."""
    d = f"{dims}, " if dims else ""
    part = f"PARTITION BY {dims} " if dims else ""
    join = f" AND g.{dims} = m.{dims}" if dims else ""
    held = " AND ".join(
        f"COALESCE(LAG({breach}, {k}) OVER ({part}ORDER BY s), FALSE)" if k else f"COALESCE({breach}, FALSE)"
        for k in range(periods)
    )
    group = "GROUP BY ALL" if dims else ""
    return f"""{samples},
m AS (SELECT {d}CAST(floor(epoch(seen) / {seconds}) AS BIGINT) * {seconds} AS s, {stat} AS metric
      FROM samples GROUP BY ALL),
g AS (SELECT {d}UNNEST(range(lo, hi + 1, {seconds})) AS s
      FROM (SELECT {d}MIN(s) AS lo, MAX(s) AS hi FROM m {group})),
dense AS (SELECT {'g.' + dims + ', ' if dims else ''}g.s, m.metric
          FROM g LEFT JOIN m ON g.s = m.s{join})
SELECT {d}make_timestamp(s * 1000000) AS period_start, metric, {held} AS in_alarm FROM dense"""


_LAG = f"""WITH {bronze(1)},
samples AS (SELECT symbol, make_timestamp(ingestion_time * 1000) AS seen,
                   ingestion_time - timestamp AS value FROM bronze)"""


def oracle_sql() -> dict[str, str]:
    hour = 3_600_000
    return {
        "symbol_universe": f"{HOURLY} SELECT {BRONZE_COLUMNS} FROM bronze "
        "WHERE symbol IN ('click', 'view', 'purchase')",
        "symbol_universe_table": f"WITH {DAILY_BRONZE} SELECT {BRONZE_COLUMNS} FROM bronze "
        "WHERE symbol IN (SELECT 'S' || s_suppkey FROM supplier WHERE s_acctbal > 0)",
        "prev_envelope": f"{HOURLY} SELECT symbol, open, high, low, close, volume, vwap, timestamp, "
        "num_trades, CAST(1706763967000 AS BIGINT) AS ingestion_time FROM bronze "
        f"WHERE timestamp // {hour} % 13 <> 0 AND timestamp // {hour} % 17 <> 0",
        "snapshot_envelope": f"{HOURLY} SELECT symbol, open, high, low, close, volume, vwap, "
        "timestamp, num_trades, CAST(1706763967000 AS BIGINT) AS ingestion_time FROM bronze "
        "WHERE open IS NOT NULL",
        "message_roundtrip": f"{HOURLY} SELECT {BRONZE_COLUMNS} FROM bronze",
        "decode_stats": f"{HOURLY},{RECORDS.format(ms=hour)} "
        "SELECT COUNT(*) AS received, COUNT(*) FILTER (WHERE failure IS NULL) AS written, "
        "COUNT(failure) AS decode_failures FROM records",
        "decoded_bars": f"{HOURLY},{RECORDS.format(ms=hour)} "
        f"SELECT {BRONZE_COLUMNS} FROM records WHERE failure IS NULL",
        "quarantined_records": f"""{HOURLY},{RECORDS.format(ms=hour)}
SELECT symbol AS key, CASE failure WHEN 'encoding' THEN '?? no letters of that code ??'
         ELSE base64(CAST('[ cut off here' AS BLOB)) END AS data,
       symbol || '-' || timestamp || '-' || ingestion_time AS "sequenceNumber",
       CAST(ingestion_time AS DOUBLE) / 1000 AS "approximateArrivalTimestamp", failure
FROM records WHERE failure IS NOT NULL""",
        "unusable_bars": f"{HOURLY} SELECT {BRONZE_COLUMNS}, 'prices' AS reason FROM bronze "
        f"WHERE NOT ({USABLE})",
        "bronze_scan": f"{HOURLY} SELECT {BRONZE_COLUMNS}, 2024 AS year, 2 AS month, 1 AS day "
        "FROM bronze",
        "gold_created": f"{SILVER} SELECT symbol, timestamp_ms, trade_date, close, volume FROM silver",
        "gold_two_sessions": f"{SILVER} SELECT * REPLACE (COALESCE(volume, 0) AS volume) FROM silver",
        "gold_refresh": f"{SILVER} SELECT * REPLACE (COALESCE(volume, 0) AS volume) FROM silver",
        "gold_date_emptied": f"{SILVER} SELECT * REPLACE (COALESCE(volume, 0) AS volume) FROM silver "
        "WHERE trade_date <> (SELECT MAX(trade_date) FROM silver)",
        "incremental_silver": f"{SILVER} SELECT * FROM silver",
        "incremental_late_bars": f"{SILVER} SELECT * FROM silver",
        "incremental_new_checkpoint": f"{SILVER} SELECT * FROM silver",
        "incremental_superseded": f"{SILVER} SELECT * FROM silver",
        "incremental_crash": f"{SILVER} SELECT * FROM silver",
        "incremental_counts": f"""{HOURLY},
keys AS (SELECT symbol, timestamp, COUNT(*) AS copies, COUNT(*) FILTER ({USABLE}) AS usable FROM bronze GROUP BY ALL)
SELECT CAST(SUM(copies) AS BIGINT) AS rows_read, COUNT(*) AS rows_after_dedup,
       CAST(SUM(copies) AS BIGINT) - COUNT(*) AS duplicates_removed, COUNT(*) FILTER (usable > 0) AS rows_final,
       CAST(SUM(copies - usable) AS BIGINT) AS set_aside, COUNT(*) FILTER (usable > 0) AS added,
       0::BIGINT AS replaced, 0::BIGINT AS mended FROM keys""",
        "silver_partitioned_report": f"{SILVER} SELECT symbol, timestamp_ms, close FROM silver WHERE {DAY}",
        "dead_letter_bars": f"""{FAULTY}
SELECT symbol, timestamp, ingestion_time, reason FROM reasons WHERE reason IS NOT NULL""",
        "transform_counts": f"""{FAULTY},
keys AS (SELECT symbol, timestamp, COUNT(*) AS copies, COUNT(*) FILTER (reason IS NULL) AS usable FROM reasons GROUP BY ALL),
days AS (SELECT CAST(make_timestamp(timestamp * 1000) AS DATE) AS day, * FROM keys)
SELECT CAST(SUM(copies) AS BIGINT) AS rows_read, COUNT(*) AS rows_after_dedup,
       CAST(SUM(copies) AS BIGINT) - COUNT(*) AS duplicates_removed, COUNT(*) FILTER (usable > 0) AS rows_final,
       CAST(SUM(copies - usable) AS BIGINT) AS set_aside, COUNT(*) FILTER (usable > 0) AS rows,
       MIN(day) FILTER (usable > 0) AS first_date, MAX(day) FILTER (usable > 0) AS last_date FROM days""",
        "contract_before_cast": _breached_counts(),
        "contract_breaches": _breached_rows(),
        "dead_letter_answers": f"""{HOURLY}
SELECT symbol, timestamp, CASE WHEN hx % 19 = 0 THEN 'unreadable' WHEN hx % 13 = 0 THEN 'refused' ELSE 'empty' END AS reason
FROM (SELECT *, timestamp // 3600000 AS hx FROM bronze) WHERE hx % 19 = 0 OR hx % 13 = 0 OR hx % 17 = 0""",
        "latest_day_report": f"{_MOVERS} SELECT * FROM movers",
        "retention_applied": f"""{SILVER},
aged AS (SELECT *, DATE '2024-02-04' - trade_date AS age FROM silver)
SELECT trade_date, COUNT(*) AS row_count, CAST(SUM(volume) AS BIGINT) AS volume,
       CASE WHEN age >= 7 THEN 'cold' ELSE 'hot' END AS tier, 1::BIGINT AS folders, age >= 7 AS packed
FROM aged WHERE age < 30 GROUP BY trade_date, age""",
        "fresh_bronze": f"{HOURLY} SELECT {BRONZE_COLUMNS} FROM bronze",
        "tracked_symbols": f"WITH {DAILY_BRONZE} SELECT {BRONZE_COLUMNS} FROM bronze "
        "WHERE symbol IN (SELECT 'S' || s_suppkey FROM supplier WHERE s_acctbal > 0)",
        "alarm_error_rate_within": _alarm(
            "WITH samples AS (SELECT ts AS seen, 1 AS value FROM events WHERE event_type = 'error' AND event_id % 97 <> 0 "
            "AND ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01')",
            "CAST(SUM(value) AS BIGINT)", 60, "metric >= 1", 1,
        ),
        "alarm_strays": "SELECT event_id, ts + INTERVAL 40 YEAR AS ts FROM events WHERE event_type = 'error' AND event_id % 97 = 0",
        "alarm_throttles": _alarm(
            f"""WITH {bronze(1)},
samples AS (SELECT make_timestamp(timestamp * 1000) AS seen, 1 AS value FROM bronze WHERE timestamp // 60000 % 13 = 0)""",
            "CAST(SUM(value) AS BIGINT)", 60, "metric >= 1", 1,
        ),
        "alarm_failed_tasks": _alarm(
            "WITH samples AS (SELECT ts AS seen, CASE WHEN event_type = 'error' THEN event_id % 3 ELSE 0 END AS value FROM events)",
            "CAST(SUM(value) AS BIGINT)", 60, "(metric > 0)", 1,
        ),
        "dead_letter_ticks": f"""WITH {TICKS}
SELECT * FROM (
  SELECT tick_id, CASE WHEN tick_id % 41 = 0 OR tick_id % 43 = 0 OR price IS NULL THEN 'price'
              WHEN tick_id % 53 = 0 OR size IS NULL THEN 'size'
              WHEN tick_id % 47 = 0 THEN 'range' END AS reason FROM ticks) WHERE reason IS NOT NULL""",
        "ohlcv_1h_faulty_ticks": _ohlcv(60).replace(
            "FROM events)",
            "FROM events WHERE event_id % 41 <> 0 AND event_id % 43 <> 0 AND event_id % 47 <> 0 AND event_id % 53 <> 0)",
            1,
        ),
        "append_new_only": f"{SILVER} SELECT symbol, timestamp_ms, trade_date, close FROM silver "
        "WHERE trade_date >= DATE '2024-01-16'",
        "contract_violations": _violations(),
        "duplicate_keys": f"{UNCHECKED} SELECT symbol, timestamp_ms, COUNT(*) AS copies "
        "FROM silver GROUP BY ALL HAVING COUNT(*) > 1",
        "retention_tiers": f"""{SILVER}
SELECT trade_date, COUNT(*) AS row_count,
       CASE WHEN (SELECT MAX(trade_date) FROM silver) - trade_date >= 30 THEN 'expired'
            WHEN (SELECT MAX(trade_date) FROM silver) - trade_date >= 7 THEN 'cold'
            ELSE 'hot' END AS tier
FROM silver GROUP BY trade_date""",
        "stage_counts": f"""{HOURLY},
k AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE {USABLE}) AS u
      FROM bronze GROUP BY symbol, timestamp)
SELECT CAST(SUM(n) AS BIGINT) AS rows_read, COUNT(*) AS rows_after_dedup,
       CAST(SUM(n - 1) AS BIGINT) AS duplicates_removed,
       COUNT(*) FILTER (WHERE u > 0) AS rows_final FROM k""",
        "dedup_first_arrival": f"{HOURLY} SELECT {BRONZE_COLUMNS} FROM bronze QUALIFY "
        "row_number() OVER (PARTITION BY symbol, timestamp ORDER BY ingestion_time) = 1",
        "clean_bars": f"{KEPT} SELECT * FROM clean",
        "time_columns": f"""{KEPT}
SELECT symbol, timestamp, t AS event_time, CAST(t AS DATE) AS trade_date,
       CAST(hour(t) AS INTEGER) AS hour, CAST(minute(t) AS INTEGER) AS minute
FROM (SELECT *, make_timestamp(timestamp * 1000) AS t FROM kept)""",
        "price_change": f"""{KEPT} SELECT symbol, timestamp, close - open AS price_change,
COALESCE((close - open) / NULLIF(open, 0) * 100, 0) AS price_change_pct FROM kept""",
        "bar_range": f"""{KEPT} SELECT symbol, timestamp,
COALESCE((high - low) / NULLIF(open, 0) * 100, 0) AS bar_range_pct FROM kept""",
        "market_hours_utc": f"{SILVER} SELECT symbol, timestamp_ms AS timestamp, event_time, "
        "is_market_hours FROM silver",
        "market_hours_exchange": f"""{KEPT}
SELECT symbol, timestamp, make_timestamp(timestamp * 1000) AS event_time,
       hour(l) * 60 + minute(l) BETWEEN 570 AND 959 AS is_market_hours
FROM (SELECT *, make_timestamp(timestamp * 1000) AT TIME ZONE 'UTC'
                  AT TIME ZONE 'America/New_York' AS l FROM kept)""",
        "market_hours_all_year": f"""WITH {TICKS},
moved AS (SELECT tick_id, make_timestamp(
            (epoch_us(event_time) // 1000 + tick_id % 366 * 86400000) * 1000) AS event_time FROM ticks)
SELECT tick_id, event_time, hour(l) * 60 + minute(l) BETWEEN 570 AND 959 AS is_open
FROM (SELECT *, event_time AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS l FROM moved)""",
        "rolling_volume": f"{KEPT} SELECT symbol, timestamp, volume, {HISTORY_MEAN} "
        "AS avg_volume_10bar FROM kept",
        "rolling_volume_daily": f"WITH {DAILY_BRONZE},{CLEAN} SELECT symbol, timestamp, volume, "
        f"{HISTORY_MEAN} AS avg_volume_10bar FROM kept",
        "silver_bars": f"{SILVER} SELECT * FROM silver",
        "silver_daily": f"{DAILY} SELECT * FROM silver",
        "ohlcv_1m": _ohlcv(1),
        "ohlcv_5m": _ohlcv(5),
        "ohlcv_1h": _ohlcv(60),
        "ohlcv_1d": _ohlcv(1440),
        "ohlcv_1d_rolled_up": _ohlcv(1440),
        "ohlcv_1d_lineitem": f"WITH {DAILY_BRONZE} SELECT {BRONZE_COLUMNS} FROM bronze",
        "bars_for_date": f"{SILVER} SELECT symbol, trade_date, open, high, low, close, volume, "
        f"vwap, price_change_pct, is_market_hours FROM silver WHERE {DAY}",
        "latest_bar_per_symbol": f"{SILVER} SELECT {_BAR} FROM silver QUALIFY row_number() OVER "
        "(PARTITION BY symbol ORDER BY timestamp_ms DESC) = 1",
        "latest_bar_per_symbol_daily": f"{DAILY} SELECT {_BAR} FROM silver QUALIFY row_number() "
        "OVER (PARTITION BY symbol ORDER BY timestamp_ms DESC) = 1",
        "top_movers": f"{_MOVERS} SELECT * FROM movers",
        "top_movers_abs": f"{_MOVERS} SELECT *, "
        "GREATEST(ABS(max_gain_pct), ABS(max_loss_pct)) AS max_move_pct FROM movers",
        "top_movers_gain": f"{_MOVERS} SELECT symbol, max_gain_pct, max_loss_pct, total_volume "
        "FROM movers",
        "top_movers_panel": f"{SILVER} {_PANEL}",
        "mover_bands": f"""{SILVER}, panel AS ({_PANEL})
SELECT *, CASE WHEN price_change_pct >= 0 THEN 'green' WHEN price_change_pct >= -1 THEN 'yellow'
               WHEN price_change_pct IS NOT NULL THEN 'red' END AS pct_band FROM panel""",
        "volume_spikes": _spikes(SILVER, DAY),
        "volume_spikes_all_days": _spikes(SILVER, "TRUE"),
        "volume_spikes_daily": _spikes(DAILY, "TRUE"),
        "volume_spikes_intraday": f"""{SILVER},
w AS (SELECT symbol, event_time, volume, AVG(volume) OVER (PARTITION BY symbol
        ORDER BY event_time ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS avg_vol
      FROM silver WHERE {DAY})
SELECT * FROM w WHERE volume > 2 * avg_vol""",
        "latency_top": f"""{SILVER}
SELECT symbol, event_time, timestamp_ms, ingestion_time,
       ingestion_time - timestamp_ms AS latency_ms,
       CAST(ROUND(CAST(ingestion_time - timestamp_ms AS DECIMAL(18,0)) * 0.001::DECIMAL(4,3), 1)
            AS DECIMAL(20,1)) AS latency_sec
FROM silver WHERE {DAY}
ORDER BY latency_ms DESC, symbol, timestamp_ms LIMIT 20""",
        "daily_summary": f"{SILVER} {_SUMMARY.format(where=_LAST_7)}",
        "daily_summary_all_days": f"{SILVER} {_SUMMARY.format(where='TRUE')}",
        "daily_summary_as_written": f"""{SILVER},
recent AS (SELECT * FROM silver WHERE {_LAST_7}),
grouped AS (SELECT symbol, trade_date, open, close, event_time, MAX(high) AS day_high, MIN(low) AS day_low,
                CAST(SUM(volume) AS BIGINT) AS day_volume
         FROM recent GROUP BY symbol, trade_date, open, close, event_time)
SELECT symbol, trade_date, first_value(open) OVER day AS day_open, day_high, day_low,
       last_value(close) OVER day AS day_close, day_volume
FROM grouped WINDOW day AS (PARTITION BY symbol, trade_date ORDER BY event_time
                         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
        "completeness": f"""{SILVER}
SELECT trade_date, symbol, COUNT(*) AS bar_count, MIN(event_time) AS first_bar,
       MAX(event_time) AS last_bar FROM silver GROUP BY trade_date, symbol""",
        "load_check": f"""{SILVER}
SELECT trade_date, COUNT(*) AS row_count, COUNT(DISTINCT symbol) AS symbol_count
FROM silver GROUP BY trade_date ORDER BY trade_date DESC LIMIT 10""",
        "close_by_symbol": f"{SILVER} SELECT symbol, CAST(close AS DOUBLE) AS close FROM silver "
        f"WHERE {DAY}",
        "close_series": f"{SILVER} SELECT symbol, event_time, CAST(close AS DOUBLE) AS close "
        "FROM silver",
        "close_series_range": f"{SILVER} SELECT symbol, event_time, CAST(close AS DOUBLE) AS close FROM silver "
        "WHERE event_time >= TIMESTAMP '2024-01-10 06:00:00' AND event_time < TIMESTAMP '2024-01-12 18:30:00'",
        "volume_by_symbol": f"{SILVER} SELECT symbol, CAST(SUM(volume) AS BIGINT) AS total_volume "
        f"FROM silver WHERE {DAY} GROUP BY symbol",
        "avg_latency": f"{SILVER} SELECT {_MEAN_LATENCY} AS avg_latency_ms FROM silver WHERE {DAY}",
        "record_count": f"{SILVER} SELECT COUNT(*) AS record_count FROM silver WHERE {DAY}",
        "symbol_history": f"""{SILVER}
SELECT trade_date, CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high,
       CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close, volume
FROM silver WHERE symbol = 'purchase'
ORDER BY trade_date DESC, event_time DESC LIMIT 30""",
        "health_bands": f"""{SILVER},
f AS (SELECT {_MEAN_LATENCY} AS avg_latency_ms, COUNT(*) AS record_count FROM silver WHERE {DAY})
SELECT *, CASE WHEN avg_latency_ms >= 90000 THEN 'red' WHEN avg_latency_ms >= 60000 THEN 'yellow'
               ELSE 'green' END AS latency_band,
       CASE WHEN record_count >= 10 THEN 'green' WHEN record_count >= 5 THEN 'yellow'
            ELSE 'red' END AS record_count_band FROM f""",
        "ingest_lag": f"""{HOURLY}
SELECT make_timestamp(ingestion_time // {hour} * {hour} * 1000) AS period_start,
       MAX(ingestion_time - timestamp) AS max_lag_ms, COUNT(*) AS record_count
FROM bronze GROUP BY ALL""",
        "alarm_error_rate": _alarm(
            "WITH samples AS (SELECT ts AS seen, 1 AS value FROM events WHERE event_type = 'error')",
            "CAST(SUM(value) AS BIGINT)", 60, "metric >= 1", 1,
        ),
        "alarm_lag": _alarm(_LAG, "MAX(value)", 60, "(metric > 60000)", 2),
        "alarm_lag_by_symbol": _alarm(_LAG, "MAX(value)", 60, "(metric > 60000)", 2, "symbol"),
        "alarm_dead_letters": _alarm(
            f"""WITH {bronze(1)},{RECORDS.format(ms=60_000)},
samples AS (SELECT make_timestamp(ingestion_time * 1000) AS seen, 1 AS value
            FROM records WHERE failure IS NOT NULL)""",
            "CAST(SUM(value) AS BIGINT)", 300, "metric >= 1", 1,
        ),
        "stream_ohlcv_1h": _ohlcv(60),
        "stream_dedup": f"""{HOURLY} SELECT {BRONZE_COLUMNS} FROM bronze
QUALIFY row_number() OVER (PARTITION BY symbol, timestamp ORDER BY ingestion_time) = 1""",
        "stream_first_arrival": f"""{HOURLY} SELECT {BRONZE_COLUMNS} FROM bronze
QUALIFY row_number() OVER (PARTITION BY symbol, timestamp ORDER BY ingestion_time) = 1""",
        "stream_late_ticks": f"""{LATE} SELECT tick_id, symbol, event_time FROM judged WHERE usable AND late""",
        "stream_late_account": f"""{LATE}
SELECT COUNT(*) AS ticks, COUNT(*) FILTER (usable AND NOT late) AS in_bars,
       COUNT(*) FILTER (usable AND late) AS late, COUNT(*) FILTER (NOT usable) AS unusable FROM judged""",
        "stream_rolling_volume": f"{KEPT} SELECT symbol, timestamp, volume, {HISTORY_MEAN} "
        "AS avg_volume_10bar FROM kept",
        "stream_rolling_late": f"{KEPT} SELECT symbol, timestamp, volume, {HISTORY_MEAN} "
        "AS avg_volume_10bar FROM kept",
        "stream_bronze_two_runs": f"{HOURLY},{RECORDS.format(ms=hour)} "
        f"SELECT {BRONZE_COLUMNS} FROM records WHERE failure IS NULL",
        "stream_bronze": f"{HOURLY},{RECORDS.format(ms=hour)} "
        f"SELECT {BRONZE_COLUMNS} FROM records WHERE failure IS NULL",
    }
