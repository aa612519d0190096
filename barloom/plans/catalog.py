"""Every operator and report as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import asdict, fields
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom import functions as B
from barloom.operators import alarms
from barloom.operators.clean import clean_bars, fill, unusable_bars
from barloom.operators.contract import breaches, check_contract
from barloom.operators.dedup import (
    append_new_only,
    duplicate_keys,
    first_arrival,
    stage_counts,
)
from barloom.operators.clean import usable
from barloom.operators.derive import add_price_columns, add_session_column, add_time_columns
from barloom.operators.resample import INTERVALS, daily_summary, resample_ohlcv, rollup_bars, unusable_ticks
from barloom.operators.retention import retention_tiers
from barloom.operators.rolling import trailing_mean
from barloom.plans import reports as R
from barloom.plans.jobs import run_transform
from barloom.plans.silver import distinct_bars, finish, silver, widened
from barloom.schemas import BRONZE, SILVER
from barloom.session import pin_utc, shared_path
from barloom.sinks.gold import GoldTable, gold_rows
from barloom.sinks.tables import write_bronze, write_silver
from barloom.sinks.upkeep import apply_retention, tier
from barloom.sinks.versions import VersionedTable
from barloom.sources import derived as D
from barloom.sources.envelopes import parse_prev_envelope, parse_snapshot_envelope, unusable_answers
from barloom.sources.messages import decode_messages, decode_stats, split_good_bad
from barloom.sources.tables import latest_day, read_bronze, read_fresh_bronze, register_table
from barloom.sources.universe import restrict_to, symbols_in
from barloom.streaming.bars import (
    late_ticks,
    read_means,
    start_to_parquet,
    stream_dedup,
    stream_first_arrival,
    stream_resample,
    stream_rolling_volume,
)
from barloom.streaming.held import held_bars, held_first_copies, with_held
from barloom.streaming.incremental import STORED, read_silver, run_incremental, silver_table
from barloom.streaming.ingest import read_messages, stream_bronze

Query = Callable[[SparkSession, str], DataFrame]

# Parameters the queries are run with.
UNIVERSE = ("click", "view", "purchase")
ONE_SYMBOL = "purchase"
PROCESSED_AT = datetime(2024, 2, 1, 5, 6, 7, tzinfo=timezone.utc)
INGESTED_AT_MS = 1_706_763_967_000
SPLIT_DAY = "2024-01-16"
QUARTER_MS = 64 * D.DAY_MS  # bucket width for bars that come once a day

BAR_COLUMNS = ["symbol", "bar_start", "open", "high", "low", "close", "volume", "num_trades", "vwap"]


def _bronze(spark: SparkSession, sf: str, minutes: int = 60) -> DataFrame:
    return D.bronze_from_events(spark, sf, minutes)


def _silver(spark: SparkSession, sf: str, **options) -> DataFrame:
    return silver(_bronze(spark, sf), **options)


def _slim(spark: SparkSession, sf: str) -> DataFrame:
    """Silver without the trailing mean, for reports that do not show it."""
    return _silver(spark, sf, rolling=False)


def _daily(spark: SparkSession, sf: str, **options) -> DataFrame:
    return silver(D.bars_from_lineitem(spark, sf), bucket_ms=QUARTER_MS, **options)


def _unchecked(spark: SparkSession, sf: str) -> DataFrame:
    """Raw bars typed as silver but neither filtered nor deduplicated."""
    return finish(fill(_bronze(spark, sf)), rolling=False)


# --- sources, sinks, tables -----------------------------------------------------


def symbol_universe(spark, sf):
    return restrict_to(_bronze(spark, sf), UNIVERSE)


def symbol_universe_table(spark, sf):
    solvent = D.load(spark, sf, "supplier").filter("s_acctbal > 0")
    symbols = solvent.select(F.concat(F.lit("S"), F.col("s_suppkey")).alias("symbol"))
    return restrict_to(D.bars_from_lineitem(spark, sf), symbols)


def prev_envelope(spark, sf):
    answers = D.prev_answers_from_bronze(_bronze(spark, sf))
    return parse_prev_envelope(answers, F.lit(INGESTED_AT_MS))


def snapshot_envelope(spark, sf):
    answers = D.snapshot_answers_from_bronze(_bronze(spark, sf))
    return parse_snapshot_envelope(answers, F.lit(INGESTED_AT_MS))


def message_roundtrip(spark, sf):
    records = D.transport_from_bronze(_bronze(spark, sf), planted=False)
    return split_good_bad(decode_messages(records))[0]


def _records(spark, sf, minutes=60):
    return D.transport_from_bronze(_bronze(spark, sf, minutes), minutes)


def decode_counts(spark, sf):
    return decode_stats(decode_messages(_records(spark, sf)))


def decoded_bars(spark, sf):
    return split_good_bad(decode_messages(_records(spark, sf)))[0]


def quarantined_records(spark, sf):
    return split_good_bad(decode_messages(_records(spark, sf)))[1]


def bronze_scan(spark, sf):
    path = shared_path(spark, "bronze")
    write_bronze(_bronze(spark, sf), path, PROCESSED_AT)
    return read_bronze(spark, path).filter("year = 2024 AND month = 2")


def gold_refresh(spark, sf):
    """Full load of all days but the latest, then the latest day on its own."""
    bars = _silver(spark, sf)
    latest = bars.agg(F.max("trade_date").alias("d")).first().d
    gold = GoldTable(spark, shared_path(spark, "gold"))
    gold.refresh_full(bars.filter(F.col("trade_date") < F.lit(latest)))
    gold.refresh_date(bars, latest)
    return gold.read()


def gold_created(spark, sf):
    """A catalog table set up over date folders that were loaded before."""
    path = shared_path(spark, "gold")
    gold_rows(_silver(spark, sf)).write.partitionBy("trade_date").parquet(path)
    GoldTable(spark, path, "gold_created_bars").create()
    return spark.sql("SELECT symbol, timestamp_ms, trade_date, close, volume FROM gold_created_bars")


def gold_two_sessions(spark, sf):
    """One session loads and then replaces the latest day; another reads by the catalog's name."""
    bars = _silver(spark, sf)
    latest = bars.agg(F.max("trade_date").alias("d")).first().d
    gold = GoldTable(spark, shared_path(spark, "gold"), "gold_shared_bars", buckets=4)
    gold.refresh_full(bars.withColumn("volume", F.when(F.col("trade_date") < F.lit(latest), F.col("volume")).otherwise(F.lit(0))))
    gold.refresh_date(bars, latest)
    other = pin_utc(spark.newSession())
    return other.table("gold_shared_bars")


def incremental_silver(spark, sf):
    """Two runs over a growing bronze folder; the second delivery repeats the first."""
    bronze = _bronze(spark, sf)
    raw, out, state, done = (shared_path(spark, n) for n in ("raw", "silver", "tails", "files"))
    first = F.to_date(F.timestamp_millis("timestamp")) < F.lit(SPLIT_DAY).cast("date")
    for delivery in (bronze.filter(first), bronze):
        write_bronze(delivery, raw, PROCESSED_AT)
        run_incremental(spark, raw, out, state, done)
    return read_silver(spark, out).select(*SILVER.fieldNames())


def gold_date_emptied(spark, sf):
    """Full load, then a refresh of the latest day from a silver that no longer has it."""
    bars = _silver(spark, sf)
    latest = bars.agg(F.max("trade_date").alias("d")).first().d
    gold = GoldTable(spark, shared_path(spark, "gold"))
    gold.refresh_full(bars)
    gold.refresh_date(bars.filter(F.col("trade_date") < F.lit(latest)), latest)
    return gold.read()


def _late(bronze: DataFrame) -> F.Column:
    """Every third hour and the first days: what a late delivery brings."""
    hx = F.expr("timestamp div 3600000")
    return (hx % 3 == 0) | (F.to_date(F.timestamp_millis("timestamp")) < F.lit("2024-01-04").cast("date"))


def incremental_late_bars(spark, sf):
    """Bars that come after the bars that follow them; their neighbours' means are mended."""
    bronze = _bronze(spark, sf)
    raw, out, state, done = (shared_path(spark, n) for n in ("raw", "silver", "tails", "files"))
    for delivery in (bronze.filter(~_late(bronze)), bronze.filter(_late(bronze))):
        write_bronze(delivery, raw, PROCESSED_AT)
        run_incremental(spark, raw, out, state, done)
    return read_silver(spark, out).select(*SILVER.fieldNames())


def incremental_new_checkpoint(spark, sf):
    """The second run has lost its checkpoint and state and reads everything again."""
    bronze = _bronze(spark, sf)
    raw, out = shared_path(spark, "raw"), shared_path(spark, "silver")
    first = F.to_date(F.timestamp_millis("timestamp")) < F.lit(SPLIT_DAY).cast("date")
    for delivery in (bronze.filter(first), bronze.filter(~first)):
        write_bronze(delivery, raw, PROCESSED_AT)
        run_incremental(spark, raw, out, shared_path(spark, "tails"), shared_path(spark, "files"))
    return read_silver(spark, out).select(*SILVER.fieldNames())


def incremental_superseded(spark, sf):
    """The later copies of bars come first, with other volumes; the first copies replace them when they come."""
    bronze = _bronze(spark, sf)
    first = first_arrival(bronze)
    later = bronze.exceptAll(first).withColumn("volume", F.col("volume") + 1000)
    raw, out, state, done = (shared_path(spark, n) for n in ("raw", "silver", "tails", "files"))
    early = F.to_date(F.timestamp_millis("timestamp")) < F.lit(SPLIT_DAY).cast("date")
    for delivery in (later.unionByName(first.filter(early & (F.expr("timestamp div 3600000") % 5 != 0))), first):
        write_bronze(delivery, raw, PROCESSED_AT)
        run_incremental(spark, raw, out, state, done)
    return read_silver(spark, out).select(*SILVER.fieldNames())


def incremental_counts(spark, sf):
    """What a run over the whole folder reports."""
    raw = shared_path(spark, "raw")
    write_bronze(_bronze(spark, sf), raw, PROCESSED_AT)
    told = run_incremental(spark, raw, *(shared_path(spark, n) for n in ("silver", "tails", "files")))
    return spark.createDataFrame([asdict(told)], ", ".join(f"{f.name} bigint" for f in fields(told)))


def incremental_crash(spark, sf):
    """The run dies after it has written the second delivery's rows and before they are published; it is run again."""
    bronze = _bronze(spark, sf)
    raw, out, state, done = (shared_path(spark, n) for n in ("raw", "silver", "tails", "files"))
    for delivery, dies in ((bronze.filter(~_late(bronze)), False), (bronze.filter(_late(bronze)), True)):
        write_bronze(delivery, raw, PROCESSED_AT)
        if dies:
            with _unpublished():
                try:
                    run_incremental(spark, raw, out, state, done)
                except Exception as error:
                    if "nothing is published" not in str(error):
                        raise
        run_incremental(spark, raw, out, state, done)
    return read_silver(spark, out).select(*SILVER.fieldNames())


@contextmanager
def _unpublished():
    """Meanwhile no version of a table can be published."""
    kept = VersionedTable.commit

    def refuse(*_, **__):
        raise RuntimeError("nothing is published")

    VersionedTable.commit = refuse
    try:
        yield
    finally:
        VersionedTable.commit = kept


def silver_partitioned_report(spark, sf):
    """The latest day of a silver table in date folders, of which one is read."""
    path = shared_path(spark, "silver")
    write_silver(_slim(spark, sf), path, ["trade_date"])
    return R.on_day(register_table(spark, path, "silver_by_date")).select("symbol", "timestamp_ms", "close")


def latest_day_report(spark, sf):
    """Movers of the newest folder of a silver table in date folders; no other is read."""
    path = shared_path(spark, "silver")
    write_silver(_slim(spark, sf), path, ["trade_date"])
    return R.top_movers(latest_day(spark, path))


def retention_applied(spark, sf):
    """What is left of a silver table of several deliveries five days after its last bar, and how it lies."""
    bronze = _bronze(spark, sf)
    raw, out, state, done = (shared_path(spark, n) for n in ("raw", "silver", "tails", "files"))
    for k in range(3):
        write_bronze(bronze.filter(F.expr("timestamp div 3600000") % 3 == k), raw, PROCESSED_AT)
        run_incremental(spark, raw, out, state, done)
    table = silver_table(spark, out)
    as_of = date(2024, 2, 4)
    apply_retention(table, STORED, as_of, most_folders=1)
    version = table.current()
    folders = spark.createDataFrame(
        [(f.date, tier(f.date, as_of), f.write.startswith("cold-")) for f in version.folders], "day string, tier string, packed boolean"
    )
    rows = read_silver(spark, out).groupBy("trade_date").agg(F.count("*").alias("row_count"), F.sum("volume").alias("volume"))
    lies = folders.groupBy("day", "tier").agg(F.count("*").alias("folders"), F.bool_and("packed").alias("packed"))
    return rows.join(lies, F.col("trade_date") == F.col("day").cast("date")).drop("day")


def fresh_bronze(spark, sf):
    """Bars of files written within two hours: all as of now, none as of three hours later."""
    path = shared_path(spark, "bronze")
    write_bronze(_bronze(spark, sf), path, PROCESSED_AT)
    now = datetime.now(timezone.utc)
    return read_fresh_bronze(spark, path, now).unionByName(read_fresh_bronze(spark, path, now + timedelta(hours=3)))


def transform_counts(spark, sf):
    """What the batch job reports about a folder with faulty bars and copies."""
    raw, out = shared_path(spark, "raw"), shared_path(spark, "silver")
    write_bronze(D.faulty_bronze(_bronze(spark, sf)), raw, PROCESSED_AT)
    told = run_transform(spark, raw, out, partition_by=["trade_date"])
    kinds = ", ".join(f"{f.name} {'date' if f.name.endswith('_date') else 'bigint'}" for f in fields(told))
    return spark.createDataFrame([asdict(told)], kinds)


def _breached(spark, sf) -> DataFrame:
    once = first_arrival(D.breached_bronze(_bronze(spark, sf)))
    wide = widened(once.withColumn("vwap", F.coalesce("vwap", "close")))
    return wide.unionByName(wide.filter(F.expr("timestamp_ms div 3600000") % 97 == 0))


def contract_before_cast(spark, sf):
    """Violations of every rule among raw bars with a fault for each, counted before any cast."""
    return check_contract(_breached(spark, sf))


def contract_breaches(spark, sf):
    """Which rows break which rules."""
    rows = breaches(_breached(spark, sf))
    return rows.select("symbol", "timestamp_ms", "ingestion_time", F.concat_ws(",", F.array_sort("broken")).alias("broken"))


def tracked_symbols(spark, sf):
    """Bars of the symbols that comma-separated settings name, with stray blanks."""
    settings = D.load(spark, sf, "supplier").filter("s_acctbal > 0").groupBy(F.col("s_suppkey") % 7)
    settings = settings.agg(F.concat_ws(" ,, ", F.collect_list(F.concat(F.lit(" S"), "s_suppkey"))).alias("setting"))
    return restrict_to(D.bars_from_lineitem(spark, sf), symbols_in(settings, "setting"))


def dead_letter_answers(spark, sf):
    answers = D.prev_answers_from_bronze(_bronze(spark, sf))
    answers = answers.withColumn("timestamp", F.get_json_object("body", "$.results[0].t").cast("bigint"))
    cut = F.when(F.expr("timestamp div 3600000") % 19 == 0, F.left("body", F.lit(30))).otherwise(F.col("body"))
    return unusable_answers(answers.withColumn("body", cut)).select("symbol", "timestamp", "reason")


def dead_letter_bars(spark, sf):
    bad = unusable_bars(D.faulty_bronze(_bronze(spark, sf)))
    return bad.select("symbol", "timestamp", "ingestion_time", "reason")


def dead_letter_ticks(spark, sf):
    return unusable_ticks(D.faulty_ticks(D.ticks_from_events(spark, sf))).select("tick_id", "reason")


def ohlcv_1h_faulty_ticks(spark, sf):
    ticks = D.faulty_ticks(D.ticks_from_events(spark, sf))
    return resample_ohlcv(ticks, INTERVALS["1h"], tie_breaker="tick_id").select(*BAR_COLUMNS)


def append_new(spark, sf):
    bars = _slim(spark, sf)
    stored = bars.filter(F.col("trade_date") < F.lit(SPLIT_DAY).cast("date"))
    return append_new_only(bars, stored).select("symbol", "timestamp_ms", "trade_date", "close")


# --- health -----------------------------------------------------------------------


def alarm_error_rate(spark, sf):
    errors = D.load(spark, sf, "events").filter("event_type = 'error'").select("ts")
    return alarms.eval_alarm(errors, "ts", F.lit(1), alarms.ERRORS)


def _lag_samples(spark, sf):
    return _bronze(spark, sf, 1).select(
        "symbol",
        F.timestamp_millis("ingestion_time").alias("at"),
        (F.col("ingestion_time") - F.col("timestamp")).alias("lag_ms"),
    )


def alarm_lag(spark, sf):
    return alarms.eval_alarm(_lag_samples(spark, sf), "at", F.col("lag_ms"), alarms.LAG_MS)


def alarm_lag_by_symbol(spark, sf):
    samples = _lag_samples(spark, sf)
    return alarms.eval_alarm(samples, "at", F.col("lag_ms"), alarms.LAG_MS, dims=["symbol"])


JANUARY = datetime(2024, 1, 1, tzinfo=timezone.utc), datetime(2024, 2, 1, tzinfo=timezone.utc)


def _stamped_errors(spark, sf) -> DataFrame:
    """Errors, some of them stamped forty years late."""
    errors = D.load(spark, sf, "events").filter("event_type = 'error'").select("event_id", "ts")
    late = F.col("ts") + F.make_ym_interval(F.lit(40))
    return errors.withColumn("ts", F.when(F.col("event_id") % 97 == 0, late).otherwise(F.col("ts")))


def alarm_error_rate_within(spark, sf):
    return alarms.eval_alarm(_stamped_errors(spark, sf), "ts", F.lit(1), alarms.ERRORS, within=JANUARY)


def alarm_strays(spark, sf):
    return alarms.strays(_stamped_errors(spark, sf), "ts", JANUARY)


def close_series_range(spark, sf):
    """Two days and a half of the price line, out of a table in date folders."""
    path = shared_path(spark, "silver")
    write_silver(_slim(spark, sf), path, ["trade_date"])
    bars = register_table(spark, path, "silver_for_a_range")
    at = lambda day, hour, minute: datetime(2024, 1, day, hour, minute, tzinfo=timezone.utc)
    return R.close_series(bars, at(10, 6, 0), at(12, 18, 30))


def alarm_throttles(spark, sf):
    """The vendor's refusals a minute."""
    hx = F.expr("timestamp div 60000")
    refused = _bronze(spark, sf, 1).filter(hx % 13 == 0).select(F.timestamp_millis("timestamp").alias("at"))
    return alarms.eval_alarm(refused, "at", F.lit(1), alarms.THROTTLES)


def alarm_failed_tasks(spark, sf):
    """Failures a minute, told as counts that are mostly zero."""
    samples = D.load(spark, sf, "events").select("ts", F.when(F.col("event_type") == "error", F.col("event_id") % 3).otherwise(F.lit(0)).alias("failed"))
    return alarms.eval_alarm(samples, "ts", F.col("failed"), alarms.FAILED_TASKS)


def alarm_dead_letters(spark, sf):
    _, bad = split_good_bad(decode_messages(_records(spark, sf, 1)))
    at = F.timestamp_seconds(F.floor("approximateArrivalTimestamp"))
    return alarms.eval_alarm(bad.select(at.alias("at")), "at", F.lit(1), alarms.DEAD_LETTERS)


# --- streams ------------------------------------------------------------------------


def _tick_stream(spark, sf):
    schema = D.load(spark, sf, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return D.ticks_from(events)


def _run(query) -> None:
    query.awaitTermination()


def stream_ohlcv_1h(spark, sf):
    """Bars of a tick stream: those it gave out and, as its source has ended, those it still holds."""
    bars = stream_resample(_tick_stream(spark, sf), 60, tie_breaker="tick_id")
    path, offsets = shared_path(spark, "stream-bars"), shared_path(spark, "offsets")
    _run(start_to_parquet(bars, path, offsets))
    return with_held(spark, path, held_bars(spark, offsets)).select(*BAR_COLUMNS)


def _late_delivery() -> F.Column:
    """What comes first: two of three ticks of the first days."""
    return (F.to_date("event_time") < F.lit(SPLIT_DAY).cast("date")) & (F.col("tick_id") % 3 != 0)


def _late_run(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A stream of ticks, some faulty, in two deliveries of which the second holds ticks of hours that are closed by
    then: all ticks, the bars and the late ticks."""
    source, path, offsets = (shared_path(spark, n) for n in ("stream-in", "stream-bars", "offsets"))
    ticks = D.faulty_ticks(D.ticks_from_events(spark, sf))
    for part in (ticks.filter(_late_delivery()), ticks.filter(~_late_delivery())):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(part.schema).parquet(source)
        _run(start_to_parquet(stream_resample(stream, 60, tie_breaker="tick_id"), path, offsets))
    late = late_ticks(spark, offsets, part.schema, 60)
    return spark.read.parquet(source), with_held(spark, path, held_bars(spark, offsets)), late


def stream_late_ticks(spark, sf):
    return _late_run(spark, sf)[2].select("tick_id", "symbol", "event_time")


def stream_late_account(spark, sf):
    """Every tick is in a bar, late or unusable."""
    ticks, bars, late = _late_run(spark, sf)
    names = ["ticks", "in_bars", "late", "unusable"]
    counts = [ticks.agg(F.count("*")), bars.agg(F.sum("num_trades")), late.agg(F.count("*")), unusable_ticks(ticks).agg(F.count("*"))]
    rows = [c.toDF("n").withColumn("kind", F.lit(k)) for k, c in zip(names, counts)]
    told = rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])
    return told.agg(*[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).alias(k) for k in names])


def stream_dedup_bars(spark, sf):
    """Bars in two deliveries, the second of which brings the later copies; the copy given out first stays."""
    source, path, offsets = (shared_path(spark, n) for n in ("stream-in", "stream-out", "offsets"))
    bronze = _bronze(spark, sf)
    first = first_arrival(bronze)
    for part in (first, bronze.exceptAll(first)):
        part.write.mode("append").parquet(source)
        _run(start_to_parquet(stream_dedup(spark.readStream.schema(bronze.schema).parquet(source)), path, offsets))
    return spark.read.schema(bronze.schema).parquet(path)


def stream_first_copies(spark, sf):
    """First copies of all bars: those given out and those still held."""
    source = shared_path(spark, "stream-in")
    bronze = _bronze(spark, sf)
    bronze.write.parquet(source)
    bars = stream_first_arrival(spark.readStream.schema(bronze.schema).parquet(source))
    path, offsets = shared_path(spark, "stream-out"), shared_path(spark, "offsets")
    _run(start_to_parquet(bars, path, offsets))
    return with_held(spark, path, held_first_copies(spark, offsets, bronze.columns))


def stream_rolling(spark, sf):
    """Clean bars delivered in two parts, in time order, as two micro-batches or more."""
    source, path = shared_path(spark, "stream-in"), shared_path(spark, "stream-out")
    state, offsets = shared_path(spark, "tails"), shared_path(spark, "offsets")
    bars = distinct_bars(_bronze(spark, sf)).select("symbol", "timestamp", "volume")
    early = F.to_date(F.timestamp_millis("timestamp")) < F.lit(SPLIT_DAY).cast("date")
    for part in (bars.filter(early), bars.filter(~early)):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(part.schema).parquet(source)
        _run(stream_rolling_volume(stream, path, state, offsets))
    return read_means(spark, path, part.schema).select("symbol", "timestamp", "volume", "avg_volume_10bar")


def stream_rolling_late(spark, sf):
    """As :func:`stream_rolling`, with every third hour and the first days delivered last."""
    source, path = shared_path(spark, "stream-in"), shared_path(spark, "stream-out")
    state, offsets = shared_path(spark, "tails"), shared_path(spark, "offsets")
    bars = distinct_bars(_bronze(spark, sf)).select("symbol", "timestamp", "volume")
    for part in (bars.filter(~_late(bars)), bars.filter(_late(bars))):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(part.schema).parquet(source)
        _run(stream_rolling_volume(stream, path, state, offsets))
    return read_means(spark, path, part.schema).select("symbol", "timestamp", "volume", "avg_volume_10bar")


def stream_bronze_two_runs(spark, sf):
    """Two streams with a checkpoint each, both starting at batch 0, land in one bronze folder."""
    bronze, bad = shared_path(spark, "bronze"), shared_path(spark, "quarantine")
    records = _records(spark, sf)
    half = F.crc32("sequenceNumber") % 2 == 0
    for part in (records.filter(half), records.filter(~half)):
        source = shared_path(spark, "messages")
        part.write.parquet(source)
        _run(stream_bronze(read_messages(spark, source), bronze, bad, shared_path(spark, "offsets")))
    return read_bronze(spark, bronze).select(*BRONZE.fieldNames())


def stream_ingest(spark, sf):
    """Transport records through the streaming ingest; bronze as it was written."""
    source, bronze, bad, offsets = (
        shared_path(spark, n) for n in ("messages", "bronze", "quarantine", "offsets")
    )
    _records(spark, sf).write.parquet(source)
    _run(stream_bronze(read_messages(spark, source), bronze, bad, offsets))
    return read_bronze(spark, bronze).select(*BRONZE.fieldNames())


# --- the catalogue --------------------------------------------------------------------


def _ohlcv(interval: str) -> Query:
    def query(spark, sf):
        ticks = D.ticks_from_events(spark, sf)
        return resample_ohlcv(ticks, INTERVALS[interval], tie_breaker="tick_id").select(*BAR_COLUMNS)

    return query


def ohlcv_1d_rolled_up(spark, sf):
    """One pass over the ticks, then bars from bars."""
    bars = resample_ohlcv(D.ticks_from_events(spark, sf), INTERVALS["1m"], tie_breaker="tick_id")
    for interval in ("5m", "1h", "1d"):
        bars = rollup_bars(bars, INTERVALS[interval])
    return bars.select(*BAR_COLUMNS)


def _report(report: Callable[..., DataFrame], rows: Callable = _slim, **options) -> Query:
    return lambda spark, sf: report(rows(spark, sf), **options)


def _distinct(spark, sf):
    return distinct_bars(_bronze(spark, sf))


def _flagged(mode: str) -> Query:
    def query(spark, sf):
        bars = _distinct(spark, sf).transform(add_time_columns)
        return add_session_column(bars, mode).select(
            "symbol", "timestamp", "event_time", "is_market_hours"
        )

    return query


def market_hours_all_year(spark, sf):
    """Exchange-clock flag of every tick, moved through the year by whole days."""
    ticks = D.ticks_from_events(spark, sf)
    moved = F.timestamp_millis(
        F.unix_millis("event_time") + F.col("tick_id") % 366 * D.DAY_MS
    )
    return ticks.select("tick_id", moved.alias("event_time")).select(
        "tick_id", "event_time", B.is_market_hours(F.col("event_time"), "exchange_tz").alias("is_open")
    )


def _rolling(rows: Callable, **options) -> Query:
    def query(spark, sf):
        bars = trailing_mean(rows(spark, sf).select("symbol", "timestamp", "volume"), **options)
        return bars.select("symbol", "timestamp", "volume", "avg_volume_10bar")

    return query


def _columns(*names: str) -> Query:
    return lambda spark, sf: add_price_columns(_distinct(spark, sf)).select(*names)


QUERIES: dict[str, Query] = {
    # sources, sinks, tables
    "symbol_universe": symbol_universe,
    "symbol_universe_table": symbol_universe_table,
    "prev_envelope": prev_envelope,
    "snapshot_envelope": snapshot_envelope,
    "message_roundtrip": message_roundtrip,
    "decode_stats": decode_counts,
    "decoded_bars": decoded_bars,
    "quarantined_records": quarantined_records,
    "unusable_bars": lambda spark, sf: unusable_bars(_bronze(spark, sf)),
    "bronze_scan": bronze_scan,
    "gold_refresh": gold_refresh,
    "gold_created": gold_created,
    "gold_two_sessions": gold_two_sessions,
    "gold_date_emptied": gold_date_emptied,
    "incremental_silver": incremental_silver,
    "incremental_late_bars": incremental_late_bars,
    "incremental_new_checkpoint": incremental_new_checkpoint,
    "incremental_superseded": incremental_superseded,
    "incremental_crash": incremental_crash,
    "incremental_counts": incremental_counts,
    "silver_partitioned_report": silver_partitioned_report,
    "dead_letter_bars": dead_letter_bars,
    "dead_letter_answers": dead_letter_answers,
    "latest_day_report": latest_day_report,
    "retention_applied": retention_applied,
    "fresh_bronze": fresh_bronze,
    "transform_counts": transform_counts,
    "contract_before_cast": contract_before_cast,
    "contract_breaches": contract_breaches,
    "tracked_symbols": tracked_symbols,
    "dead_letter_ticks": dead_letter_ticks,
    "ohlcv_1h_faulty_ticks": ohlcv_1h_faulty_ticks,
    "stream_rolling_late": stream_rolling_late,
    "stream_bronze_two_runs": stream_bronze_two_runs,
    "append_new_only": append_new,
    "contract_violations": lambda spark, sf: check_contract(_unchecked(spark, sf)),
    "duplicate_keys": lambda spark, sf: duplicate_keys(_unchecked(spark, sf)),
    "retention_tiers": lambda spark, sf: retention_tiers(_slim(spark, sf)),
    "stage_counts": lambda spark, sf: stage_counts(_bronze(spark, sf), usable()),
    # rows and columns
    "dedup_first_arrival": lambda spark, sf: first_arrival(_bronze(spark, sf)),
    "clean_bars": lambda spark, sf: clean_bars(_bronze(spark, sf)),
    "time_columns": lambda spark, sf: add_time_columns(_distinct(spark, sf)).select(
        "symbol", "timestamp", "event_time", "trade_date", "hour", "minute"
    ),
    "price_change": _columns("symbol", "timestamp", "price_change", "price_change_pct"),
    "bar_range": _columns("symbol", "timestamp", "bar_range_pct"),
    "market_hours_utc": _flagged("utc_fixed"),
    "market_hours_exchange": _flagged("exchange_tz"),
    "market_hours_all_year": market_hours_all_year,
    "rolling_volume": _rolling(_distinct),
    "rolling_volume_daily": _rolling(
        lambda spark, sf: distinct_bars(D.bars_from_lineitem(spark, sf)), bucket_ms=QUARTER_MS
    ),
    "silver_bars": _silver,
    "silver_daily": _daily,
    # bars from ticks and from bars
    "ohlcv_1m": _ohlcv("1m"),
    "ohlcv_5m": _ohlcv("5m"),
    "ohlcv_1h": _ohlcv("1h"),
    "ohlcv_1d": _ohlcv("1d"),
    "ohlcv_1d_rolled_up": ohlcv_1d_rolled_up,
    "ohlcv_1d_lineitem": D.bars_from_lineitem,
    # reports
    "bars_for_date": _report(R.bars_for_date),
    "latest_bar_per_symbol": _report(R.latest_bar_per_symbol),
    "latest_bar_per_symbol_daily": lambda spark, sf: R.latest_bar_per_symbol(
        _daily(spark, sf, rolling=False)
    ),
    "top_movers": _report(R.top_movers),
    "top_movers_abs": _report(R.top_movers_abs),
    "top_movers_gain": _report(R.top_movers_gain),
    "top_movers_panel": _report(R.top_movers_panel),
    "mover_bands": _report(R.mover_bands),
    "volume_spikes": _report(R.volume_spikes, _silver),
    "volume_spikes_all_days": _report(R.volume_spikes, _silver, all_days=True),
    "volume_spikes_daily": _report(R.volume_spikes, _daily, all_days=True),
    "volume_spikes_intraday": _report(R.volume_spikes_intraday),
    "latency_top": _report(R.latency_top),
    "daily_summary": _report(R.daily_summary),
    "daily_summary_all_days": _report(daily_summary),
    "daily_summary_as_written": _report(R.daily_summary_as_written),
    "completeness": _report(R.completeness),
    "load_check": _report(R.load_check),
    "close_by_symbol": _report(R.close_by_symbol),
    "close_series": _report(R.close_series),
    "volume_by_symbol": _report(R.volume_by_symbol),
    "avg_latency": _report(R.avg_latency),
    "record_count": _report(R.record_count),
    "symbol_history": _report(R.symbol_history, symbol=ONE_SYMBOL),
    # health
    "health_bands": _report(R.health_bands),
    "ingest_lag": lambda spark, sf: R.ingest_lag(_bronze(spark, sf)),
    "alarm_error_rate": alarm_error_rate,
    "alarm_lag": alarm_lag,
    "alarm_lag_by_symbol": alarm_lag_by_symbol,
    "alarm_dead_letters": alarm_dead_letters,
    "alarm_throttles": alarm_throttles,
    "alarm_error_rate_within": alarm_error_rate_within,
    "alarm_strays": alarm_strays,
    "close_series_range": close_series_range,
    "alarm_failed_tasks": alarm_failed_tasks,
    # streams
    "stream_ohlcv_1h": stream_ohlcv_1h,
    "stream_dedup": stream_dedup_bars,
    "stream_late_ticks": stream_late_ticks,
    "stream_late_account": stream_late_account,
    "stream_first_arrival": stream_first_copies,
    "stream_rolling_volume": stream_rolling,
    "stream_bronze": stream_ingest,
}


def plain_timestamps(df: DataFrame) -> DataFrame:
    """UTC instants as timestamps without zone, the way the given tables store them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def catalog() -> dict[str, Query]:
    def bind(query: Query) -> Query:
        return lambda spark, sf: plain_timestamps(query(pin_utc(spark), sf))

    return {name: bind(query) for name, query in QUERIES.items()}
