"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default sf 0.1), BENCH_CPUS the cores, BENCH_RUNS the timed
runs per query after one warm-up; the figure is their median, the spread their range.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from barloom.plans import reports as R
from barloom.plans.catalog import QUARTER_MS, catalog
from barloom.plans.silver import silver
from barloom.session import local_session, shared_path
from barloom.sinks.tables import layout_gold
from barloom.sources.derived import bars_from_lineitem

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

# From the raw tables to the answer, nothing stored in between.
WHOLE = [
    "silver_bars",
    "silver_daily",
    "rolling_volume_daily",
    "volume_spikes_daily",
    "ohlcv_1m",
    "ohlcv_5m",
    "ohlcv_1h",
    "ohlcv_1d",
    "ohlcv_1d_rolled_up",
    "ohlcv_1d_lineitem",
    "top_movers",
    "daily_summary_all_days",
    "completeness",
    "message_roundtrip",
    "decode_stats",
    "contract_violations",
    "alarm_lag_by_symbol",
    "append_new_only",
    "stream_ohlcv_1h",
    "incremental_silver",
]

# Reports over a stored table, the way they are asked day to day.
STORED = {
    "stored_top_movers": R.top_movers,
    "stored_volume_spikes": lambda bars: R.volume_spikes(bars, all_days=True),
    "stored_volume_by_symbol": R.volume_by_symbol,
    "stored_latest_bar_per_symbol": R.latest_bar_per_symbol,
    "stored_daily_summary": lambda bars: R.daily_summary(bars, days=36_500),
    "stored_completeness": R.completeness,
    "stored_load_check": R.load_check,
    "stored_latency_top": R.latency_top,
    "stored_symbol_history": lambda bars: R.symbol_history(bars, "S1"),
}


SPREAD: dict[str, float] = {}


def timed(name: str, run) -> float:
    taken = []
    for _ in range(RUNS + 1):
        start = time.perf_counter()
        run().write.format("noop").mode("overwrite").save()
        taken.append(time.perf_counter() - start)
    SPREAD[name] = round(max(taken[1:]) - min(taken[1:]), 3)
    return round(statistics.median(taken[1:]), 3)


def main() -> None:
    spark = local_session(CPUS, partitions=int(CPUS))
    queries = catalog()
    seconds = {name: timed(name, lambda q=queries[name]: q(spark, SF_DIR)) for name in WHOLE}
    table = shared_path(spark, "stored-bars")
    layout_gold(silver(bars_from_lineitem(spark, SF_DIR), bucket_ms=QUARTER_MS)).write.parquet(table)
    for name, report in STORED.items():
        seconds[name] = timed(name, lambda r=report: r(spark.read.parquet(table)))
    print(
        json.dumps(
            {
                "metric": "total_seconds_of_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "spread": SPREAD,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
