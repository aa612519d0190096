from pathlib import Path

import pytest
from fixtures import bar, bronze
from pyspark.sql import functions as F

from barloom.plans.silver import silver
from barloom.schemas import SILVER
from barloom.sinks.tables import write_bronze
from barloom.sinks.versions import StaleVersion, VersionedTable
from barloom.streaming.incremental import read_silver, run_incremental
from barloom.streaming.means import reach

HOUR = 3_600_000
DAY = 24 * HOUR


def table_of(spark, tmp_path, days=("2024-01-01", "2024-01-02")):
    table = VersionedTable(spark, str(tmp_path / "t"))
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "n int, day string").select("n", F.to_date("day").alias("by_date"))
    table.commit(table.current(), table.add(rows), mark="run-0", tails="x")
    return table, rows


def test_a_version_is_its_list(spark, tmp_path):
    table, rows = table_of(spark, tmp_path)
    now = table.current()
    assert (now.number, now.dates(), now.notes) == (1, ["2024-01-01", "2024-01-02"], {"tails": "x"})
    assert now.has("run-0") and not now.has("run-1") and not now.has("other-0") and not now.has(None)
    table.add(rows)  # written, not published
    assert table.read(rows.select("n").schema).count() == 2
    kept = now.on(["2024-01-02"])
    added = table.add(rows.filter("n = 0").withColumn("n", F.lit(7)))
    table.commit(now, added, now.on(["2024-01-01"]))
    got = {(r.n, str(r.by_date)) for r in table.read(rows.select("n").schema).collect()}
    assert got == {(7, "2024-01-01"), (1, "2024-01-02")}
    assert table.current().folders == frozenset([*kept, *added])
    assert table.read(rows.select("n").schema, []).count() == 0
    assert table.version(1) == now


def test_of_two_writers_one_has_to_start_anew(spark, tmp_path):
    table, rows = table_of(spark, tmp_path)
    base = table.current()
    table.commit(base, gone=base.on(["2024-01-01"]))
    with pytest.raises(StaleVersion):
        table.commit(base, gone=base.on(["2024-01-02"]))
    assert table.current().dates() == ["2024-01-02"]


def test_vacuum_removes_what_no_kept_version_holds(spark, tmp_path):
    table, rows = table_of(spark, tmp_path)
    table.add(rows)  # of a writer that died
    base = table.current()
    table.commit(base, gone=base.on(["2024-01-01"]))
    assert table.vacuum(keep=2) == 1
    assert table.read(rows.select("n").schema, base.folders).count() == 2
    assert table.vacuum(keep=1) == 1
    assert table.read(rows.select("n").schema).count() == 1
    assert len(list((tmp_path / "t" / "_versions").glob("*.json"))) == 1
    assert not (tmp_path / "t" / f"write={base.on(['2024-01-01'])[0].write}" / "by_date=2024-01-01").exists()


def test_reach_follows_the_bars_and_not_the_days(spark):
    counts = [("A", f"2024-01-{d:02d}", n) for d, n in ((1, 9), (2, 4), (3, 3), (4, 3), (9, 1), (10, 8), (11, 2), (12, 5))]
    counts += [("B", "2024-01-01", 50)]
    counts = spark.createDataFrame(counts, "symbol string, day string, bars long").select("symbol", F.to_date("day").alias("by_date"), F.col("bars").alias("rows"))
    touched = spark.createDataFrame([("A", "2024-01-04"), ("C", "2024-01-04")], "symbol string, day string").select("symbol", F.to_date("day").alias("by_date"))
    got = {(r.symbol, r.by_date.day): r.inner for r in reach(counts, touched, 10).collect()}
    assert got.pop(("C", 4))
    # 4 + 3 bars lie between the 1st and the 4th, so the 1st still fills frames; 1 + 8 between the 4th and the 11th
    assert got == {("A", 1): False, ("A", 2): False, ("A", 3): False, ("A", 4): True, ("A", 9): True, ("A", 10): True, ("A", 11): True}


def args_of(tmp_path):
    return [str(tmp_path / n) for n in ("raw", "silver", "state", "cp")]


def spoil(path, dates):
    """Make the files of some dates unreadable."""
    for file in Path(path).rglob("*.parquet"):
        if file.parent.name.split("=")[-1] in dates:
            file.write_bytes(b"spoilt")


def test_one_late_bar_reads_three_dates(spark, tmp_path):
    start = 19_700 * DAY
    rows = [bar(symbol=s, timestamp=start + t * HOUR, volume=float(t % 13)) for t in range(24 * 9) for s in ("AB", "CD")]
    late = [r for r in rows if r[0] == "AB" and r[7] == start + 100 * HOUR]
    args = args_of(tmp_path)
    write_bronze(bronze(spark, [r for r in rows if r not in late]), args[0])
    run_incremental(spark, *args)
    table = VersionedTable(spark, args[1])
    before = table.current()
    days = before.dates()
    spoil(args[1], [d for i, d in enumerate(days) if abs(i - 4) > 1])
    write_bronze(bronze(spark, late), args[0])
    told = run_incremental(spark, *args)
    assert (told.added, told.replaced, told.mended) == (1, 0, 10)
    after = table.current()
    assert {f.date for f in before.folders ^ after.folders} == {days[4]}
    got = table.read(SILVER, after.on(days[3:6])).select(*SILVER.fieldNames())
    want = silver(bronze(spark, rows)).filter(F.col("trade_date").between(days[3], days[5]))
    assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr)


def test_a_copy_that_arrived_earlier_replaces_the_stored_one(spark, tmp_path):
    first = [bar(timestamp=i * 5 * HOUR, volume=5.0, ingestion_time=1000 + i) for i in range(30)]
    second = [bar(timestamp=i * 5 * HOUR, volume=8.0, ingestion_time=900) for i in (3, 17, 29)]
    second += [bar(timestamp=4 * 5 * HOUR, volume=9.0, ingestion_time=5000), bar(timestamp=6 * 5 * HOUR, volume=9.0, ingestion_time=None)]
    second += [bar(timestamp=7 * 5 * HOUR, volume=4.0, ingestion_time=1007), bar(timestamp=8 * 5 * HOUR, volume=6.0, ingestion_time=1008)]
    third = [bar(timestamp=29 * 5 * HOUR, volume=7.0, ingestion_time=1), bar(timestamp=30 * 5 * HOUR, volume=1.0)]
    args = args_of(tmp_path)
    told = []
    for part in (first, second, third):
        write_bronze(bronze(spark, part), args[0])
        told.append(run_incremental(spark, *args))
    assert [(t.added, t.replaced) for t in told] == [(30, 0), (0, 4), (1, 1)]
    got = read_silver(spark, args[1]).select(*SILVER.fieldNames())
    assert sorted(got.collect(), key=repr) == sorted(silver(bronze(spark, first + second + third)).collect(), key=repr)


def test_a_batch_that_dies_before_its_list_changes_nothing(spark, tmp_path, monkeypatch):
    rows = [bar(timestamp=t * 5 * HOUR, volume=float(t % 7)) for t in range(40)]
    args = args_of(tmp_path)
    write_bronze(bronze(spark, [r for i, r in enumerate(rows) if i % 4]), args[0])
    run_incremental(spark, *args)
    before = sorted(read_silver(spark, args[1]).collect(), key=repr)
    write_bronze(bronze(spark, rows[::4]), args[0])

    def dies(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(VersionedTable, "commit", dies)
        with pytest.raises(Exception, match="lost"):
            run_incremental(spark, *args)
    assert sorted(read_silver(spark, args[1]).collect(), key=repr) == before
    run_incremental(spark, *args)
    got = read_silver(spark, args[1]).select(*SILVER.fieldNames())
    assert sorted(got.collect(), key=repr) == sorted(silver(bronze(spark, rows)).collect(), key=repr)
