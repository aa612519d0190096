import os
from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pytest
from fixtures import RAW, bronze

from barloom.plans.jobs import Written, run_transform
from barloom.session import shared_path, shared_root
from barloom.sinks.tables import write_bronze

NOW = datetime.now(timezone.utc)


def test_transform_counts_what_it_writes(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "silver")
    write_bronze(bronze(spark, RAW), raw)
    for by in ((), ("trade_date",)):
        got = run_transform(spark, raw, out + str(len(by)), partition_by=by)
        assert got == Written(4, 3, 1, 2, 1, 2, date(2023, 11, 14), date(2023, 11, 14))
        assert spark.read.parquet(out + str(len(by))).count() == 2


def test_transform_waits_for_fresh_files(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "silver")
    write_bronze(bronze(spark, RAW), raw)
    stamp = (NOW - timedelta(hours=3)).timestamp()
    for file in Path(raw).rglob("*.parquet"):
        os.utime(file, (stamp, stamp))
    assert run_transform(spark, raw, out, only_if_fresh=True) is None
    assert not Path(out).exists()
    write_bronze(bronze(spark, RAW), raw)
    assert run_transform(spark, raw, out, only_if_fresh=True).rows == 2


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_root(spark) == named
    a, b = shared_path(spark, "x"), shared_path(spark, "x")
    assert a != b and a.startswith(named)


def test_without_the_setting_files_go_to_the_warehouse(spark, tmp_path):
    class Unset:
        def get(self, key):
            return f"{tmp_path}/warehouse" if key == "spark.sql.warehouse.dir" else None

        def getConf(self):
            return self

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = conf = Unset()

    root = shared_root(Session())
    assert root.startswith(f"{tmp_path}/warehouse/")
    spark.range(3).write.parquet(f"{root}/some")
    assert spark.read.parquet(f"{root}/some").count() == 3
