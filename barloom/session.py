"""Session settings the library relies on."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def pin_utc(spark: SparkSession) -> SparkSession:
    """Bars are keyed by UTC epoch milliseconds, so dates and hours are UTC too."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def local_session(cores: str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("barloom")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    A session that sets none keeps the files in its warehouse, which is shared as well.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    return root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_between"


def shared_path(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below :func:`shared_root`; nothing is ever overwritten there."""
    return f"{shared_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
