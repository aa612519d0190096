"""The gold table: versioned folders by date, shown under one name in the catalog.

Each version is a catalog table of its own over that version's folders, one partition a date; the name that readers
use is a view over the newest of them. Replacing the view is one write, so every session that shares the catalog sees the
old version or the new one. A load that fails has neither published a list nor moved the view.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators.contract import apply_defaults
from barloom.schemas import GOLD, conform
from barloom.sinks.versions import Version, VersionedTable, is_versioned
from barloom.sources.files import exists

DAY = "trade_date"
_INNER = T.StructType([f for f in GOLD.fields if f.name != DAY])
#: Versions whose catalog tables stay, so that queries that are under way can end.
KEPT = 2


def quoted(name: str) -> str:
    """A name, which may hold a database, for use in SQL."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def gold_rows(silver: DataFrame) -> DataFrame:
    """Silver as gold stores it: its columns, with the contract's defaults."""
    return apply_defaults(conform(silver, GOLD))


class GoldTable:
    """Gold at ``path``, shown as ``name`` if one is given.

    With ``buckets`` the files of a date are split by symbol, so that grouping and joining by symbol need no
    shuffle; a heavy symbol's rows still come from all tasks that write. All versions of a table have the same number.
    """

    def __init__(self, spark: SparkSession, path: str, name: str | None = None, buckets: int = 0):
        self.spark = spark
        self.table = VersionedTable(spark, path, DAY)
        self.name = name
        self.buckets = buckets

    def read(self) -> DataFrame:
        return self.table.read(_INNER).select(*GOLD.fieldNames())

    def refresh_full(self, silver: DataFrame) -> Version:
        """Load everything anew; readers of the old version are not disturbed."""
        base = self.table.current()
        return self._publish(base, self._written(silver), base.folders)

    def refresh_date(self, silver: DataFrame, day: date | str) -> Version:
        """Replace one date and leave the others alone; a date without rows leaves the table."""
        base = self.table.current()
        rows = silver.filter(F.col(DAY) == F.lit(str(day)).cast("date"))
        return self._publish(base, self._written(rows), base.on([str(day)]))

    def _written(self, silver: DataFrame):
        if self.buckets:
            return self.table.add(gold_rows(silver), ("event_time",), ("symbol", self.buckets))
        return self.table.add(gold_rows(silver), ("symbol", "event_time"))

    def _publish(self, base: Version, added, gone) -> Version:
        version = self.table.commit(base, added, gone)
        if self.name:
            self.show(version)
        return version

    def show(self, version: Version | None = None) -> None:
        """Make the catalog's name stand for a version, by default the newest."""
        version = version or self.table.current()
        shown = f"{self.name}__v{version.number}"
        inner = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in [*_INNER.fields, GOLD[DAY]])
        clustered = f"CLUSTERED BY (symbol) SORTED BY (event_time) INTO {int(self.buckets)} BUCKETS" if self.buckets else ""
        self.spark.sql(f"DROP TABLE IF EXISTS {quoted(shown)}")
        self.spark.sql(
            f"CREATE TABLE {quoted(shown)} ({inner}) USING parquet PARTITIONED BY ({DAY}) {clustered} LOCATION {text(self.table.path + '/_shown')}"
        )
        parts = [f"PARTITION ({DAY} = DATE {text(f.date)}) LOCATION {text(self.table.place(f))}" for f in sorted(version.folders)]
        for at in range(0, len(parts), 500):
            self.spark.sql(f"ALTER TABLE {quoted(shown)} ADD " + " ".join(parts[at : at + 500]))
        columns = ", ".join(map(quoted, GOLD.fieldNames()))
        self.spark.sql(f"CREATE OR REPLACE VIEW {quoted(self.name)} AS SELECT {columns} FROM {quoted(shown)}")
        self.spark.sql(f"DROP TABLE IF EXISTS {quoted(f'{self.name}__v{version.number - KEPT}')}")

    def create(self) -> None:
        """Drop what the catalog knows by the name and set it up anew over what lies at the path.

        That may be a table of this class or plain folders by date that something else has loaded; nothing there is none too.
        """
        for kind in ("VIEW", "TABLE"):
            try:
                self.spark.sql(f"DROP {kind} IF EXISTS {quoted(self.name)}")
            except Exception as error:  # the name is the other kind's
                if "EXPECT_" not in str(error) and "WRONG_" not in str(error) and "NOT_" not in str(error):
                    raise
        if is_versioned(self.spark, self.table.path):
            return self.show()
        inner = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in GOLD.fields)
        self.spark.sql(f"CREATE TABLE {quoted(self.name)} ({inner}) USING parquet PARTITIONED BY ({DAY}) LOCATION {text(self.table.path)}")
        if exists(self.spark, self.table.path):
            self.spark.sql(f"ALTER TABLE {quoted(self.name)} RECOVER PARTITIONS")
