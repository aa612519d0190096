"""Tables whose content is a list of folders, changed as a whole by one write.

Rows lie in folders that are written once and never touched again. Which of them make up the table is said by
a numbered list below ``_versions``; a change writes new folders first and then the next list, which comes into being
by a rename that never replaces a file. So a reader sees a version or the next one and nothing between; a writer that dies
before its rename has changed nothing, and two writers that start from the same version cannot both end.

The list is the table's metadata: an entry per folder and date, so its size follows the time span (and the
number of writes since the last compaction), not the rows. Dates and folders to read are picked from it without looking at files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.sources.files import children, exists, publish, read_text, remove

LISTS, INDEX = "_versions", "_index"


class StaleVersion(RuntimeError):
    """Another writer has published the version that this one was about to write."""


@dataclass(frozen=True, order=True)
class Folder:
    """One date's rows of one write."""

    date: str
    write: str


@dataclass(frozen=True)
class Version:
    number: int = 0
    folders: frozenset[Folder] = frozenset()
    #: The last batch of each run that is part of the table.
    runs: dict[str, int] = field(default_factory=dict)
    notes: dict[str, str] = field(default_factory=dict)

    def has(self, mark: str | None) -> bool:
        """Whether a batch (named ``run-number``) is part of the table already."""
        run, _, number = (mark or "").rpartition("-")
        return bool(mark) and self.runs.get(run, -1) >= int(number)

    def dates(self) -> list[str]:
        return sorted({f.date for f in self.folders})

    def on(self, dates: Iterable[str]) -> list[Folder]:
        wanted = set(dates)
        return sorted(f for f in self.folders if f.date in wanted)


class VersionedTable:
    """A table at ``path`` whose folders are named ``write=…/<by>=<date>``.

    With ``counted``, a string column, each write is indexed by how many rows a value of it has on each date.
    """

    def __init__(self, spark: SparkSession, path: str, by: str = "by_date", counted: str | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.by = by
        self.counted = counted

    def current(self) -> Version:
        """The newest version; number 0, without folders, where there is none."""
        names = [n for n in children(self.spark, f"{self.path}/{LISTS}") if n.endswith(".json")]
        if not names:
            return Version()
        return self.version(int(max(names).removesuffix(".json")))

    def version(self, number: int) -> Version:
        told = json.loads(read_text(self.spark, self._list(number)))
        folders = frozenset(Folder(date, write) for date, write in told["folders"])
        return Version(number, folders, told["runs"], told["notes"])

    def _list(self, number: int) -> str:
        return f"{self.path}/{LISTS}/{number:020d}.json"

    def place(self, folder: Folder) -> str:
        return f"{self.path}/write={folder.write}/{self.by}={folder.date}"

    def read(self, schema: T.StructType, folders: Iterable[Folder] | None = None) -> DataFrame:
        """The rows of ``folders`` (by default all of the current version), with the columns ``write`` and ``by``.

        Only these folders are listed and read.
        """
        chosen = sorted(self.current().folders if folders is None else folders)
        full = T.StructType([*schema.fields, T.StructField("write", T.StringType()), T.StructField(self.by, T.DateType())])
        if not chosen:
            return self.spark.createDataFrame([], full)
        return self.spark.read.schema(full).option("basePath", self.path).parquet(*map(self.place, chosen))

    def add(
        self, rows: DataFrame, sort_by: tuple[str, ...] = (), bucket_by: tuple[str, int] | None = None,
        prefix: str = "", codec: str = "snappy",
    ) -> list[Folder]:
        """Write ``rows`` (with the column ``by``) into new folders, which are not part of the table yet.

        Rows are gathered per date first, by a rebalance, which splits a date that is too big for one task, and
        sorted within a file. With ``bucket_by`` (a column and how many) the files of a date are split by that column instead.
        """
        write = prefix + uuid.uuid4().hex
        place = f"{self.path}/write={write}"
        if bucket_by is None:
            rows = rows.hint("rebalance", self.by)
            rows = rows.sortWithinPartitions(self.by, *sort_by) if sort_by else rows
            rows.write.partitionBy(self.by).option("compression", codec).parquet(place)
        else:  # bucketed files are written by way of a catalog table; dropping it leaves them in place
            writer = rows.write.partitionBy(self.by).bucketBy(bucket_by[1], bucket_by[0]).option("path", place).option("compression", codec)
            (writer.sortBy(*sort_by) if sort_by else writer).format("parquet").saveAsTable(name := f"write_{uuid.uuid4().hex}")
            self.spark.sql(f"DROP TABLE {name}")
        found = [n for n in children(self.spark, place) if n.startswith(f"{self.by}=")]
        added = [Folder(name.split("=", 1)[1], write) for name in found]
        if self.counted and added:
            column = T.StructType([T.StructField(self.counted, T.StringType())])
            counts = self.read(column, added).groupBy(self.counted, self.by).agg(F.count("*").alias("rows"))
            counts.write.parquet(f"{self.path}/{INDEX}/write={write}")
        return added

    def counts(self, version: Version) -> DataFrame:
        """``counted``, ``by`` and rows of the folders of a version; only the index is read."""
        live = self.spark.createDataFrame([(f.date, f.write) for f in version.folders], f"{self.by} string, write string")
        live = live.withColumn(self.by, F.col(self.by).cast("date"))
        root = f"{self.path}/{INDEX}"
        places = [f"{root}/write={w}" for w in sorted({f.write for f in version.folders})]
        schema = f"{self.counted} string, {self.by} date, rows bigint, write string"
        found = self.spark.read.schema(schema).option("basePath", root).parquet(*places) if places else self.spark.createDataFrame([], schema)
        return found.join(live, [self.by, "write"]).groupBy(self.counted, self.by).agg(F.sum("rows").alias("rows"))

    def commit(
        self,
        base: Version,
        added: Iterable[Folder] = (),
        gone: Iterable[Folder] = (),
        mark: str | None = None,
        **notes: str,
    ) -> Version:
        """Publish the version after ``base``: without the folders ``gone``, with those ``added``."""
        runs = dict(base.runs)
        if mark:
            run, _, number = mark.rpartition("-")
            runs[run] = int(number)
        new = Version(base.number + 1, (base.folders - set(gone)) | set(added), runs, {**base.notes, **notes})
        told = {"folders": sorted((f.date, f.write) for f in new.folders), "runs": new.runs, "notes": new.notes}
        if not publish(self.spark, self._list(new.number), json.dumps(told)):
            raise StaleVersion(f"{self.path}: version {new.number} was written by another run")
        return new

    def vacuum(self, keep: int = 10) -> int:
        """Remove folders that none of the last ``keep`` versions holds, and older lists; returns the folders removed.

        No writer may be at work, as its folders belong to no version yet.
        """
        newest = self.current().number
        names = sorted(n for n in children(self.spark, f"{self.path}/{LISTS}") if n.endswith(".json"))
        kept = [int(n.removesuffix(".json")) for n in names if int(n.removesuffix(".json")) > newest - keep]
        live = {f for number in kept for f in self.version(number).folders}
        removed = 0
        for write in children(self.spark, self.path):
            if not write.startswith("write="):
                continue
            name = write.split("=", 1)[1]
            dates = {f.date for f in live if f.write == name}
            if not dates:
                remove(self.spark, f"{self.path}/{write}")
                remove(self.spark, f"{self.path}/{INDEX}/{write}")
                removed += 1
                continue
            for folder in children(self.spark, f"{self.path}/{write}"):
                if folder.startswith(f"{self.by}=") and folder.split("=", 1)[1] not in dates:
                    remove(self.spark, f"{self.path}/{write}/{folder}")
                    removed += 1
        for name in names:
            if int(name.removesuffix(".json")) not in kept:
                remove(self.spark, f"{self.path}/{LISTS}/{name}")
        return removed


def is_versioned(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path.rstrip('/')}/{LISTS}")
