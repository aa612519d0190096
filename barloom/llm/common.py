"""Helpers that the text operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.session import shared_path
from barloom.sources.files import remove


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: What is being written below each open :func:`only_last`.
_made: list[list[str]] = []


@contextlib.contextmanager
def only_last(spark: SparkSession):
    """Of the tables that :func:`stored` writes within, the last stays; the folders of the others are removed at the end."""
    _made.append([])
    try:
        yield
    finally:
        paths = _made.pop()
        for path in paths[:-1]:
            remove(spark, path)
        if _made:
            _made[-1] += paths[-1:]


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: a lost executor costs a read of the files, not the work before.
    """
    path = shared_path(df.sparkSession, purpose)
    df.write.parquet(path)
    if _made:
        _made[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Have Spark remove the shuffle files of steps that are over; it does when the driver's garbage is collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Rows without a key of their own are numbered from here on; keys are taken to lie below.
UNKEYED = 1 << 62


def unique_key(docs: DataFrame, key: str, name: str) -> tuple[DataFrame, bool]:
    """``docs`` with a column ``name`` of integers that tell its rows apart, and whether they are more than the key.

    A row's number is its key. Of rows that repeat a key one keeps it; the others, and rows without a key, get
    numbers from ``UNKEYED`` on. Only then is the table written out, so that the numbers stay what they are.
    """
    own = F.col(f"`{key}`").cast("long")
    twice = docs.groupBy(own.alias("k")).agg(F.count("*").alias("n")).where("n > 1 OR k IS NULL")
    if twice.isEmpty():
        return docs.withColumn(name, own), False
    rows = stored(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered-rows")
    first = rows.groupBy(own.alias("__key")).agg(F.min("__row").alias("__first"), F.count("*").alias("__n"))
    first = first.where("__n > 1 AND __key IS NOT NULL").drop("__n")
    met = rows.join(first, own == F.col("__key"), "left")
    spare = own.isNull() | (F.col("__first").isNotNull() & (F.col("__first") != F.col("__row")))
    numbered = met.withColumn(name, F.when(spare, F.col("__row") + UNKEYED).otherwise(own))
    return numbered.drop("__row", "__key", "__first"), True


class WordMemory(dict):
    """Values by word, forgotten all at once when the words take more than ``limit`` bytes, roughly."""

    def __init__(self, limit: int, each: int):
        super().__init__()
        self.limit, self.each, self.taken = limit, each, 0

    def has_room(self, words: list) -> bool:
        """Count ``words`` in; False, with everything forgotten, if they do not fit beside the others."""
        size = sum(map(len, words)) + self.each * len(words)
        fits = self.taken + size <= self.limit
        if not fits:
            self.clear()
            self.taken = 0
        self.taken += size
        return fits


def let_go() -> None:
    """Give memory that is no longer used back to the system, as the worker stays for other tasks and the driver for other stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def in_batches(
    df: DataFrame, schema: str, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], setup: Callable[[], object] | None = None
) -> DataFrame:
    """Apply ``work`` to each Arrow batch; Spark bounds a batch by rows and bytes.

    ``setup`` runs once a task and its result is the second argument of ``work``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = setup() if setup else None
        try:
            for batch in batches:
                out = work(batch, state) if setup else work(batch)
                if out is not None:
                    yield out
        finally:
            state = batch = out = None
            let_go()

    return df.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Rows that no model may learn labels from."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def hash_order(column: str, seed: int = 7) -> F.Column:
    """A fixed order that has nothing to do with the values; samples are cut from it."""
    return F.xxhash64(F.lit(seed), F.col(column))


def in_groups(
    df: DataFrame, keys: list[str], order: list, schema: str, work: Callable[[pa.Table], Iterator[pa.RecordBatch]]
) -> DataFrame:
    """Apply ``work`` to the rows of each value of ``keys`` (integers, never null), sorted by ``order``.

    The groups of a partition stream by; one group is in memory at a time, so callers bound their groups.
    """
    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(_grouped(keys, work), schema)


def _grouped(keys: list[str], work):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
            change = np.zeros(batch.num_rows, dtype=bool)
            for c in columns:
                change[1:] |= c[1:] != c[:-1]
            cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
            for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                key = tuple(c[a] for c in columns)
                if held and key != last:
                    yield from work(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(a, b - a))
                last = key
        if held:
            yield from work(pa.Table.from_batches(held))
        held = batch = columns = None
        let_go()

    return run
