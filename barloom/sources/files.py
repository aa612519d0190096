"""What lies below a path, asked of whichever store holds it."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    store, where = _place(spark, path)
    return store.exists(where)


def complete_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below ``path`` whose write ended, oldest first."""
    store, where = _place(spark, path)
    if not store.exists(where):
        return []
    found = []
    for child in store.listStatus(where):
        done = spark._jvm.org.apache.hadoop.fs.Path(child.getPath(), "_SUCCESS")
        if store.exists(done):
            found.append((store.getFileStatus(done).getModificationTime(), child.getPath().getName()))
    return [name for _, name in sorted(found)]


def remove(spark: SparkSession, path: str) -> None:
    store, where = _place(spark, path)
    store.delete(where, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly below ``path``; nothing if it does not exist."""
    store, where = _place(spark, path)
    return sorted(child.getPath().getName() for child in store.listStatus(where)) if store.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    store, where = _place(spark, path)
    stream = store.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file appear whole under ``path``, by a rename; False if there is one of that name."""
    store, where = _place(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    draft = hadoop.Path(where.getParent(), f".draft-{uuid.uuid4().hex}")
    stream = store.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = hadoop.FileContext.getFileContext(where.toUri(), spark._jsc.hadoopConfiguration())
    kind = getattr(hadoop, "Options$Rename")
    never_replace = spark.sparkContext._gateway.new_array(kind, 1)
    never_replace[0] = kind.NONE
    try:
        context.rename(store.makeQualified(draft), store.makeQualified(where), never_replace)
    except Py4JJavaError as error:
        store.delete(draft, False)
        if store.exists(where):
            return False
        raise error
    return True
