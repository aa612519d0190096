"""Substring dedup: lines and sentences that another document had first are cut out.

A text is read as lines, and lines as sentences. Units are normalised (lower case, single spaces) and
hashed to 128 bits; digests are grouped over all documents and the document of the lowest rank
keeps the unit, all others lose it; within one document the first place keeps it. Units of fewer than
three words are too common to count alone: they are looked up joined with their neighbours, in windows of
eight words or more that start or end at them. Between removed units, fewer than eight words in such units go
along. A run of repeated units goes if it has eight words in all. Of a shorter run, whole lines of four words or
more go, and units that eight or more rows hold; what else is as short may repeat by chance and stays. Words are counted by spaces, and by letters in scripts that have none.

What each document loses is reported as spans of its original text, with the document that keeps the
unit. Digests are counted map-side first and joined back by shuffle, which Spark splits where one line
is everywhere; a document's own spans are the only thing gathered by document.

Null and empty texts lose nothing. Of rows that repeat a rank one has it; the others, and rows without one, are
documents of their own that rank last. Columns of any other name are kept as they are; ``text`` is replaced and
``removed`` is added in place of a column of that name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Set

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import UNKEYED, unique_key

CUT = re.compile(r"\n|(?<=[.!?])\s+|(?<=[\u3002\uff01\uff1f\uff61])")
#: Letters of scripts written without spaces, and how many of them count as a word.
UNSPACED = (
    (re.compile("[\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9d\U00020000-\U0003ffff]"), 2),
    (re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff]"), 4),
)
#: Words a unit needs to be looked up by itself, and words a run of repeated units needs to be removed.
MIN_UNIT, MIN_RUN = 3, 8
#: A shorter run goes where it is a whole line of so many words, or where a unit is in so many rows.
MIN_LINE, COMMON = 4, 8
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("first", pa.int64())]))


def _count(words: list[str], unspaced: bool) -> int:
    """Words in ``words``; in scripts without spaces two ideographs or kana, or four other letters, make one."""
    n = len(words)
    for word in words if unspaced else ():
        n += max(0, sum(len(r.findall(word)) // per for r, per in UNSPACED) - 1)
    return n


def pieces(text: str) -> tuple[list[tuple[int, int, int, bytes | None]], list[tuple[int, int, bytes]]]:
    """(start, end, words, digest) of the units, which together are the text, and (first, last, digest) of the windows.

    A short unit has no digest. It starts a window and ends one: its neighbours are joined to it until
    there are MIN_RUN words. A window's digest is of its units.
    """
    found, bodies, at = [], [], 0
    unspaced = not text.isascii() and any(r.search(text) for r, _ in UNSPACED)
    for end in [*(m.end() for m in CUT.finditer(text)), len(text)]:
        if end > at:
            words = text[at:end].lower().split()
            body, n = " ".join(words).encode(), _count(words, unspaced)
            found.append((at, end, n, xxhash.xxh3_128_digest(body) if n >= MIN_UNIT else None))
            bodies.append(body)
            at = end
    sizes, spans = [u[2] for u in found], set()
    for i, n in enumerate(sizes):
        if 0 < n < MIN_UNIT:
            for step in (1, -1):
                j, total = i, n
                while total < MIN_RUN and 0 <= j + step < len(found):
                    j += step
                    total += sizes[j]
                if total >= MIN_RUN:
                    spans.add((min(i, j), max(i, j)))
    windows = []
    for i, j in sorted(spans):
        joined = [found[k][3] or bodies[k] for k in range(i, j + 1) if sizes[k]]
        windows.append((i, j, xxhash.xxh3_128_digest(b"\n".join([b"", *joined]))))
    return found, windows


def units(text: str) -> Iterator[tuple[int, int, int, bytes | None]]:
    """(start, end, words, digest) of the units, which together are the text; then of each window, at the end and empty."""
    found, windows = pieces(text)
    yield from found
    for _, _, digest in windows:
        yield len(text), len(text), 0, digest


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, digests, counts = batch.column(0).to_numpy(), [], []
        for text in batch.column(1).to_pylist():
            own = {u[3] for u in units(text or "")} - {None}
            digests += own
            counts.append(len(own))
        halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
        columns = [np.repeat(keys, counts), halves[:, 0], halves[:, 1]]
        for i in range(0, len(digests), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(c[i : i + 100_000]) for c in columns], ["doc", "h1", "h2"])


def _whole_lines(text: str, found: list, owners: list, i: int, j: int) -> Iterator[int]:
    """The units of ``i`` to ``j`` in whole lines of MIN_LINE repeated words or more."""
    start = i if found[i][0] == 0 or text[found[i][0] - 1] == "\n" else None
    for k in range(i, j):
        if found[k][1] == len(text) or text[found[k][1] - 1] == "\n":
            if start is not None and sum(found[m][2] for m in range(start, k + 1) if owners[m] is not None) >= MIN_LINE:
                yield from range(start, k + 1)
            start = k + 1


def removals(text: str, taken: dict[bytes, int], key: int, common: Set[bytes] = frozenset()) -> list[tuple[int, int, int]]:
    """Spans of ``text`` to remove: units in ``taken`` (digest to owner) and later ones of its own.

    ``common`` are the digests of units that are removed however short their run.
    """
    found, windows = pieces(text)
    seen: set[bytes] = set()
    owners: list[int | None] = []
    for _, _, _, digest in found:
        owners.append(taken.get(digest, key if digest in seen else None) if digest else None)
        if digest:
            seen.add(digest)
    ends: dict[bytes, int] = {}  # last unit of a window's first place, which stays
    for i, j, digest in windows:
        owner, begin = taken.get(digest), i
        if owner is None:
            if digest not in ends:
                ends[digest] = j
                continue
            owner, begin = key, max(i, ends[digest] + 1)
        for k in range(begin, j + 1):
            if owners[k] is None:
                owners[k] = owner
    spans, i = [], 0
    while i < len(found):
        if owners[i] is None:
            i += 1
            continue
        j, words, gap = i, 0, 0
        for k in range(i, len(found)):
            if owners[k] is not None:
                j, words, gap = k + 1, words + found[k][2], 0
            else:
                gap += found[k][2]
                if found[k][3] is not None or gap >= MIN_RUN:
                    break
        gone = set(range(i, j))
        if words < MIN_RUN:
            gone = {k for k in gone if found[k][3] in common and owners[k] is not None}
            gone |= set(_whole_lines(text, found, owners, i, j))
        spans += [(found[k][0], found[k][1], owners[k]) for k in gone]
        i = j
    return sorted(spans, key=lambda s: s[0])


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", rank: str | None = None, removed: str = "removed") -> DataFrame:
    """``docs`` with units cut out of ``text`` and ``removed`` (or another name): array of (start, end, first).

    ``first`` is the rank of the keeping document, null if it has none of its own. ``rank``
    names an integer column, the key by default.
    """
    docs, _ = unique_key(docs, rank or key, "__doc")
    rows = docs.select("__doc", F.col(f"`{text}`").cast("string")).mapInArrow(_digests, "doc long, h1 long, h2 long")
    held = rows.groupBy("h1", "h2").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.count("*").alias("n"))
    shared = held.where("first < last").select("h1", "h2", "first", (F.col("n") >= COMMON).alias("common"))
    # the first document is told what is common, as it may repeat that itself
    lost = rows.join(shared, ["h1", "h2"]).where("doc > first OR common")
    lost = lost.groupBy("doc").agg(F.collect_list(F.struct("h1", "h2", "first", "common")).alias("__lost"))
    kept = [c for c in docs.columns if c not in (removed, "__doc")]
    joined = docs.select(*[F.col(f"`{c}`") for c in kept], "__doc").join(
        lost.withColumnRenamed("doc", "__doc"), "__doc", "left"
    )
    at = kept.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean, spans = [], []
            lists = batch.column(len(kept) + 1)
            for row, body in enumerate(batch.column(at + 1).to_pylist()):
                place = batch.column(0)[row].as_py()
                lost = [(np.array([x["h1"], x["h2"]], "<i8").tobytes(), x) for x in lists[row].as_py() or ()]
                taken = {digest: x["first"] for digest, x in lost if x["first"] < place}
                common = {digest for digest, x in lost if x["common"]}
                gone = removals(body, taken, place, common) if body else []
                parts, last = [], 0
                for a, b, _ in gone:
                    parts.append(body[last:a])
                    last = b
                clean.append("".join([*parts, body[last:]]) if gone else body)
                spans.append([{"start": a, "end": b, "first": f if f is not None and f < UNKEYED else None} for a, b, f in gone])
            columns = [batch.column(i + 1) for i in range(len(kept))]
            columns[at] = pa.array(clean, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, SPANS)], [*kept, removed])

    fields = ", ".join(
        f"`{c}` {'string' if c == text else docs.schema[c].dataType.simpleString()}" for c in kept
    )
    ordered = joined.select("__doc", *[F.col(f"`{c}`") for c in kept], "__lost")
    return ordered.mapInArrow(cut, f"{fields}, `{removed}` array<struct<start:bigint,end:bigint,first:bigint>>")
