"""Keeping a versioned table small: expired dates go, old ones are packed once, new ones when their folders pile up."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import types as T

from barloom.operators.retention import COLD_AFTER_DAYS, EXPIRE_AFTER_DAYS
from barloom.sinks.versions import Folder, Version, VersionedTable

#: Writes of packed cold dates are named so; it is how they are known.
COLD = "cold-"
#: A hot date is packed once it has more folders than this.
MOST_FOLDERS = 8


@dataclass(frozen=True)
class Plan:
    """Dates to drop, to pack as cold and to pack as they are."""

    expired: tuple[str, ...]
    cold: tuple[str, ...]
    crowded: tuple[str, ...]


def tier(day: str, as_of: date, cold_after: int = COLD_AFTER_DAYS, expire_after: int = EXPIRE_AFTER_DAYS) -> str:
    age = (as_of - date.fromisoformat(day)).days
    return "expired" if age >= expire_after else "cold" if age >= cold_after else "hot"


def plan(
    version: Version,
    as_of: date,
    cold_after: int = COLD_AFTER_DAYS,
    expire_after: int = EXPIRE_AFTER_DAYS,
    most_folders: int = MOST_FOLDERS,
) -> Plan:
    """What is to be done, from the list of folders alone."""
    held: dict[str, list[Folder]] = {}
    for folder in version.folders:
        held.setdefault(folder.date, []).append(folder)
    tiers = {d: tier(d, as_of, cold_after, expire_after) for d in held}
    packed = {d for d, fs in held.items() if len(fs) == 1 and fs[0].write.startswith(COLD)}
    return Plan(
        tuple(sorted(d for d, t in tiers.items() if t == "expired")),
        tuple(sorted(d for d, t in tiers.items() if t == "cold" and d not in packed)),
        tuple(sorted(d for d, t in tiers.items() if t == "hot" and len(held[d]) > most_folders)),
    )


def apply_retention(
    table: VersionedTable,
    schema: T.StructType,
    as_of: date,
    *,
    sort_by: tuple[str, ...] = ("symbol",),
    cold_after: int = COLD_AFTER_DAYS,
    expire_after: int = EXPIRE_AFTER_DAYS,
    most_folders: int = MOST_FOLDERS,
) -> Plan:
    """Drop, pack and publish in one version; the files themselves go with ``vacuum``.

    Cold dates are sorted and compressed harder. A date that was packed before and has got nothing since is left
    alone, so a run costs what has changed. Late bars of a cold date are packed with it by the next run.
    """
    base = table.current()
    todo = plan(base, as_of, cold_after, expire_after, most_folders)
    gone = base.on([*todo.expired, *todo.cold, *todo.crowded])
    if not gone:
        return todo
    added = []
    for dates, prefix, codec in ((todo.cold, COLD, "zstd"), (todo.crowded, "", "snappy")):
        if dates:
            rows = table.read(schema, base.on(dates)).drop("write")
            added += table.add(rows, sort_by, prefix=prefix, codec=codec)
    table.commit(base, added, gone)
    return todo
