"""Repair of conversations by cheapest edits: a dynamic programme that keeps cost vectors at checkpoints only.

A conversation is right if the initials of its roles read ``(s?(ua)+)?``. Its rows are taken by turn (nulls first),
within a turn by role and then by the MD5 of the text. A row's first fault counts: blank (nothing but white
space), duplicate (role and text were there before), truncated (the last character that is no white space is not
one of ``.!?``). Keep costs 0, Rerole to user or assistant 1, Delete 2, Insert of an empty user or assistant turn 5;
blank rows and duplicates must go, and a truncated row that stays costs 5 more. Of the cheapest edits those whose
initials come first in ASCII are taken.

The states are what the last turn was (nothing, system, user, assistant). The rows of a conversation are cut into blocks
whose sizes grow by one from ``FIRST``, so that n rows make blocks of at most about the root of 2n rows, and as many. What a
block costs from each state to each state is a 4 x 4 matrix; the matrices of a conversation are run through
backwards, and the vector of costs at the end of each block is its checkpoint. From it a block's own vectors are computed
again and the block is walked forward, from each state it may be entered in; at last the walks are chained. So blocks
are worked on wherever Spark puts them, and of one conversation only a matrix, a checkpoint and the letters of the
edits pass through one task.

Rows alike in turn, role and text are counted before they move. The audit of a conversation has a letter
for each row and is one string. Null roles and texts count as one space, so as an unknown role and as blank; a null
conversation key is a conversation; texts may have any length; a table without rows gives no conversation. Turns are
64-bit; gaps beyond that are cut to the largest long. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import in_batches, stored

#: Rows of the first block of a conversation in a partition; each later block has one more.
FIRST = 64
SPACE = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, CUT_SHORT = 1, 2, 5, 5
#: States: nothing yet, after system, user, assistant. What an inserted or reroled turn leads to.
TURN = (2, 2, 3, 2)
#: What a kept turn of an initial leads to.
KEEP = {"s": (1, -1, -1, -1), "u": (2, 2, -1, 2), "a": (-1, -1, 3, -1), "": (-1, -1, -1, -1)}
ROLE = {2: "user", 3: "assistant"}
#: Costs of what is still to insert after the last row.
END = (0, 2 * INSERT, INSERT, 0)
NEVER = 1 << 60
LEGAL = {"su", "ua", "au"}
MOST = (1 << 63) - 1

#: Rows in order: what a row that may stay is (its initial: s, u, a or nothing, and whether it is cut short), or
#: None, and how many rows that must go follow it.
Kind = tuple[str, bool]
Entry = tuple[Kind | None, int]
Costs = tuple[int, tuple[int, ...]]


@lru_cache(maxsize=100_000)
def _before(after: tuple[int, ...], kind: Kind) -> Costs:
    """Costs before a row from those after it, as the least and what each is above it."""
    initial, short = kind
    stays = CUT_SHORT if short else 0
    costs = [min(DELETE + after[q], stays + REROLE + after[TURN[q]]) for q in range(4)]
    costs = [min(c, stays + after[KEEP[initial][q]]) if KEEP[initial][q] >= 0 else c for q, c in enumerate(costs)]
    for _ in range(3):
        costs = [min(c, INSERT + costs[TURN[q]]) for q, c in enumerate(costs)]
    least = min(costs)
    return least, tuple(c - least if c < NEVER // 2 else NEVER for c in costs)


def back(rows: list[Entry], after: tuple[int, ...]) -> list[Costs]:
    """(base, what each state costs above it) before each entry and after the last, first entry first."""
    base = min(after)
    above = tuple(c - base if c < NEVER // 2 else NEVER for c in after)
    out = [(base, above)]
    for kind, gone in reversed(rows):
        base += DELETE * gone  # nothing but Delete is open to them, and it is cheapest to do so first
        if kind is not None:
            more, above = _before(above, kind)
            base += more
        out.append((base, above))
    out.reverse()
    return out


def matrix(rows: list[Entry]) -> list[int]:
    """Cost of the rows from state q to state r at place 4 q + r."""
    out = [NEVER] * 16
    for r in range(4):
        base, above = back(rows, tuple(0 if q == r else NEVER for q in range(4)))[0]
        for q in range(4):
            if above[q] < NEVER:
                out[4 * q + r] = base + above[q]
    return out


def through(block: list[int], after: list[int]) -> list[int]:
    """Costs before a block from those after it."""
    return [min(NEVER, *(block[4 * q + r] + after[r] for r in range(4))) for q in range(4)]


def walk(rows: list[Entry], costs: list[Costs], state: int, closes: bool) -> tuple[int, str]:
    """The state after the rows and the tight edits whose initials come first; the last block closes the conversation."""
    script = []
    for i, (kind, gone) in enumerate(rows):
        (base, here), (later, after) = costs[i], costs[i + 1]
        while kind is not None:
            stays = CUT_SHORT if kind[1] else 0
            kept = KEEP[kind[0]][state]
            rest = base + here[state] - later - DELETE * gone
            if rest == DELETE + after[state]:
                script.append("D")
            elif here[state] == INSERT + here[TURN[state]]:
                script.append("I")
                state = TURN[state]
                continue
            elif kept >= 0 and rest == stays + after[kept]:
                script.append("K")
                state = kept
            else:
                script.append("R")
                state = TURN[state]
            break
        script.append("D" * gone)
    while closes and END[state]:
        script.append("I")
        state = TURN[state]
    return state, "".join(script)


@dataclass(frozen=True)
class Repair:
    """report: conv, gaps, blank, duplicate, truncated, illegal, cost, audit of every conversation with rows.

    turns: conv, place (a struct to sort by), role and text of the repaired conversations.
    """

    report: DataFrame
    turns: DataFrame


def repair(talks: DataFrame, key: str = "conv_id", first: int = FIRST) -> Repair:
    """Edits of the conversations in rows (key, turn, role, text)."""
    rows = talks.select(
        F.col(key).cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
    ).withColumn("digest", F.unhex(F.md5("text")))
    kinds = stored(_kinds(rows), "turn-kinds")
    alike = ["conv", "turn", "role", "digest"]
    placed = kinds.repartitionByRange(*alike).sortWithinPartitions(*alike).withColumn("part", F.spark_partition_id())
    blocks = stored(placed.mapInArrow(_blocks(first), BLOCK), "turn-blocks")
    matrices = in_batches(blocks.select("conv", "block", "kinds"), "conv long, block long, costs array<long>", _matrices)
    ends = matrices.repartition("conv").sortWithinPartitions("conv", F.desc("block")).mapInArrow(_checkpoints, "block long, after array<long>, closes boolean")
    ends = stored(ends, "checkpoints")
    walks = in_batches(blocks.select("conv", "block", "kinds", "opens", "facts").join(ends, "block").select(*WALKED), WALK, _walks)
    walks = walks.repartition("conv").sortWithinPartitions("conv", "block").mapInArrow(_chained, CHAINED)
    walks = stored(walks, "edits")
    report = walks.where("block IS NULL").select("conv", "report.*")
    edits = blocks.join(walks.where("block IS NOT NULL").select("block", "state", "script"), "block")
    edits = in_batches(edits.select("conv", "block", "kinds", "turns", "roles", "digests", "state", "script"), EDIT, _edits)
    texts = rows.groupBy(*alike).agg(F.first("text").alias("text"))
    return Repair(report, _with_texts(stored(edits, "repaired-turns"), texts))


def _kinds(rows: DataFrame) -> DataFrame:
    """One row for all rows alike: how many, blank, truncated, and whether one of them is the first of its role and text."""
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    marked = rows.select(
        "conv", "turn", "role", "digest",
        (bare == "").alias("blank"),
        (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("short"),
    )
    alike = ["conv", "turn", "role", "digest"]
    counted = marked.groupBy(*alike).agg(F.count("*").alias("copies"), F.bool_or("blank").alias("blank"), F.bool_or("short").alias("short"))
    earliest = counted.groupBy("conv", "role", "digest").agg(F.min("turn").alias("low"), F.bool_or(F.col("turn").isNull()).alias("none"))
    earliest = earliest.select(
        "conv", F.when(~F.col("none"), F.col("low")).alias("turn"), "role", "digest",
        F.lit(0).cast("long").alias("copies"), F.lit(False).alias("blank"), F.lit(False).alias("short"), F.lit(True).alias("first"),
    )
    both = counted.withColumn("first", F.lit(False)).unionByName(earliest)
    return both.groupBy(*alike).agg(
        F.sum("copies").alias("copies"), *[F.bool_or(c).alias(c) for c in ("blank", "short", "first")]
    )


FACTS = "struct<blank:bigint,duplicate:bigint,truncated:bigint,illegal:bigint,first_initial:string,last_initial:string,low:bigint,high:bigint,turns:bigint>"
BLOCK = (
    f"conv long, block long, opens boolean, kinds array<string>, turns array<bigint>, roles array<string>, "
    f"digests array<binary>, facts {FACTS}"
)
WALKED = ["conv", "block", "kinds", "opens", "facts", "after", "closes"]
WALK = f"conv long, block long, facts {FACTS}, cost array<bigint>, exits array<int>, scripts array<string>"
REPORT = "struct<gaps:bigint,blank:bigint,duplicate:bigint,truncated:bigint,illegal:bigint,cost:bigint,audit:string>"
CHAINED = f"conv long, block long, state int, script string, report {REPORT}"
EDIT = "conv long, block long, seq int, role string, turn long, was string, digest binary"
_INT, _STR = pa.int64(), pa.string()
_FACTS = pa.struct(
    [("blank", _INT), ("duplicate", _INT), ("truncated", _INT), ("illegal", _INT), ("first_initial", _STR), ("last_initial", _STR), ("low", _INT), ("high", _INT), ("turns", _INT)]
)
_BLOCK = pa.schema(
    [("conv", _INT), ("block", _INT), ("opens", pa.bool_()), ("kinds", pa.list_(_STR)), ("turns", pa.list_(_INT)),
     ("roles", pa.list_(_STR)), ("digests", pa.list_(pa.binary())), ("facts", _FACTS)]
)
_WALK = pa.schema(
    [("conv", _INT), ("block", _INT), ("facts", _FACTS), ("cost", pa.list_(_INT)), ("exits", pa.list_(pa.int32())), ("scripts", pa.list_(_STR))]
)
_REPORT = pa.struct([(c, _INT) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", _STR)])
_CHAINED = pa.schema([("conv", _INT), ("block", _INT), ("state", pa.int32()), ("script", _STR), ("report", _REPORT)])
_EDIT = pa.schema(
    [("conv", _INT), ("block", _INT), ("seq", pa.int32()), ("role", _STR), ("turn", _INT), ("was", _STR), ("digest", pa.binary())]
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


#: A kind as a letter and back: its initial, a capital if it is cut short.
_LETTERS = {("s", False): "s", ("u", False): "u", ("a", False): "a", ("", False): "o", ("s", True): "S", ("u", True): "U", ("a", True): "A", ("", True): "O"}
_KINDS = {v: k for k, v in _LETTERS.items()}


def _read(packed: list[str]) -> list[Entry]:
    """Entries from their packed form: the letter of a kind, if any, and how many rows that must go follow."""
    return [(_KINDS[x[0]], int(x[1:])) if x[0] in _KINDS else (None, int(x)) for x in packed]


def _blocks(first: int):
    """Cut the rows of a sorted partition into blocks of growing size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        opens, room, number, conv = False, first, 0, None
        started = False

        def close() -> tuple:
            nonlocal number
            block = (held[0]["part"] << 33) + number
            number += 1
            return conv, block, opens, *_packed(held)

        for batch in batches:
            done = []
            for row in batch.to_pylist():
                fresh = started and row["conv"] != conv
                if held and (fresh or len(held) == room):
                    done.append(close())
                    held, opens, room = [], False, room + 1
                if not started or fresh:
                    opens, room = started, first  # the first conversation of a partition may go on from the one before
                started, conv = True, row["conv"]
                held.append(row)
            yield _batch(done, _BLOCK)
        if held:
            yield _batch([close()], _BLOCK)

    return run


def _packed(rows: list[dict]) -> tuple:
    """kinds, turns, roles, digests and facts of a block."""
    kinds, blank, duplicate, truncated, illegal, distinct = [], 0, 0, 0, 0, 0
    last_initial = last_turn = low = None
    for r in rows:
        initial, copies = r["role"][:1], r["copies"]
        stays = r["first"] and not r["blank"]
        kinds.append(_LETTERS[initial if initial in ("s", "u", "a") else "", r["short"]] + str(copies - 1) if stays else str(copies))
        blank += copies * r["blank"]
        duplicate += 0 if r["blank"] else copies - r["first"]
        truncated += stays and r["short"]
        illegal += copies - 1 + (last_initial is not None and last_initial + initial not in LEGAL)
        last_initial = initial
        if r["turn"] is not None:
            distinct += r["turn"] != last_turn
            last_turn = r["turn"]
            low = last_turn if low is None else low
    facts = {
        "blank": blank, "duplicate": duplicate, "truncated": truncated, "illegal": illegal, "first_initial": rows[0]["role"][:1],
        "last_initial": last_initial, "low": low, "high": last_turn, "turns": distinct,
    }
    return kinds, [r["turn"] for r in rows], [r["role"] for r in rows], [r["digest"] for r in rows], facts


def _matrices(batch: pa.RecordBatch) -> pa.RecordBatch:
    costs = [matrix(_read(k)) for k in batch.column(2).to_pylist()]
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(costs, pa.list_(_INT))], ["conv", "block", "costs"])


def _checkpoints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs after each block, from rows sorted by conversation, last block first."""
    last: object = _checkpoints  # no key yet
    after: list[int] = []
    for batch in batches:
        out = []
        for conv, block, costs in zip(*(c.to_pylist() for c in batch.columns)):
            closes = conv != last
            if closes:
                after, last = list(END), conv
            out.append((block, after, closes))
            after = through(costs, after)
        yield _batch(out, pa.schema([("block", _INT), ("after", pa.list_(_INT)), ("closes", pa.bool_())]))


def _walks(batch: pa.RecordBatch) -> pa.RecordBatch:
    """What each block costs, where it leads and by which edits, from each state it may be entered in."""
    out = []
    for conv, block, letters, opens, facts, after, closes in zip(*(c.to_pylist() for c in batch.columns)):
        rows = _read(letters)
        costs = back(rows, tuple(after))
        base, above = costs[0]
        found = [
            walk(rows, costs, q, closes) if above[q] < NEVER and (q == 0 or not opens) else (-1, "") for q in range(4)
        ]
        out.append((conv, block, facts, [base + c for c in above], [q for q, _ in found], [s for _, s in found]))
    return _batch(out, _WALK)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits by block and, once it has ended, the report of each conversation (its row has no block)."""
    last: object = _chained  # no key yet
    state, sums, audit, ends = 0, {}, [], {}

    def report() -> tuple:
        gaps = ends["high"] - ends["low"] + 1 - sums["turns"] if ends["low"] is not None else 0
        told = {k: v for k, v in sums.items() if k != "turns"}
        return last, None, None, None, {"gaps": min(gaps, MOST), **told, "audit": "".join(audit)}

    for batch in batches:
        out = []
        for conv, block, facts, cost, exits, scripts in zip(*(c.to_pylist() for c in batch.columns)):
            if conv != last:
                if last is not _chained:
                    out.append(report())
                last, state, audit = conv, 0, []
                sums = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": cost[0], "turns": 0}
                ends = {"low": None, "high": None, "initial": None}
            for name in ("blank", "duplicate", "truncated", "illegal", "turns"):
                sums[name] += facts[name]
            if ends["initial"] is not None and ends["initial"] + facts["first_initial"] not in LEGAL:
                sums["illegal"] += 1
            ends["initial"] = facts["last_initial"]
            if facts["low"] is not None:
                sums["turns"] -= facts["low"] == ends["high"]
                ends["low"] = facts["low"] if ends["low"] is None else ends["low"]
                ends["high"] = facts["high"]
            out.append((conv, block, state, scripts[state], None))
            audit.append(scripts[state])
            state = exits[state]
        yield _batch(out, _CHAINED)
    if last is not _chained:
        yield _batch([report()], _CHAINED)


def _edits(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The turns that the edits leave, in order; an inserted one has no digest."""
    out = []
    for conv, block, packed, turns, roles, digests, state, script in zip(*(c.to_pylist() for c in batch.columns)):
        at = seq = 0
        for (kind, gone), turn, role, digest in zip(_read(packed), turns, roles, digests):
            while kind is not None:
                edit = script[at]
                at += 1
                if edit != "D":
                    state = KEEP[kind[0]][state] if edit == "K" else TURN[state]
                    if edit == "I":
                        out.append((conv, block, seq, ROLE[state], None, None, None))
                    else:
                        out.append((conv, block, seq, role if edit == "K" else ROLE[state], turn, role, digest))
                    seq += 1
                if edit != "I":
                    break
            at += gone
        for _ in script[at:]:
            state = TURN[state]
            out.append((conv, block, seq, ROLE[state], None, None, None))
            seq += 1
    return _batch(out, _EDIT)


def _with_texts(edits: DataFrame, texts: DataFrame) -> DataFrame:
    """conv, place, role and text; texts: conv, turn, role, digest, text, each once."""
    known = edits.where("digest IS NOT NULL").join(
        texts.withColumnsRenamed({"conv": "k_conv", "turn": "k_turn", "role": "k_role", "digest": "k_digest"}),
        F.col("conv").eqNullSafe(F.col("k_conv")) & F.col("turn").eqNullSafe(F.col("k_turn"))
        & (F.col("was") == F.col("k_role")) & (F.col("digest") == F.col("k_digest")),
    )
    place = F.struct("block", "seq").alias("place")
    empty = edits.where("digest IS NULL").select("conv", place, "role", F.lit("").alias("text"))
    return known.select("conv", place, "role", "text").unionByName(empty)


def damage(talks: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with planted faults, by the checksum of ``conv_id:turn``."""
    told = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    nth = F.crc32(F.concat(told[0], F.lit(":"), told[1])) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    times = F.when(F.col("nth") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        talks.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), nth.alias("nth"))
        .where("nth <> 0")
        .withColumn("time", F.explode(times))
        .select(
            "conv_id", "turn",
            F.when(F.col("nth") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("nth") == 1, "").when(F.col("nth") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        )
    )


def digests(turns: DataFrame) -> DataFrame:
    """conv and repaired_sha256 (lowercase hex of ``role:text``, newline-joined) of repaired turns.

    The turns of a conversation stream through one task, as one digest covers them all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: object = run  # no key yet
        held = None
        schema = pa.schema([("conv", _INT), ("repaired_sha256", _STR)])
        for batch in batches:
            out = []
            for conv, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if conv != last:
                    if held is not None:
                        out.append((last, held.hexdigest()))
                    last, held = conv, hashlib.sha256()
                else:
                    held.update(b"\n")
                held.update(f"{role}:{text}".encode())
            yield _batch(out, schema)
        if held is not None:
            yield _batch([(last, held.hexdigest())], schema)

    placed = turns.repartition("conv").sortWithinPartitions("conv", "place").select("conv", "role", "text")
    return placed.mapInArrow(run, "conv long, repaired_sha256 string")
