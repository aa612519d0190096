"""Chat formatting in windows of a token budget.

The turns of a conversation become windows of text. Prefix sums of the turns' tokens choose
spans that start and end with a turn. A window opens with the conversation's system turn (its
first turn, if it has that role), then repeats the last turns before the span as far as a history
budget allows, then holds the span. Only the assistant texts of the span carry loss; what is
repeated is masked, so every assistant text is learned once.

A conversation may be longer than a task: its prefix sums are taken in blocks of turns and it is cut at
fixed token counts into sections that are windowed independently; the last turns before a section
travel with it. A turn beyond the budget gets a window of its own, longer than the budget.

Texts and roles that are null count as empty. Turns are ordered by turn, role and text, nulls
first; repeated rows are turns of their own. A null conv_id is a conversation like others.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import in_batches, in_groups
from barloom.llm.spm_bpe import codec_factory

START, END = "<|im_start|>", "<|im_end|>"
#: Tokens a window may have, those of repeated history among them, and what marking a turn costs.
BUDGET, HISTORY, PER_TURN = 1024, 256, 4
#: A section has so many budgets, a block of prefix sums so many turn numbers.
SECTION, BLOCK = 64, 64
NO_ID = -(1 << 63)
LOSS = "array<struct<start:int,end:int>>"


def escape(text: str) -> str:
    """No ``<|`` is left: each ``<``, backslashes, ``|`` gets one backslash more."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text) if "<" in text else text


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text) if "<\\" in text else text


def escape_role(role: str) -> str:
    return role.replace("\\", "\\\\").replace("\n", "\\n").replace("|", "\\p")


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: {"n": "\n", "p": "|"}.get(m[1], m[1]), role)


TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.S)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) pairs of a window; what does not read back completely is an error."""
    found, at = [], 0
    for m in TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"not a turn at {at}")
        found.append((unescape_role(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"not a turn at {at}")
    return found


def spans(lengths: np.ndarray, first: int, system: int, budget: int, history: int) -> Iterator[tuple[int, int, int]]:
    """(history from, span from, span to) over turns of given lengths; those before ``first`` are history only."""
    ends = np.concatenate([[0], np.cumsum(lengths)])
    at, n = first, len(lengths)
    while at < n:
        room = budget - system
        kept = max(0, min(history, room - int(lengths[at])))
        back = int(np.searchsorted(ends, ends[at] - kept, "left"))
        room -= int(ends[at] - ends[back])
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + room, "right")) - 1)
        yield back, at, to
        at = to


def with_positions(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """Adds pos and start: turns and tokens before this one in its conversation, and ``total`` tokens."""
    placed = turns.withColumn("block", F.floor(F.coalesce(F.col("turn"), F.lit(NO_ID)) / block))
    blocks = placed.groupBy("conv", "block").agg(F.sum("tokens").alias("t"), F.count("*").alias("c"))
    over = Window.partitionBy("conv").orderBy("block")
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        "conv",
        "block",
        F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t0"),
        F.coalesce(F.sum("c").over(before), F.lit(0)).alias("c0"),
        F.sum("t").over(Window.partitionBy("conv")).alias("total"),
    )
    inside = Window.partitionBy("conv", "block").orderBy("turn", "role", "text")
    sums = inside.rowsBetween(Window.unboundedPreceding, 0)
    local = placed.withColumns(
        {"t1": F.sum("tokens").over(sums) - F.col("tokens"), "c1": F.row_number().over(inside) - 1}
    )
    return local.join(offsets, ["conv", "block"]).select(
        "conv", "role", "text", "tokens", (F.col("c0") + F.col("c1")).alias("pos"), (F.col("t0") + F.col("t1")).alias("start"), "total"
    )


def windows(
    conversations: DataFrame, vocabulary: str, pattern: str, budget: int = BUDGET, history: int = HISTORY, section: int = SECTION
) -> DataFrame:
    """conv_id, first (position of the span's first turn), n_turns, n_repeated, tokens, text, loss (spans in text)."""
    if not 0 <= history <= budget:
        raise ValueError("the history is part of the budget")
    factory = codec_factory(vocabulary, pattern)

    def count(batch: pa.RecordBatch, codec) -> pa.RecordBatch:
        roles, texts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        n = [PER_TURN + len(codec.encode(r)) // 4 + len(codec.encode(t)) // 4 for r, t in zip(roles, texts)]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64())], ["conv", "turn", "role", "text", "tokens"])

    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("conv"),
        F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit("")),
        F.coalesce(F.col("text").cast("string"), F.lit("")),
    )
    counted = in_batches(rows, "conv long, turn long, role string, text string, tokens long", count, factory)
    size = section * budget
    placed = with_positions(counted)
    end, at = F.col("start") + F.col("tokens"), F.floor(F.col("start") / size)
    edge = (at + 1) * size
    to = F.when((end >= edge) & (F.col("tokens") <= history), F.floor(end / size)).when(
        (end < edge) & (F.col("start") >= edge - history), at + 1
    )
    system = (F.col("pos") == 0) & (F.col("role") == "system")
    copies = F.when(system, F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.floor(F.col("total") / size))), lambda s: F.struct(s.alias("section"), F.lit(0).alias("kind"))))
    copies = F.coalesce(F.when(F.col("total") >= size, copies), F.array().cast("array<struct<section:bigint,kind:int>>"))
    halo = F.when(to.isNotNull() & ~system, F.array(F.struct(to.alias("section"), F.lit(1).alias("kind")))).otherwise(
        F.array().cast("array<struct<section:bigint,kind:int>>")
    )
    own = F.array(F.struct(at.alias("section"), F.lit(2).alias("kind")))
    dealt = placed.select("conv", "role", "text", "tokens", "pos", F.explode(F.concat(own, copies, halo)).alias("at")).select(
        "conv", "at.section", "at.kind", "pos", "role", "text", "tokens"
    )

    def format_section(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        kinds = rows.column("kind").to_numpy()
        if not (kinds == 2).any():
            return
        roles, texts = rows.column("role").to_pylist(), rows.column("text").to_pylist()
        pos, tokens = rows.column("pos").to_numpy(), rows.column("tokens").to_numpy()
        marked = [f"{START}{escape_role(r)}\n" for r in roles]
        bodies = [escape(t) for t in texts]
        lead = roles[0] == "system" and pos[0] == 0  # its own section's or a copy
        skip = int(lead)
        own_first = int(np.argmax(kinds[skip:] == 2)) if (kinds[skip:] == 2).any() else None
        out: list[list] = [[] for _ in range(6)]

        def emit(first: int, repeated: list[int], new: list[int]) -> None:
            parts, loss, at = [], [], 0
            for i in repeated:
                parts += [marked[i], bodies[i], END, "\n"]
            at = sum(map(len, parts))
            for i in new:
                begin = at + len(marked[i])
                if roles[i] == "assistant":
                    loss.append({"start": begin, "end": begin + len(bodies[i])})
                parts += [marked[i], bodies[i], END, "\n"]
                at = begin + len(bodies[i]) + len(END) + 1
            used = int(tokens[repeated].sum() + tokens[new].sum())
            for column, value in zip(out, (first, len(new), len(repeated), used, "".join(parts), loss)):
                column.append(value)

        system_new = lead and kinds[0] == 2
        if own_first is None:
            emit(0, [], [0])
        else:
            for back, a, b in spans(tokens[skip:], own_first, int(tokens[0]) if lead else 0, budget, history):
                head = [0] if lead else []
                if system_new and a == own_first:
                    emit(0, [], [0, *range(skip + a, skip + b)])
                else:
                    emit(int(pos[skip + a]), head + list(range(skip + back, skip + a)), list(range(skip + a, skip + b)))
        conv = rows.column("conv")[0].as_py()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([None if conv == NO_ID else conv] * len(out[0]), pa.int64()),
                *[pa.array(c, pa.int64()) for c in out[:4]],
                pa.array(out[4], pa.string()),
                pa.array(out[5], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            ],
            ["conv_id", "first", "n_turns", "n_repeated", "tokens", "text", "loss"],
        )

    schema = f"conv_id long, first long, n_turns long, n_repeated long, tokens long, text string, loss {LOSS}"
    return in_groups(dealt, ["conv", "section"], ["kind", "pos"], schema, format_section)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, read from its windows in order: a conversation streams through its task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, sums = None, None
        done: list[tuple] = []
        for batch in batches:
            for row in batch.to_pylist():
                if sums is None or row["conv"] != conv:
                    if sums:
                        done.append(close(conv, sums))
                    conv, sums = row["conv"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                turns = read_turns(row["text"])[row["n_repeated"] :]
                sums[0] += len(turns)
                for role, text in turns:
                    sums[1].update(f"{role}\n{text}\n".encode())
                for span in row["loss"]:
                    text = unescape(row["text"][span["start"] : span["end"]])
                    sums[2] += len(text)
                    sums[3].update(text.encode())
                sums[4] += len(row["text"])
            if len(done) > 1000:
                yield as_batch(done)
                done = []
        if sums:
            done.append(close(conv, sums))
        yield as_batch(done)

    def close(conv, s):
        return None if conv == NO_ID else conv, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4]

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def as_batch(rows):
        columns = zip(*rows) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    rows = formatted.select(F.coalesce("conv_id", F.lit(NO_ID)).alias("conv"), "first", "n_repeated", "text", "loss")
    return rows.repartition("conv").sortWithinPartitions("conv", "first").mapInArrow(run, schema)
