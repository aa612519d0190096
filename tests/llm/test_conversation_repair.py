import hashlib
import random
import re
import zlib

import pytest

from barloom.llm import conversation_repair as cr
from barloom.llm.queries import op12_conversation_repair

STRUCTURE = {"": "su", "s": "u", "u": "a", "a": "u"}


def cheapest(rows):
    """(cost, edits, repaired turns) of rows (role, text) by trying everything from the back."""
    seen, faults = set(), []
    for role, text in rows:
        bare = text.strip(cr.SPACE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    after = {q: (0, "", []) if q in ("", "a") else None for q in STRUCTURE}
    for i in range(len(rows), -1, -1):
        now = dict(after)
        if i < len(rows):
            role, text = rows[i]
            now = {}
            for q in STRUCTURE:
                options = [(2 + after[q][0], "D" + after[q][1], after[q][2])] if after[q] else []
                if faults[i] not in ("blank", "duplicate"):
                    more = 5 if faults[i] == "truncated" else 0
                    made = [(0, "K", role)] + [(1, "R", r) for r in ("user", "assistant")]
                    for cost, letter, name in made:
                        if name[:1] in STRUCTURE[q] and name[:1] and after[name[:1]]:
                            c, s, t = after[name[:1]]
                            options.append((more + cost + c, letter + s, [(name, text), *t]))
                now[q] = min(options, key=lambda o: o[:2]) if options else None
        for _ in range(4):
            for q in STRUCTURE:
                for r in ("user", "assistant"):
                    if r[0] in STRUCTURE[q] and now[r[0]]:
                        c, s, t = now[r[0]]
                        option = (5 + c, "I" + s, [(r, ""), *t])
                        if now[q] is None or option[:2] < now[q][:2]:
                            now[q] = option
        after = now
    return faults, after[""]


def report(rows):
    """As the contract has it, for rows (turn, role, text) after damage, in order."""
    faults, (cost, audit, turns) = cheapest([(r, t) for _, r, t in rows])
    assert re.fullmatch(r"(s?(ua)+)?", "".join(r[0] for r, _ in turns))
    known = [n for n, _, _ in rows if n is not None]
    initials = [r[:1] for _, r, _ in rows]
    return {
        "gaps": max(known) - min(known) + 1 - len(set(known)) if known else 0,
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "cost": cost, "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest(),
    }


def in_order(rows):
    return sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.md5(x[2].encode()).digest()))


def got_of(found):
    shas = {r.conv: r.repaired_sha256 for r in cr.digests(found.turns).collect()}
    none = hashlib.sha256(b"").hexdigest()
    return {r.conv: {k: v for k, v in r.asDict().items() if k != "conv"} | {"repaired_sha256": shas.get(r.conv, none)} for r in found.report.collect()}


def random_talks(n, longest, seed):
    random.seed(seed)
    texts = ["Yes.", "No!", "cut off", "  ", "", "What?", "a. b", "x.\n"] + [f"t{i}." for i in range(20)]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "Sam", "super"]
    out = {}
    for conv in range(n):
        size = random.randint(1, longest)
        turns = random.sample([None, *range(2 * size)], size)
        out[None if conv == 0 else conv] = [(t, random.choice(roles), random.choice(texts)) for t in turns for _ in range(random.choice([1, 1, 1, 2, 3]))]
    return out


@pytest.mark.parametrize(("first", "longest"), [(1, 14), (3, 40), (64, 14)])
def test_blocks_of_any_size_as_by_trying_everything(spark, first, longest):
    talks = random_talks(25, longest, first)
    rows = [(conv, *r) for conv, rows in talks.items() for r in rows]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = got_of(cr.repair(df, first=first))
    assert got == {conv: report(in_order(rows)) for conv, rows in talks.items()}


def test_one_long_conversation_over_many_partitions(spark):
    random.seed(9)
    rows = [(1, t, random.choice(["user", "assistant", "system"]), f"text {random.randint(0, 900)}{random.choice(['.', ''])}") for t in range(2000)]
    rows += [(1, 5000, "user", "again")] * 500 + [(2, 0, "user", "Hi.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    got = got_of(cr.repair(df, first=4))
    assert got[1] == report(in_order([r[1:] for r in rows if r[0] == 1]))
    assert got[2] == report([(0, "user", "Hi.")])


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        shown = [" " if x is None else str(x) for x in (conv, turn)]
        nth = zlib.crc32(":".join(shown).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if nth == 0:
            continue
        text = "" if nth == 1 else re.sub("[.!?]", "", text) if nth == 2 else text
        out += [(turn, "user" if nth == 4 else role, text)] * (2 if nth == 3 else 1)
    return in_order(out)


def test_query_over_whole_tables(spark, sf_dir):
    talks = {}
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect():
        talks.setdefault(r.conv_id, []).append((r.conv_id, r.turn, r.role, r.text))
    got = {r.conv_id: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in op12_conversation_repair(spark, sf_dir).collect()}
    assert got == {conv: report(damaged(rows)) for conv, rows in talks.items()}


def test_edge_rows(spark, tmp_path):
    long = "word " * 300_000 + "end."
    rows = [(None, None, None, None), (None, 1, "user", "x."), (4, 2, None, "Hm."), (4, -(1 << 63), "user", long), (4, (1 << 63) - 1, "assistant", "")]
    rows += [(7, t, "user", "same.") for t in range(30)] + [(8, None, "assistant", "a."), (8, None, "assistant", "a.")]
    rows += [(c, 0, "user", "Only.") for c in range(100, 160)]
    path = str(tmp_path / "conversations.parquet")
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, place string, digest string")
    df.write.parquet(path)
    got = {r.conv_id: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in op12_conversation_repair(spark, str(tmp_path)).collect()}
    want = {}
    for conv in {r[0] for r in rows}:
        kept = damaged([r for r in rows if r[0] == conv])
        want[conv] = report(kept)
        want[conv]["gaps"] = min(want[conv]["gaps"], cr.MOST)
    assert got == want
    assert any(not damaged([r for r in rows if r[0] == c]) for c in want)  # a conversation without rows after damage
    none = cr.repair(df.where("false"))
    assert none.report.count() == 0 and none.turns.count() == 0


def test_turns_hold_the_texts(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hello."), (1, 1, "user", "No, you."), (1, 2, "assistant", "Bye.")], "conv_id long, turn long, role string, text string")
    turns = [(r.role, r.text) for r in cr.repair(df).turns.orderBy("place").collect()]
    assert turns == cheapest([("user", "Hello."), ("user", "No, you."), ("assistant", "Bye.")])[1][2]
