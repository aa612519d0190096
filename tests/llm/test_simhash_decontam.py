import random
from collections import Counter
from math import log1p

from pyspark.sql import functions as F

from barloom.llm import simhash_decontam as S
from barloom.llm.common import table
from barloom.llm.queries import op9_simhash_decontam


def words(text):
    return "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()


def shingled(ws):
    return Counter(" ".join(ws[i : i + 5]) for i in range(len(ws) - 4))


def best(texts, items):
    """(key, item): the best weighted similarity of any window as long as the item, by trying all of them."""
    own = {k: shingled(words(t)) for k, t in items.items() if len(words(t)) >= 5}
    held = Counter(s for c in own.values() for s in c)
    weight = lambda s: log1p(len(own) / max(1, held[s]))
    out = {}
    for key, text in texts.items():
        ws = words(text)
        for item, c in own.items():
            n = len(words(items[item]))
            for at in range(-n + 5, len(ws) - 4):
                w = shingled(ws[max(at, 0) : at + n])
                if w & c:
                    top = sum(min(w[s], c[s]) * weight(s) for s in w & c)
                    out[key, item] = max(out.get((key, item), 0), top / sum(max(w[s], c[s]) * weight(s) for s in w | c))
    return out


def test_query_finds_every_verbatim_item(spark, sf_dir):
    docs = {r.doc_id: " ".join(words(r.text)) for r in table(spark, sf_dir, "documents").collect()}
    items = {r.item_id: " ".join(words(r.text)) for r in table(spark, sf_dir, "benchmark").collect()}
    want = {(d, i) for d, t in docs.items() for i, x in items.items() if f" {x} " in f" {t} "}
    got = {(r.doc_id, r.item_id): r.similarity for r in op9_simhash_decontam(spark, sf_dir).collect()}
    assert want and want <= set(got) and all(got[p] > 1 - 1e-9 for p in want)


def test_against_all_windows(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    items = {i: " ".join(rng.choices(vocabulary, k=rng.randint(8, 60))) for i in range(25)}
    items |= {90: "too short", 91: "", 92: None}
    texts = {}
    for k in range(60):
        part = words(items[rng.randrange(25)])
        for _ in range(rng.randint(0, 2)):
            part[rng.randrange(len(part))] = rng.choice(vocabulary)
        if rng.random() < 0.3:
            part.insert(rng.randrange(len(part)), "more")
        texts[k] = " ".join(rng.choices(vocabulary, k=rng.randint(0, 50)) + part + rng.choices(vocabulary, k=rng.randint(0, 50)))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    want = {p: s for p, s in best(texts, items).items() if s >= 0.8}
    got = {(r.doc_id, r.item_id): r.similarity for r in S.matches(docs, bench, radius=24).collect()}
    assert len(want) > 10 and set(got) <= set(want)
    assert len(set(want) - set(got)) <= len(want) // 20  # fingerprints further apart than the radius
    assert all(abs(got[p] - want[p]) < 0.2 and got[p] <= want[p] + 1e-9 for p in got)


def test_blocks_share_out_the_bits(spark):
    rng = random.Random(2)
    pairs = []
    for _ in range(300):
        a, b = rng.getrandbits(64), 0
        for bit in rng.sample(range(64), rng.randint(0, 14)):
            b |= 1 << bit
        pairs.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, a ^ b)))
    df = spark.createDataFrame(pairs, "a long, b long").select(S.blocks(F.col("a"), 14).alias("a"), S.blocks(F.col("b"), 14).alias("b"))
    assert df.where(~F.arrays_overlap("a", "b")).count() == 0 and df.where(F.size("a") != 15).count() == 0


def test_the_shuffled_form_gives_the_same(spark, sf_dir, monkeypatch):
    docs, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    was = {tuple(r) for r in S.matches(docs, bench).collect()}
    monkeypatch.setattr(S, "BROADCAST_ROWS", 0)
    assert {tuple(r) for r in S.matches(docs, bench).collect()} == was


def test_edges(spark, edge_docs, no_docs):
    bench = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog"), (1, "quick brown fox jumps over the lazy dog"), (2, None), (3, ""), (4, "word1 and more word2 and more word3 and more")], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in S.matches(edge_docs, bench).collect()}
    assert found == {(1, 1), (4, 4), (5, 4)}
    assert S.matches(no_docs, bench).count() == 0 and S.matches(edge_docs, bench.where("false")).count() == 0
    kept = S.drop_contaminated(edge_docs, bench)
    assert kept.columns == edge_docs.columns and {r.doc_id for r in kept.collect()} == {2, 3, 6, 7, None}


def test_no_python_on_the_way(spark, sf_dir):
    plan = op9_simhash_decontam(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_all_pairs_at_the_registered_parameters(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = {i: " ".join(rng.choices(vocabulary, k=rng.randint(40, 90))) for i in range(12)}
    texts = {}
    for k in range(60):
        part = words(items[k % 12])
        for _ in range(rng.randint(1, 3)):
            at, kind = rng.randrange(len(part)), rng.randrange(3)
            part[at : at + (kind < 2)] = [rng.choice(vocabulary)] * (kind != 1)
        texts[k] = " ".join(rng.choices(vocabulary, k=9) + part + rng.choices(vocabulary, k=9))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    want = {p: s for p, s in best(texts, items).items() if s >= 0.8}
    got = {(r.doc_id, r.item_id): r.similarity for r in S.matches(docs, bench).collect()}
    assert sum(s < 0.85 for s in want.values()) > 4 and set(got) == set(want)
    assert all(abs(got[p] - want[p]) < 1e-9 for p in got)


def test_rows_of_one_key_are_judged_by_their_texts(spark, monkeypatch):
    item = "quick brown fox jumps over the lazy dog"
    rows = [(None, f"The {item} today."), (None, "Clean words without any of that in them."), (1, f"{item} again"), (1, "Also clean words and nothing more here."), (None, None)]
    rows += [(2, f"a {item}"), (2, "b one two three four five six seven eight")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, "one two three four five six seven eight")], "item_id long, text string")
    for limit in (S.BROADCAST_ROWS, 0):
        monkeypatch.setattr(S, "BROADCAST_ROWS", limit)
        kept = sorted(map(str, S.drop_contaminated(docs, bench).collect()))
        assert kept == sorted(str(r) for r in docs.collect() if r.text is None or "lean" in r.text)
        assert {(r.doc_id, r.item_id) for r in S.matches(docs, bench).collect()} == {(None, 1), (1, 1), (2, 1), (2, 2)}


def test_no_plan_holds_the_sums_by_bit_twice(spark, sf_dir, monkeypatch, capsys):
    """The driver keeps and prints every plan; one with four copies of the sums took 276,000 characters."""
    plans, write = [], S.stored

    def plan(df):
        capsys.readouterr()
        df.explain()
        plans.append(capsys.readouterr().out)

    def stored(df, purpose):
        plan(df)
        return write(df, purpose)

    monkeypatch.setattr(S, "stored", stored)
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    plan(S.matches(docs, benchmark))
    plan(S.drop_contaminated(docs, benchmark))
    assert len(plans) > 10 and max(map(len, plans)) < 60_000
    assert all(p.count("partial_sum(CASE WHEN") <= 64 for p in plans)
