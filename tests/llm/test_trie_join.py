import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import trie_join as T
from barloom.llm.common import table
from barloom.llm.components import components
from barloom.llm.queries import op4_trie_join


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))) if words else frozenset()


def plain(texts, width, percent):
    sets = {k: shingles(t, width) for k, t in texts.items()}
    links, keys = [], sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    links.append((a, b))
    found = roots(keys, links)
    return {k: (len(sets[k]), found[k]) for k in keys}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_walks_against_all_pairs(percent):
    rng = random.Random(percent)
    cells = np.random.default_rng(0).integers(0, 50, T.CELLS)
    for _ in range(60):
        base = [rng.getrandbits(64) for _ in range(rng.randint(1, 200))]
        own = set()
        for _ in range(rng.randint(2, 14)):
            s = set(base) - set(rng.sample(base, rng.randint(0, len(base) // rng.choice([3, 10, 20]))))
            own.add(frozenset(s | {rng.getrandbits(64) for _ in range(rng.randint(1, 1 + len(base) // 20))}))
        own = sorted(own, key=sorted)
        pairs = [(a, b) for a in range(len(own)) for b in range(a) if 100 * len(own[a] & own[b]) >= percent * len(own[a] | own[b])]
        labels = np.arange(len(own))
        found = T.join_group([np.array(sorted(s), np.uint64) for s in own], labels, cells, percent)
        assert set(found) <= {p for a, b in pairs for p in ((a, b), (b, a))}
        assert roots(labels.tolist(), found) == roots(labels.tolist(), pairs)
        half = len(own) // 2
        if half:
            across = [p for p in pairs if (p[0] < half) != (p[1] < half)]
            found = T.join_group([np.array(sorted(s), np.uint64) for s in own], labels, cells, percent, half)
            assert roots(labels.tolist(), found) == roots(labels.tolist(), across)


def test_query_against_all_pairs(spark, sf_dir):
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    assert got(op4_trie_join(spark, sf_dir)) == plain(texts, 3, 90)


@pytest.mark.parametrize("block, width, percent", [(4, 3, 80), (8, 3, 80), (1500, 5, 80)])
def test_families_of_near_copies(spark, monkeypatch, block, width, percent):
    monkeypatch.setattr(T, "BLOCK", block)
    monkeypatch.setattr(T, "BLOCKS", 16 if block > 4 else 1)
    rng = random.Random(block)
    texts, key = {}, 0
    for family in range(4):
        base = [f"w{family}x{rng.randint(0, 500)}" for _ in range(60)]
        for _ in range(25):
            words = list(base)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = f"edit{rng.randint(0, 30)}"
            texts[key] = " ".join(words[: len(words) - rng.randint(0, 2)])
            key += 1
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    assert got(T.groups(docs, width, percent)) == plain(texts, width, percent)


def test_edges(spark, edge_docs, no_docs):
    found = {(r.doc_id, r.n_shingles, r.component_id) for r in T.groups(edge_docs, 5, 80).collect()}
    n = len(shingles(edge_docs.where("doc_id = 4").first().text, 5))
    assert found == {(1, 10, 1), (2, 0, 2), (3, 0, 3), (4, n, 4), (5, n, 4), (6, 0, 6), (7, 1, 7), (None, 8, None)}
    assert T.groups(edge_docs, 5, 80).count() == edge_docs.count()
    assert T.groups(no_docs, 5, 80).count() == 0


def test_short_texts_are_one_shingle(spark):
    docs = spark.createDataFrame([(1, "A b"), (2, "a  B"), (3, "a"), (4, "b a"), (5, "A")], "doc_id long, text string")
    assert got(T.groups(docs, 3, 90)) == {1: (1, 1), 2: (1, 1), 3: (1, 3), 4: (1, 4), 5: (1, 3)}


def test_components_of_chains_stars_and_rings(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 80)] + [(200 + i, 200 + (i + 1) % 17) for i in range(17)]
    links += [(300 + rng.randint(0, 60), 300 + rng.randint(0, 60)) for _ in range(50)]
    rng.shuffle(links)
    df = spark.createDataFrame(links, "a long, b long")
    want = roots({n for link in links if link[0] != link[1] for n in link}, links)
    assert {r.node: r.component for r in components(df).collect()} == want
    assert components(df.where("false")).count() == 0
    assert components(df.select(F.col("b").alias("a"), F.col("a").alias("b"))).count() == len(want)


def rows_alone(rows, width, percent):
    """Brute force over rows (key, text), each a document of its own: bag of (key, set size, smallest key of the group)."""
    found = plain(dict(enumerate(t for _, t in rows)), width, percent)
    least = {}
    for i, (key, _) in enumerate(rows):
        group = found[i][1]
        if key is not None and (least.get(group) is None or key < least[group]):
            least[group] = key
    return sorted(((k, found[i][0], least.get(found[i][1])) for i, (k, _) in enumerate(rows)), key=repr)


def test_rows_without_a_key_of_their_own(spark):
    rng = random.Random(8)
    base = {c: [f"{c}{i}" for i in range(40)] for c in "xyzw"}

    def near(c):
        words = list(base[c])
        words[rng.randrange(40)] = f"edit{rng.randint(0, 99)}"
        return " ".join(words)

    rows = [(9, near("x")), (9, near("y")), (5, near("x")), (6, near("y")), (10, near("y")), (9, near("x"))]
    rows += [(None, near("z")) for _ in range(6)] + [(None, near("x")), (None, "w0 w1"), (None, "w0 w1"), (None, None), (None, "")]
    rows += [(30, near("w")), (None, near("w")), (30, near("w")), (31, "some other text"), (31, "some other text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in T.groups(docs, 3, 80).collect()), key=repr)
    assert got == rows_alone(rows, 3, 80)


@pytest.mark.parametrize("shingles", [40, 400])
def test_blocks_by_shingles_lose_no_link(spark, monkeypatch, shingles):
    monkeypatch.setattr(T, "SHINGLES", shingles)
    monkeypatch.setattr(T, "BLOCKS", 2)
    rng = random.Random(shingles)
    texts = {}
    for key in range(90):
        base = [f"w{key % 3}x{i}" for i in range(30 + 20 * (key % 3))]
        for _ in range(rng.randint(0, 3)):
            base[rng.randrange(len(base))] = f"edit{rng.randint(0, 30)}"
        texts[key] = " ".join(base)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    assert got(T.groups(docs, 3, 80)) == plain(texts, 3, 80)


def walked_rows(monkeypatch):
    """What the next joins send to be walked, as rows (token, doc, n)."""
    seen, walked = [], T._walked

    def spy(rows, *rest):
        seen.extend((r.token, r.doc, r.n) for r in rows.collect())
        return walked(rows, *rest)

    monkeypatch.setattr(T, "_walked", spy)
    return seen


def edited(rng, words, edits):
    out = list(words)
    for at in rng.sample(range(len(out)), edits):
        out[at] = f"edit{rng.getrandbits(40)}"
    return out


def test_families_that_hang_together_by_chance_are_sent_about_once(spark, monkeypatch):
    monkeypatch.setattr(T, "SHINGLES", 3000)
    monkeypatch.setattr(T, "BLOCKS", 1)
    seen = walked_rows(monkeypatch)
    rng = random.Random(11)
    texts = {}
    for family in range(30):  # each has four texts that are not similar enough, and a phrase in common with the next
        base = [f"w{family}x{i}" for i in range(300)]
        for i in range(4):
            phrase = [f"p{(family + (i == 3)) % 30}x{j}" for j in range(5)] if i in (0, 3) else []
            texts[4 * family + i] = " ".join(edited(rng, base, 10) + phrase)
    texts[500] = texts[2] + " more"  # and some have one that is
    texts[501] = texts[70] + " and more"
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    found = got(T.groups(docs, 3, 80))
    assert found == plain(texts, 3, 80)
    assert found[500][1] == 2 and found[501][1] == 70
    assert {doc for _, doc, _ in seen} >= set(range(120))
    assert len(seen) < 3 * len(texts)


def test_sets_of_other_sizes_are_not_walked_together(spark, monkeypatch):
    seen = walked_rows(monkeypatch)
    rng = random.Random(12)
    texts = {}
    for family in range(8):  # a short and a long text have a phrase in common, each with a text of its size that is not similar enough
        for i in range(2):
            phrase = [f"p{family}x{i}x{j}" for j in range(8)]
            for size in (60, 120):
                texts[len(texts)] = " ".join(edited(rng, [f"w{family}x{size}x{j}" for j in range(size)], size // 40) + phrase)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    assert got(T.groups(docs, 3, 80)) == plain(texts, 3, 80)
    sizes = {}
    for token, _, n in seen:
        sizes.setdefault(token, []).append(n)
    assert sizes
    assert all(max(s) < min(s) * 1.25**2 for s in sizes.values())


@pytest.mark.parametrize("percent", [50, 80, 90, 97])
def test_sizes_that_can_be_similar_meet(spark, percent):
    pairs = [(a, 100 * a // percent) for a in [*range(1, 400), 9_999, 123_456, 8_000_000]]
    rows = [(1, i, n, i) for pair in pairs for i, n in enumerate(pair)]
    got = T._by_size(spark.createDataFrame(sorted(set(rows)), "token long, doc long, n long, component long"), percent)
    classes, own = {}, {}
    for r in got.collect():
        classes.setdefault(r.n, set()).add(r.token)
        if r.own:
            own[r.n] = r.token
    assert all({own[a], own[b]} & classes[a] & classes[b] for a, b in pairs)
