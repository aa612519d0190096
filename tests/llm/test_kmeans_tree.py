import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import kmeans_tree as K
from barloom.llm.common import table
from barloom.llm.queries import op6_kmeans_tree

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, queries, nearest=5):
    """{query: [(id, score)]} by comparing everything."""
    kept = {}
    for i, v in rows:
        if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v):
            kept[i] = np.asarray(v, np.float32).astype(float)
    out = {}
    for q in queries:
        if q in kept:
            a = kept[q]
            all_ = [(float(a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b))), i) for i, b in kept.items() if i != q]
            out[q] = sorted(all_, key=lambda s: (-s[0], s[1]))[:nearest]
    return out


def got(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.score, r.vec_id))
    return out


def test_query_recall(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf_dir, "embeddings").collect()]
    want, found = plain(rows, [i for i, _ in rows if i % 50 == 0]), got(op6_kmeans_tree(spark, sf_dir))
    assert set(found) == set(want)
    hits = sum(len({i for _, i in want[q]} & {i for _, i in found[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_the_tree_visits_every_leaf_once_and_assigns_to_one():
    x = np.random.default_rng(1).normal(size=(3000, 8))
    tree = K.Tree(x, 100)
    assert tree.leaves > 10 and set(tree.assign(x)) == set(range(tree.leaves))
    order = tree.visits(x[0], tree.leaves)
    assert sorted(order) == list(range(tree.leaves)) and tree.visits(x[0], 3) == order[:3]
    near = np.mean([tree.visits(v, 1)[0] == leaf for v, leaf in zip(x[:200], tree.assign(x[:200]))])
    assert near > 0.5


@pytest.mark.parametrize("block", [7, 8192])
def test_clustered_vectors_with_copies(spark, monkeypatch, block):
    monkeypatch.setattr(K, "VECTORS", block)
    monkeypatch.setattr(K, "QUERIES", block)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 6))
    rows = [(i, (centres[i % 6] + 0.1 * rng.normal(size=6)).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]  # one vector again and again
    rows += [(2000, (2 * np.array(rows[5][1], np.float32)).tolist())]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    found = got(K.search(df, F.col("vec_id") % 20 == 0, recall=1.0))
    want = plain(rows, [i for i, _ in rows if i % 20 == 0])
    assert set(found) == set(want)
    hits = total = 0
    for q in want:
        hits += len({i for _, i in want[q]} & {i for _, i in found[q]})
        total += 5
        assert [s for s, _ in found[q]] == sorted((s for s, _ in found[q]), reverse=True)
    assert hits >= 0.95 * total
    assert [i for _, i in found[1000]] == [0, 1001, 1002, 1003, 1004]


def test_edges(spark):
    rows = [
        (0, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, None, 1), (3, [0.0, 0.0], 1), (4, [float("nan"), 1.0], 1), (5, [float("inf"), 1.0], 1),
        (6, [None, 1.0], 1), (7, [1.0, 1.0, 1.0], 1), (8, [], 1), (0, [1.0, 0.0], 1), (None, [1.0, 0.5], 1), (9, [3e38, 1e-38], 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS leaf", "2 AS id", "3 AS h1", "'x' AS vec")
    found = got(K.search(df, F.lit(True)))
    assert {q: [i for _, i in hits] for q, hits in found.items()} == {0: [9, 1], 1: [9, 0], 9: [0, 1]}
    assert K.search(df.where("false"), F.lit(True)).count() == 0
    assert K.search(df.where("vec_id = 3"), F.lit(True)).count() == 0
    assert got(K.search(df.where("vec_id = 1"), F.lit(True))) == {}
