import math
from fractions import Fraction

import numpy as np
import pytest

from barloom.llm import polar_whitening as pw
from barloom.llm.queries import op13_polar_whitening

SCHEMA = "vec_id long, embedding array<float>"


def exact(vectors):
    """n, sums and covariance of distinct whole vectors, by fractions and products."""
    fit = sorted({tuple(math.floor(64 * float(c)) + 1_000_000 for c in v) for v in vectors})
    n, size = len(fit), len(fit[0])
    sums = [sum(v[i] for v in fit) for i in range(size)]
    z = [[n * v[i] - sums[i] for i in range(size)] for v in fit]
    cov = [[float(Fraction(sum(r[i] * r[j] for r in z), n**3)) for j in range(size)] for i in range(size)]
    return n, sums, np.array(cov)


def check(rows, vectors, key="vec_id"):
    """The rows of a result against the exact covariance; vectors: sound ones by id."""
    n, sums, cov = exact(list(vectors.values()))
    size = min(len(sums), 16)
    values = np.linalg.eigvalsh(cov)[::-1]
    got = {}
    for r in rows:
        got.setdefault(r[key], {})[r.component] = r
    assert set(got) == set(vectors) and all(sorted(g) == list(range(1, size + 1)) for g in got.values())
    white = {}
    for k, found in got.items():
        x = [math.floor(64 * float(c)) + 1_000_000 for c in vectors[k]]
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        for c, r in found.items():
            assert r.n == n and int(r.deviation) == deviation
            assert r.explained == pytest.approx(values[c - 1] / np.trace(cov), rel=1e-9)
            assert r.identity_error < 1e-8
        white[tuple(x)] = [found[c].whitened for c in range(1, size + 1)]
    w = np.array(list(white.values()))
    assert np.abs(w.T @ w / n - np.eye(size)).max() < 1e-8
    centred = np.array([[a - s / n for a, s in zip(x, sums)] for x in white])
    directions = np.linalg.lstsq(centred, w, rcond=None)[0] * np.sqrt(values[:size])
    assert np.abs(cov @ directions - directions * values[:size]).max() < 1e-7 * values[0]
    return n


def test_query_over_whole_tables(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    found = op13_polar_whitening(spark, sf_dir)
    assert dict(found.dtypes)["deviation"] == "bigint" and dict(found.dtypes)["component"] == "int"
    check(found.collect(), {r.vec_id: r.embedding for r in rows})


def test_copies_count_once_and_unsound_vectors_not_at_all(spark):
    rng = np.random.default_rng(3)
    vectors = {i: [float(np.float32(c)) for c in rng.normal(size=5)] for i in range(60)}
    vectors |= {100 + i: vectors[3] for i in range(40)}
    bad = [(900, None), (901, []), (902, [1.0, None, 2.0, 3.0, 4.0]), (903, [1.0, float("nan"), 0.0, 0.0, 0.0]),
           (904, [float("inf")] + [0.0] * 4), (905, [1.0, 2.0])]
    df = spark.createDataFrame([*vectors.items(), *bad], SCHEMA).selectExpr("*", "'c' AS key", "1 AS x", "2 AS n", "3 AS entry")
    assert check(pw.whiten(df.repartition(5)).collect(), vectors) == 60


def test_square_sums_are_exact_in_both_forms():
    rng = np.random.default_rng(4)
    z = rng.integers(-(1 << 48), 1 << 48, size=(300, 4))
    want = []
    for i in range(4):
        want += [sum(int(a) ** 2 for a in z[:, i])] + [sum((int(a) + int(b)) ** 2 for a, b in zip(z[:, i], z[:, j])) for j in range(i + 1, 4)]
    for form in (z, z.astype(object)):
        assert [sum(int(v) << (pw.BITS * k) for k, v in enumerate(row)) for row in pw.polar_sums(form)] == want


@pytest.mark.parametrize("n", [3, 10**6, 10**13])
def test_centred_is_exact_at_any_size(n):
    x = np.array([[1_000_063, 999_000], [1_000_001, 1_002_000]])
    sums = [1_000_030 * n + 7, 999_990 * n + 1]
    assert pw.centred(x, n, sums).tolist() == [[n * int(a) - s for a, s in zip(row, sums)] for row in x]


def test_edge_tables(spark):
    assert pw.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert pw.whiten(spark.createDataFrame([(1, None), (2, [])], SCHEMA)).count() == 0
    one = pw.whiten(spark.createDataFrame([(1, [0.5, 0.25]), (1, [0.5, 0.25]), (None, [0.5, 0.25])], SCHEMA)).collect()
    assert len(one) == 6 and all(r.whitened == 0.0 and r.deviation == 0 and r.n == 1 for r in one)
    wide = spark.createDataFrame([(1, [1e30, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 5.0])], SCHEMA)
    rows = pw.whiten(wide).collect()
    assert len(rows) == 6 and all(math.isfinite(r.whitened) for r in rows)
    doubles = spark.createDataFrame([("a", [1e308, 1.0]), ("b", [2.0, 3.0])], "vec_id string, embedding array<double>")
    assert {r.vec_id for r in pw.whiten(doubles).collect()} == {"a", "b"}
