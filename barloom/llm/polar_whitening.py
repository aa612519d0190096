"""Whitening of vectors by a covariance from squares alone (polarisation), in whole numbers.

Every entry c becomes the whole number x = floor(64 c) + 1000000. The fit list holds each distinct x-vector once: n vectors
with sums S. A centred value is n x - S, so that it is whole as well. Tasks add up the squares of the centred values of
every dimension and of the sums of every two dimensions, exactly. As the variance of a sum is the two variances plus twice the
covariance, differences of these sums give every covariance; they are rounded once, to double, and the matrix goes
to a symmetric eigensolver on the driver. It has dimension x dimension entries, however many vectors there are, and so
has what each task sends.

A row is left out if its vector is null or empty, holds a null or non-finite entry, or has another length than
most vectors have (of lengths equally frequent the greater counts). Entries whose x would pass 2^62 are cut there. Components
without variance (less than 1e-12 of the greatest) have whitened values of zero. Repeated rows and null keys are kept
as they are; no sound vector gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import in_batches, stored

#: Scale and shift of the whole numbers, components given out.
SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
LARGEST = 1 << 62
#: Sums travel as so many limbs of so many bits; the last one is signed and holds the rest.
LIMBS, BITS = 7, 26
#: Rows whose squares are added before they are carried over, and the greatest number squared in 64 bits.
ROWS, WIDEST = 2048, 1 << 50
#: Below this share of the greatest variance a component counts as without variance.
FLAT = 1e-12


@dataclass(frozen=True)
class Fit:
    """What the fit list says: n vectors, sums, covariance in double precision, components and what was measured."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    vectors: np.ndarray  # a column for each component
    variances: np.ndarray
    identity_error: float = 0.0


def whole(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """key and x (array of longs) of the rows that take part."""
    sound = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    rows = embeddings.where(F.col(vector).isNotNull() & (F.size(vector) > 0)).where(sound)
    lengths = rows.groupBy(F.size(vector).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).select("size").first()
    rows = rows.where(F.size(vector) == (lengths.size if lengths else 0))
    rows = rows.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column(1)
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        with np.errstate(over="ignore"):
            scaled = np.floor(flat * SCALE)
        x = np.clip(scaled, -float(LARGEST), float(LARGEST)).astype(np.int64)
        x += np.where(np.abs(x) < LARGEST, SHIFT, 0)
        made = pa.ListArray.from_arrays(pa.array(lists.offsets.to_numpy() - lists.offsets[0].as_py(), pa.int32()), pa.array(x))
        return pa.RecordBatch.from_arrays([batch.column(0), made], ["key", "x"])

    kind = rows.schema["key"].dataType.simpleString()
    return in_batches(rows, f"key {kind}, x array<bigint>", work)


def matrix_of(lists: pa.Array) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1) if len(lists) else np.zeros((0, 0), np.int64)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S exactly: 64-bit where that is wide enough for squares of sums of two, Python's numbers otherwise."""
    most = int(max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))))
    if most * n + max(map(abs, sums)) < WIDEST >> 1:
        return x * n - np.array(sums, np.int64)
    shift = [s // n for s in sums]  # take out a whole mean first, as what is left is small as a rule
    y = x - np.array(shift, np.int64)
    rest = np.array([s - n * m for s, m in zip(sums, shift)], object)
    most = max(abs(int(y.max(initial=0))), abs(int(y.min(initial=0))))
    if most < LARGEST >> 2 and most * n + n < WIDEST >> 1:
        return y * n - rest.astype(np.int64)
    return (x.astype(object) - np.array(shift, object)) * n - rest


def _limbs(values: np.ndarray) -> np.ndarray:
    """Whole numbers of any size as limbs, a row each."""
    out, rest = [], values.astype(object)
    for _ in range(LIMBS - 1):
        out.append((rest & ((1 << BITS) - 1)).astype(np.int64))
        rest = rest >> BITS
    return np.stack([*out, rest.astype(np.int64)], axis=1)


def _carried(limbs: np.ndarray) -> np.ndarray:
    for k in range(LIMBS - 1):
        limbs[:, k + 1] += limbs[:, k] >> BITS
        limbs[:, k] &= (1 << BITS) - 1
    return limbs


def square_sums(z: np.ndarray) -> np.ndarray:
    """Sums over the rows of the squares of each column, exact, as limbs."""
    if z.dtype == object:
        return _limbs((z * z).sum(axis=0)) if len(z) else np.zeros((z.shape[1], LIMBS), np.int64)
    out = np.zeros((z.shape[1], LIMBS), np.int64)
    low, high = z & ((1 << BITS) - 1), z >> BITS
    out[:, 0] = np.einsum("ij,ij->j", low, low)
    out[:, 1] = 2 * np.einsum("ij,ij->j", low, high)
    out[:, 2] = np.einsum("ij,ij->j", high, high)
    return _carried(out)


def polar_sums(z: np.ndarray) -> np.ndarray:
    """For every dimension i and then every later one j the sum of z_i^2 and of (z_i + z_j)^2, as limbs."""
    parts = [square_sums(np.concatenate([z[:, i : i + 1], z[:, i : i + 1] + z[:, i + 1 :]], axis=1)) for i in range(z.shape[1])]
    return np.concatenate(parts)


def _added(rows: DataFrame, work) -> tuple[int, list[int]]:
    """Exact sums over the vectors of ``rows``: how many there are and the sums that ``work`` gives, as limbs, for a block of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            x = matrix_of(batch.column(0))
            for at in range(0, len(x), ROWS):
                part = work(x[at : at + ROWS])
                total = part if total is None else _carried(total + part)
            n += len(x)
        if total is not None:
            columns = [pa.array(np.arange(-1, len(total)))]
            count = np.zeros((1, LIMBS), np.int64)
            count[0, 0] = n
            columns += [pa.array(c) for c in np.concatenate([_carried(count), total]).T]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["entry", *[f"limb{k}" for k in range(LIMBS)]]
    partial = rows.select("x").mapInArrow(run, ", ".join(f"{c} long" for c in names))
    summed = partial.groupBy("entry").agg(*[F.sum(c).alias(c) for c in names[1:]]).orderBy("entry").collect()
    numbers = [sum(int(row[k + 1]) << (BITS * k) for k in range(LIMBS)) for row in summed]
    return (numbers[0], numbers[1:]) if numbers else (0, [])


def covariance(fit: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """n, sums and the covariance of the distinct vectors ``fit``, each entry rounded once."""
    n, sums = _added(fit, lambda x: _limbs(x.astype(object).sum(axis=0)) if np.abs(x).max() > 1 << 50 else _limbs(x.sum(axis=0)))
    if not n:
        return 0, [], np.zeros((0, 0))
    _, squares = _added(fit, lambda x: polar_sums(centred(x, n, sums)))
    size = len(sums)
    own = [0] * size
    at = 0
    for i in range(size):
        own[i] = squares[at]
        at += size - i
    out = np.zeros((size, size))
    scale = n**3
    at = 0
    for i in range(size):
        out[i, i] = own[i] / scale
        for j in range(i + 1, size):
            out[i, j] = out[j, i] = (squares[at + j - i] - own[i] - own[j]) / (2 * scale)
        at += size - i
    return n, sums, out


def learn(rows: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """The fit of rows with a column x; None if there are none."""
    fit = stored(rows.select("x").distinct(), "distinct-vectors")
    n, sums, cov = covariance(fit)
    if not n:
        return None
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[:components]
    found = Fit(n, sums, cov, vectors[:, order], np.maximum(values[order], 0.0))
    return Fit(found.n, found.sums, cov, found.vectors, found.variances, _identity_error(fit, found))


def project(x: np.ndarray, fit: Fit) -> tuple[np.ndarray, np.ndarray]:
    """Whitened values of whole vectors (a column for each component) and their deviations."""
    z = centred(x, fit.n, fit.sums)
    deviation = (z.astype(object) ** 2).sum(axis=1) if z.dtype == object or np.abs(z).max(initial=0) >= 1 << 28 else (z * z).sum(axis=1)
    scale = np.sqrt(fit.variances)
    varied = fit.variances > FLAT * fit.variances.max(initial=0.0)
    scale = np.divide(1.0, scale, out=np.zeros_like(scale), where=varied)
    return (z.astype(np.float64) / fit.n) @ fit.vectors * scale, deviation


def _identity_error(rows: DataFrame, fit: Fit) -> float:
    """Largest entry of the covariance of the whitened fit list less the identity, measured on the list."""
    size = len(fit.variances)
    width = size * size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(size), np.zeros((size, size))
        for batch in batches:
            white = project(matrix_of(batch.column(0)), fit)[0] if batch.num_rows else np.zeros((0, size))
            sums += white.sum(axis=0)
            products += white.T @ white  # centred already, as x - S/n is
        flat = np.concatenate([products.reshape(-1), sums])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], ["entry", "value"])

    summed = rows.select("x").mapInArrow(run, "entry long, value double").groupBy("entry").agg(F.sum("value").alias("value"))
    flat = np.zeros(width + size)
    for entry, value in summed.collect():
        flat[entry] = value / fit.n
    cov = flat[:width].reshape(size, size) - np.outer(flat[width:], flat[width:])
    return float(np.abs(cov - np.eye(size)).max())


def whiten(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """key, component, n, deviation decimal(38,0) (null beyond it), whitened, explained and identity_error for each row and component."""
    rows = whole(embeddings, key, vector)
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    fit = learn(rows, components)
    if fit is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    size = len(fit.variances)
    trace = float(np.trace(fit.covariance))
    explained = fit.variances / trace if trace else np.zeros(size)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        white, deviation = project(matrix_of(batch.column(1)), fit)
        times = np.repeat(np.arange(len(white)), size)
        columns = [
            batch.column(0).take(pa.array(times)),
            pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), len(white))),
            pa.array(np.full(len(times), fit.n)),
            _decimals(deviation).take(pa.array(times)),
            pa.array(white.reshape(-1)),
            pa.array(np.tile(explained, len(white))),
            pa.array(np.full(len(times), fit.identity_error)),
        ]
        return pa.RecordBatch.from_arrays(columns, [key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return in_batches(rows, schema, work)


def _decimals(values: np.ndarray) -> pa.Array:
    if values.dtype != object:
        return pa.array(values, pa.int64()).cast(pa.decimal128(38, 0))
    from decimal import Decimal

    return pa.array([Decimal(v) if v < 10**38 else None for v in values.tolist()], pa.decimal128(38, 0))
