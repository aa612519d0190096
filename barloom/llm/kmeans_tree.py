"""Nearest neighbours by cosine through a hierarchical k-means tree.

A tree of spherical k-means is fitted on a bounded sample; every vector goes down to one leaf. A query
visits leaves best bin first: a priority queue over tree nodes hands out the closest unvisited bin
next. How many leaves are visited is calibrated: for some queries the exact neighbours are found
by brute force over all vectors, and visits are widened until enough of those neighbours lie in visited leaves.

Equal vectors are one entry of the index with their smallest ids, as many as a result can hold, so a vector
that is repeated without end fills no leaf. Leaves are searched in blocks: a bounded number of vectors against
a bounded number of queries in a task. The first leaves of every query are searched first; their worst kept score
is a bound below which the other leaves need not report anything.

Vectors that are null, zero, of another length than the others or that hold null or non-finite components take no part. Ties in
score fall to the smaller id; an id's own rows are never among its neighbours. Repeated rows count once. Other
columns are not read; an empty table has an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import in_batches, in_groups, stored

#: Vectors the tree is fitted on, children of a node, leaves for each root of the number of vectors, leaves at most.
SAMPLE, BRANCH, SPREAD, LEAVES = 20_000, 8, 0.5, 2048
#: Leaves that each query searches before the others.
FIRST = 2
#: Neighbours wanted, queries the visits are calibrated on, and the recall to reach there.
NEAREST, CALIBRATION, RECALL = 5, 400, 0.95
#: Vectors and queries of one block.
VECTORS, QUERIES = 8192, 8192


class Tree:
    """Nodes with unit centres; leaves are numbered."""

    def __init__(self, vectors: np.ndarray, leaf: int, seed: int = 3):
        self.centres: list[np.ndarray] = []  # of each inner node's children
        self.children: list[list[int]] = []  # inner nodes, or -1 - leaf
        self.leaves = 0
        rng = np.random.default_rng(seed)
        self.root = self._split(_unit(vectors), max(1, leaf), rng)

    def _split(self, x: np.ndarray, leaf: int, rng) -> int:
        if len(x) <= leaf or len(x) < 2 * BRANCH:
            self.leaves += 1
            return -self.leaves
        centres = x[rng.choice(len(x), BRANCH, replace=False)]
        for _ in range(12):
            near = np.argmax(x @ centres.T, axis=1)
            sums = np.zeros_like(centres)
            np.add.at(sums, near, x)
            lost = np.bincount(near, minlength=BRANCH) == 0
            sums[lost] = x[rng.choice(len(x), int(lost.sum()))]
            centres = _unit(sums)
        near = np.argmax(x @ centres.T, axis=1)
        used = [b for b in range(BRANCH) if (near == b).any()]
        if len(used) < 2:
            self.leaves += 1
            return -self.leaves
        at = len(self.centres)
        self.centres.append(centres[used])
        self.children.append([])
        self.children[at] = [self._split(x[near == b], leaf, rng) for b in used]
        return at

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        out, queue = np.zeros(len(x), np.int64), [(self.root, np.arange(len(x)))]
        unit = _unit(x)
        while queue:
            node, rows = queue.pop()
            if node < 0:
                out[rows] = -1 - node
                continue
            near = np.argmax(unit[rows] @ self.centres[node].T, axis=1)
            queue += [(child, rows[near == b]) for b, child in enumerate(self.children[node]) if (near == b).any()]
        return out

    def visits(self, query: np.ndarray, limit: int) -> list[int]:
        """The first ``limit`` leaves in the order of best bin first."""
        unit, heap, out = _unit(query[None])[0], [(0.0, 0, self.root)], []
        count = 1
        while heap and len(out) < limit:
            _, _, node = heapq.heappop(heap)
            if node < 0:
                out.append(-1 - node)
                continue
            for child, close in zip(self.children[node], (self.centres[node] @ unit).tolist()):
                heapq.heappush(heap, (-close, count, child))
                count += 1
        return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, np.float64)
    big = np.abs(x).max(axis=1, keepdims=True, initial=0)  # first, so that no square runs over
    x = x / np.where(big > 0, big, 1)
    n = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(n > 0, n, 1)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of the rows of ``a`` and ``b``, in double precision on the vectors as they are."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def sound(vector: Column, size: int) -> Column:
    ok = vector.isNotNull() & (F.size(vector) == size) & F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return ok & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of fixed-width binaries as doubles."""
    return np.frombuffer(b"".join(x.as_py() for x in column), np.float64).reshape(len(column), -1)


def _digest(row: np.ndarray) -> tuple[int, int]:
    both = np.frombuffer(xxhash.xxh3_128_digest(row.tobytes()), "<i8")
    return int(both[0]), int(both[1])


def packed(vectors: DataFrame, key: str, vector: str, size: int) -> DataFrame:
    """id, vec (binary of doubles) and its digest h1, h2, of the sound rows; zeros are all positive."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
        x = flat.reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, 1))
        digests = np.array([_digest(r) for r in x], np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([r.tobytes() for r in x], pa.binary()), pa.array(digests[:, 0]), pa.array(digests[:, 1])],
            ["id", "vec", "h1", "h2"],
        )

    column = F.col(f"`{vector}`")
    rows = vectors.where(sound(column, size) & F.col(key).isNotNull()).select(F.col(key).cast("long"), column.cast("array<double>"))
    return in_batches(rows, "id long, vec binary, h1 long, h2 long", work)


def entries(rows: DataFrame, keep: int) -> DataFrame:
    """One row for each distinct vector: h1, h2, vec and its ``keep`` smallest ids."""
    schema = "h1 long, h2 long, vec binary, ids array<bigint>"
    kind = pa.list_(pa.int64())

    def made(found: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([h[0] for h in found], pa.int64()),
                pa.array([h[1] for h in found], pa.int64()),
                pa.array([v for v, _ in found.values()], pa.binary()),
                pa.array([sorted(ids)[:keep] for _, ids in found.values()], kind),
            ],
            ["h1", "h2", "vec", "ids"],
        )

    def within(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: dict = {}
        for i, vec, h1, h2 in zip(*(c.to_pylist() for c in batch.columns)):
            found.setdefault((h1, h2), (vec, set()))[1].add(i)
        return made(found)

    def over(group: pa.Table) -> Iterator[pa.RecordBatch]:
        ids = set(group.column("ids").combine_chunks().flatten().to_pylist())
        yield made({(group.column("h1")[0].as_py(), group.column("h2")[0].as_py()): (group.column("vec")[0].as_py(), ids)})

    return in_groups(in_batches(rows.select("id", "vec", "h1", "h2"), schema, within), ["h1", "h2"], [], schema, over)


def _best(queries: np.ndarray, vectors: np.ndarray, ids: list[list[int]], keep: int) -> Iterator[tuple[int, int, float]]:
    """(query, vector, score) of each query's ``keep`` nearest vectors, exact among ``vectors``."""
    rough = _unit(queries) @ _unit(vectors).T
    lowest = np.array([i[0] for i in ids])
    for q in range(len(queries)):
        if len(vectors) > keep:
            limit = np.partition(rough[q], -keep)[-keep]
            near = np.flatnonzero(rough[q] >= limit - 1e-9)
        else:
            near = np.arange(len(vectors))
        scores = cosine(np.broadcast_to(queries[q], (len(near), queries.shape[1])), vectors[near])
        for o in np.lexsort((lowest[near], -scores))[:keep]:
            yield q, int(near[o]), float(scores[o])


FOUND = "h1 long, h2 long, score double, leaf long, ids array<bigint>"


def _found(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 5
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["h1", "h2", "score", "leaf", "ids"])


def _top(found: DataFrame, keep: int) -> DataFrame:
    """The best ``keep`` rows of each digest."""

    def cut(group: pa.Table) -> Iterator[pa.RecordBatch]:
        score = group.column("score").to_numpy()
        first = np.array([x[0].as_py() for x in group.column("ids")])
        yield from group.take(pa.array(np.lexsort((first, -score))[:keep])).combine_chunks().to_batches()

    return in_groups(found, ["h1", "h2"], [], FOUND, cut)


def exact(queries: list[tuple[int, int, bytes]], index: DataFrame, keep: int) -> DataFrame:
    """Brute force: the ``keep`` nearest entries for a bounded list of queries, over all of the index."""
    matrix = np.frombuffer(b"".join(q[2] for q in queries), np.float64).reshape(len(queries), -1)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, leaves = batch.column(2).to_pylist(), batch.column(0).to_pylist()
        best = _best(matrix, _matrix(batch.column(1)), ids, keep) if batch.num_rows else ()
        return _found([(*queries[q][:2], score, leaves[v], ids[v]) for q, v, score in best])

    return _top(in_batches(index.select("leaf", "vec", "ids"), FOUND, work), keep)


def search(vectors: DataFrame, query: Column, key: str = "vec_id", vector: str = "embedding", nearest: int = NEAREST, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found of every row for which ``query`` holds."""
    spark, keep = vectors.sparkSession, nearest + 1
    column = F.col(f"`{vector}`")
    sizes = vectors.where(F.size(column) > 0).groupBy(F.size(column).alias("n")).count().orderBy(F.desc("count"), "n").first()
    out = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], out)
    rows = packed(vectors, key, vector, sizes["n"])
    whole = stored(entries(rows, keep), "entries")
    n = whole.count()
    if not n:
        return spark.createDataFrame([], out)
    sample = [r[0] for r in whole.select("vec").orderBy(F.xxhash64("h1"), "h1", "h2").limit(SAMPLE).collect()]
    fitted = np.frombuffer(b"".join(sample), np.float64).reshape(len(sample), -1)
    leaves = min(LEAVES, max(1, int(SPREAD * n**0.5)))
    tree = Tree(fitted, max(2, len(sample) // leaves))

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        leaf = tree.assign(_matrix(batch.column(0))) if batch.num_rows else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(leaf), *batch.columns], ["leaf", "vec", "ids"])

    index = stored(in_batches(whole.select("vec", "ids"), "leaf long, vec binary, ids array<bigint>", place), "index")
    asked = packed(vectors.where(query), key, vector, sizes["n"])
    asked = stored(asked, "asked")
    distinct = asked.groupBy("h1", "h2").agg(F.first("vec").alias("vec"))
    trial = [tuple(r) for r in distinct.orderBy(F.xxhash64("h1"), "h1", "h2").limit(CALIBRATION).collect()]
    limit = calibrated(tree, trial, exact(trial, index, keep).collect(), recall) if trial else 1

    sized = lambda df, per: {r[0]: -(-r[1] // per) for r in df.groupBy("leaf").count().collect()}  # noqa: E731  at most LEAVES rows
    schema = "leaf long, turn long, h1 long, h2 long, vec binary"

    def visit(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = _matrix(batch.column(2)) if batch.num_rows else np.zeros((0, 1))
        orders = [tree.visits(r, limit) for r in x]
        take = pa.array(np.repeat(np.arange(len(x)), [len(o) for o in orders]))
        flat, turns = [leaf for o in orders for leaf in o], [t for o in orders for t in range(len(o))]
        columns = [pa.array(flat, pa.int64()), pa.array(turns, pa.int64()), *[c.take(take) for c in batch.columns]]
        return pa.RecordBatch.from_arrays(columns, ["leaf", "turn", "h1", "h2", "vec"])

    visited = stored(in_batches(distinct.select("h1", "h2", "vec"), schema, visit), "visits")
    over_v = sized(index, VECTORS)
    h = F.xxhash64(F.col("vec"))

    def searched(visits: DataFrame) -> DataFrame:
        """The best entries in the visited leaves; visits: leaf, bound, h1, h2, vec."""
        over_q = sized(visits, QUERIES)
        sizes = spark.createDataFrame([(k, v, over_q.get(k, 0)) for k, v in over_v.items()], "leaf long, vs long, qs long")
        blocks = F.broadcast(sizes)  # at most LEAVES rows
        mine = index.join(blocks, "leaf").where("qs > 0").select(
            "leaf", F.pmod(h, F.col("vs")).alias("vb"), F.explode(F.sequence(F.lit(0), F.col("qs") - 1)).alias("qb"),
            F.lit(0).alias("kind"), F.lit(-2.0).alias("bound"), F.lit(0).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2"), "vec", "ids",
        )
        theirs = visits.join(blocks, "leaf").select(
            "leaf", F.explode(F.sequence(F.lit(0), F.col("vs") - 1)).alias("vb"), F.pmod(h, F.col("qs")).alias("qb"),
            F.lit(1).alias("kind"), "bound", "h1", "h2", "vec", F.lit(None).cast("array<bigint>").alias("ids"),
        )
        return in_groups(mine.unionByName(theirs), ["leaf", "vb", "qb"], ["kind"], FOUND, compare)

    def compare(group: pa.Table) -> Iterator[pa.RecordBatch]:
        group = group.combine_chunks()
        kinds = group.column("kind").to_numpy()
        split = int(np.searchsorted(kinds, 1))
        if not 0 < split < len(kinds):
            return
        vec = group.column("vec").combine_chunks()
        x, q = _matrix(vec[:split]), _matrix(vec[split:])
        ids = group.column("ids")[:split].to_pylist()
        h1, h2, bound = (group.column(c).to_numpy()[split:] for c in ("h1", "h2", "bound"))
        for i in range(0, len(q), 512):
            best = _best(q[i : i + 512], x, ids, keep)
            yield _found([(int(h1[i + a]), int(h2[i + a]), s, 0, ids[b]) for a, b, s in best if s >= bound[i + a]])

    near = stored(_top(searched(visited.where(F.col("turn") < FIRST).withColumn("bound", F.lit(-2.0))), keep), "first-found")
    bounds = near.groupBy("h1", "h2").agg(F.min("score").alias("least"), F.count("*").alias("c"))
    bounds = bounds.select("h1", "h2", F.when(F.col("c") >= keep, F.col("least")).otherwise(-2.0).alias("bound"))
    rest = visited.where(F.col("turn") >= FIRST).join(bounds, ["h1", "h2"], "left").withColumn("bound", F.coalesce("bound", F.lit(-2.0)))
    met = near.unionByName(searched(rest))

    def listed(group: pa.Table) -> Iterator[pa.RecordBatch]:
        pairs = [(-s, i) for s, ids in zip(group.column("score").to_pylist(), group.column("ids").to_pylist()) for i in ids]
        top = [{"score": -s, "id": i} for s, i in sorted(set(pairs))[:keep]]
        first = group.slice(0, 1)
        kind = pa.list_(pa.struct([("score", pa.float64()), ("id", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [first.column("h1").combine_chunks(), first.column("h2").combine_chunks(), pa.array([top], kind)], ["h1", "h2", "top"]
        )

    lists = in_groups(_top(met, keep), ["h1", "h2"], [], "h1 long, h2 long, top array<struct<score:double,id:bigint>>", listed)
    mine_out = F.slice(F.filter("top", lambda x: x["id"] != F.col("id")), 1, nearest)
    answers = asked.select("id", "h1", "h2").distinct().join(lists, ["h1", "h2"]).select(F.col("id").alias("query_id"), F.posexplode(mine_out).alias("rank", "hit"))
    return answers.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("hit.id").alias("vec_id"), F.col("hit.score").alias("score"))


def calibrated(tree: Tree, trial: list[tuple[int, int, bytes]], truth: list, recall: float) -> int:
    """Leaves to visit: widened by an eighth until ``recall`` of the true neighbours of the trial queries is reached.

    A query's own entry, which always lies in the first leaf, does not count.
    """
    place: dict[tuple[int, int], list[int]] = {}
    own: set[tuple[int, int]] = set()
    for r in sorted(truth, key=lambda r: -r["score"]):
        query = (r["h1"], r["h2"])
        if query not in own:
            own.add(query)  # its nearest entry holds itself
            if len(r["ids"]) == 1:
                continue
        place.setdefault(query, []).append(r["leaf"])
    ranks = []
    for h1, h2, vec in trial:
        order = {leaf: i for i, leaf in enumerate(tree.visits(np.frombuffer(vec, np.float64), tree.leaves))}
        ranks += [order[leaf] for leaf in place.get((h1, h2), [])]
    limit = 1
    while ranks and limit < tree.leaves and np.mean(np.array(ranks) < limit) < recall:
        limit = min(tree.leaves, limit + max(1, limit // 8))
    return limit
