"""Similarity join of shingle sets with a prefix tree: links by Jaccard similarity, and their groups.

Every document becomes a set of word shingles in one global order: rare shingles first, by a sketch of
how many documents hold each (counted over all documents, fixed in size), then by hash. Two sets can only reach the
similarity if they share a shingle among their first few in that order (prefix filter), so the prefixes are posted
by shingle and shingles of a single set are dropped. Sets of equal content are one node from the start.

Within a posting the sets are stored in a trie along the global order. A probe walks the trie: sets with
the same beginning share the overlap counted so far, and a subtree is left as soon as the shingles that
remain on either side cannot make up the overlap its sizes require. What arrives at a set's end is an exact comparison.
Prefixes are a little longer than one shared shingle needs, so that similar sets share a known number of them;
documents whose prefix holds fewer shingles that others post have no partner and leave before their sets are looked at.

Groups of thousands of near copies would make every posting quadratic. So each node is first compared with
one node, of the lowest-priority nodes of its postings the one it meets most often, and linked if it is similar
enough; only postings that still hold nodes of different groups are walked, one class of sizes and the next at a time, as
similar sets are at most a class apart. Postings that hang together are one family and share one trie, so that a set is sent
once for each of its two classes; a family too large for a task is walked in blocks of neighbouring sizes. Beyond some blocks
a family is cut into cores, whose nodes have in common one of the few postings that each is known by: a single
shingle that nodes share by chance seldom is among them. Postings inside a core are walked with it, those
between cores one by one, equal ones once, long ones in such blocks. A walk skips subtrees that lie in the
probe's group already: links inside a group cannot change any group, links between groups are all found.

Texts that are null or hold no word have the empty set and are linked with nothing. Rows that repeat a key, or have
none, are documents of their own, each with its text; a group without any key has a null one. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import free_shuffles, in_batches, in_groups, only_last, stored, unique_key
from barloom.llm.components import components
from barloom.llm.shingle_sets import Shingler

#: Cells of the sketch of document counts, and the rows it travels in.
CELLS, PARTS = 1 << 18, 16
#: Sets in one block at most, shingles in one block (a set costs as many more that both bounds hold), blocks a family
#: may have, and tokens in one step of a walk.
BLOCK, SHINGLES, BLOCKS, STEP = 1500, 3_000_000, 16, 64
#: Percent of a set that its prefix is longer than it had to be.
MARGIN = 6
#: Times that nodes with too few mixed postings leave before the rest is walked.
PEEL = 3
#: Postings that a node of a family with too many blocks is known by.
TIES = 2


def sketch(texts: DataFrame, width: int) -> np.ndarray:
    """Documents by cell of the shingle's hash: ``CELLS`` counts, whatever the table's size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, cells = Shingler(width), np.zeros(CELLS, np.int64)
        for batch in batches:
            sets = [shingler.set(t) for t in batch.column(0).to_pylist()]
            if sets:
                cells += np.bincount((np.concatenate(sets) & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS)
        yield parts(dict(enumerate(cells.reshape(PARTS, -1))))

    def parts(sums: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([c.tobytes() for c in sums.values()], pa.binary())], ["part", "cells"]
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, cells in zip(batch.column(0).to_pylist(), batch.column(1)):
                cells = np.frombuffer(cells.as_buffer(), np.int64)
                sums[part] = sums[part] + cells if part in sums else cells
        yield parts(sums)

    schema = "part int, cells binary"
    summed = texts.mapInArrow(count, schema).repartition("part").mapInArrow(add, schema).collect()
    cells = np.zeros((PARTS, CELLS // PARTS), np.int64)
    for part, got in summed:
        cells[part] += np.frombuffer(got, np.int64)
    return cells.reshape(-1)


def in_order(hashes: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """Positions of ``hashes`` in the global order, rare first."""
    return np.lexsort((hashes, cells[(hashes & np.uint64(CELLS - 1)).astype(np.int64)]))


class Trie:
    """Sequences of ranks, sorted and with shared beginnings stored once. Nodes are numbered parents first."""

    def __init__(self, sequences: list[np.ndarray]):
        self.size = np.array([len(s) for s in sequences])
        order = sorted(range(len(sequences)), key=lambda i: sequences[i].astype(">u4").tobytes())
        spans: list[list[int]] = [[0, 0, order[0], -1, -1]]  # start, end, sequence, parent, sequence that ends here
        stack = [0]
        previous = None
        for i in order:
            now = sequences[i]
            shared = 0
            if previous is not None:
                n = min(len(previous), len(now))
                differ = np.flatnonzero(previous[:n] != now[:n])
                shared = int(differ[0]) if len(differ) else n
            below = None
            while spans[stack[-1]][1] > shared:
                below = stack.pop()
            if spans[stack[-1]][1] < shared:  # the beginning ends inside a node: cut it
                start, _, source, parent, _ = spans[below]
                spans.append([start, shared, source, parent, -1])
                spans[below][0], spans[below][3] = shared, len(spans) - 1
                stack.append(len(spans) - 1)
            spans.append([shared, len(now), i, stack[-1], i])
            stack.append(len(spans) - 1)
            previous = now
        chained: list[list[int]] = []  # nodes of at most STEP tokens, so that a walk can stop on the way
        tail: dict[int, int] = {}
        children: dict[int, list[int]] = {}
        for n, span in enumerate(spans):
            children.setdefault(span[3], []).append(n)
        queue = [0]
        for n in queue:
            start, end, source, parent, stop = spans[n]
            above = tail.get(parent, -1)
            for at in range(start, max(end, start + 1), STEP):
                upto = min(end, at + STEP)
                chained.append([at, upto, source, above, stop if upto == end else -1])
                above = len(chained) - 1
            tail[n] = above
            queue += children.get(n, [])
        nodes = np.array(chained)
        self.start, self.end, source, self.parent, self.stop = nodes.T
        lengths = self.end - self.start
        self.token_at = np.concatenate([[0], np.cumsum(lengths)])
        self.tokens = np.concatenate([sequences[s][a:b] for s, a, b in zip(source, self.start, self.end)])
        by_parent = np.argsort(self.parent, kind="stable")
        self.child = by_parent
        self.first = np.searchsorted(self.parent[by_parent], np.arange(len(nodes)))
        self.last = np.searchsorted(self.parent[by_parent], np.arange(len(nodes)), "right")
        self.shortest, self.longest = self._over(self.size, np.minimum), self._over(self.size, np.maximum)

    def _over(self, values: np.ndarray, fold) -> np.ndarray:
        """For each node the least or greatest value of the sequences that end in or below it."""
        none = np.iinfo(np.int64).max if fold is np.minimum else np.iinfo(np.int64).min
        out = np.where(self.stop >= 0, values[self.stop], none).tolist()
        pick = min if fold is np.minimum else max
        for n in range(len(out) - 1, 0, -1):
            p = self.parent[n]
            out[p] = pick(out[p], out[n])
        return np.array(out)

    def group(self, labels: np.ndarray) -> None:
        self.low, self.high = self._over(labels, np.minimum), self._over(labels, np.maximum)

    def walk(self, probe: np.ndarray, held: np.ndarray, label: int, percent: int) -> np.ndarray:
        """Sequences of other labels whose similarity with ``probe`` is at least ``percent`` / 100.

        held: which ranks the probe holds; cut by :meth:`group` first.
        """
        upto = np.cumsum(held)
        nodes, overlap, found = np.zeros(1, np.int64), np.zeros(1, np.int64), []
        n = len(probe)
        while len(nodes):
            lengths = self.end[nodes] - self.start[nodes]
            ends = np.cumsum(lengths)
            place = np.arange(ends[-1]) + np.repeat(self.token_at[nodes] - ends + lengths, lengths)
            hits = np.concatenate([[0], np.cumsum(held[self.tokens[place]])])
            overlap = overlap + hits[ends] - hits[ends - lengths]
            stop = self.stop[nodes]
            ended = stop >= 0
            union = n + self.size[stop] - overlap
            found.append(stop[ended & (100 * overlap >= percent * union)])
            final = self.tokens[np.maximum(self.token_at[nodes] + lengths - 1, 0)]
            left = np.where(self.end[nodes] > 0, n - upto[final], n)
            most = overlap + np.minimum(left, self.longest[nodes] - self.end[nodes])
            open_ = (100 + percent) * most >= percent * (n + self.shortest[nodes])
            open_ &= (self.low[nodes] != label) | (self.high[nodes] != label)
            open_ &= self.last[nodes] > self.first[nodes]
            nodes, overlap = nodes[open_], overlap[open_]
            counts = self.last[nodes] - self.first[nodes]
            if not len(nodes):
                break
            ends = np.cumsum(counts)
            overlap = np.repeat(overlap, counts)
            nodes = self.child[np.arange(ends[-1]) + np.repeat(self.first[nodes] - ends + counts, counts)]
        return np.concatenate(found)


def join_group(sets: list[np.ndarray], labels: np.ndarray, cells: np.ndarray, percent: int, split: int = 0) -> list[tuple[int, int]]:
    """Links between sets (hashes in any order) of different labels, enough to connect all that are linked.

    With ``split`` only the sets before it are compared with those from it on.
    """
    hashes, ranks = np.unique(np.concatenate(sets), return_inverse=True)
    rank = np.empty(len(hashes), np.int64)
    rank[in_order(hashes, cells)] = np.arange(len(hashes))
    sequences = [np.sort(s) for s in np.split(rank[ranks], np.cumsum([len(s) for s in sets])[:-1])]
    trie = Trie(sequences[split:])
    links, labels = [], labels.copy()
    trie.group(labels[split:])
    for i in range(split or len(sets)):
        held = np.zeros(len(hashes), bool)
        held[sequences[i]] = True
        moved = False
        for j in (trie.walk(sequences[i], held, labels[i], percent) + split).tolist():
            if labels[i] != labels[j]:
                links.append((i, j))
                low, high = sorted((labels[i], labels[j]))
                labels[labels == high] = low
                moved = True
        if moved:
            trie.group(labels[split:])
    return links


def required(n: int, percent: int) -> int:
    """The least overlap that a set of ``n`` needs with any other."""
    return -(-percent * n // 100)


def margin(n: int) -> int:
    """By how many shingles the prefix of a set of ``n`` is longer than nothing that sets must share."""
    return max(1, MARGIN * n // 100)


def prefix_length(n: int, percent: int) -> int:
    return n - required(n, percent) + margin(n)


def cost() -> F.Column:
    """What a set takes of a block."""
    return F.col("n") + F.lit(SHINGLES // BLOCK)


def _sets(texts: DataFrame, width: int, percent: int, cells: np.ndarray) -> DataFrame:
    """doc, n, prefix in the global order and shingles (binary of 64-bit hashes) of rows (doc, text)."""

    def work(batch: pa.RecordBatch, shingler: Shingler) -> pa.RecordBatch:
        sets = [shingler.set(t) for t in batch.column(1).to_pylist()]
        prefixes = [s[in_order(s, cells)[: prefix_length(len(s), percent)]] for s in sets]
        columns = [pa.array([len(s) for s in sets], pa.int64()), _lists(prefixes), pa.array([s.tobytes() for s in sets], pa.binary())]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc", "n", "prefix", "shingles"])

    return in_batches(texts, "doc long, n long, prefix array<bigint>, shingles binary", work, lambda: Shingler(width))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays).view(np.int64) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _signatures(texts: DataFrame, width: int, percent: int, cells: np.ndarray) -> DataFrame:
    """doc, n, two halves of the set's digest and its prefix; of equal sets in a batch only the first has its prefix."""

    def work(batch: pa.RecordBatch, shingler: Shingler) -> pa.RecordBatch:
        n, halves, prefixes, seen = [], [], [], set()
        for text in batch.column(1).to_pylist():
            own = shingler.set(text)
            digest = xxhash.xxh3_128_digest(own.tobytes())
            n.append(len(own))
            halves.append(digest)
            keep = prefix_length(len(own), percent) if len(own) and digest not in seen else 0
            prefixes.append(own[in_order(own, cells)[:keep]] if keep else own[:0])
            seen.add(digest)
        digest = np.frombuffer(b"".join(halves), "<i8").reshape(-1, 2)
        columns = [pa.array(n, pa.int64()), pa.array(digest[:, 0]), pa.array(digest[:, 1]), _lists(prefixes)]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc", "n", "f1", "f2", "prefix"])

    return in_batches(texts, "doc long, n long, f1 long, f2 long, prefix array<bigint>", work, lambda: Shingler(width))


def _postings(prefixes: DataFrame) -> DataFrame:
    """From (token, doc, n) the rows of tokens that several documents post, with the one of lowest priority as ``hub``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row so far, not given out if it is the only one of its token
        hub = hub_n = None
        for batch in batches:
            if not batch.num_rows:
                continue
            token, doc, n = (batch.column(i).to_numpy() for i in (0, 1, 2))
            if held is not None:
                token, doc, n = (np.concatenate([[h], c]) for h, c in zip(held, (token, doc, n)))
            begins = np.concatenate([[held is None or hub is None], token[1:] != token[:-1]])
            at = np.maximum.accumulate(np.where(begins, np.arange(len(token)), 0))
            hubs, hubs_n = doc[at], n[at]
            if held is not None and hub is not None:  # the first token's hub came earlier
                inside = at == 0
                hubs, hubs_n = np.where(inside, hub, hubs), np.where(inside, hub_n, hubs_n)
            alone = begins & np.concatenate([begins[1:], [True]])
            give = ~alone
            give[-1] = False
            last = token[-1], doc[-1], n[-1]
            hub, hub_n = (None, None) if begins[-1] else (hubs[-1], hubs_n[-1])
            held = last
            if give.any():
                yield batch_of(token[give], doc[give], n[give], hubs[give], hubs_n[give])
        if held is not None and hub is not None:
            yield batch_of(*[np.array([x]) for x in (*held, hub, hub_n)])

    def batch_of(*columns):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["token", "doc", "n", "hub", "hub_n"])

    sorted_rows = prefixes.repartition("token").sortWithinPartitions("token", F.xxhash64("doc"), "doc")
    return sorted_rows.mapInArrow(run, "token long, doc long, n long, hub long, hub_n long")


def groups(docs: DataFrame, width: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles and component_id (the smallest key of the group) for every row of ``docs``."""
    texts, more = unique_key(docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").cast("string").alias("text")), "key", "doc")
    found = _groups(texts.select("doc", "text"), width, percent)
    if not more:
        return found.select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
    # rows that are not known by their key: the smallest key of a group, null where none has one
    keyed = found.join(texts.select("doc", "key"), "doc")
    least = keyed.groupBy("component").agg(F.min("key").alias("least"))
    return keyed.join(least, "component").select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.col("least").alias("component_id"))


def later_copies(docs: DataFrame, key: str, width: int = 5, percent: int = 80, text: str = "text") -> DataFrame:
    """The ``key`` of each row that is not the first of its group; keys have to tell the rows apart."""
    texts = docs.select(F.col(f"`{key}`").cast("long").alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))
    return _groups(texts, width, percent).where("doc <> component").select(F.col("doc").alias(key))


def _groups(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """doc, n and component (the smallest of the group) of rows (doc, text) with a doc each."""
    cells = sketch(texts.select("text"), width)
    spark = texts.sparkSession
    # Who shares enough of what it posts. The first k shingles that two similar sets share lie in both prefixes for all k up
    # to the larger margin, less one because both the overlap and the margin are rounded to whole shingles.
    with only_last(spark):  # the prefixes are as large as the sets below
        signed = stored(_signatures(texts, width, percent, cells), "signatures")
        shared = _postings(signed.select(F.explode("prefix").alias("token"), "doc", "n")).groupBy("doc").agg(F.count("*").alias("shared"))
        signed = stored(signed.select("doc", "n", "f1", "f2").join(shared, "doc", "left"), "shared")
    free_shuffles(spark)
    classes = signed.where("n > 0").groupBy("f1", "f2").agg(F.min("doc").alias("rep"))
    classes = stored(classes, "classes")
    enough = F.greatest(F.lit(1), F.expr(f"n * {MARGIN} div 100") - 1)
    involved = signed.where(F.col("shared") >= enough).select("f1", "f2").distinct()
    reps = stored(classes.join(involved, ["f1", "f2"]).select(F.col("rep").alias("doc")).distinct(), "involved")
    sets = stored(_sets(texts.join(reps, "doc", "left_semi"), width, percent, cells), "sets")
    postings = stored(_postings(sets.select(F.explode("prefix").alias("token"), "doc", "n")), "postings")
    sets = sets.select("doc", "shingles")
    fits = lambda a, b: (100 * F.col(a) >= percent * F.col(b)) & (100 * F.col(b) >= percent * F.col(a))
    # one comparison for each node
    pairs = postings.where((F.col("doc") != F.col("hub")) & fits("n", "hub_n"))
    met = pairs.groupBy("doc", "hub").agg(F.count("*").alias("times"))
    pairs = met.groupBy("doc").agg(F.max(F.struct("times", F.xxhash64("hub").alias("p"), "hub")).alias("h")).select("doc", "h.hub")
    near = _verified(pairs, sets, percent)
    first = stored(near, "hub-links")
    free_shuffles(spark)
    labels = stored(components(first, "doc", "hub"), "hub-groups")
    # walks where groups still differ
    label = lambda rows: rows.join(labels.withColumnRenamed("node", "doc"), "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    posted = _by_size(label(postings.select("token", "doc", "n")), percent)
    sums = [
        F.max("own").alias("own"), F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"), F.sum(cost()).alias("cost"),
        F.sum(F.xxhash64("doc").bitwiseAND(0xFFFFFFFFFF)).alias("m1"), F.bit_xor(F.xxhash64(F.lit(1), "doc")).alias("m2"),
    ]
    for _ in range(PEEL):  # similar nodes of different groups share enough of these postings, so who has fewer leaves
        mixed = posted.groupBy("token").agg(*sums).where("low < high AND own").select("token")
        left = posted.join(mixed, "token", "left_semi")
        busy = left.groupBy("node", "n").agg(F.count("*").alias("shared")).where(F.col("shared") >= enough).select("node")
        posted = stored(left.join(busy, "node", "left_semi"), "mixed-postings")
        free_shuffles(spark)
    mixed = posted.groupBy("token").agg(*sums).where("low < high AND own")
    walks = stored(mixed.groupBy("size", "cost", "m1", "m2").agg(F.min("token").alias("token")).select("token", F.col("cost").alias("size")), "walks")
    rows = stored(posted.join(walks, "token").drop("own"), "walk-rows")
    rows = stored(_dealt(rows), "walk-families")
    free_shuffles(spark)
    links = first.select(F.col("doc").alias("a"), F.col("hub").alias("b")).unionByName(_walked(rows, sets, cells, percent))
    joined = components(links)
    final = classes.join(joined.withColumnRenamed("node", "rep"), "rep", "left").select("f1", "f2", F.coalesce("component", "rep").alias("component"))
    out = signed.select("doc", "n", "f1", "f2").join(final, ["f1", "f2"], "left")
    return out.select("doc", "n", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc")).alias("component"))


def _by_size(posted: DataFrame, percent: int) -> DataFrame:
    """Rows (token, doc, n, component) once for the class of their size, there their ``own``, and once for the one below.

    Sets that can be similar are at most a class apart, so they meet in the lower one of their own. ``token`` then stands for
    the shingle and the class, ``node`` for the document and the class; should two of them fall together, more is compared.
    """
    step = math.log(100 / percent * (1 + 1e-6))
    both = posted.withColumn("own", F.explode(F.array(F.lit(True), F.lit(False))))
    level = F.floor(F.log("n") / F.lit(step)) - F.when(F.col("own"), 0).otherwise(1)
    return both.select(F.xxhash64("token", level).alias("token"), F.xxhash64("doc", level).alias("node"), "doc", "n", "component", "own")


def _tied(rows: DataFrame) -> DataFrame:
    """node, family and members (cost) of the nodes that hang together by tokens, of families that blocks can walk."""
    least = rows.groupBy("token").agg(F.min("node").alias("least"))
    ties = rows.join(least, "token").where("node <> least").select("node", "least").distinct()
    family = stored(components(ties, "node", "least").select("node", F.col("component").alias("family")), "families")
    sizes = family.join(rows.select("node", "n").distinct(), "node").groupBy("family").agg(F.sum(cost()).alias("members"))
    return stored(family.join(sizes.where(F.col("members") <= SHINGLES * BLOCKS), "family"), "small-families")


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows (token, doc, n, component, size) of what is walked together, families or single postings, from the postings' rows."""
    fit = _tied(rows)
    crowd = rows.join(fit.select("node"), "node", "left_anti").select("token", "node", "n")
    apart = rows.select("token").where("false")
    if not crowd.isEmpty():
        order = Window.partitionBy("node").orderBy(F.xxhash64(F.lit(2), "token"), "token")
        cores = _tied(crowd.withColumn("place", F.row_number().over(order)).where(F.col("place") <= TIES))
        fit = fit.unionByName(cores)
        met = crowd.join(cores, "node", "left").groupBy("token")
        met = met.agg(F.count("*").alias("all"), F.count("family").alias("placed"), F.min("family").alias("low"), F.max("family").alias("high"))
        apart = stored(met.where("placed < all OR low < high").select("token"), "apart")
    whole = rows.join(apart, "token", "left_anti").select("node", "doc", "n", "component").distinct().join(fit, "node")
    single = rows.join(apart, "token").select("token", "doc", "n", "component", "size")
    return whole.select(F.col("family").alias("token"), "doc", "n", "component", F.col("members").alias("size")).unionByName(single)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (doc, hub) that are similar enough, by their whole sets."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        good = []
        for a, b in zip(batch.column(2), batch.column(3)):
            a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (a, b))
            both = len(np.intersect1d(a, b, assume_unique=True))
            good.append(100 * both >= percent * (len(a) + len(b) - both))
        keep = pa.array(good, pa.bool_())
        return pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["doc", "hub"])

    other = sets.select(F.col("doc").alias("hub"), F.col("shingles").alias("other"))
    return in_batches(pairs.join(sets, "doc").join(other, "hub").select("doc", "hub", "shingles", "other"), "doc long, hub long", work)


def _walked(rows: DataFrame, sets: DataFrame, cells: np.ndarray, percent: int) -> DataFrame:
    """Links (a, b) found by walking each posting's trie; rows: token, doc, n, component, size (cost) of the posting."""
    placed = Window.partitionBy("token").orderBy("n", "doc").rowsBetween(Window.unboundedPreceding, 0)
    long = rows.where(F.col("size") > SHINGLES).withColumn("block", F.floor((F.sum(cost()).over(placed) - 1) / SHINGLES))
    blocks = stored(long, "long-postings")
    ranges = blocks.groupBy("token", "block").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    other = ranges.select("token", F.col("block").alias("upper"), F.col("least").alias("other_least"))
    # sizes grow with the blocks: a block meets those above it that its largest set can still be similar to
    meet = ranges.join(other, "token").where((F.col("upper") >= F.col("block")) & (100 * F.col("most") >= percent * F.col("other_least")))
    left = blocks.join(meet.select("token", "block", "upper"), ["token", "block"])
    left = left.select("token", "block", "upper", F.lit(0).alias("side"), "doc", "component")
    right = blocks.withColumnRenamed("block", "upper").join(meet.where("upper > block").select("token", "block", "upper"), ["token", "upper"])
    dealt = left.unionByName(right.select("token", "block", "upper", F.lit(1).alias("side"), "doc", "component"))
    none = F.lit(0).cast("long")
    short = rows.where(F.col("size") <= SHINGLES).select("token", none.alias("block"), none.alias("upper"), F.lit(0).alias("side"), "doc", "component")
    full = short.unionByName(dealt).join(sets, "doc")

    def walk(group: pa.Table) -> Iterator[pa.RecordBatch]:
        labels = group.column("component").to_numpy()
        if labels.min() == labels.max():
            return
        docs = group.column("doc").to_numpy()
        held = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("shingles")]
        split = int(np.searchsorted(group.column("side").to_numpy(), 1)) % len(held)
        links = join_group(held, labels, cells, percent, split)
        if links:
            a, b = np.array(links).T
            yield pa.RecordBatch.from_arrays([pa.array(docs[a], pa.int64()), pa.array(docs[b], pa.int64())], ["a", "b"])

    return in_groups(full, ["token", "block", "upper"], ["side"], "a long, b long", walk)
