"""Toxicity of whole texts by a bidirectional gated recurrent network, in numpy.

A word enters the network as the mean of its hashed character n-gram vectors beside a vector of the
word itself. Overlapping windows of words, which together cover the text, run through a GRU in both
directions; attention pools the states of a window into one score. A document's score comes from the
largest and the mean window score through a logistic layer. All parts are trained here: the
network on windows by backpropagation through time, the last layer on documents.

Texts that are null or hold no word score the share of toxic documents seen in training, below the limit of 0.5;
without labels to learn from every text scores 0. Texts are read whole, in windows, and any
length is one pass. Repeated rows are scored alike; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import hash_order, held_out, in_batches
from barloom.llm.word_hash import BITS, WORD, word_features

WINDOW, STRIDE = 32, 24
STATES, CHARS, WORDS = 8, 12, 12
#: Labelled documents sampled for each label and their longest text, windows of a clean and of a toxic one,
#: passes over the windows, and the share of a toxic document's windows that stands for it after the first pass.
SAMPLE, SAMPLE_CHARS, PER_DOC, EPOCHS, TOXIC_PART = 1000, 20_000, (8, 24), 8, 0.4
#: Features count only if so many of the sampled documents hold them; the rest would be learned by heart.
MIN_DOCS = 6
#: Every so many documents one is kept from the network's training, to fit the last layer on.
FOLD = 4
RATE, BATCH, SHRINK = 0.01, 128, 3e-4
CACHE = 250_000
#: Windows scored at once.
CHUNK = 4096


def window_starts(n: int) -> np.ndarray:
    """Starts of windows that cover ``n`` words and overlap; one window if the words are few."""
    return np.arange(0, max(1, n - (WINDOW - STRIDE)), STRIDE)


def _sigmoid(x):
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Network:
    """Parameters and passes. Word vectors: rows of features are hashed n-grams, the last is the word."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        draw = lambda scale, *shape: (scale * rng.standard_normal(shape)).astype(np.float32)
        self.p = {
            "chars": np.zeros((1 << BITS, CHARS), np.float32),
            "words": np.zeros((1 << BITS, WORDS), np.float32),
            "known": np.zeros(1 << BITS, np.float32),
            "b": np.zeros((2, 3 * STATES), np.float32),
            "w": draw(0.3, 2, CHARS + WORDS, 3 * STATES),
            "u": draw(0.3, 2, STATES, 3 * STATES),
            "attend": draw(0.3, 2 * STATES),
            "out": draw(0.3, 2 * STATES),
            "bias": np.zeros(1, np.float32),
        }

    def vectors(self, ids: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Inputs of words given their features (:func:`word_features`)."""
        rows = np.add.reduceat(self.p["chars"][ids], begin[:-1], axis=0)
        last = ids[begin[1:] - 1]
        return np.concatenate([rows / self.grams(ids, begin)[:, None], self.p["words"][last]], axis=1).astype(np.float32)

    def grams(self, ids: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """How many features of each word are known, at least 1."""
        return np.maximum(np.add.reduceat(self.p["known"][ids], begin[:-1]), 1)

    def admit(self, ids: np.ndarray, rng: np.random.Generator) -> None:
        """From now on these features have vectors; all others stay zero."""
        self.p["known"][ids] = 1
        for key, size in (("chars", CHARS), ("words", WORDS)):
            self.p[key][ids] = 0.1 * rng.standard_normal((len(ids), size))

    def run(self, table: np.ndarray, index: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Scores of windows. table: projected inputs by word (two directions); index, mask: windows x WINDOW."""
        n, steps = index.shape
        states = np.zeros((2, steps, n, STATES), np.float32)
        kept = []
        for d in (0, 1):
            u = self.p["u"][d]
            h = np.zeros((n, STATES), np.float32)
            for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
                x = table[index[:, t], d]
                hu = h @ u
                g = np.tanh(0.5 * (x[:, : 2 * STATES] + hu[:, : 2 * STATES]))
                g += 1
                g *= 0.5
                z, r = g[:, :STATES], g[:, STATES:]
                c = np.tanh(x[:, 2 * STATES :] + r * hu[:, 2 * STATES :])
                m = mask[:, t : t + 1]
                after = c + z * (h - c)
                if keep:
                    kept.append((d, t, h, z, r, c, hu[:, 2 * STATES :], m))
                h = after if m.all() else np.where(m, after, h)
                states[d, t] = h
        both = np.concatenate([states[0], states[1]], axis=2)  # steps x windows x states
        weight = both @ self.p["attend"]
        weight = np.where(mask.T, weight, -1e9)
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = (weight[:, :, None] * both).sum(axis=0)
        score = pooled @ self.p["out"] + self.p["bias"]
        return (score, both, weight, pooled, kept) if keep else score

    def project(self, vectors: np.ndarray) -> np.ndarray:
        return np.stack([vectors @ self.p["w"][d] + self.p["b"][d] for d in (0, 1)], axis=1)

    def gradients(self, vectors: np.ndarray, index: np.ndarray, mask: np.ndarray, want: np.ndarray):
        """Loss gradients of the dense parameters and of the word vectors."""
        p = self.p
        table = self.project(vectors)
        score, both, weight, pooled, kept = self.run(table, index, mask, keep=True)
        g = {k: np.zeros_like(v) for k, v in p.items() if k not in ("chars", "words", "known")}
        ds = ((_sigmoid(score) - want) / len(want)).astype(np.float32)
        g["out"], g["bias"] = pooled.T @ ds, np.array([ds.sum()], np.float32)
        dpooled = ds[:, None] * p["out"]
        dweight = (both * dpooled).sum(axis=2)
        dlogit = weight * (dweight - (weight * dweight).sum(axis=0))
        g["attend"] = np.einsum("tn,tns->s", dlogit, both)
        dboth = weight[:, :, None] * dpooled + dlogit[:, :, None] * p["attend"]
        dtable = np.zeros_like(table)
        carry = [None, None]
        for d, t, h, z, r, c, hun, m in reversed(kept):
            dh = dboth[t, :, d * STATES : (d + 1) * STATES] + (0 if carry[d] is None else carry[d])
            live = np.where(m, dh, 0)
            dc = live * (1 - z) * (1 - c * c)
            dz = live * (h - c) * z * (1 - z)
            dr = dc * hun * r * (1 - r)
            dhu = np.concatenate([dz, dr, dc * r], axis=1)
            np.add.at(dtable, (index[:, t], d), np.concatenate([dz, dr, dc], axis=1))
            g["u"][d] += h.T @ dhu
            carry[d] = np.where(m, live * z + dhu @ p["u"][d].T, dh)
        for d in (0, 1):
            g["w"][d] = vectors.T @ dtable[:, d]
            g["b"][d] = dtable[:, d].sum(axis=0)
        return g, sum(dtable[:, d] @ p["w"][d].T for d in (0, 1))


class Scorer:
    """Scores texts with a trained network; remembers the projected inputs of words."""

    def __init__(self, params: dict, last: np.ndarray, empty: float):
        self.net = Network.__new__(Network)
        self.net.p = params
        self.last, self.empty = last, empty
        self.known: dict[str, int] = {}
        self.table = np.zeros((0, 2, 3 * STATES), np.float32)

    def ids(self, words: list[str]) -> np.ndarray:
        known = self.known
        fresh = [w for w in dict.fromkeys(words) if w not in known]
        if fresh:
            if len(known) + len(fresh) > CACHE:
                known.clear()
                self.table = self.table[:0]
                fresh = list(dict.fromkeys(words))
            made = [self.net.project(self.net.vectors(*word_features(fresh[i : i + 20_000]))) for i in range(0, len(fresh), 20_000)]
            known.update(zip(fresh, range(len(self.table), len(self.table) + len(fresh))))
            self.table = np.concatenate([self.table, *made])
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def windows(self, texts: list[str | None]) -> list[np.ndarray]:
        """Window scores of each text, in order."""
        words = [WORD.findall(t.lower()) if t else [] for t in texts]
        flat = [w for ws in words for w in ws]
        if not flat:
            return [np.zeros(0, np.float32) for _ in words]
        ids = self.ids(flat)
        starts, ends, counts, at = [], [], [], 0
        for ws in words:
            s = window_starts(len(ws)) if ws else np.zeros(0, np.int64)
            starts.append(s + at)
            at += len(ws)
            ends.append(np.full(len(s), at))
            counts.append(len(s))
        starts, ends = np.concatenate(starts), np.concatenate(ends)
        scores = np.empty(len(starts), np.float32)
        for i in range(0, len(starts), CHUNK):
            place = starts[i : i + CHUNK, None] + np.arange(WINDOW)
            mask = place < ends[i : i + CHUNK, None]
            scores[i : i + CHUNK] = self.net.run(self.table, ids[np.minimum(place, len(ids) - 1)], mask)
        return np.split(scores, np.cumsum(counts)[:-1])

    def score(self, texts: list[str | None]) -> list[float]:
        return [
            float(_sigmoid(np.float64(self.last @ [x.max(), x.mean(), 1.0]))) if len(x) else self.empty
            for x in self.windows(texts)
        ]


def train(texts: list[str], labels: list[int], share_toxic: float | None = None, seed: int = 5) -> Scorer:
    """Fit the network on windows that carry their document's label, then the last layer on other documents.

    ``share_toxic``: of all labelled documents, where the sample's share is another.
    """
    net, rng = Network(seed), np.random.default_rng(seed)
    toxic = sum(labels) / len(labels) if labels else 0.0
    if not 0 < toxic < 1:
        return Scorer(net.p, np.array([0.0, 0.0, -50.0 if toxic == 0 else 50.0]), 0.0 if toxic == 0 else 0.49)
    words = [WORD.findall(t.lower()) for t in texts]
    names = list(dict.fromkeys(w for ws in words for w in ws))
    number = dict(zip(names, range(len(names))))
    feats, begin = word_features(names) if names else (np.zeros(0, np.int64), np.zeros(1, np.int64))
    numbered = [np.array([number[w] for w in ws], np.int64) for ws in words]
    holders = np.zeros(1 << BITS, np.int64)
    index, mask, want, owner = [], [], [], []
    for k, (ids, label) in enumerate(zip(numbered, labels)):
        starts = window_starts(len(ids)) if len(ids) else []
        if not len(starts) or k % FOLD == 0:
            continue
        own = np.unique(ids)
        holders[np.unique(np.concatenate([feats[begin[i] : begin[i + 1]] for i in own]))] += 1
        for s in starts if len(starts) <= PER_DOC[label] else rng.choice(starts, PER_DOC[label], replace=False):
            part = ids[s : s + WINDOW]
            index.append(np.pad(part, (0, WINDOW - len(part))))
            mask.append(np.arange(WINDOW) < len(part))
            want.append(label)
            owner.append(k)
    if not index:
        return Scorer(net.p, np.array([0.0, 0.0, -50.0]), min(0.49, toxic))
    net.admit(np.flatnonzero(holders >= min(MIN_DOCS, max(2, len(texts) // 40))), rng)
    index, mask, want, owner = np.array(index), np.array(mask), np.array(want, np.float32), np.array(owner)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0

    def adam(key, grad, rows=slice(None)):
        m, v = moments[key]
        grad = grad + SHRINK * net.p[key][rows]
        m[rows] = 0.9 * m[rows] + 0.1 * grad
        v[rows] = 0.999 * v[rows] + 0.001 * grad * grad
        net.p[key][rows] -= RATE * (m[rows] / (1 - 0.9**step)) / (np.sqrt(v[rows] / (1 - 0.999**step)) + 1e-6)

    chosen = np.arange(len(index))
    for epoch in range(EPOCHS):
        order = rng.permutation(chosen)
        for i in range(0, len(order), BATCH):
            step += 1
            part = order[i : i + BATCH]
            used, local = np.unique(index[part], return_inverse=True)
            lengths = begin[used + 1] - begin[used]
            own = np.concatenate([[0], np.cumsum(lengths)])
            ids = feats[np.repeat(begin[used] - own[:-1], lengths) + np.arange(own[-1])]
            grads, dvec = net.gradients(net.vectors(ids, own), local.reshape(len(part), WINDOW), mask[part], want[part])
            for key, grad in grads.items():
                adam(key, grad)
            known = net.p["known"][ids] > 0
            share = np.repeat(dvec[:, :CHARS] / net.grams(ids, own)[:, None], lengths, axis=0)[known]
            _sparse(adam, "chars", ids[known], share)
            last = own[1:] - 1
            _sparse(adam, "words", ids[last][known[last]], dvec[:, CHARS:][known[last]])
        if epoch + 1 < EPOCHS:  # a toxic document is not toxic everywhere: its highest windows stand for it
            table = net.project(net.vectors(feats, begin))
            scores = np.concatenate([net.run(table, index[i : i + CHUNK], mask[i : i + CHUNK]) for i in range(0, len(index), CHUNK)])
            limit = {k: np.quantile(scores[owner == k], 1 - TOXIC_PART) for k in np.unique(owner[want == 1])}
            chosen = np.flatnonzero((want == 0) | (scores >= np.array([limit.get(k, 0) for k in owner])))
    found = Scorer(net.p, np.zeros(3), min(0.49, toxic))
    kept = [t for t in texts[::FOLD]]
    seen = [(x.max(), x.mean(), 1.0) if len(x) else None for i in range(0, len(kept), 500) for x in found.windows(kept[i : i + 500])]
    x = np.array([s for s in seen if s]).reshape(-1, 3)
    y = np.array([label for s, label in zip(seen, labels[::FOLD]) if s], float)
    weight = np.where(y == 1, share_toxic / toxic, (1 - share_toxic) / (1 - toxic)) if share_toxic is not None else np.ones(len(y))
    last = np.zeros(3)
    for _ in range(50):  # Newton's method
        q = _sigmoid(x @ last)
        last -= np.linalg.solve((x * (weight * q * (1 - q))[:, None]).T @ x + 1e-1 * np.eye(3), x.T @ (weight * (q - y)) + 1e-1 * last)
    found.last = last
    return found


def _sparse(adam, key: str, ids: np.ndarray, grad: np.ndarray) -> None:
    if not len(ids):
        return
    order = np.argsort(ids, kind="stable")
    rows, at = np.unique(ids[order], return_index=True)
    adam(key, np.add.reduceat(grad[order], at, axis=0), rows)


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Scorer:
    """Train on at most about ``sample`` documents of each label that are not held out, cut by hash."""
    marked = labels.where(F.col(label).isin(0, 1) & ~held_out(key)).select(key, F.col(label).cast("int").alias(label))
    counts = {r[0]: r[1] for r in marked.groupBy(label).count().collect()}
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col(label) == value, min(1.0, sample / n)).otherwise(share)
    drawn = marked.where((hash_order(key) + F.lit(0)) / F.lit(2.0**64) + 0.5 < share).dropDuplicates([key])
    drawn = F.broadcast(drawn.orderBy(hash_order(key)).limit(3 * sample))  # a sample of known size: the texts do not move
    rows = docs.select(key, text).where(F.col(text).isNotNull() & (F.length(text) <= SAMPLE_CHARS)).join(drawn, key)
    taken = rows.orderBy(hash_order(key), text).limit(4 * sample).collect()
    whole = counts.get(1, 0) / max(1, sum(counts.values()))
    return train([r[text] for r in taken], [r[label] for r in taken], whole)


def score(docs: DataFrame, scorer: Scorer, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and score for every row."""
    kinds = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)
    parts = (scorer.net.p, scorer.last, scorer.empty)

    def work(batch: pa.RecordBatch, own: Scorer) -> pa.RecordBatch:
        texts = batch.column(len(keys)).to_pylist()
        scores = [s for i in range(0, len(texts), 500) for s in own.score(texts[i : i + 500])]
        return pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], pa.array(scores, pa.float64())], [*keys, "score"])

    rows = docs.select(*[F.col(f"`{k}`") for k in keys], F.col(text).cast("string").alias("__text"))
    return in_batches(rows, f"{kinds}, score double", work, lambda: Scorer(*parts))
