"""Language identification with a linear-chain conditional random field over words.

Each word of a text gets a language: its scores are sums of hashed features (affixes and character
n-grams, which carry the word's edges, and the word itself as a lexicon entry), neighbouring
words are tied by learned transitions, and forward-backward gives the marginals. A document's
language is the one with the largest mean marginal, its score that mean; so mixed text is settled by
how much of it each language holds.

Training learns from documents with one label each. Sequences are spliced from pieces of several
documents, so that the transitions learn how long a language lasts in code-switched text.

If asked, the field learns one more label, for words in none of the languages, from texts made of the sampled words'
lengths and other letters. A text most of whose words bear that label is ``und``.

A text that is null or has no letter is ``und`` with score 0; so is every text if no row can be
learned from. Texts of any length are read whole. Repeated rows are judged alike, ties between
languages fall to the first in alphabetical order; columns besides the key and the text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import WordMemory, hash_order, held_out, in_batches, let_go
from barloom.llm.word_hash import BITS, WORD, word_features

#: Documents sampled per language for training, their longest text, and their words per sequence.
SAMPLE, SAMPLE_CHARS, LENGTH = 300, 20_000, 64
EPOCHS, RATE, SHRINK = 3, 0.5, 1e-4
#: Bytes that the words a worker remembers the scores of may take, and what one takes beside its letters.
MEMORY, EACH = 32 << 20, 200
NONE = "und"
#: Label of words in no learned language, which no table holds; a text is in none if that label's mean marginal is larger.
FOREIGN, MOST_FOREIGN = "\x00", 2 / 3
#: Letters of a script that lie together, of which a foreign text is made.
SCRIPT = 60
#: Texts that have to be left to measure what is familiar; the share by which any text may fall short, and how much further than
#: the least familiar of them a short one may.
LEAST, SHORT, SLACK = 10, 0.25, 1.5


def forward_backward(scores: np.ndarray, lengths: np.ndarray, trans: np.ndarray, pairs: bool = False):
    """Marginals of the words of several sequences, laid out one after the other; expected transitions too if asked."""
    order = np.argsort(-lengths, kind="stable")
    sizes = lengths[order]
    steps = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(steps), "left")  # sequences longer than t
    offset = np.concatenate([[0], np.cumsum(active)])
    rank = np.empty(len(lengths), np.int64)
    rank[order] = np.arange(len(lengths))
    begin = np.cumsum(lengths) - lengths
    inside = np.arange(len(scores)) - np.repeat(begin, lengths)
    place = offset[inside] + np.repeat(rank, lengths)  # time-major
    em = np.empty_like(scores)
    em[place] = np.exp(scores - scores.max(axis=1, keepdims=True))
    a = np.exp(trans)
    alpha = np.empty_like(em)
    if steps:
        now = em[: active[0]] / em[: active[0]].sum(axis=1, keepdims=True)
        alpha[: active[0]] = now
    for t in range(1, steps):
        now = (now[: active[t]] @ a) * em[offset[t] : offset[t + 1]]
        now /= now.sum(axis=1, keepdims=True)
        alpha[offset[t] : offset[t + 1]] = now
    expected = np.zeros_like(trans)
    beta = np.ones((active[-1] if steps else 0, trans.shape[0]), em.dtype)
    marginal = alpha
    for t in range(steps - 1, 0, -1):
        onward = beta * em[offset[t] : offset[t + 1]]
        back = onward @ a.T
        n = active[t - 1]
        if pairs:
            joint = alpha[offset[t - 1] : offset[t - 1] + active[t], :, None] * a * onward[:, None, :]
            expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        marginal_now = alpha[offset[t] : offset[t + 1]] * beta
        beta = np.ones((n, trans.shape[0]), em.dtype)
        beta[: active[t]] = back / back.sum(axis=1, keepdims=True)
        if pairs:
            em[offset[t] : offset[t + 1]] = marginal_now
        else:
            marginal[offset[t] : offset[t + 1]] = marginal_now
    if steps:
        first = alpha[: active[0]] * beta
        (em if pairs else marginal)[: active[0]] = first
    out = (em if pairs else marginal)[place]
    return out / out.sum(axis=1, keepdims=True), expected


class Familiar:
    """Which three letters in a row occur in the sampled words, word edges included, and how many of a text may not.

    The letters come from four fifths of the sample; the rest tells what share of a text that is in one of the
    languages is known, and by how much a text may fall short of it: by a fixed part, and by more the shorter it is.
    Each word counts once, however often a text repeats it.
    """

    def __init__(self, texts: list[str]):
        words = [WORD.findall(t.lower()) for t in texts]
        self.grams = frozenset(g for i, ws in enumerate(words) if i % 5 for w in set(ws) for g in self.of(w))
        shares = [self.count(list(set(ws))) for ws in words[::5]]
        known, total = (np.array([s[k] for s in shares if s[1]], float) for k in (0, 1))
        self.usual = float(known.sum() / total.sum()) if len(total) >= LEAST else 0.0
        short = self.usual - known / np.maximum(total, 1)
        self.spread = float((short * np.sqrt(total)).max(initial=0.0))

    @staticmethod
    def of(word: str) -> list[str]:
        edged = f"\x02{word}\x03"
        return [edged[i : i + 3] for i in range(len(edged) - 2)]

    def count(self, words: list[str]) -> tuple[int, int]:
        found = [g in self.grams for w in words for g in self.of(w)]
        return sum(found), len(found)

    def least(self, total: float) -> float:
        """The share that a text of so many threes needs."""
        return self.usual - max(SHORT, SLACK * self.spread / max(total, 1.0) ** 0.5)


class Model:
    def __init__(self, languages: list[str], weights: np.ndarray, trans: np.ndarray, familiar: Familiar | None = None):
        self.languages, self.weights, self.trans = languages, weights, trans
        self.familiar = familiar
        self.counts = np.zeros((0, 2), np.int32)
        self.known = WordMemory(MEMORY, EACH)
        self.scores = np.zeros((0, len(languages)), np.float32)

    def numbers(self, words: list[str]) -> np.ndarray:
        """Places of the words in ``scores`` (and ``counts``); words not met before are scored."""
        known = self.known
        fresh = [w for w in dict.fromkeys(words) if w not in known]
        if fresh:
            if not known.has_room(fresh):
                self.scores, self.counts = self.scores[:0], self.counts[:0]
                fresh = list(dict.fromkeys(words))
                known.has_room(fresh)
            found = []
            for i in range(0, len(fresh), 20_000):
                ids, begin = word_features(fresh[i : i + 20_000])
                found.append(np.add.reduceat(self.weights[ids], begin[:-1], axis=0))
            known.update(zip(fresh, range(len(self.scores), len(self.scores) + len(fresh))))
            self.scores = np.concatenate([self.scores, *found])
            if self.familiar:
                met = np.array([self.familiar.count([w]) for w in fresh], np.int32)
                self.counts = np.concatenate([self.counts, met])
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def word_scores(self, words: list[str]) -> np.ndarray:
        at = self.numbers(words)
        return self.scores[at]

    def is_familiar(self, words: list[str]) -> bool:
        """Whether the letters of the words are what the sampled languages are written with."""
        if not self.familiar or not words:
            return bool(words)
        at = np.unique(self.numbers(words))
        known, total = self.counts[at].sum(axis=0, dtype=np.int64)
        return bool(known >= self.familiar.least(total) * total)

    def label_words(self, texts: list[str | None]) -> list[tuple[list[str], np.ndarray]]:
        """Words of each text and their marginals over ``languages``."""
        words = [WORD.findall(t.lower()) if t else [] for t in texts]
        lengths = np.array([len(w) for w in words], np.int64)
        full = np.flatnonzero(lengths)
        flat = [w for ws in words for w in ws]
        if not flat or not self.languages:
            return [(w, np.zeros((len(w), len(self.languages)), np.float32)) for w in words]
        marginals, _ = forward_backward(self.word_scores(flat), lengths[full], self.trans)
        ends = np.cumsum(lengths)
        return [(w, marginals[e - len(w) : e]) for w, e in zip(words, ends)]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        return self.judge(texts)[:2]

    def judge(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        """Language, score and whether the text is familiar, for each text."""
        names, scores, familiar = [], [], []
        foreign = self.languages.index(FOREIGN) if FOREIGN in self.languages else None
        for words, marginals in self.label_words(texts):
            familiar.append(self.is_familiar(words))
            if not len(words) or not self.languages:
                names.append(NONE)
                scores.append(0.0)
                continue
            mean = marginals.mean(axis=0, dtype=np.float64)
            if foreign is not None and mean[foreign] > MOST_FOREIGN:
                names.append(NONE)
                scores.append(float(min(1.0, mean[foreign])))
                continue
            if foreign is not None:
                mean[foreign] = -1.0
            best = int(mean.argmax())
            names.append(self.languages[best])
            scores.append(float(min(1.0, mean[best])))
        return names, scores, familiar


def foreign_texts(texts: list[str], seed: int = 13) -> list[str]:
    """For each text one of as many words, as long as its own, in no language.

    Its letters are in turn the text's own in another order, drawn from the text's alphabet, or from another script.
    """
    rng = np.random.default_rng(seed)
    letters = [c for c in map(chr, range(0x110000)) if c.isalpha()]
    made = []
    for k, text in enumerate(texts):
        words = WORD.findall(text.lower())
        own = list("".join(words))
        if k % 3 == 0:
            rng.shuffle(own)
        elif own:
            at = int(rng.integers(len(letters) - SCRIPT))
            alphabet = sorted(set(own)) if k % 3 == 1 else letters[at : at + SCRIPT]
            own = [alphabet[i] for i in rng.integers(len(alphabet), size=len(own))]
        ends = np.cumsum([len(w) for w in words]).tolist()
        made.append(" ".join("".join(own[e - len(w) : e]) for w, e in zip(words, ends)))
    return made


def train(texts: list[str], labels: list[str], seed: int = 11, foreign: int = 0) -> Model:
    """Fit features and transitions by stochastic gradients (AdaGrad) on spliced sequences.

    ``foreign``: of so many texts at most, spread over all, foreign ones are made for the label of no language.
    """
    sampled = texts
    if foreign and texts:
        made = foreign_texts([texts[i] for i in np.unique(np.linspace(0, len(texts) - 1, foreign, dtype=int))])
        texts, labels = [*texts, *made], [*labels, *[FOREIGN] * len(made)]
    languages = sorted(set(labels))
    weights = np.zeros((1 << BITS, len(languages)), np.float32)
    trans = np.zeros((len(languages),) * 2, np.float32)
    if not languages:
        return Model(languages, weights, trans)
    rng = np.random.default_rng(seed)
    pieces: list[tuple[int, list[str]]] = []
    for text, label in zip(texts, labels):
        words, at = WORD.findall(text.lower()), 0
        while at < len(words):
            n = 1 + int(rng.geometric(1 / 24))
            pieces.append((languages.index(label), words[at : at + n]))
            at += n
    square, square_t = np.full_like(weights, 1e-2), np.full_like(trans, 1e-2)
    for epoch in range(EPOCHS):
        rng.shuffle(pieces)
        flat = [w for _, ws in pieces for w in ws]
        gold = np.concatenate([np.full(len(ws), k) for k, ws in pieces]) if pieces else np.zeros(0, int)
        for at in range(0, len(flat), LENGTH * 32):
            words, want = flat[at : at + LENGTH * 32], gold[at : at + LENGTH * 32]
            lengths = np.full(-(-len(words) // LENGTH), LENGTH)
            lengths[-1] = len(words) - LENGTH * (len(lengths) - 1)
            ids, begin = word_features(words)
            scores = np.add.reduceat(weights[ids], begin[:-1], axis=0)
            marginals, expected = forward_backward(scores, lengths, trans, pairs=True)
            marginals[np.arange(len(want)), want] -= 1
            grad = np.zeros_like(weights)
            np.add.at(grad, ids, np.repeat(marginals, np.diff(begin), axis=0))
            used = np.unique(ids)
            g = grad[used] / len(lengths) + SHRINK * weights[used]
            square[used] += g * g
            weights[used] -= RATE * g / np.sqrt(square[used])
            inner = np.ones(len(want), bool)
            inner[np.cumsum(lengths) - lengths] = False
            to = np.flatnonzero(inner)
            np.add.at(expected, (want[to - 1], want[to]), -1)
            g = expected / len(lengths) + SHRINK * trans
            square_t += g * g
            trans -= RATE * 0.2 * g / np.sqrt(square_t)
    return Model(languages, weights, trans, Familiar(sampled))


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", sample: int = SAMPLE, foreign: bool = False) -> Model:
    """Train on at most about ``sample`` rows a language that are not held out, cut by hash, whichever the table's size.

    With ``foreign`` the model also tells texts in none of the languages, which are then ``und``.
    """
    rows = docs.where(~held_out(key) & F.col(label).isNotNull() & F.col(text).isNotNull() & (F.length(text) <= SAMPLE_CHARS))
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    if not counts:
        return train([], [])
    share = F.lit(0.0)
    for name in sorted(counts):
        share = F.when(F.col(label) == name, min(1.0, sample / counts[name])).otherwise(share)
    drawn = (hash_order(key) + F.lit(0)) / F.lit(2.0**64) + 0.5 < share
    taken = rows.where(drawn).select(key, text, label).orderBy(hash_order(key), text).limit(2 * sample * len(counts)).collect()
    model = train([r[1] for r in taken], [r[2] for r in taken], foreign=sample if foreign else 0)
    taken = None
    let_go()
    return model


def identify(
    docs: DataFrame, model: Model, keys: list[str], text: str = "text", names: tuple[str, str] = ("lang_pred", "score"), familiar: str | None = None
) -> DataFrame:
    """``keys``, lang_pred and score (or other ``names``, where keys are named so) for every row.

    ``familiar`` names one more column: whether the text is written as the learned languages are. The score
    cannot tell, as it shares out certainty among the learned languages whatever the text.
    """
    kinds = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)
    parts = (model.languages, model.weights, model.trans, model.familiar if familiar else None)

    def work(batch: pa.RecordBatch, own: Model) -> pa.RecordBatch:
        found, scores, usual = [], [], []
        texts = batch.column(len(keys)).to_pylist()
        for i in range(0, len(texts), 1000):
            a, b, c = own.judge(texts[i : i + 1000])
            found += a
            scores += b
            usual += c
        made = [pa.array(found, pa.string()), pa.array(scores, pa.float64()), *([pa.array(usual, pa.bool_())] if familiar else [])]
        return pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], *made], [*keys, *names, *([familiar] if familiar else [])])

    rows = docs.select(*[F.col(f"`{k}`") for k in keys], F.col(text).cast("string").alias("__text"))
    more = f", `{familiar}` boolean" if familiar else ""
    return in_batches(rows, f"{kinds}, `{names[0]}` string, `{names[1]}` double{more}", work, lambda: Model(*parts))
