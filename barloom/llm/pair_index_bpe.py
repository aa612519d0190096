"""Byte-level BPE with word ends, by an index from each pair to all its positions in a partition.

Texts are normalised and cut into words as the tokenizer file says. The words of a partition that were not
met before are laid out as one array of symbols with links to the neighbours, and an index maps the rank of every
pair that a merge exists for to all positions where it stands. The ranks that have positions (the active ones) are applied
in ascending order: all places of a pair are joined at once, left to right where they overlap, and the lists of the
pairs that come into being beside them are extended. A merge file in which every part is made before it is
used has no pair that comes up again with a lower rank, so this gives what joining the best pair of one word after the
other gives; other files are refused.

Special tokens stand for themselves wherever their strings occur. Decoding joins the tokens of the ids with spaces
(the file names no decoder), special ones included.

Nulls count as empty text and give no ids. Texts may have any length: words are numbered as they are met, texts
become arrays of numbers, and a task forgets its words once they take ``MEMORY`` bytes. Repeated rows are encoded
alike; a table without rows gives none; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barloom.llm.common import in_batches
from barloom.llm.spm_bpe import byte_letters

#: Bytes that the words a task remembers may take, and letters of text worked on at a time.
MEMORY, LETTERS = 96 << 20, 8 << 20
#: What a remembered word takes beside its own letters and ids, roughly.
OVERHEAD = 220


class Vocabulary:
    """What a tokenizer file says, checked for being of the kind this module applies."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            self.source = file.read()
        data = json.loads(self.source)
        model, before = data["model"], data["pre_tokenizer"]["pretokenizers"]
        steps = [n["type"] for n in data["normalizer"]["normalizers"]]
        split, letters = before[0], before[-1]
        known = (
            model["type"] == "BPE" and not model["dropout"] and not model["ignore_merges"] and not model["byte_fallback"]
            and not model["continuing_subword_prefix"] and steps == ["NFC", "Replace", "Lowercase"]
            and [n["type"] for n in before] == ["Split", "ByteLevel"] and split["behavior"] == "Removed" and split["invert"]
            and not letters["add_prefix_space"] and not letters["use_regex"] and not data["decoder"] and not data["post_processor"]
        )
        specials = [t for t in data["added_tokens"] if t["special"] and not (t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"])]
        if not known or len(specials) != len(data["added_tokens"]):
            raise ValueError(f"{path}: not a lower-casing byte-level BPE with plain special tokens")
        ids = model["vocab"]
        end = model["end_of_word_suffix"] or ""
        self.pattern = split["pattern"]["Regex"]
        self.specials = {t["content"]: t["id"] for t in specials}
        self.tokens = {**{i: t for t, i in ids.items()}, **{i: t for t, i in self.specials.items()}}
        self.inner = np.array([ids[x] for x in byte_letters()], np.int32)
        self.final = np.array([ids[x + end] for x in byte_letters()], np.int32)
        parts = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.left = np.array([ids[a] for a, _ in parts], np.int64)
        self.right = np.array([ids[b] for _, b in parts], np.int64)
        self.made = np.array([ids[a + b] for a, b in parts], np.int64)
        born = np.full(max(ids.values()) + 1, -1)
        born[self.made] = np.arange(len(parts))
        at = np.arange(len(parts))
        if len(np.unique(self.made)) < len(parts) or (born[self.left] >= at).any() or (born[self.right] >= at).any():
            raise ValueError(f"{path}: a merge uses what a later merge makes")


class PairIndex:
    """Applies merges to many words at once."""

    def __init__(self, words: Vocabulary):
        self.left, self.right, self.made = words.left, words.right, words.made
        keys = self.left << 32 | self.right
        self.rank = np.argsort(keys)
        self.keys = keys[self.rank]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, -1 where no merge joins them."""
        wanted = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.rank[at], -1)

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols left of words laid end to end, and how many each word has."""
        n = len(symbols)
        symbol = np.append(symbols, -1)  # the place n stands for no neighbour
        ends = np.cumsum(lengths)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[ends - 1] = n
        before[ends - lengths] = n
        positions: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def extend(places: np.ndarray) -> None:
            places = places[after[places] < n]
            ranks = self.ranks(symbol[places], symbol[after[places]])
            there = ranks >= 0
            ranks, places = ranks[there], places[there]
            order = np.argsort(ranks, kind="stable")
            ranks, places = ranks[order], places[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            for rank, part in zip(ranks[np.append(0, cuts)].tolist() if len(ranks) else [], np.split(places, cuts)):
                if rank not in positions:
                    positions[rank] = []
                    heapq.heappush(active, rank)
                positions[rank].append(part)

        extend(np.arange(n))
        while active:
            rank = heapq.heappop(active)
            held = positions.pop(rank)
            places = held[0] if len(held) == 1 else np.concatenate(held)
            a, b = self.left[rank], self.right[rank]
            places = places[(symbol[places] == a) & (symbol[after[places]] == b)]
            if a == b and len(places) > 1:
                places = _apart(np.sort(places), after)
            if not len(places):
                continue
            gone = after[places]
            far = after[gone]
            symbol[places], symbol[gone] = self.made[rank], -1
            after[places] = far
            before[far] = places
            earlier = before[places]
            extend(np.unique(np.concatenate([places, earlier[earlier < n]])))
        kept = symbol[:n] >= 0
        counted = np.concatenate([[0], np.cumsum(kept)])
        return symbol[:n][kept], counted[ends] - counted[ends - lengths]


def _apart(places: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of places in runs that overlap, every second one from the left."""
    begins = np.append(True, after[places[:-1]] != places[1:])
    at = np.arange(len(places))
    return places[(at - np.maximum.accumulate(np.where(begins, at, 0))) % 2 == 0]


class _Numbers(dict):
    """Numbers words as they are asked for."""

    def __init__(self, fresh: list[str]):
        super().__init__()
        self.fresh = fresh

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.fresh.append(word)
        return number


class Codec:
    """Encodes texts to ids and decodes them; remembers words within ``memory`` bytes."""

    def __init__(self, words: Vocabulary, memory: int = MEMORY):
        self.index = PairIndex(words)
        self.words = words
        self.memory = memory
        self.pattern = regex.compile(words.pattern)
        self.plain: set[str] = set()  # characters met that this Python's tables know
        self.special = re.compile("(" + "|".join(map(re.escape, words.specials)) + ")") if words.specials else None
        self.library = Tokenizer.from_str(words.source)
        self.byte_of = {x: b for b, x in enumerate(byte_letters())}
        self.forget()

    def forget(self) -> None:
        self.fresh: list[str] = []
        self.numbers = _Numbers(self.fresh)
        self.ids = np.zeros(0, np.int32)
        self.begin = np.zeros(1, np.int64)
        self.taken = 0

    def known(self, text: str) -> bool:
        """Whether no character of the text is newer than this Python's tables."""
        met = set(text) - self.plain
        self.plain.update(c for c in met if unicodedata.category(c) != "Cn")
        return met <= self.plain

    def cut(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        if not text.isascii():
            if not self.known(text):
                found = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
                return [bytes(map(self.byte_of.__getitem__, w)).decode() for w, _ in found]
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # letters are lowered one by one
        return self.pattern.findall(text.lower())

    def numbered(self, text: str) -> np.ndarray:
        """The text as numbers of words; special token s as -1 - its id."""
        if self.special is None or not any(s in text for s in self.words.specials):
            return np.fromiter(map(self.numbers.__getitem__, self.cut(text)), np.int64)
        out = []
        for i, part in enumerate(self.special.split(text)):
            if i % 2:
                out.append(-1 - self.words.specials[part])
            else:
                out += map(self.numbers.__getitem__, self.cut(part))
        return np.array(out, np.int64)

    def learn(self) -> None:
        """Merge the words that were numbered since the last time."""
        if not self.fresh:
            return
        coded = [w.encode() for w in self.fresh]
        lengths = np.fromiter(map(len, coded), np.int64, len(coded))
        flat = np.frombuffer(b"".join(coded), np.uint8)
        symbols = self.words.inner[flat].astype(np.int64)
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.words.final[flat[ends]]
        ids, counts = self.index.merge(symbols, lengths)
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(counts)])
        self.taken += len(flat) + 4 * len(ids) + OVERHEAD * len(coded)
        self.fresh.clear()

    def gather(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of a numbered text."""
        special = numbers < 0
        if not len(self.ids):
            return -1 - numbers
        at = np.where(special, 0, numbers)
        counts = np.where(special, 1, self.begin[at + 1] - self.begin[at])
        ends = np.cumsum(counts)
        place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.begin[at] - ends + counts, counts)
        out = self.ids[place].astype(np.int64)
        out[ends[special] - 1] = -1 - numbers[special]
        return out

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text, little-endian 32-bit."""
        held: list[np.ndarray] = []
        letters = 0
        for text in texts:
            held.append(self.numbered(text))
            letters += len(text)
            if letters > LETTERS:
                yield from self._given(held)
                held, letters = [], 0
        yield from self._given(held)

    def _given(self, held: list[np.ndarray]) -> Iterator[np.ndarray]:
        self.learn()
        for numbers in held:
            yield self.gather(numbers).astype("<u4")
        if self.taken > self.memory:
            self.forget()

    def decode(self, ids: np.ndarray) -> str:
        return " ".join(map(self.words.tokens.__getitem__, ids.tolist()))


def encode(docs: DataFrame, path: str, keys: list[str], text: str = "text") -> DataFrame:
    """``keys``, n_tokens int64, ids binary (little-endian unsigned 32-bit) and decoded string of every row of ``docs``."""
    return _coded(
        docs, path, keys, text, "ids binary, decoded string",
        lambda ids, decoded: (ids, decoded), (pa.binary(), pa.string()),
    )


def encode_digests(docs: DataFrame, path: str, keys: list[str], text: str = "text") -> DataFrame:
    """As :func:`encode`, with SHA-256 digests made in the task in place of ids and decoded text."""
    return _coded(
        docs, path, keys, text, "ids_sha256 string, decoded_sha256 string",
        lambda ids, decoded: (hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()),
        (pa.string(), pa.string()),
    )


def _coded(docs: DataFrame, path: str, keys: list[str], text: str, shown: str, show, types) -> DataFrame:
    words = Vocabulary(path)  # a few megabytes, fixed by the file; travels with the tasks
    kinds = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)
    names = [*keys, "n_tokens", *[c.split(" ")[0] for c in shown.split(", ")]]

    def work(batch: pa.RecordBatch, codec: Codec) -> pa.RecordBatch:
        n, made = [], []
        for ids in codec.encode([t or "" for t in batch.column(len(keys)).to_pylist()]):
            n.append(len(ids))
            made.append(show(ids.tobytes(), codec.decode(ids)))
        columns = [pa.array(n, pa.int64()), *[pa.array([m[i] for m in made], t) for i, t in enumerate(types)]]
        return pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], *columns], names)

    rows = docs.select(*[F.col(f"`{k}`") for k in keys], F.col(text).cast("string").alias("__text"))
    return in_batches(rows, f"{kinds}, n_tokens long, {shown}", work, lambda: Codec(words))


def decode(coded: DataFrame, path: str, keys: list[str], ids: str = "ids") -> DataFrame:
    """``keys`` and the text of stored ids (binary, little-endian unsigned 32-bit); null ids give null."""
    tokens = Vocabulary(path).tokens
    kinds = ", ".join(f"`{k}` {coded.schema[k].dataType.simpleString()}" for k in keys)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [
            None if x is None else " ".join(map(tokens.__getitem__, np.frombuffer(x, "<u4").tolist()))
            for x in batch.column(len(keys)).to_pylist()
        ]
        return pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], pa.array(texts, pa.string())], [*keys, "decoded"])

    rows = coded.select(*[F.col(f"`{k}`") for k in keys], F.col(ids).alias("__ids"))
    return in_batches(rows, f"{kinds}, decoded string", work)
