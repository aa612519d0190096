"""Byte-level BPE by way of a sentencepiece model written straight from the vocabulary.

A byte-level vocabulary holds byte strings and their ranks. Every byte is mapped to a printable
code point, so that each entry becomes a piece of text; its score is the negative rank, so that
sentencepiece joins pairs in the order of the ranks. The model's normalisation is the identity
and nothing is trained. Pre-tokens are encoded one by one; decoding maps ids back to bytes.

Nulls count as empty text and give no ids. Texts may have any length: a task holds one Arrow
batch and a bounded cache of pre-tokens. Repeated rows are encoded alike; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from array import array

import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import WordMemory, in_batches

#: Field types of the model file, after its public definition.
NORMAL, UNKNOWN, BPE = 1, 2, 2
#: Bytes that the pre-tokens a worker remembers may take, and what one takes beside its letters; beyond it the memory starts anew.
MEMORY, EACH = 64 << 20, 200


def read_ranks(path: str) -> dict[bytes, int]:
    """Lines of base64 and rank, as in a ``.tiktoken`` file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def byte_letters() -> list[str]:
    """For each byte a code point of its own: itself if it is printable, else one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: int | float | bytes) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """The serialised model; piece ids are the ranks, the unknown piece comes last."""
    letters = byte_letters()
    by_rank = sorted(ranks.items(), key=lambda kv: kv[1])
    if [rank for _, rank in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must run from 0 without gaps")
    out = bytearray()
    for token, rank in by_rank:
        piece = "".join(letters[b] for b in token).encode()
        out += _field(1, _field(1, piece) + _field(2, -float(rank)) + _field(3, NORMAL))
    out += _field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, UNKNOWN))
    absent = _varint((1 << 64) - 1)  # -1
    trainer = _field(3, BPE) + _field(4, len(by_rank) + 1) + _field(40, len(by_rank))
    trainer += b"".join(_varint(n << 3) + absent for n in (41, 42, 43))
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return bytes(out + _field(2, trainer) + _field(3, normalizer))


class Codec:
    """Encodes texts to little-endian 32-bit ids and decodes them."""

    def __init__(self, model: bytes, tokens: list[bytes], pattern: str):
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.tokens = tokens
        self.whole = {t: i for i, t in enumerate(tokens)}
        self.pattern = regex.compile(pattern)
        self.letters = dict(enumerate(byte_letters()))
        self.known = WordMemory(MEMORY, EACH)

    def _learn(self, fresh: list[str]) -> None:
        """Encode pre-tokens not seen yet: a whole vocabulary entry is itself, the rest is merged."""
        self.known.has_room(fresh)
        rest = []
        for word in fresh:
            rank = self.whole.get(word.encode())
            if rank is None:
                rest.append(word)
            else:
                self.known[word] = struct.pack("<I", rank)
        mapped = [word.encode().decode("latin-1").translate(self.letters) for word in rest]
        for word, ids in zip(rest, self.pieces.encode(mapped, num_threads=1)):
            self.known[word] = array("I", ids).tobytes()

    def encode(self, text: str) -> bytes:
        words = self.pattern.findall(text)
        try:
            return b"".join(map(self.known.__getitem__, words))
        except KeyError:
            self._learn([w for w in dict.fromkeys(words) if w not in self.known])
        known = self.known
        if any(w not in known for w in words):  # the memory was started anew
            self._learn(list(dict.fromkeys(words)))
        return b"".join(map(self.known.__getitem__, words))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(ids).cast("I")))


def codec_factory(path: str, pattern: str):
    """Read the vocabulary on the driver and return what builds a codec in a task.

    The model is about a megabyte, fixed by the vocabulary, and travels with the tasks.
    """
    ranks = read_ranks(path)
    model = model_bytes(ranks)
    tokens = [t for t, _ in sorted(ranks.items(), key=lambda kv: kv[1])]
    return lambda: Codec(model, tokens, pattern)


def encode(docs: DataFrame, path: str, pattern: str, keys: list[str], text: str = "text") -> DataFrame:
    """``keys``, the ids and the bytes they decode to, for every row of ``docs``.

    Returns keys, n_tokens int64, ids binary (little-endian unsigned 32-bit) and decoded binary.
    """
    factory = codec_factory(path, pattern)
    kinds = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)

    def work(batch: pa.RecordBatch, codec: Codec) -> pa.RecordBatch:
        ids = [codec.encode(t or "") for t in batch.column(len(keys)).to_pylist()]
        made = [
            pa.array([len(x) // 4 for x in ids], pa.int64()),
            pa.array(ids, pa.binary()),
            pa.array([codec.decode(x) for x in ids], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], *made], [*keys, "n_tokens", "ids", "decoded"])

    rows = docs.select(*[F.col(f"`{k}`") for k in keys], F.col(text).cast("string").alias("__text"))
    return in_batches(rows, f"{kinds}, n_tokens long, ids binary, decoded binary", work, factory)


def encode_digests(docs: DataFrame, path: str, pattern: str, keys: list[str], text: str = "text") -> DataFrame:
    """As :func:`encode`, with SHA-256 digests made in the task in place of the bytes."""
    factory = codec_factory(path, pattern)
    kinds = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)

    def work(batch: pa.RecordBatch, codec: Codec) -> pa.RecordBatch:
        n, a, b = [], [], []
        for t in batch.column(len(keys)).to_pylist():
            ids = codec.encode(t or "")
            n.append(len(ids) // 4)
            a.append(hashlib.sha256(ids).hexdigest())
            b.append(hashlib.sha256(codec.decode(ids)).hexdigest())
        made = [pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[: len(keys)], *made], [*keys, "n_tokens", "ids_sha256", "decoded_sha256"]
        )

    rows = docs.select(*[F.col(f"`{k}`") for k in keys], F.col(text).cast("string").alias("__text"))
    return in_batches(rows, f"{kinds}, n_tokens long, ids_sha256 string, decoded_sha256 string", work, factory)
