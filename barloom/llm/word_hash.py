"""Hashed features of words: character n-grams with the word's edges, and the word itself."""

from __future__ import annotations

import numpy as np
import regex

#: Letters only: numbers such as a half or a raised two are none.
WORD = regex.compile(r"\p{L}+")
#: Features are hashed to so many bits; n-grams have these lengths, the word's two edges included.
BITS, GRAMS = 17, range(2, 6)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids of words, one word after the other, and where each begins (one more entry at the end).

    The n-grams of a word come first, the word itself last.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    joined = "".join([f"\x02{w}\x03" for w in words]).encode("utf-32-le", "surrogatepass")
    letters = np.frombuffer(joined, np.uint32).astype(np.uint64)
    ends = np.cumsum(lengths)
    left = np.repeat(ends, lengths) - np.arange(len(letters))  # letters up to the word's end, this one included
    ids = np.zeros((len(letters), len(GRAMS) + 1), np.uint64)
    valid = np.zeros(ids.shape, bool)
    gram = letters
    for column, n in enumerate(GRAMS):
        gram = gram[: len(letters) - n + 1] * _STEP + letters[n - 1 :]
        ids[: len(gram), column] = gram + np.uint64(n)
        valid[:, column] = left >= n
    weights = np.power(_STEP, np.arange(int(lengths.max(initial=1)), dtype=np.uint64))
    ids[ends - 1, -1] = np.add.reduceat(letters * weights[left - 1], ends - lengths) + np.uint64(99)
    valid[ends - 1, -1] = True
    found = ids[valid]
    found = (found ^ (found >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    found = ((found ^ (found >> np.uint64(29))) >> np.uint64(64 - BITS)).astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(np.add.reduceat(valid.sum(axis=1), ends - lengths))])
    return found, begin
