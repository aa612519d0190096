"""Sets of word shingles as sorted 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

from barloom.llm.common import WordMemory

#: Bytes that the words a worker remembers the hash of may take, and what one takes beside its letters.
MEMORY, EACH = 32 << 20, 160
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class Shingler:
    """Words are runs of bytes other than ASCII white space, A-Z lower-cased; a shingle is ``width`` of them."""

    def __init__(self, width: int):
        self.width = width
        self.known = WordMemory(MEMORY, EACH)

    def words(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split()
        known = self.known
        try:
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            fresh = [w for w in dict.fromkeys(words) if w not in known]
            if not known.has_room(fresh):
                fresh = list(dict.fromkeys(words))
                if not known.has_room(fresh):  # more words than are ever remembered
                    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
            known.update(zip(fresh, map(xxhash.xxh64_intdigest, fresh)))
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def set(self, text: str | None) -> np.ndarray:
        """Distinct shingles, ascending; with fewer words than a shingle has, the whole sequence as one."""
        words = self.words(text) if text else np.zeros(0, np.uint64)
        if not len(words):
            return words
        width = min(self.width, len(words))
        out = np.full(len(words) - width + 1, width, np.uint64)
        for i in range(width):
            out = (out ^ words[i : len(words) - width + 1 + i]) * _A
            out ^= out >> np.uint64(29)
        out *= _B
        return np.unique(out ^ (out >> np.uint64(32)))
