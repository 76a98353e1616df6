"""Word shingles of whole texts as 64-bit hashes, for a frame of texts at a time."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import xxhash

from jobloom.llm.common import find_words

WORDS = 5
_M1, _M2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers (the finisher of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Hashes of the runs of five words of each text; a shorter text with a word is one shingle of all its words."""

    def __init__(self, remembered: int = 100_000):
        self.remembered = remembered
        self.places: dict[str, int] = {}
        self.hashes = np.zeros(0, np.uint64)

    def shingles(self, texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all shingles in order, and the place of the text that each belongs to (ascending)."""
        if len(self.places) > self.remembered:
            self.places, self.hashes = {}, self.hashes[:0]
        known, places = len(self.places), self.places
        words, counts = [], []
        for text in texts:
            found = find_words(text) if isinstance(text, str) else []
            words.append(np.array([places.setdefault(w, len(places)) for w in found], np.int64))
            counts.append(len(found))
        fresh = [xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in list(places)[known:]]
        self.hashes = np.concatenate([self.hashes, np.array(fresh, np.uint64)])
        n = np.array(counts, np.int64)
        code = self.hashes[np.concatenate(words)] if words else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(n)), n)
        starts = np.cumsum(n) - n
        place = np.arange(len(code)) - starts[owner]
        size = np.minimum(n, WORDS)[owner]
        first = place <= (n[owner] - size)  # where a shingle begins
        at = np.flatnonzero(first)
        value = np.zeros(len(at), np.uint64)
        for k in range(WORDS):
            inside = k < size[at]
            word = np.where(inside, code[np.minimum(at + k, len(code) - 1)], np.uint64(0)) if len(code) else value
            value = mixed(value + word + np.uint64((k + 1) * int(_STEP) & 0xFFFFFFFFFFFFFFFF))
        return value, owner[at]


def numbered(value: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner and value of the distinct shingles of each text, with how often each stands there."""
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(new)
    return owner[starts], value[starts], np.diff(np.append(starts, len(value)))
