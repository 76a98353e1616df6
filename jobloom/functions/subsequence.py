"""Length of the longest common subsequence as an Arrow-batched function.

The rows of the usual table are kept as bits of machine words, so a column of the table costs a few operations for a whole batch
of pairs at once. Built from Spark expressions, or pair by pair in Python, the same takes ten times as long and more.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = 64
#: Words of the table (pairs, characters, words) that are held at a time.
HELD_WORDS = 1 << 16


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in one array, and the lengths of the texts."""
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat, np.fromiter(map(len, texts), np.int64, len(texts))


def _padded(flat: np.ndarray, sizes: np.ndarray, pad: int) -> np.ndarray:
    """A row for each text, filled up with ``pad``."""
    out = np.full((len(sizes), int(sizes.max(initial=0))), pad, np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def common_lengths(a: list[str], b: list[str]) -> np.ndarray:
    """For each pair the length of the longest common subsequence."""
    (flat_a, size_a), (flat_b, size_b) = _codes(a), _codes(b)
    used = np.zeros(1 + max(flat_a.max(initial=0), flat_b.max(initial=0)), bool)
    used[flat_a] = used[flat_b] = True
    number = np.cumsum(used) - 1
    n_chars = int(number[-1]) + 1
    code_a, code_b = number[flat_a], number[flat_b]
    starts_a, starts_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
    out = np.zeros(len(a), np.int64)
    words = -(-int(size_a.max(initial=0)) // WORD)
    step = max(1, HELD_WORDS // max(1, (n_chars + 1) * words))
    for k in range(0, len(a), step):
        part = slice(k, k + step)
        sa, sb = size_a[part], size_b[part]
        own = _padded(code_a[starts_a[k] : starts_a[k] + int(sa.sum())], sa, n_chars)
        other = _padded(code_b[starts_b[k] : starts_b[k] + int(sb.sum())], sb, n_chars)
        out[part] = _table(own, sa, other, n_chars)
    return out


def _table(own: np.ndarray, sizes: np.ndarray, other: np.ndarray, pad: int) -> np.ndarray:
    """Runs over the columns of ``other``; bit i of a pair's words is off where row i of its table steps up."""
    n, words, width = len(own), -(-own.shape[1] // WORD), pad + 1
    base = np.arange(n) * width
    own, other = np.ascontiguousarray(own.T) + base, np.ascontiguousarray(other.T) + base
    places = np.zeros((words, n * width), np.uint64)  # where a character stands in ``own``; a padding one nowhere
    for i, at in enumerate(own):
        places[i // WORD][at] |= np.uint64(1 << i % WORD)
    places[:, base + pad] = 0
    free = np.full((words, n), ~np.uint64(0))
    for at in other:
        carry = np.uint64(0)
        for w in range(words):
            now = free[w]
            hit = now & places[w].take(at)
            total = now + hit
            over = total < hit
            if w:
                total += carry
                over |= total < carry
            free[w] = total | (now - hit)
            carry = over.astype(np.uint64) if w + 1 < words else carry
    bits = np.arange(words)[:, None] * WORD
    inside = np.clip(sizes[None, :] - bits, 0, WORD)
    mask = np.where(inside >= WORD, ~np.uint64(0), (np.uint64(1) << np.minimum(inside, WORD - 1).astype(np.uint64)) - np.uint64(1))
    return np.bitwise_count(~free & mask).sum(axis=0, dtype=np.int64)


def _lengths(a: pd.Series, b: pd.Series) -> pd.Series:
    known = a.notna() & b.notna()
    found = pd.Series([None] * len(a), dtype="Int32")
    if known.any():
        found[known.to_numpy()] = common_lengths(a[known].tolist(), b[known].tolist())
    return found


def common_subsequence_length(a: Column, b: Column) -> Column:
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    return F.pandas_udf(T.IntegerType())(_lengths)(a, b)
