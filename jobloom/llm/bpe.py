"""Byte-pair encoding and decoding with a pair occurrence index.

A task gathers the distinct words of a large frame of texts into one run of symbols and maps each pair of neighbours to all
its positions. Active ranks are then applied in ascending order: the lowest rank merges at all its positions at once, in
every word, and only the lists of the pairs beside those positions change. A merge can only give rise to pairs of higher
rank than its own, which loading the vocabulary proves, so this order gives what merging word by word gives.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import appended, modest_batches

#: Characters of text handled at a time, and distinct words a task remembers.
GROUP_CHARS, REMEMBERED = 500_000, 100_000
END = "</w>"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it prints, else the next from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


@dataclass
class Vocabulary:
    """A word-end BPE vocabulary: pair keys in ascending order with their ranks, merged symbols by rank."""

    tokens: list[str]
    inner: np.ndarray  # symbol of a byte inside a word
    final: np.ndarray  # symbol of a byte that ends a word
    keys: np.ndarray
    ranks: np.ndarray
    pairs: np.ndarray  # rank, left and right
    merged: np.ndarray
    special: dict[str, int]
    pattern: str

    @staticmethod
    def load(path: str) -> Vocabulary:
        """Read a vocabulary file of the layout of word_bpe_49k.json; others are refused."""
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, splits = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["end_of_word_suffix"] != END or steps != ["NFC", "Replace", "Lowercase"] or spec["decoder"]:
            raise ValueError("only word-end vocabularies of lower-case text are read here")
        ids = model["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = [""] * (max([*ids.values(), *special.values()]) + 1)
        for token, i in (ids | special).items():
            tokens[i] = token
        pairs = np.array([(ids[a], ids[b]) for a, b in model["merges"]], np.int64)
        merged = np.array([ids[a + b] for a, b in model["merges"]], np.int64)
        made = dict(zip(merged.tolist(), range(len(merged)), strict=True))
        if any(made.get(int(part), -1) >= rank for rank, pair in enumerate(pairs) for part in pair):
            raise ValueError("a merge uses a symbol that a later merge makes")
        keys = pairs[:, 0] << 32 | pairs[:, 1]
        order = np.argsort(keys)
        symbols = byte_symbols()
        return Vocabulary(
            tokens, np.array([ids[s] for s in symbols]), np.array([ids[s + END] for s in symbols]),
            keys[order], order, pairs, merged, special, splits[0]["pattern"]["Regex"],
        )

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of symbols; -1 where there is none."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key).clip(0, len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], -1)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary.load(path)


def merge_words(words: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all words one after another, and where each word's symbols begin (and the end)."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate([[0], np.cumsum(lengths)])
    data = np.frombuffer(b"".join(words), np.uint8)
    size = len(data)
    symbol = vocab.inner[data]
    symbol[starts[1:] - 1] = vocab.final[data[starts[1:] - 1]]
    after = np.arange(1, size + 1)
    after[starts[1:] - 1] = size  # size: no neighbour
    before = np.arange(-1, size - 1)
    before[starts[:-1]] = size
    symbol, after, before = np.append(symbol, -1), np.append(after, size), np.append(before, size)

    occurrences: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def note(positions: np.ndarray) -> None:
        """Enter pairs that begin at these positions into the index."""
        rank = vocab.ranks_of(symbol[positions], symbol[after[positions]])
        known = rank >= 0
        positions, rank = positions[known], rank[known]
        if not len(rank):
            return
        order = np.argsort(rank, kind="stable")
        positions, rank = positions[order], rank[order]
        cuts = np.flatnonzero(np.diff(rank)) + 1
        first = rank[np.concatenate([[0], cuts])].tolist()
        for r, part in zip(first, np.split(positions, cuts) if len(cuts) else [positions], strict=True):
            if r in occurrences:
                occurrences[r].append(part)
            else:
                occurrences[r] = [part]
                heapq.heappush(active, r)

    note(np.arange(size))
    while active:
        rank = heapq.heappop(active)
        lists = occurrences.pop(rank)
        at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        left, right = vocab.pairs[rank]
        at = at[(symbol[at] == left) & (symbol[after[at]] == right)]  # some have gone into other merges since
        if left == right and len(at) > 1:  # in a run of one symbol, every second pair from its start
            at = np.sort(at)
            chained = np.concatenate([[False], after[at[:-1]] == at[1:]])
            place = np.arange(len(at))
            head = np.maximum.accumulate(np.where(chained, 0, place))
            at = at[(place - head) % 2 == 0]
        if not len(at):
            continue
        gone = after[at]
        symbol[at] = vocab.merged[rank]
        symbol[gone] = -1
        after[at] = after[gone]
        follows = after[at]
        before[follows[follows < size]] = at[follows < size]
        leads = before[at]
        note(np.unique(np.concatenate([leads[leads < size], at])))
    symbol = symbol[:size]
    alive = symbol >= 0
    kept = np.concatenate([[0], np.cumsum(alive)])
    return symbol[alive].astype(np.uint32), kept[starts]


class Encoder:
    """Encodes frames of texts; words already met are remembered, up to a bound."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.split = regex.compile(vocab.pattern.replace(r"\s", r"\p{White_Space}")).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, vocab.special)) + ")").split
        self.marks = tuple(vocab.special)
        self.forget()

    def forget(self) -> None:
        self.places: dict[str, int] = {s: k for k, s in enumerate(self.vocab.special)}  # no word holds both < and letters
        self.decoded = list(self.vocab.special)
        self.ids = np.array(list(self.vocab.special.values()), np.uint32)
        self.starts = np.arange(len(self.marks) + 1)

    def words(self, text: str) -> list[str]:
        """The words of a text, special tokens in their places."""
        if any(mark in text for mark in self.marks):
            parts = self.cut(text)
            return [w for k, part in enumerate(parts) for w in ([part] if k % 2 else self.words(part))]
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # capitals by themselves, no final form
        return self.split(text.lower())

    def encode(self, texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, str]]:
        """Ids and decoded text of each text of a frame."""
        if len(self.places) > REMEMBERED:
            self.forget()
        known = len(self.places)
        places = self.places
        rows = [
            np.array([places.setdefault(w, len(places)) for w in self.words(text)] if isinstance(text, str) else [], np.int64)
            for text in texts
        ]
        fresh = [w.encode("utf-8", "surrogatepass") for w in list(places)[known:]]
        if fresh:
            ids, starts = merge_words(fresh, self.vocab)
            tokens = self.vocab.tokens
            named = [tokens[i] for i in ids.tolist()]
            bounds = starts.tolist()
            self.decoded += [" ".join(named[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
            self.starts = np.concatenate([self.starts, len(self.ids) + starts[1:]])
            self.ids = np.concatenate([self.ids, ids])
        lengths = np.diff(self.starts)
        for row in rows:
            n = lengths[row]
            ends = np.cumsum(n)
            at = np.repeat(self.starts[row] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)
            yield self.ids[at], " ".join([self.decoded[i] for i in row.tolist()])


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids`` (little-endian unsigned 32-bit integers) and ``decoded``, the text of the ids.

    ``path`` names the vocabulary file on the driver; its content travels with the job. A null or empty text has no ids and
    an empty decoded text. Repeated rows are encoded each; other columns stay, columns of these three names are replaced.
    Texts are encoded whole: a group holds about GROUP_CHARS characters, or one longer text.
    """
    modest_batches(docs.sparkSession)
    vocab = vocabulary(path)
    rows = docs.drop("n_tokens", "ids", "decoded")
    added = {"n_tokens": F.lit(0).cast("long"), "ids": F.lit(b""), "decoded": F.lit("")}
    types = {"n_tokens": pa.int64(), "ids": pa.binary(), "decoded": pa.string()}

    def of_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocab)

        def run(texts: list) -> dict[str, list]:
            ids, decoded = zip(*encoder.encode(texts), strict=True)
            return {"n_tokens": [len(i) for i in ids], "ids": [i.astype("<u4").tobytes() for i in ids], "decoded": list(decoded)}

        return appended(run, text, types, GROUP_CHARS)(batches)

    return rows.mapInArrow(of_task, rows.withColumns(added).schema)


def decode(ids: bytes, vocab: Vocabulary) -> str:
    """Text of packed ids: the tokens, special ones too, with a blank between them."""
    return " ".join(vocab.tokens[i] for i in np.frombuffer(ids, "<u4").tolist())


def public_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode_documents(documents: DataFrame) -> DataFrame:
    """Result of the query: token counts and digests of the ids and of the decoded text."""
    found = encode(documents.select("doc_id", "text"), public_vocabulary())
    return found.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
