"""Alignment of the tokens of two tokenizers over whole texts, as Arrow tables inside tasks.

Both read a text after one space, so their tokens are spans of the same bytes. Texts are split into segments before every space
that follows a character other than white space; neither tokenizer joins bytes across such a place, which is checked for the
given vocabularies (otherwise a text is one segment). Equal segments of a group of texts are encoded and aligned once, many
segments to a call: token ids are flattened with the index of their segment, byte lengths are summed up from each segment's
start, and a hash join of Acero on (segment, end) finds where tokens of both end together. Every such place closes a group and
links the two tokens that end there.

The links of a text are kept as distinct pairs of ids with their number. Tasks count pairs with ``Table.group_by`` and Spark adds
these counts up. Pairs that hold at least a 2**-20 part of all links, so at most 2**20 of them, are sent to the tasks; the counts
of all other pairs meet the texts in a join.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import give_back, modest_batches
from jobloom.scratch import materialize

GROUP_CHARS = 1_000_000
#: Segments whose alignment a task remembers before it starts anew.
REMEMBERED = 250_000
#: Segments that are put together for one call of a tokenizer.
TOGETHER = 2000
#: Pairs that are sent to all tasks have at least this share of all links.
COMMON_SHARE = 2.0**-20
SPACE = "▁"  # how pieces write a space


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: printable ones for themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


#: Fixed value: how byte-level vocabularies cut a text into words.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Below this character both libraries agree on what a letter is, whatever their edition of Unicode.
SETTLED = "\u0250"


@dataclass
class Vocabularies:
    """What travels to the tasks: the contents of the two files."""

    byte_level: str  # a JSON file of a byte-level vocabulary
    pieces: bytes  # a model of pieces

    @classmethod
    def read(cls, byte_level_path: str, pieces_path: str) -> Vocabularies:
        with open(byte_level_path, encoding="utf-8") as a, open(pieces_path, "rb") as b:
            return cls(a.read(), b.read())


class ByteLevel:
    """The first tokenizer: ids of texts, and the bytes of its tokens."""

    def __init__(self, content: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        import tokenizers

        self.library = tokenizers.Tokenizer.from_str(content)
        self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()
        spec, of_char = json.loads(content), byte_characters()
        named = self.library.get_vocab(with_added_tokens=False)
        self.bytes = [b""] * (max(named.values(), default=-1) + 1)
        for token, k in named.items():
            if all(c in of_char for c in token):
                self.bytes[k] = bytes(of_char[c] for c in token)
        cut = spec.get("pre_tokenizer") or {}
        self.by_words = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space") and spec.get("normalizer") is None
        self.quick = self._quick(spec["model"], named)

    def _quick(self, model: dict, named: dict[str, int]):
        """An encoder by ranks that gives the same ids. It needs ids in the order of the merges, each token by a single merge: then

        where two neighbours make a token, all earlier merges inside it are done, so they are the parts of its own merge.
        """
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        made = [named.get(a + b, -1) for a, b in pairs]
        single = [k for token, k in named.items() if len(token) == 1]
        in_order = all(x < y for x, y in zip([max(single, default=-1), *made], made, strict=False))
        if not (self.by_words and in_order and len(single) == 256 and len(single) + len(made) == sum(map(bool, self.bytes))):
            return None
        import tiktoken

        ranks = {self.bytes[k]: k for k in [*single, *made]}
        return tiktoken.Encoding("byte-level", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __call__(self, text: str) -> list[int]:
        if self.quick and (text.isascii() or max(text) < SETTLED):
            return self.quick(text)
        return self.library.encode(text, add_special_tokens=False).ids


class Pieces:
    """The second tokenizer, which puts a space before each text."""

    def __init__(self, content: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=content)
        names = [self.library.id_to_piece(k) for k in range(self.library.get_piece_size())]
        self.bytes = [
            bytes([int(name[3:5], 16)]) if self.library.is_byte(k) else name.replace(SPACE, " ").encode() for k, name in enumerate(names)
        ]
        self.by_words = not any(re.search(f"[^{SPACE}]{SPACE}", name) for name in names)

    def __call__(self, text: str) -> list[int]:
        return self.library.encode(text)


def _odd(segment: str) -> int:
    """2: by itself, as it may not give back its bytes or stand before another; 1: of other scripts; 0: of settled letters."""
    if SPACE in segment or segment[-1:].isspace() or not segment:
        return 2
    return 0 if segment.isascii() or max(segment) < SETTLED else 1


def _lists(rows: list[list[int]]) -> pa.ListArray:
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    flat = np.fromiter((k for row in rows for k in row), np.int32, int(sizes.sum()))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat))


def _joined(ids: pa.ListArray, tokens: pa.BinaryArray) -> pa.Array:
    """The bytes of all tokens of each list, one after the other."""
    return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, tokens.take(ids.values)), b"")


def _ends(ids: pa.ListArray, lengths: np.ndarray, at: str) -> pa.Table:
    """Of every token: the index of its list, the byte in it at which it ends, and its place in the flattened ids (``at``)."""
    parent = pc.list_parent_indices(ids).to_numpy()
    size = lengths[pc.list_flatten(ids).to_numpy()]
    total = pc.cumulative_sum(pa.array(size)).to_numpy()
    before = np.concatenate([[0], total])[ids.offsets.to_numpy()[:-1]]  # what the lists before it hold
    return pa.table({"segment": pa.array(parent, pa.int64()), "end": total - before[parent], at: np.arange(len(parent))})


def _group_texts(ids: pa.ListArray, stops: np.ndarray) -> pa.Array:
    """Decimal ids of each group, joined by commas; a group stops at a place in the flattened ids, where the next begins."""
    offsets = pa.array(np.concatenate([[0], stops + 1]).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, pc.cast(ids.values, pa.string())), ",")


def aligned(left: pa.ListArray, right: pa.ListArray, left_sizes: np.ndarray, right_sizes: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Of lists of tokens over the same bytes: the text of the groups of each, its number of groups, and both ids of every link."""
    one, other = _ends(left, left_sizes, "left_at"), _ends(right, right_sizes, "right_at")
    met = one.join(other, keys=["segment", "end"], join_type="inner", use_threads=False).sort_by([("left_at", "ascending")])
    a, b = met.column("left_at").to_numpy(), met.column("right_at").to_numpy()
    groups = pc.binary_join_element_wise(_group_texts(left, a), _group_texts(right, b), "|")
    number = np.bincount(met.column("segment").to_numpy(), minlength=len(left))
    offsets = pa.array(np.concatenate([[0], np.cumsum(number)]).astype(np.int32))
    texts = pc.binary_join(pa.ListArray.from_arrays(offsets, groups), ";")
    return texts, number, left.values.to_numpy()[a], right.values.to_numpy()[b]


class Aligner:
    """Aligns groups of texts; segments already met are remembered, up to a bound."""

    def __init__(self, vocabularies: Vocabularies):
        self.encoders = [ByteLevel(vocabularies.byte_level), Pieces(vocabularies.pieces)]
        self.splits = all(e.by_words for e in self.encoders)
        self.tokens = [pa.array(e.bytes, pa.binary()) for e in self.encoders]
        self.token_sizes = [np.array([len(b) for b in e.bytes], np.int64) for e in self.encoders]
        self.pairs = len(self.tokens[1])  # a pair of ids is written as a * pairs + b
        self.forget()

    def forget(self) -> None:
        self.places: dict[str, int] = {}
        self.texts: list[bytes] = []
        self.sizes = np.zeros((4, 0), np.int64)  # fits (0 or 1), tokens of either kind, groups
        self.links = np.zeros(0, np.int64)
        self.starts = np.zeros(1, np.int64)

    def segments(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """For every segment in order its text's index and its place in the third result: the distinct ones, less their first space."""
        if not self.splits:
            found = texts.dictionary_encode()
            return np.arange(len(texts)), found.indices.to_numpy(), found.dictionary.to_pylist()
        parts = pc.split_pattern(texts, " ")
        owner = pc.list_parent_indices(parts).to_numpy()
        found = pc.list_flatten(parts).dictionary_encode()
        code, distinct = found.indices.to_numpy().astype(np.int64), found.dictionary.to_pylist()
        empty = np.array([not part for part in distinct], bool)
        blank = np.array([not part or part[-1].isspace() for part in distinct], bool)  # a space behind it is no place to split
        glued = (owner[1:] == owner[:-1]) & (blank[code[:-1]] | empty[code[1:]])
        if not glued.any():
            return owner, code, distinct
        start = np.flatnonzero(np.concatenate([[True], ~glued]))
        stop = np.append(start[1:], len(code))
        out = code[start]
        joined: dict[str, int] = {}
        for k in np.flatnonzero(stop - start > 1).tolist():
            text = " ".join([distinct[c] for c in code[start[k] : stop[k]].tolist()])
            out[k] = len(distinct) + joined.setdefault(text, len(joined))
        return owner[start], out, distinct + list(joined)

    def encoded(self, segments: list[str]) -> list[pa.ListArray]:
        """Ids of every segment by either tokenizer.

        Where texts may be split, the other way round segments are put together and encoded at once; token ends that do not fall on
        the ends of all segments, or tokens that do not give back the bytes, show segments that are encoded one by one instead.
        """
        out = []
        together = " " + " ".join(segments)
        whole = together.encode()
        ends = np.cumsum(pc.binary_length(pa.array(segments, pa.string())).to_numpy() + 1)
        for encode, tokens, sizes, text in zip(self.encoders, self.tokens, self.token_sizes, (together, together[1:]), strict=True):
            if self.splits and len(segments) > 1:  # none of which ends with white space
                ids = np.array(encode(text), np.int32)
                reached = np.cumsum(sizes[ids])
                at = np.searchsorted(reached, ends)
                if reached[-1] == len(whole) and (reached[at] == ends).all():
                    once = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(ids))
                    if _joined(once, tokens)[0].as_py() == whole:
                        out.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], at + 1]).astype(np.int32)), once.values))
                        continue
            space = " " if encode is self.encoders[0] else ""
            out.append(_lists([encode(space + s) for s in segments]))
        return out

    def learn(self, fresh: list[str]) -> None:
        """Encode and align segments that were not met before."""
        fresh.sort(key=_odd)
        parts = []
        for kind, same in groupby(fresh, _odd):
            same = list(same)
            step = 1 if kind == 2 else TOGETHER
            parts += [self.encoded(same[k : k + step]) for k in range(0, len(same), step)]
        left, right = (pa.concat_arrays(lists) for lists in zip(*parts, strict=True))
        whole = pc.binary_join_element_wise(b"", pa.array(fresh, pa.string()).cast(pa.binary()), b" ")
        fits = pc.and_(pc.equal(_joined(left, self.tokens[0]), whole), pc.equal(_joined(right, self.tokens[1]), whole))
        texts, groups, a, b = aligned(left.filter(fits), right.filter(fits), *self.token_sizes)
        fit = fits.to_numpy(zero_copy_only=False)
        sizes = np.zeros((4, len(fresh)), np.int64)
        sizes[:, fit] = [np.ones(int(fit.sum()), np.int64), pc.list_value_length(left).to_numpy()[fit], pc.list_value_length(right).to_numpy()[fit], groups]
        kept = texts.cast(pa.binary()).to_pylist()
        if not fit.all():
            given = iter(kept)
            kept = [next(given) if f else b"" for f in fit.tolist()]
        self.texts += kept
        self.places.update(zip(fresh, range(len(self.places), len(self.places) + len(fresh)), strict=True))
        self.sizes = np.concatenate([self.sizes, sizes], axis=1)
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes[3])])
        self.links = np.concatenate([self.links, a.astype(np.int64) * self.pairs + b])

    def align(self, texts: pa.Array) -> pa.Table:
        """A row per text (none null or empty): token numbers, the digest of its groups, and its pairs with their numbers."""
        if len(self.places) > REMEMBERED:
            self.forget()
        owner, code, distinct = self.segments(texts)
        used = np.bincount(code, minlength=len(distinct)).tolist()  # glued parts may stand nowhere else
        fresh = [s for s, n in zip(distinct, used, strict=True) if n and s not in self.places]
        if fresh:
            self.learn(fresh)
        place = np.array([self.places.get(s, -1) for s in distinct], np.int64)[code]
        n = len(texts)
        unfit = np.bincount(owner, self.sizes[0][place] == 0, n) > 0
        owner, place = owner[~unfit[owner]], place[~unfit[owner]]
        tokens = [np.bincount(owner, size[place], n).astype(np.int64) for size in self.sizes[1:]]
        first = np.searchsorted(owner, np.arange(n + 1))
        named = self.texts
        digests = []
        for k in range(n):
            groups = b";".join([named[p] for p in place[first[k] : first[k + 1]].tolist()])
            digests.append(hashlib.sha256(groups).hexdigest() if groups else "")
        size = self.sizes[3][place]
        ends = np.cumsum(size)
        at = np.repeat(self.starts[place] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)
        links = pa.table({"text": np.repeat(owner, size), "pair": self.links[at]})
        links = links.group_by(["text", "pair"], use_threads=False).aggregate([([], "count_all")]).sort_by([("text", "ascending"), ("pair", "ascending")])
        bounds = pa.array(np.searchsorted(links.column("text").to_numpy(), np.arange(n + 1)).astype(np.int32))
        lists = {
            name: pa.ListArray.from_arrays(bounds, links.column(of).combine_chunks().cast(pa.int64()))
            for name, of in (("pairs", "pair"), ("times", "count_all"))
        }
        return pa.table({"n_a": tokens[0], "n_b": tokens[1], "n_groups": tokens[2], "n_links": tokens[2], "groups_sha256": digests, **lists})


FOUND = pa.schema([
    *[(name, pa.int64()) for name in ("n_a", "n_b", "n_groups", "n_links")], ("groups_sha256", pa.string()),
    ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64())),
])
FOUND_SQL = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"


def _grouped(batches: Iterable[pa.RecordBatch], text: str, chars: int) -> Iterator[pa.Table]:
    """The rows in tables of about ``chars`` characters, or of one longer text."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        lengths = pc.fill_null(pc.utf8_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start = 0
        for stop, length in enumerate(lengths.tolist(), 1):
            size += length
            if size >= chars:
                yield pa.Table.from_batches([*held, batch.slice(start, stop - start)])
                held, size, start = [], 0, stop
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def align(docs: DataFrame, vocabularies: Vocabularies, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` of every row with its token numbers, the digest of its groups, and its linked pairs of ids (``pairs``, ``times``).

    A pair is a * (number of pieces) + b. A null or empty text, and one whose tokens do not give back its bytes, has no tokens:
    zeros, an empty digest and no pairs. Repeated rows are aligned each, other columns are not read, and an empty table gives an
    empty result. A text is read whole, whatever its length.
    """
    modest_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))

    def of_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        for table in _grouped(batches, "text", GROUP_CHARS):
            texts = table.column("text").combine_chunks()
            texts = texts if isinstance(texts, pa.Array) else pa.concat_arrays(texts.chunks)
            given = pc.fill_null(pc.greater(pc.binary_length(texts), 0), False).to_numpy(zero_copy_only=False)
            aligner = aligner or Aligner(vocabularies)
            found = aligner.align(texts.filter(pa.array(given))) if given.any() else FOUND.empty_table()
            # Rows without a text take the row of zeros at the end.
            none = pa.table({"n_a": [0], "n_b": [0], "n_groups": [0], "n_links": [0], "groups_sha256": [""], "pairs": [[]], "times": [[]]}, schema=FOUND)
            place = np.where(given, np.cumsum(given) - 1, found.num_rows)
            whole = pa.concat_tables([found.cast(FOUND), none]).take(pa.array(place))
            yield from whole.add_column(0, "key", table.column("key")).combine_chunks().to_batches()
        give_back()

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(of_task, f"key {kind}, {FOUND_SQL}").withColumnRenamed("key", key)


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a task's rows with their numbers, as many times as a batch has them."""
    for batch in batches:
        flat = pa.table({"pair": pc.list_flatten(batch.column("pairs")), "n": pc.list_flatten(batch.column("times"))})
        counts = flat.group_by("pair", use_threads=False).aggregate([("n", "sum")]).select(["pair", "n_sum"]).rename_columns(["pair", "n"])
        yield from counts.combine_chunks().to_batches()


def pair_counts(found: DataFrame, pieces: int) -> DataFrame:
    """``pair``, ``count`` (its links in all rows) and ``best``, whether no other pair of its second id has more."""
    counts = found.select("pairs", "times").mapInArrow(_counted, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("count"))
    counts = materialize(counts.withColumn("b", F.col("pair") % pieces), "pair-counts")
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def with_pair_counts(found: DataFrame, pieces: int) -> DataFrame:
    """What ``align`` gives with ``n_best``, its links that are the most frequent of their second id, and ``count_sum``.

    ``found`` must be a written table, as it is read twice.
    """
    counts = materialize(pair_counts(found, pieces), "pairs")
    total = counts.agg(F.sum("count")).first()[0] or 0
    common = counts.where(F.col("count") >= total * COMMON_SHARE).toArrow().sort_by([("pair", "ascending")])  # 1 / COMMON_SHARE rows at most
    code, count, best = (common.column(c).to_numpy() for c in ("pair", "count", "best"))

    def of_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, times = batch.column("pairs"), pc.list_flatten(batch.column("times")).to_numpy()
            pair, owner, n = pc.list_flatten(lists).to_numpy(), pc.list_parent_indices(lists).to_numpy(), batch.num_rows
            at = np.minimum(np.searchsorted(code, pair), max(len(code) - 1, 0))
            known = code[at] == pair if len(code) else np.zeros(len(pair), bool)
            k = at[known]
            sums = [np.zeros(n, np.int64), np.zeros(n, np.int64)]
            for into, value in zip(sums, (best[k] * times[known], count[k] * times[known]), strict=True):
                np.add.at(into, owner[known], value)
            rare = [pa.ListArray.from_arrays(pa.array(np.searchsorted(owner[~known], np.arange(n + 1)).astype(np.int32)), pa.array(v[~known])) for v in (pair, times)]
            rest = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(sums[0]), pa.array(sums[1]), *rare], names)

    kept = [c for c in found.columns if c not in ("pairs", "times")]
    names = [*kept, "n_best", "count_sum", "rare", "rare_times"]
    schema = found.select(*kept, F.lit(0).cast("long").alias("n_best"), F.lit(0).cast("long").alias("count_sum"), F.col("pairs").alias("rare"), F.col("times").alias("rare_times")).schema
    scored = found.mapInArrow(of_task, schema)
    scored = materialize(scored.withColumn("_row", F.monotonically_increasing_id()), "aligned")
    rare = scored.where(F.size("rare") > 0).select("_row", F.inline(F.arrays_zip(F.col("rare").alias("pair"), F.col("rare_times").alias("times"))))
    sums = rare.join(counts, "pair").groupBy("_row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_more_best"), F.sum(F.col("times") * F.col("count")).alias("_more_sum")
    )
    out = scored.drop("rare", "rare_times").join(sums, "_row", "left")
    return out.withColumns({
        "n_best": F.col("n_best") + F.coalesce("_more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("_more_sum", F.lit(0)),
    }).drop("_row", "_more_best", "_more_sum")


def public_vocabularies() -> Vocabularies:
    import public_tokenizers

    return Vocabularies.read(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def align_documents(documents: DataFrame, vocabularies: Vocabularies | None = None) -> DataFrame:
    """Result of the query: token, group and link numbers of every document, and what its links count in the whole corpus."""
    vocabularies = vocabularies or public_vocabularies()
    pieces = len(Pieces(vocabularies.pieces).bytes)
    found = materialize(align(documents, vocabularies), "links")
    return with_pair_counts(found, pieces).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
