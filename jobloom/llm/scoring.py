"""Language-model scores of whole texts by a log-bilinear neural model.

The words of the training texts are counted in full. The commonest ones are classes of their own; all others, unseen words
too, are dealt by their endings over further classes. There is a fixed number of either, so the model has the same size for any
vocabulary. A log-bilinear model predicts a class from the two before it: context vectors, each weighed by position, add up to a
prediction whose product with a class vector is the class's score. It is trained in numpy by noise-contrastive estimation
against the classes' frequencies, on the whole of all training texts: a first model on a part of the texts in one task, then from
there every task on all texts that it reads, and the models are averaged by their tokens, in tasks. For scoring, a matrix product
gives the normaliser of every pair of context classes, so token probabilities are normalised. Inside a class of several words, a
word has its share of smoothed counts.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import find_words, give_back, lower_ascii, modest_batches, remainder
from jobloom.scratch import materialize

END = "\n"  # no word holds it
CLASSES, MOST_ENDINGS, DIMENSIONS, NOISE = 511, 512, 24, 32
ENDING = 3  # characters of a word that choose its class if it has none of its own
SMOOTHING = 0.1
#: Words that are sent to all tasks have at least this share of all tokens, so there are at most a million of them.
COMMON_SHARE = 2.0**-20
#: Tokens of the part that the first model learns from, its least steps, rows of its steps and of later ones.
PART_TOKENS, LEAST_STEPS, FIRST_ROWS, LATER_ROWS = 1 << 21, 900, 1024, 8192
GROUP_CHARS, COUNTED = 1_500_000, 300_000
SALTS = 1024  # models of so many tasks at most are added up in one


def tokens(text: str | None) -> list[str]:
    """Words in lower case (A-Z only), then the end; a null text is empty."""
    return [*find_words(lower_ascii(text)), END] if isinstance(text, str) else [END]


def ending_class(word: str, endings: int) -> int:
    return zlib.crc32(word[-ENDING:].encode("utf-8", "surrogatepass")) % endings


@dataclass
class Words:
    """The tokens of a group of texts: places in ``distinct`` (the end is the last), and where each text begins."""

    distinct: list[str]
    place: np.ndarray
    starts: np.ndarray


def split(texts: pa.Array) -> Words:
    """Tokens of whole texts, a null one being empty, as ``tokens`` gives them one by one."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))  # at blanks of ASCII, as in WORD
    owner, flat = pc.list_parent_indices(parts).to_numpy(), pc.list_flatten(parts).dictionary_encode()
    code, distinct = flat.indices.to_numpy(zero_copy_only=False), flat.dictionary.to_pylist()
    if "" in distinct:  # what stands before a first and behind a last blank
        word = code != distinct.index("")
        owner, code = owner[word], code[word]
    sizes = np.bincount(owner, minlength=len(texts)) + 1
    starts = np.cumsum(sizes) - sizes
    place = np.full(int(sizes.sum()), len(distinct), np.int64)
    place[np.arange(len(code)) + owner] = code
    return Words([*distinct, END], place, starts)


def groups(batches: Iterable[pa.RecordBatch], chars: int = GROUP_CHARS) -> Iterator[pa.Table]:
    """The rows in tables whose column ``text`` has about ``chars`` bytes, or one longer text."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = min(int(np.searchsorted(ends, before + chars - size)) + 1, batch.num_rows)
            held.append(batch.slice(start, stop - start))
            size += int(ends[stop - 1]) - before
            start = stop
            if size >= chars:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def texts_of(table: pa.Table) -> pa.Array:
    column = table.column("text").combine_chunks()
    return column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks)


@dataclass
class LogBilinear:
    """Vectors of context and of predicted classes; normalisers by the pair of context classes."""

    context: np.ndarray  # classes, dimensions
    position: np.ndarray  # 2, dimensions: weights of the class before last and of the last
    target: np.ndarray  # classes, dimensions
    bias: np.ndarray  # classes
    normaliser: np.ndarray | None = None  # classes, classes

    def predicted(self, older: np.ndarray, last: np.ndarray) -> np.ndarray:
        return self.context[older] * self.position[0] + self.context[last] * self.position[1]

    @property
    def weights(self) -> list[np.ndarray]:
        return [self.context, self.position, self.target, self.bias]

    def normalise(self) -> None:
        """Sum of all classes' weights for each pair of context classes: the weights are products of a part of either."""
        context, target, bias = (x.astype(np.float64) for x in (self.context, self.target, self.bias))
        older, last = ((context * weight) @ target.T + bias / 2 for weight in self.position)
        tops = [x.max(axis=1, keepdims=True) for x in (older, last)]
        sums = np.exp(older - tops[0]) @ np.exp(last - tops[1]).T
        self.normaliser = (np.log(np.maximum(sums, 1e-300)) + tops[0] + tops[1].T).astype(np.float32)

    def log_probability(self, older: np.ndarray, last: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Natural logarithms; the model must be normalised."""
        score = np.einsum("nd,nd->n", self.predicted(older, last), self.target[word]) + self.bias[word]
        return score - self.normaliser[older, last]


def untrained(share: np.ndarray, seed: int) -> LogBilinear:
    g = np.random.default_rng(seed)
    n, d = len(share), DIMENSIONS
    parts = g.normal(0, 0.1, (n, d)), np.full((2, d), 0.5), g.normal(0, 0.1, (n, d)), np.log(np.maximum(share, 1e-12))
    return LogBilinear(*(x.astype(np.float32) for x in parts))


def _added(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Rows of ``values`` added up by their place in ``at``."""
    return np.stack([np.bincount(at, column, n) for column in np.ascontiguousarray(values.T)], axis=1)


class Fit:
    """Noise-contrastive estimation with Adagrad, in place, a step at a time. A step's rows share their noise."""

    def __init__(self, model: LogBilinear, sums: list[np.ndarray], share: np.ndarray, seed: int):
        self.model, self.sums, self.random = model, sums, np.random.default_rng(seed)
        self.log_share = np.log(np.maximum(share, 1e-12)).astype(np.float32)
        self.drawn_from = np.cumsum(share) / share.sum()

    def step(self, a: np.ndarray, b: np.ndarray, word: np.ndarray, rate: float) -> None:
        """The classes before last, last and next of some places in texts."""
        model, n, rows = self.model, len(self.log_share), len(word)
        noise = np.searchsorted(self.drawn_from, self.random.random(NOISE)).clip(0, n - 1)
        predicted = model.predicted(a, b)
        own, others = model.target[word], model.target[noise]
        shift = np.float32(math.log(NOISE))
        right = np.einsum("nd,nd->n", predicted, own) + (model.bias - self.log_share)[word] - shift
        wrong = predicted @ others.T + ((model.bias - self.log_share)[noise] - shift)
        right = -1 / (1 + np.exp(right)) / rows
        wrong = 1 / (1 + np.exp(-wrong)) / rows
        d_predicted = right[:, None] * own + wrong @ others
        grads = [
            _added(np.concatenate([a, b]), np.concatenate([d_predicted * model.position[0], d_predicted * model.position[1]]), n),
            np.stack([np.einsum("nd,nd->d", d_predicted, model.context[x]) for x in (a, b)]),
            _added(np.concatenate([word, noise]), np.concatenate([right[:, None] * predicted, wrong.T @ predicted]), n),
            np.bincount(np.concatenate([word, noise]), np.concatenate([right, wrong.sum(axis=0)]), n),
        ]
        for w, grad, total in zip(model.weights, grads, self.sums, strict=True):
            total += grad**2
            w -= rate * grad / np.sqrt(total)

    def read(self, older: np.ndarray, last: np.ndarray, word: np.ndarray, rows: int, rate: float) -> None:
        """Every place once, in a random order."""
        order = self.random.permutation(len(word))
        for k in range(0, len(order), rows):
            at = order[k : k + rows]
            self.step(older[at], last[at], word[at], rate)


def begun(older: np.ndarray, last: np.ndarray, word: np.ndarray, share: np.ndarray, steps: int | None = None, seed: int = 3) -> tuple[LogBilinear, list[np.ndarray]]:
    """A model that has read all places once at least, and what Adagrad has added up."""
    model = untrained(share, seed)
    fit = Fit(model, [np.full_like(w, 1e-3) for w in model.weights], share, seed)
    if len(word):
        steps = max(LEAST_STEPS, -(-len(word) // FIRST_ROWS)) if steps is None else steps
        order = fit.random.permutation(len(word))
        for step in range(steps):
            at = order.take(np.arange(step * FIRST_ROWS, (step + 1) * FIRST_ROWS), mode="wrap")
            fit.step(older[at], last[at], word[at], 0.15 * (1 - step / steps) + 0.01)
    return model, fit.sums


def train(sequences: list[np.ndarray], share: np.ndarray, first: int, steps: int | None = None, seed: int = 3) -> LogBilinear:
    """A model of whole sequences of classes; ``share`` is each class's frequency, ``first`` opens a text."""
    opened = [np.concatenate([[first, first], s]) for s in sequences]
    places = [np.concatenate([s[k : len(s) - 2 + k] for s in opened]) for k in range(3)] if opened else [np.zeros(0, np.int64)] * 3
    model, _ = begun(*places, share / share.sum(), steps, seed)
    model.normalise()
    return model


@dataclass
class Scorer:
    """What a task needs: places of the common words (classes first), their smoothed log10 shares, and the model."""

    places: dict[str, int]
    log_share: np.ndarray
    classes: int  # classes with a word of their own; the next numbers are those of all other words, by ending
    endings: int
    class_at: np.ndarray  # class of each common word
    model: LogBilinear | None = None
    inside: np.ndarray | None = None  # log10 of the share of all words of a class by ending

    def plain(self) -> tuple:
        """What can be sent without this class."""
        model = self.model and (*self.model.weights, self.model.normaliser)
        return list(self.places), self.log_share, self.classes, self.endings, self.class_at, model, self.inside

    @classmethod
    def from_plain(cls, sent: tuple) -> Scorer:
        words, log_share, classes, endings, class_at, model, inside = sent
        places = dict(zip(words, range(len(words)), strict=True))
        return cls(places, log_share, classes, endings, class_at, model and LogBilinear(*model), inside)

    def class_of(self, word: str, place: int) -> int:
        return int(self.class_at[place]) if place >= 0 else self.classes + ending_class(word, self.endings)

    def first(self) -> int:
        return self.class_of(END, self.places.get(END, -1))

    def read(self, texts: pa.Array) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The tokens of the texts, the places of the distinct ones, and of every token the classes (older, last, word)."""
        words = split(texts)
        common = np.array([self.places.get(w, -1) for w in words.distinct], np.int64)
        classes = self.class_at[common] if len(self.class_at) else np.zeros(len(common), np.int64)
        for k in np.flatnonzero(common < 0).tolist():
            classes[k] = self.class_of(words.distinct[k], -1)
        word = classes[words.place]
        last, older = np.roll(word, 1), np.roll(word, 2)
        starts = words.starts
        older[np.minimum(starts + 1, max(len(word) - 1, 0))] = last[starts] = older[starts] = self.first()
        return words, common, older, last, word

    def score(self, table: pa.Table) -> pa.Table:
        """Per text: tokens, sums over the common words, the model's score but for the rare words, and these with counts."""
        words, common, older, last, word = self.read(texts_of(table))
        place, starts, n = common[words.place], words.starts, table.num_rows
        known = place >= 0
        base = np.where(known, self.log_share[np.maximum(place, 0)] if len(self.log_share) else 0.0, 0.0)
        chance = np.empty(len(word))
        for k in range(0, len(word), 100_000):
            part = slice(k, k + 100_000)
            chance[part] = self.model.log_probability(older[part], last[part], word[part]) / np.log(10)
        chance += np.where(word >= self.classes, base - self.inside[np.maximum(word - self.classes, 0)], 0.0)
        owner = np.repeat(np.arange(n), np.diff(np.append(starts, len(word))))
        rare, times = np.unique(owner[~known] * len(words.distinct) + words.place[~known], return_counts=True)
        bounds = pa.array(np.searchsorted(rare // len(words.distinct), np.arange(n + 1)).astype(np.int32))
        named = pa.array(words.distinct).take(pa.array(rare % len(words.distinct)))
        return table.drop_columns(["text"]).append_column("n_tokens", pa.array(np.bincount(owner, minlength=n))).append_column(
            "known", pa.array(np.bincount(owner, known, n).astype(np.int64))
        ).append_column("base", pa.array(np.bincount(owner, base, n))).append_column(
            "neural", pa.array(np.bincount(owner, chance, n))
        ).append_column("rare", pa.ListArray.from_arrays(bounds, named)).append_column("times", pa.ListArray.from_arrays(bounds, pa.array(times.astype(np.int64))))


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def taken() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"token": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())})

    for table in groups(batches):
        words = split(texts_of(table))
        times = np.bincount(words.place, minlength=len(words.distinct)).tolist()
        for word, n in zip(words.distinct, times, strict=True):
            if n:
                held[word] = held.get(word, 0) + n
        if len(held) > COUNTED:
            yield taken()
            held.clear()
    if held:
        yield taken()
    give_back()


def counts(texts: DataFrame) -> DataFrame:
    """``token`` and ``c``, its count over all texts (column ``text``), tasks adding up their own first."""
    found = texts.mapInArrow(_counted, "token string, n long")
    return found.groupBy("token").agg(F.sum("n").alias("c"))


def _packed(weights: list[np.ndarray]) -> bytes:
    return np.concatenate([w.ravel() for w in weights]).astype(np.float32).tobytes()


def _unpacked(packed: bytes | np.ndarray, like: list[np.ndarray]) -> list[np.ndarray]:
    flat = np.frombuffer(packed, np.float32) if isinstance(packed, bytes | bytearray) else packed.astype(np.float32)
    return [x.reshape(w.shape).copy() for x, w in zip(np.split(flat, np.cumsum([w.size for w in like])[:-1]), like, strict=True)]


MODELS = pa.schema([("salt", pa.int32()), ("tokens", pa.int64()), ("weights", pa.binary()), ("sums", pa.binary())])
MODELS_SQL = "salt int, tokens long, weights binary, sums binary"


def _averaged(group: pd.DataFrame) -> pd.DataFrame:
    """The mean of the models, by the tokens that each has read; means of means meet under one number."""
    total, weights = int(group["tokens"].sum()), 0.0
    for n, packed in zip(group["tokens"], group["weights"], strict=True):
        weights = weights + np.frombuffer(packed, np.float32).astype(np.float64) * (n / total)
    return pd.DataFrame({"salt": [0], "tokens": [total], "weights": [weights.astype(np.float32).tobytes()], "sums": [b""]})


def first_model(texts: DataFrame, scorer: Scorer, share: np.ndarray, parts: int) -> tuple[LogBilinear, bytes]:
    """The model that one task learns from one of ``parts`` parts of the texts, drawn by chance, and what Adagrad has added up."""
    sent = texts.sparkSession.sparkContext.broadcast(scorer.plain())

    def of_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer.from_plain(sent.value)
        read = [own.read(texts_of(table))[2:] for table in groups(batches)]
        places = [np.concatenate(x) for x in zip(*read, strict=True)] if read else [np.zeros(0, np.int64)] * 3
        order = np.lexsort(places)  # texts may come in any order
        places = [x[order] for x in places]
        model, sums = begun(*places, share)
        yield pa.RecordBatch.from_pylist([{"salt": 0, "tokens": len(places[2]), "weights": _packed(model.weights), "sums": _packed(sums)}], MODELS)

    some = texts if parts == 1 else texts.where(F.rand(11) < 1.0 / parts)
    row = some.repartition(1).mapInArrow(of_task, MODELS_SQL).first()
    model = untrained(share, 3)
    if row is None:
        return model, _packed([np.full_like(w, 1e-3) for w in model.weights])
    return LogBilinear(*_unpacked(bytes(row["weights"]), model.weights)), bytes(row["sums"])


def further_models(texts: DataFrame, scorer: Scorer, share: np.ndarray, start: LogBilinear, sums: bytes) -> DataFrame:
    """A model for every task that has texts, which has read each of their tokens once from ``start`` on."""
    sent = texts.sparkSession.sparkContext.broadcast(scorer.plain())
    begin = _packed(start.weights)

    def of_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit, n, salt, own = None, 0, 0, Scorer.from_plain(sent.value)
        for table in groups(batches):
            if fit is None:
                salt = table.column("salt")[0].as_py()
                like = untrained(share, 3).weights
                fit = Fit(LogBilinear(*_unpacked(begin, like)), _unpacked(sums, like), share, salt)
            _, _, older, last, word = own.read(texts_of(table))
            fit.read(older, last, word, LATER_ROWS, 0.05)
            n += len(word)
        if fit is not None:
            yield pa.RecordBatch.from_pylist([{"salt": salt % SALTS, "tokens": n, "weights": _packed(fit.model.weights), "sums": b""}], MODELS)
        give_back()

    return texts.withColumn("salt", F.spark_partition_id()).mapInArrow(of_task, MODELS_SQL)


def learnt(texts: DataFrame, scorer: Scorer, total: int, share: np.ndarray) -> LogBilinear:
    """The model from all texts: a first one, then every task's from there on, and their mean, of which one row comes back."""
    parts = max(1, -(-total // PART_TOKENS))
    model, sums = first_model(texts, scorer, share, parts)
    if parts > 1:
        models = further_models(texts, scorer, share, model, sums)
        mean = models.groupBy("salt").applyInPandas(_averaged, MODELS_SQL).groupBy("salt").applyInPandas(_averaged, MODELS_SQL).first()
        model = LogBilinear(*_unpacked(bytes(mean["weights"]), model.weights))
    model.normalise()
    return model


def learn(texts: DataFrame) -> tuple[DataFrame, int, int, Scorer]:
    """Counts, tokens, distinct tokens and the scorer, all from the whole of all texts."""
    found = materialize(counts(texts.select("text")), "counts")
    total, distinct = (int(x or 0) for x in found.agg(F.sum("c"), F.count("*")).first())
    common = found.where(F.col("c") >= max(1.0, total * COMMON_SHARE)).toArrow()  # at most 1 / COMMON_SHARE rows
    common = common.sort_by([("c", "descending"), ("token", "ascending")])
    names, often = common.column("token").to_pylist(), common.column("c").to_numpy()
    whole = total + SMOOTHING * (distinct + 1)
    share = (often + SMOOTHING) / whole
    classes, endings = min(CLASSES, len(names)), min(MOST_ENDINGS, max(1, math.isqrt(distinct)))
    class_at = np.array([k if k < classes else classes + ending_class(w, endings) for k, w in enumerate(names)], np.int64)
    ending = F.crc32(F.right("token", F.lit(ENDING)).cast("binary")) % endings
    words, times = np.ones(endings), np.zeros(endings)  # every class has room for an unseen word
    for r in found.groupBy(ending.alias("k")).agg(F.count("*").alias("words"), F.sum("c").alias("c")).collect():
        words[r["k"]], times[r["k"]] = words[r["k"]] + r["words"], r["c"]
    for word, n in zip(names[:classes], often.tolist(), strict=False):
        k = ending_class(word, endings)
        words[k], times[k] = words[k] - 1, times[k] - n
    by_ending = (times + SMOOTHING * words) / whole
    scorer = Scorer(dict(zip(names, range(len(names)), strict=True)), np.log10(share), classes, endings, class_at, inside=np.log10(by_ending))
    shares = np.append(share[:classes], by_ending)
    scorer.model = learnt(texts.select("text"), scorer, total, shares / shares.sum())
    return found, total, distinct, scorer


def score(docs: DataFrame, learn_from: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every row, in log10.

    The model learns from the rows that ``learn_from`` (a condition on columns of ``docs``) lets in; null does not. Columns may
    have any names, the key too; others are not returned. A null text is empty and has the end alone. Repeated rows are scored
    each. Without a training text every token is unseen. Rare words are looked up by a join with the counts, whose size is not
    bounded; common ones are sent to the tasks.
    """
    modest_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"), learn_from.alias("learn"))
    found, total, distinct, scorer = learn(rows.where("learn").select("text"))
    sent, kind = docs.sparkSession.sparkContext.broadcast(scorer.plain()), rows.schema["id"].dataType.simpleString()

    def of_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer.from_plain(sent.value)
        for table in groups(batches):
            yield from own.score(table).combine_chunks().to_batches()
        give_back()

    scored = rows.select("id", "text").mapInArrow(
        of_task, f"id {kind}, n_tokens long, known long, base double, neural double, rare array<string>, times array<long>"
    )
    scored = materialize(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("row", "r.rare", "r.times")
    rare = rare.join(found.withColumnRenamed("token", "rare"), "rare", "left")
    whole = total + SMOOTHING * (distinct + 1)
    each = F.log10((F.coalesce("c", F.lit(0)) + SMOOTHING) / whole) * F.col("times")
    sums = rare.groupBy("row").agg(
        F.sum(each).alias("more"), F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("more_known")
    )
    out = scored.drop("rare", "times").join(sums, "row", "left").fillna(0, ["more", "more_known"])
    return out.select(
        F.col("id").alias(key), "n_tokens", (F.col("known") + F.col("more_known")).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + F.col("more")).alias("base_score"),
        (F.col("neural") + F.col("more")).alias("score"),
    )


def score_documents(documents: DataFrame) -> DataFrame:
    """Result of the query: scores of every document, learnt where crc32 of the id modulo 10 is not 0."""
    found = score(documents.select("doc_id", "text"), remainder(F.col("doc_id"), 10) != 0)
    held = F.coalesce(remainder(F.col("doc_id"), 10) == 0, F.lit(False))
    return found.withColumn("held_out", held).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
