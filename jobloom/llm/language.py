"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the UTF-8 bytes of each run of letters, in lower case, in both directions, and gives every position a
distribution over the languages. A document's probabilities are the mean over all its positions. The state starts anew with
every run of letters, so equal runs have equal labels: a task computes each distinct run once and weighs it by its count,
which gives exactly what reading the whole text would give. Runs are read in pieces of at most ``PIECE`` bytes, which
bounds the steps in time however long a run is.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobloom.llm.common import appended, modest_batches, remainder

PIECE = 24
HIDDEN = 12
#: Bounds of the sample that training collects: labelled rows of each language, characters of each, languages with so many.
SAMPLE_ROWS, SAMPLE_CHARS, MAX_LANGUAGES = 150, 3000, 256
#: Distinct pieces that a task remembers before it starts to forget, and characters handled at a time.
REMEMBERED, GROUP_CHARS = 200_000, 1_000_000
UNDETERMINED = "und"
_letters = regex.compile(r"\p{L}+").findall


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class Network:
    """Weights by direction (0 reads forwards, 1 backwards), and the languages in the order of the outputs."""

    languages: list[str]
    embed: np.ndarray  # 2, 256, 3H: a byte's part in the update gate, the reset gate and the candidate
    recur: np.ndarray  # 2, H, 3H
    out: np.ndarray  # 2H, L
    bias: np.ndarray  # L

    @property
    def weights(self) -> list[np.ndarray]:
        return [self.embed, self.recur, self.out, self.bias]

    @staticmethod
    def fresh(languages: list[str], seed: int = 7) -> Network:
        g = np.random.default_rng(seed)
        h, n = HIDDEN, len(languages)
        return Network(
            languages,
            g.normal(0, 0.3, (2, 256, 3 * h)).astype(np.float32),
            g.normal(0, 0.3, (2, h, 3 * h)).astype(np.float32),
            g.normal(0, 0.3, (2 * h, n)).astype(np.float32),
            np.zeros(n, np.float32),
        )

    def read(self, data: np.ndarray, way: int, keep: list | None = None) -> np.ndarray:
        """States at every position of ``data`` (rows of bytes of one length); ``keep`` gets what learning needs."""
        n, steps = data.shape
        h = HIDDEN
        states = np.zeros((steps, n, h), np.float32)
        state = np.zeros((n, h), np.float32)
        for t in range(steps) if way == 0 else range(steps - 1, -1, -1):
            x = self.embed[way][data[:, t]]
            gates = _sigmoid(x[:, : 2 * h] + state @ self.recur[way][:, : 2 * h])
            update, reset = gates[:, :h], gates[:, h:]
            candidate = np.tanh(x[:, 2 * h :] + (reset * state) @ self.recur[way][:, 2 * h :])
            if keep is not None:
                keep.append((t, state, update, reset, candidate))
            state = state + update * (candidate - state)
            states[t] = state
        return states

    def label(self, data: np.ndarray, keep: tuple[list, list] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of every position: steps, rows, languages; and the states below them."""
        states = np.concatenate([self.read(data, way, keep and keep[way]) for way in (0, 1)], axis=2)
        scores = states @ self.out + self.bias
        scores -= scores.max(axis=2, keepdims=True)
        p = np.exp(scores)
        return p / p.sum(axis=2, keepdims=True), states

    def learn(self, data: np.ndarray, answer: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean cross-entropy over all positions, by backpropagation through time."""
        n, steps = data.shape
        h = HIDDEN
        keep: tuple[list, list] = ([], [])
        p, states = self.label(data, keep)
        p[:, np.arange(n), answer] -= 1
        p /= n * steps
        d_out = np.einsum("tnh,tnl->hl", states, p)
        d_bias = p.sum(axis=(0, 1))
        d_states = p @ self.out.T
        d_embed, d_recur = np.zeros_like(self.embed), np.zeros_like(self.recur)
        for way in (0, 1):
            carried = np.zeros((n, h), np.float32)
            u = self.recur[way]
            for t, before, update, reset, candidate in reversed(keep[way]):
                d = carried + d_states[t][:, way * h : (way + 1) * h]
                d_candidate = d * update * (1 - candidate**2)
                d_update = d * (candidate - before) * update * (1 - update)
                back = d_candidate @ u[:, 2 * h :].T
                d_reset = back * before * reset * (1 - reset)
                d_gates = np.concatenate([d_update, d_reset], axis=1)
                carried = d * (1 - update) + back * reset + d_gates @ u[:, : 2 * h].T
                d_recur[way][:, : 2 * h] += before.T @ d_gates
                d_recur[way][:, 2 * h :] += (reset * before).T @ d_candidate
                np.add.at(d_embed[way], data[:, t], np.concatenate([d_gates, d_candidate], axis=1))
        return [d_embed, d_recur, d_out, d_bias]


def _pieces(run: str) -> list[bytes]:
    data = run.encode("utf-8", "replace")
    return [data[i : i + PIECE] for i in range(0, len(data), PIECE)]


def _by_length(pieces: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pieces of one length, and their bytes as rows."""
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        yield at, np.frombuffer(b"".join([pieces[i] for i in at]), np.uint8).reshape(len(at), length)


def train(texts: list[str], langs: list[str], steps: int = 900, rows: int = 192, seed: int = 7) -> Network:
    """Fit the network to labelled texts with Adam; each step draws pieces of one length, lengths by their share of bytes."""
    languages = sorted(set(langs))
    network = Network.fresh(languages, seed)
    pieces: list[bytes] = []
    answers: list[int] = []
    for text, lang in zip(texts, langs, strict=True):
        found = [p for run in _letters(text.lower()) for p in _pieces(run)]
        pieces += found
        answers += [languages.index(lang)] * len(found)
    if not pieces or len(languages) < 2:
        return network
    answer = np.array(answers)
    weight = 1 / np.bincount(answer, minlength=len(languages)).clip(1)
    groups = [(data, answer[at], (w := weight[answer[at]]) / w.sum(), w.sum() * data.shape[1]) for at, data in _by_length(pieces)]
    share = np.array([g[3] for g in groups])
    g = np.random.default_rng(seed)
    first, second = ([np.zeros_like(w) for w in network.weights] for _ in range(2))
    for step in range(1, steps + 1):
        data, right, chance, _ = groups[g.choice(len(groups), p=share / share.sum())]
        drawn = g.choice(len(data), rows, p=chance)
        rate = 0.02 * (1 - step / (steps + 1)) + 1e-4
        for w, d, m, v in zip(network.weights, network.learn(data[drawn], right[drawn]), first, second, strict=True):
            m += 0.1 * (d - m)
            v += 0.01 * (d * d - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return network


def sample(docs: DataFrame, key: str, text: str, lang: str) -> list[tuple[str, str]]:
    """(text, language) of a bounded sample of the labelled rows: the rows of each language whose key hashes lowest."""
    w = Window.partitionBy("lang").orderBy(F.xxhash64("key"), "key", "text")
    known = docs.select(F.col(key).alias("key"), F.substring(text, 1, SAMPLE_CHARS).alias("text"), F.col(lang).alias("lang"))
    known = known.where("text IS NOT NULL AND lang IS NOT NULL")

    def lowest(n: int) -> DataFrame:
        return known.withColumn("r", F.row_number().over(w)).where(F.col("r") <= n).select("lang", "text", "key")

    rows = lowest(SAMPLE_ROWS).limit(SAMPLE_ROWS * (MAX_LANGUAGES + 1)).collect()
    if len({r["lang"] for r in rows}) > MAX_LANGUAGES:  # fewer rows of each, so that all are learnt
        languages = known.agg(F.count_distinct("lang")).first()[0]
        rows = lowest(max(1, SAMPLE_ROWS * MAX_LANGUAGES // languages)).collect()
    return [(r["text"], r["lang"]) for r in sorted(rows, key=lambda r: (r["lang"], str(r["key"]), r["text"]))]


class Labeller:
    """Predictions for lists of texts; the labels of runs already met are remembered, up to a bound."""

    def __init__(self, network: Network):
        self.network = network
        self.forget()

    def forget(self) -> None:
        self.places: dict[str, int] = {}
        # Of each remembered run: probabilities summed over its positions, and how many positions it has.
        self.table = np.zeros((0, len(self.network.languages) + 1))

    def __call__(self, texts: list) -> dict[str, list]:
        network, n = self.network, len(self.network.languages)
        if len(self.places) > REMEMBERED:
            self.forget()
        places, before = self.places, len(self.places)
        index, count, ends = [], [], [0]
        for text in texts:
            found = Counter(_letters(text.lower())) if isinstance(text, str) else {}
            index += [places.setdefault(run, len(places)) for run in found]
            count += found.values()
            ends.append(len(index))
        pieces, owner = [], []
        for k, run in enumerate(islice(places, before, None) if n else ()):
            parts = _pieces(run)
            pieces += parts
            owner += [k] * len(parts)
        fresh, owner = np.zeros((len(places) - before, n + 1)), np.array(owner, np.int64)
        for at, data in _by_length(pieces):
            for start in range(0, len(at), 4096):
                p, _ = network.label(data[start : start + 4096])
                np.add.at(fresh[:, :n], owner[at[start : start + 4096]], p.sum(axis=0))
                np.add.at(fresh[:, n], owner[at[start : start + 4096]], data.shape[1])
        self.table = np.concatenate([self.table, fresh])
        pooled = np.zeros((len(texts), n + 1))
        full = np.flatnonzero(np.diff(ends))
        if len(full):
            weighted = self.table[np.array(index)] * np.array(count)[:, None]
            pooled[full] = np.add.reduceat(weighted, np.array(ends)[full], axis=0)
        if not n:
            return {"lang_pred": [UNDETERMINED] * len(texts), "score": [0.0] * len(texts)}
        p, some = pooled[:, :n] / pooled[:, n:].clip(1), pooled[:, n] > 0
        best = p.argmax(axis=1)
        return {
            "lang_pred": [network.languages[b] if s else UNDETERMINED for b, s in zip(best, some, strict=True)],
            "score": np.where(some, p.max(axis=1), 0.0).clip(0, 1),
        }


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", learn_from=None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, learnt from the labelled rows that ``learn_from`` (a condition) lets in.

    A null text, one without a letter, and every text where nothing could be learnt (no labelled row) get ``und`` and 0.
    A null language is not learnt from. Repeated rows are predicted each. Other columns stay; columns of these two names
    are replaced. The sample brought to the driver is at most SAMPLE_ROWS * MAX_LANGUAGES rows of SAMPLE_CHARS characters, or
    a row of each language where there are more of these; where languages are many, each has fewer rows.
    """
    modest_batches(docs.sparkSession)
    labelled = sample(docs if learn_from is None else docs.where(learn_from), key, text, lang)
    network = train([t for t, _ in labelled], [x for _, x in labelled])
    rows = docs.drop("lang_pred", "score")
    schema = rows.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    types = {"lang_pred": pa.string(), "score": pa.float64()}
    return rows.mapInArrow(lambda batches: appended(Labeller(network), text, types, GROUP_CHARS)(batches), schema)


def identify_documents(documents: DataFrame) -> DataFrame:
    """Result of the query: the prediction of every document, learnt where crc32 of the id modulo 4 is not 2."""
    rest = remainder(F.col("doc_id"), 4)
    rows = documents.select("doc_id", "text", "lang")
    found = identify(rows.withColumn("held_out", F.coalesce(rest == 2, F.lit(False))), learn_from=rest != 2)
    return found.select("doc_id", "held_out", "lang_pred", "score")
