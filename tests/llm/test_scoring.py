import math
import random
import re
import string
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from jobloom.llm import scoring

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows):
    tokens = [[*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)), None] for _, t in rows]
    held = [key is not None and zlib.crc32(str(key).encode()) % 10 == 0 for key, _ in rows]
    count = Counter(w for (key, _), words, h in zip(rows, tokens, held, strict=True) if key is not None and not h for w in words)
    total, distinct = sum(count.values()), len(count)
    base = [sum(math.log10((count[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in words) for words in tokens]
    return [(h, len(w), sum(count[x] > 0 for x in w), total, b) for h, w, b in zip(held, tokens, base, strict=True)]


def corpus(n, seed=2):
    r = random.Random(seed)
    words = [f"{a}{b}" for a in ["re", "Un", "in", "é"] for b in range(60)]
    rows = []
    for k in range(n):
        text, word = [], r.choice(words)
        for _ in range(r.randint(0, 80)):  # each word is often followed by the next of the list
            word = words[(words.index(word) + 1) % len(words)] if r.random() < 0.7 else r.choice(words)
            text.append(word)
        rows.append((k, " ".join(text)))
    return rows


def run(documents, rows):
    frame = documents([(k, t, "en", "s") for k, t in rows])
    return sorted(scoring.score_documents(frame).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))


@pytest.mark.parametrize("share", [2.0**-20, 0.02])  # the second leaves most words to the join
def test_base_equals_brute_force(documents, monkeypatch, share):
    monkeypatch.setattr(scoring, "COMMON_SHARE", share)
    rows = corpus(300) + [(900, None), (901, ""), (902, "ÀB Zz zz"), (903, "in1 " * 5000), (None, "re1 re2")]
    for row, wanted in zip(run(documents, rows), brute(rows), strict=True):
        assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"]) == wanted[:4]
        assert row["base_score"] == pytest.approx(wanted[4], rel=1e-9)


def test_rare_words_score_alike_either_way(documents, monkeypatch):
    rows = corpus(120)
    monkeypatch.setattr(scoring, "CLASSES", 1)
    once = [r["score"] for r in run(documents, rows)]
    monkeypatch.setattr(scoring, "COMMON_SHARE", 0.02)
    assert [r["score"] for r in run(documents, rows)] == pytest.approx(once, rel=1e-6)


def test_model_beats_counts_on_held_out_texts(documents):
    found = [r for r in run(documents, corpus(500)) if r["held_out"]]
    assert sum(r["score"] for r in found) > 0.97 * sum(r["base_score"] for r in found)


def test_probabilities_sum_to_one():
    g = np.random.default_rng(0)
    model = scoring.train([g.integers(0, 6, 50) for _ in range(20)], np.full(6, 1 / 6), 0, steps=40)
    every = np.arange(6)
    for a in range(6):
        for b in range(6):
            assert np.exp(model.log_probability(np.full(6, a), np.full(6, b), every)).sum() == pytest.approx(1)


def test_no_training_text(documents):
    (row,) = run(documents, [(None, "a b")])
    assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (3, 0, 0)
    assert row["base_score"] == pytest.approx(0) and math.isfinite(row["score"])
    assert run(documents, []) == []


def test_classes_cover_the_whole_of_all_texts(spark, documents, monkeypatch):
    """A long text counts to its end, has one end only, and words beyond the classes of their own stand in several classes."""
    monkeypatch.setattr(scoring, "CLASSES", 5)
    texts = [t for _, t in corpus(40)] + [" ".join(f"w{k % 700}é{k % 13}" for k in range(9000)), "", " A\tb\x0bC\x0c", "x\x1cy\x85z\xa0w"]
    frame = documents([(k, t, "en", "s") for k, t in enumerate(texts)])
    _, total, distinct, scorer = scoring.learn(frame.select("text"))
    assert scorer.endings == math.isqrt(distinct) > 10
    n = scorer.classes + scorer.endings
    wanted = Counter()
    for text in texts:
        classes = [scorer.class_of(w, scorer.places.get(w, -1)) for w in scoring.tokens(text)]
        opened = [scorer.first()] * 2 + classes
        wanted.update(zip(opened, opened[1:], opened[2:], strict=False))
    *_, older, last, word = scorer.read(pa.array([*texts[:7], None, *texts[7:]]))
    wanted[(scorer.first(),) * 3] += 1  # the null
    assert Counter(zip(older.tolist(), last.tolist(), word.tolist(), strict=True)) == wanted
    assert sum(wanted.values()) == total + 1 and len(scorer.model.bias) == n
    # words of all classes by ending, as the driver counts them, are those that Spark has found
    inside = 10**scorer.inside * (total + 0.1 * (distinct + 1))
    own = Counter()
    for word, count in Counter(w for t in texts for w in scoring.tokens(t)).items():
        if scorer.class_of(word, scorer.places[word]) >= scorer.classes:
            own[scorer.class_of(word, -1) - scorer.classes] += count + 0.1
    assert inside == pytest.approx([own[k] + 0.1 for k in range(scorer.endings)])


def test_every_token_is_trained_on_and_parts_make_one_model(spark, documents, monkeypatch):
    frame = documents([(k, t, "en", "s") for k, t in corpus(100)]).select("text").repartition(3)
    _, total, _, scorer = scoring.learn(frame)
    share = np.full(len(scorer.model.bias), 1 / len(scorer.model.bias))
    start, sums = scoring.first_model(frame, scorer, share, 1)
    models = scoring.further_models(frame, scorer, share, start, sums).collect()
    assert len(models) == 3 and sum(r["tokens"] for r in models) == total
    seen = []
    fit = scoring.Fit(start, [np.full_like(w, 1e-3) for w in start.weights], share, 1)
    monkeypatch.setattr(fit, "step", lambda a, b, word, rate: seen.extend(zip(a, b, word, strict=True)))
    fit.read(np.arange(50), np.arange(50) + 1, np.arange(50) + 2, 7, 0.1)
    assert sorted(seen) == [(k, k + 1, k + 2) for k in range(50)]
    monkeypatch.setattr(scoring, "PART_TOKENS", 3000)
    found = [r for r in run(documents, corpus(500)) if r["held_out"]]
    assert sum(r["score"] for r in found) > 0.97 * sum(r["base_score"] for r in found)


def test_score_equals_sums_over_tokens(spark, documents):
    """The neural score of whole texts, token by token from the scorer's own parts."""
    texts = [t for _, t in corpus(60)]
    frame = documents([(k, t, "en", "s") for k, t in enumerate(texts)])
    _, total, distinct, scorer = scoring.learn(frame.select("text"))
    table = scorer.score(pa.table({"id": list(range(len(texts))), "text": texts}))
    for text, neural in zip(texts, table.column("neural").to_pylist(), strict=True):
        classes = [scorer.class_of(w, scorer.places.get(w, -1)) for w in scoring.tokens(text)]
        opened, wanted = [scorer.first()] * 2 + classes, 0.0
        for k, word in enumerate(scoring.tokens(text)):
            a, b, c = (np.array([x]) for x in opened[k : k + 3])
            every = scorer.model.predicted(a, b) @ scorer.model.target.T + scorer.model.bias
            wanted += (every[0, c[0]] - np.log(np.exp(every[0].astype(float)).sum())) / math.log(10)
            if c[0] >= scorer.classes:
                wanted += scorer.log_share[scorer.places[word]] - scorer.inside[c[0] - scorer.classes]
        assert neural == pytest.approx(wanted, rel=1e-4)


def test_keys_of_any_name(spark):
    rows = spark.createDataFrame([("a", "x y"), ("a", "x y"), (None, None)], "known string, base string")
    for key in ("known", "rare"):
        frame = rows.withColumnRenamed("known", key).withColumns({"n_tokens": F.lit("z"), "id": F.lit(0)})
        found = scoring.score(frame, F.lit(True), key, "base").orderBy(F.col(key).desc()).collect()
        assert [(r[key], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in found] == [("a", 3, 3, 7), ("a", 3, 3, 7), (None, 1, 1, 7)]
