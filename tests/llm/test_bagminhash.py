import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from jobloom.llm import bagminhash, components

WORDS = [f"w{k}" for k in range(300)]


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else Counter()


def similarity(a, b):
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 0.0


def brute_classes(rows):
    parent = list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    bags = [shingles(t) if t is not None else None for _, t in rows]
    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if a is not None and b is not None and (a == b or similarity(bags[i], bags[j]) >= 0.8):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for k, (key, text) in enumerate(rows):
        if text is not None and key is not None:
            least[find(k)] = min(least.get(find(k), key), key)
    return sorted([(key, least.get(find(k), key) if text is not None else key) for k, (key, text) in enumerate(rows)], key=repr)


def corpus(seed, n=60):
    r = random.Random(seed)
    texts = []
    for _ in range(n):
        words = [r.choice(WORDS) for _ in range(r.choice([3, 12, 60, 200]))]
        texts.append(" ".join(words))
        for _ in range(r.choice([0, 0, 1, 3])):
            copy = [r.choice(WORDS) if r.random() < r.choice([0, 0.01, 0.03, 0.08]) else w for w in words]
            texts.append(" ".join(copy * r.choice([1, 1, 2])))
    r.shuffle(texts)
    return texts


def found(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(((r["doc_id"], r["class_id"]) for r in bagminhash.classes(frame).collect()), key=repr)


def test_signatures_estimate_the_weighted_similarity_without_bias():
    g = np.random.default_rng(1)
    owner, value, weight, true = [], [], [], []
    for p in range(150):
        a = g.integers(0, 2**63, 300, dtype=np.uint64)
        wa = g.choice([1, 1, 2, 3, 5, 9, 40], 300)
        b = np.where(g.random(300) < 0.9, a, g.integers(0, 2**63, 300, dtype=np.uint64))
        wb = np.where(g.random(300) < 0.8, wa, g.choice([1, 2, 6], 300))
        x, y = Counter(dict(zip(a.tolist(), wa.tolist(), strict=True))), Counter(dict(zip(b.tolist(), wb.tolist(), strict=True)))
        true.append(similarity(x, y))
        for k, (v, w) in enumerate(((a, wa), (b, wb))):
            owner.append(np.full(300, 2 * p + k))
            value.append(v)
            weight.append(w)
    s = bagminhash.signatures(np.concatenate(owner), np.concatenate(value), np.concatenate(weight), 300)
    error = (s[0::2] == s[1::2]).mean(axis=1) - np.array(true)
    assert abs(error.mean()) < 0.015
    assert error.std() < 0.06


def test_classes_equal_brute_force(spark):
    for seed in (1, 2):
        rows = list(enumerate(corpus(seed)))
        assert found(spark, rows) == brute_classes(rows)


def test_a_group_of_copies_around_one_text(spark):
    r = random.Random(5)
    center = [r.choice(WORDS) for _ in range(120)]
    rows = []
    for k in range(120):
        words = center[:]
        for _ in range(r.choice([1, 2, 3, 5, 9])):
            words[r.randrange(len(words))] = f"x{r.random()}"
        rows.append((k, " ".join(words)))
    assert found(spark, rows) == brute_classes(rows)


def test_defined_cases(spark):
    long_ = " ".join(WORDS * 40)
    rows = [(1, None), (2, None), (3, ""), (4, ""), (5, "  "), (6, "a b"), (6, "a b"), (7, "a b c"), (8, long_), (9, long_ + " end"), (None, "a b"), (None, None)]
    assert found(spark, rows) == brute_classes(rows)
    assert found(spark, []) == []


def test_clashing_columns(spark):
    frame = spark.createDataFrame([(1, "a b c d e f", 5, "n"), (2, "a b c d e f", 6, "m")], "doc_id long, text string, node int, root string")
    assert {r["class_id"] for r in bagminhash.classes(frame).collect()} == {1}


def test_components_of_paths_and_stars(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(200, 200), (None, 3), (300, 301)]
    frame = spark.createDataFrame(links, "a long, b long")
    roots = {r["vertex"]: r["root"] for r in components.components(frame, "a", "b").collect()}
    assert roots == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100), 300: 300, 301: 300}
    assert components.components(frame.where(F.lit(False)), "a", "b").count() == 0


def test_blocks_alone_find_every_link(spark, monkeypatch):
    monkeypatch.setattr(bagminhash, "PIVOTS", 0)
    monkeypatch.setattr(bagminhash, "BLOCK_TEXTS", 8)
    monkeypatch.setattr(bagminhash, "COLUMNS", 16)
    r = random.Random(9)
    center = [r.choice(WORDS) for _ in range(80)]
    rows = []
    for k in range(70):
        words = center[:]
        for _ in range(r.choice([1, 2, 3, 4])):
            words[r.randrange(len(words))] = r.choice(["x", "y", f"z{k}"])
        rows.append((k, " ".join(words)))
    assert found(spark, rows) == brute_classes(rows)


def test_overlaps_of_a_block():
    g = np.random.default_rng(3)
    bags = [np.unique(g.integers(0, 400, g.integers(1, 200)).astype(np.uint64)) for _ in range(12)]
    wanted = [[len(set(a.tolist()) & set(b.tolist())) for b in bags] for a in bags]
    found_ = bagminhash._overlaps(bags)
    assert all(found_[i][j] == wanted[i][j] for i in range(12) for j in range(12) if i != j)
