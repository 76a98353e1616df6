import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from jobloom.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """All nodes by loops; ``rows`` are (conv_id, turn, role, text) without two of one turn."""
    own = {}
    for conv, turn, role, text in sorted([r for r in rows if r[0] is not None], key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(conv, []).append((role or "", text or ""))
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    members = {}
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    children, leaves, saved = {}, {}, {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    for node, convs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] = leaves.get(node[:d], 0) + (node not in children)
            saved[node[:d]] = saved.get(node[:d], 0) + (len(convs) - 1) * (len(node[-1][1].encode()) if node else 0)
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(node))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), children.get(node, 0), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found(spark, rows, parts=3):
    turns = spark.createDataFrame(rows, SCHEMA).withColumns({"conv": F.lit("x"), "depth": F.lit(1), "p1": F.lit(1), "a": F.lit(""), "place": F.lit(0)})
    return sorted([tuple(r[c] for c in COLUMNS) for r in trie.trie_conversations(turns.repartition(parts)).collect()], key=repr)


def random_rows(seed, convs=120):
    r = random.Random(seed)
    rows = []
    for c in range(convs):
        if c % 7 == 3:
            continue  # an absent base for some
        for t in range(r.choice([1, 2, 3, 9, 12, 30])):
            rows.append((c, None if t == 0 and c % 3 else t, r.choice(["user", "assistant", None]), r.choice(["", None, "é", "ab", "c"])))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("cells", [trie.LEAST_CELLS, 8])
def test_equals_loops(spark, monkeypatch, cells):
    monkeypatch.setattr(trie, "LEAST_CELLS", cells)  # few cells: nothing is screened, everything is grouped
    monkeypatch.setattr(trie, "MOST_CELLS", cells)
    monkeypatch.setattr(trie, "RANGE", 8 if cells == 8 else 1024)
    monkeypatch.setattr(trie, "BLOCK", 4)  # paths of many blocks
    monkeypatch.setattr(trie, "JOINED_CHARS", 10)  # ends in many texts
    rows = random_rows(1)
    assert found(spark, rows) == plain(rows)


def test_hot_conversation_copies_and_first_turn(spark):
    rows = [(0, t, "user", f"t{t}") for t in range(1500)]
    rows += [(5 * c, t, "user", f"same {t}") for c in range(1, 200) for t in range(3)]
    rows += [(5 * c, t, "user", "hello" if t == 0 else f"{c} {t}") for c in range(200, 300) for t in range(3)]
    got = found(spark, rows, 5)
    assert got == plain(rows)


def test_nulls_keys_empty_and_repeated_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "x")]) == []
    rows = [(1, None, None, None), (None, 1, "user", "x"), (10**12 + 1, 3, "user", "long " * 20_000)]
    assert found(spark, rows) == plain(rows)
    turns = [(5, 1, "user", "x"), (5, 1, "user", "x"), (5, 1, "user", "a")]  # turns of one number: in a fixed order
    assert found(spark, turns) == found(spark, turns[::-1], 1)
    assert sorted(r[1] for r in found(spark, turns)) == [0, 1, 2, 3]


def test_members_without_turns_are_in_the_root(spark):
    alone = next(c for c in range(1, 1000) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 3)
    rows = [(alone, 1, "user", "never reached")]
    assert found(spark, rows) == plain(rows) and len(plain(rows)) == 1


def test_numbers_go_on_over_tasks(spark):
    rows = [(k % 3 if k % 2 else 7, k) for k in range(2000)]
    got = trie.numbered(spark.createDataFrame(rows, "k long, v long"), "k", [F.col("v")]).collect()
    seen = {}
    for k, v in sorted(rows):
        seen.setdefault(k, []).append(v)
    assert sorted((r["k"], r["v"], r["place"]) for r in got) == sorted((k, v, n) for k, vs in seen.items() for n, v in enumerate(vs, 1))


def test_sketch_never_misses_a_repeat():
    import numpy as np

    r = np.random.default_rng(1)
    p = r.integers(-(2**62), 2**62, (2, 3000))
    parts = [trie.Sketch(4096) for _ in range(3)]
    for k, s in enumerate(parts):
        s.add(p[0, k * 900 : k * 900 + 1200], p[1, k * 900 : k * 900 + 1200])  # 300 of two tasks each
    import pandas as pd

    rows = pd.DataFrame([row for k, s in enumerate(parts) for row in s.rows(k)])
    again = [np.zeros(512, np.uint8), np.zeros(512, np.uint8)]
    for (lane, _), group in rows.groupby(["lane", "cells"]):
        again[lane] = np.frombuffer(trie._merged(group)["again"].iloc[0], np.uint8)
    for k in [*range(900, 1200), *range(1800, 2100)]:
        assert all(again[lane][(p[lane, k] & 4095) >> 3] >> (7 - ((p[lane, k] & 4095) & 7)) & 1 for lane in range(2))
