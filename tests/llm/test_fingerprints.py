import hashlib
import random
import re

import numpy as np

from jobloom.llm import fingerprints


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}


def likeness(a, b):
    return len(a & b) / len(a | b)


def corpus(n):
    r = random.Random(6)
    words = [f"w{k}" for k in range(500)]
    return [(k * 3, " ".join(r.choice(words) for _ in range(r.choice([1, 4, 30, 200, 700])))) for k in range(n)]


def run(documents, rows):
    frame = documents([(k, t, "en", "s") for k, t in rows])
    return fingerprints.fingerprint_documents(frame).collect()


def test_edits_and_likeness_equal_brute_force(documents):
    rows = corpus(150) + [(1000, None), (1001, ""), (1002, "é" * 7), (1003, "a b c d e " * 4000)]
    found = {r["doc_id"]: r for r in run(documents, rows)}
    order = sorted(rows, reverse=True)
    errors = []
    for at, (key, text) in enumerate(order):
        text, after = text or "", order[(at + 1) % len(order)][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        assert found[key]["n_chars"] == len(text)
        assert found[key]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= found[key]["near_edited"] <= 1
        if len(text) > 500:
            errors.append(found[key]["near_edited"] - likeness(shingles(text), shingles(edited)))
    assert abs(np.mean(errors)) < 0.02
    assert np.std(errors) < 0.08


def test_equal_texts_have_equal_fingerprints(documents):
    found = run(documents, [(1, "a b c d e f g"), (2, "a b c d e f g"), (2, "a b c d e f g"), (3, None), (4, ""), (5, "x y")])
    prints = {}
    for r in found:
        prints.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    assert len(found) == 6
    assert prints[1] == prints[2] and prints[3] == prints[4] and prints[5] != prints[4]
    assert len(next(iter(prints[1]))) == fingerprints.BINS * fingerprints.LOW_BITS // 4


def test_one_row_follows_itself_and_an_empty_table(documents):
    (row,) = run(documents, [(7, "a b c d e f g h i")])
    assert row["near_next"] == 1.0
    assert run(documents, []) == []
    assert len(run(documents, [(None, "a"), (None, "b"), (1, "c")])) == 3
