import random
import re
from collections import Counter

from jobloom.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = len(words)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(tuple(words[k : k + 3]) for k in range(n - 2))
    covered = {j for k in range(n - 2) if seen[tuple(words[k : k + 3])] > 1 for j in range(k, k + 3)}
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def sentence(r, n):
    return " ".join(r.choice(["the", "of", "and", "to"]) if r.random() < 0.4 else "".join(r.choice("etaoinshrdlu") for _ in range(6)) for _ in range(n)).capitalize() + "."


def counts(row):
    return (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"], row["base_failed"])


def test_counts_equal_brute_force(documents):
    r = random.Random(1)
    texts = [None, "", " \n\t ", "a b", "a b c", "a b c a b c", "x\n\nx\n x\ny", "a a a a a", "é # ß$|", "\x0b a\x0cb \x1c"]
    texts += ["".join(r.choice("ab \n#é.") for _ in range(r.randint(0, 300))) for _ in range(80)]
    texts += [" ".join(r.choice("abcde") for _ in range(r.randint(0, 200))) for _ in range(40)] + ["one two three four " * 6000]
    rows = {x["doc_id"]: x for x in quality.judge_documents(documents([(k, t, "en", "s") for k, t in enumerate(texts)])).collect()}
    assert [counts(rows[k]) for k in range(len(texts))] == [brute(t) for t in texts]
    assert not any(rows[k]["kept"] and rows[k]["base_failed"] for k in rows)


def test_sound_texts_are_kept_and_odd_ones_go(documents):
    r = random.Random(2)
    rows = [(k, " ".join(sentence(r, 12) for _ in range(20)), "en" if k % 7 else None, "s") for k in range(120)]
    odd = [" ".join(f"{w}###" if k % 2 else f"$$${w}|" for k, w in enumerate(sentence(r, 200).split())), " ".join(str(r.randint(0, 10**9)) for _ in range(200))]
    rows += [(200 + k, t, "en", "s") for k, t in enumerate(odd)]
    found = {x["doc_id"]: x["kept"] for x in quality.judge_documents(documents(rows)).collect()}
    assert all(found[k] for k in range(120))
    assert not any(found[200 + k] for k in range(len(odd)))


def test_texts_without_common_words_go_and_others_stay(documents):
    """Also where a good part of the texts is such junk, and from fifty words on."""
    r = random.Random(3)
    rows = [(k, " ".join(sentence(r, 12) for _ in range(r.choice([5, 10, 17, 30]))), r.choice(["en", "fr"]), "s") for k in range(400)]
    junk = ["".join(r.choice("etaoinshrdlu") for _ in range(r.randint(3, 9))) for _ in range(9000)]
    rows += [(1000 + k, " ".join(r.sample(junk, r.choice([60, 120, 200, 360]))), "en", "s") for k in range(60)]
    found = {x["doc_id"]: x["kept"] for x in quality.judge_documents(documents(rows)).collect()}
    assert not any(found[1000 + k] for k in range(60))
    assert sum(found[k] for k in range(400)) >= 396


def test_repeated_rows_and_other_columns(documents):
    r = random.Random(4)
    text = " ".join(sentence(r, 12) for _ in range(10))
    rows = documents([(1, text, "en", "s")] * 3 + [(2, None, None, None)]).selectExpr("*", "1 AS steps", "'x' AS `limit`", "2 AS n_words", "'y' AS `key`")
    found = sorted((x["doc_id"], x["n_words"], x["kept"]) for x in quality.judge(rows).collect())
    assert found == [(1, 120, True)] * 3 + [(2, 0, False)]


def test_empty_table(documents):
    assert quality.judge_documents(documents([])).count() == 0
