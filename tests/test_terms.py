import random
import re

import pytest
from pyspark.sql import functions as F

from jobloom import lexicon
from jobloom.functions import terms

TERMS = [
    "R", "SQL", "SQL Server", "C++", " C ", " C,", "data", "data mining", "data mining tools", "m.s.", "A/B Testing",
    "Load (ETL) Processes", "big", "big data", "Word", " Word ", "s", "ms", "k", "é", "x_y",
]
PIECES = [t for t in TERMS] + [t.upper() for t in TERMS] + [
    " ", ", ", ".", ";", "  ", "_", "é", "1", "²", "̈", "-", "(", "\n", "İ", "ı", "ſ", "K", "tools", "x",
]


def samples(seed, count=400):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 9))) for _ in range(count)]


def test_word_terms_equal_one_search_per_term(evaluate):
    texts = samples(1)
    low = [t.lower() for t in TERMS]
    wanted = [sorted(t for t in set(low) if re.search(rf"\b{re.escape(t)}\b", s, re.I)) for s in texts]
    assert evaluate(lambda s: terms.word_terms(s, TERMS), texts) == wanted


def test_groups_equal_single_lists(evaluate):
    texts = samples(2, 100)
    groups = {"a": TERMS[:9], "b": TERMS[6:], "c": ["absent"]}
    together = evaluate(lambda s: terms.word_term_groups(s, groups), texts)
    for name, words in groups.items():
        assert [row[name] for row in together] == evaluate(lambda s, w=words: terms.word_terms(s, w), texts)


def test_delimited_terms_equal_one_search_per_term(evaluate):
    texts = samples(3)
    wanted, squeezed = [], []
    for s in texts:
        hits = [t for t in TERMS if re.search(f"[.; ,]{re.escape(t)}[.; ,]", s, re.I)]
        wanted.append(sorted({t.strip(" .,;").lower() for t in hits}))
        low = [t.lower() for t in TERMS if re.search(f"[.; ,]{re.escape(t.lower())}[.; ,]", s.lower())]
        squeezed.append(sorted({re.sub("[.; ,]", "", t) for t in low}))
    assert evaluate(lambda s: terms.delimited_terms(s, TERMS), texts) == wanted
    assert evaluate(lambda s: terms.delimited_terms_squeezed(s, TERMS), texts) == squeezed


def test_substring_terms_keep_list_order_and_case(evaluate):
    texts = samples(4, 100)
    wanted = [[t.lower() for t in TERMS if t in s] for s in texts]
    assert evaluate(lambda s: terms.substring_terms(s, TERMS), texts) == wanted


def test_term_count_equals_one_search_per_term(evaluate):
    texts = samples(5)
    wanted = [sum(1 for t in TERMS if re.search(rf"\b{re.escape(t.lower())}\b", s.lower())) for s in texts]
    assert evaluate(lambda s: terms.term_count(s, TERMS), texts) == wanted


@pytest.mark.parametrize("role_terms", [lexicon.ROLE_TERMS_A, lexicon.ROLE_TERMS_B])
def test_role_terms_of_the_boards(evaluate, role_terms):
    rng = random.Random(6)
    words = [t for ts in role_terms.values() for t in ts]
    texts = ["; ".join(rng.sample(words, rng.randint(0, 12))) for _ in range(60)]
    for role, ts in role_terms.items():
        wanted = [sum(1 for t in ts if re.search(rf"\b{re.escape(t.lower())}\b", s.lower())) for s in texts]
        assert evaluate(lambda s, r=role: terms.role_term_count(s, F.lit(r), role_terms), texts) == wanted


def test_nulls_and_unknown_roles(evaluate):
    assert evaluate(lambda s: terms.delimited_terms(s, TERMS), [None]) == [[]]
    assert evaluate(lambda s: terms.delimited_terms_squeezed(s, TERMS), [None]) == [None]
    assert evaluate(lambda s: terms.word_terms(s, TERMS), [None]) == [[]]
    assert evaluate(lambda s: terms.substring_terms(s, TERMS), [None]) == [[]]
    counts = lambda role: (lambda s: terms.role_term_count(s, F.lit(role), lexicon.ROLE_TERMS_A))
    assert evaluate(counts("DATA ANALYST"), [None, "sql, python"]) == [0, 2]
    assert evaluate(counts("CLOUD ENGINEER"), ["sql"]) == [None]


def test_board_differences(evaluate):
    body = ["skills: Power BI, Accuracy. accuracy"]
    assert evaluate(lambda s: terms.delimited_terms(s, lexicon.TOOLS), body) == [["power bi"]]
    assert evaluate(lambda s: terms.delimited_terms_squeezed(s, lexicon.TOOLS), body) == [["powerbi"]]
    assert evaluate(lambda s: terms.substring_terms(s, lexicon.lowered(lexicon.SOFT_SKILLS)), ["Accuracy"]) == [[]]
    assert evaluate(lambda s: terms.word_terms(s, lexicon.SOFT_SKILLS), ["Accuracy"]) == [["accuracy"]]
    assert evaluate(lambda s: terms.delimited_terms(s, lexicon.TOOLS), ["SQL, then Python"]) == [[]]


def test_list_sizes():
    sizes = {r: len(t) for r, t in lexicon.ROLE_TERMS_A.items()}
    assert sizes == {
        "MACHINE LEARNING ENGINEER": 44, "DATA SCIENTIST": 54, "DATA ENGINEER": 43, "DATA ANALYST": 64,
    }
    assert [len(t) for t in lexicon.ROLE_TERMS_B.values()] == [44, 51, 42, 64]
    assert [len(x) for x in (lexicon.TOOLS, lexicon.SOFT_SKILLS, lexicon.INDUSTRY_SKILLS, lexicon.EDUCATION)] == [
        77, 67, 62, 10,
    ]


def test_counts_of_several_lists_equal_single_counts(evaluate):
    texts = [*samples(6), None]
    groups = {"a": TERMS[:9], "b b": TERMS[6:], "c": ["absent"]}
    together = evaluate(lambda s: terms.term_counts(s, groups), texts)
    for name, words in groups.items():
        assert [row[name] for row in together] == evaluate(lambda s, w=words: terms.term_count(s, w), texts)


def test_word_search_begins_with_a_plain_class():
    """Java settles most positions by a table of single characters, before classes of all Unicode letters."""
    assert terms.word_pattern(["sql", "r"]).startswith("[^abc")
    assert terms.delimited_pattern(["sql"]).startswith(terms.DELIMITER)
