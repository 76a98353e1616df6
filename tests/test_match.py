import random

import pytest
from pyspark.sql import functions as F

from jobloom.operators import match, metrics


def subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def form(name):
    kept = "".join(c if c.isalnum() or c == "_" else " " for c in "".join(name.lower().split()))
    return kept.strip()


def tokens(processed):
    return " ".join(sorted(processed.split()))


def brute_force(lefts, rights, threshold):
    out = {}
    for left in lefts:
        best, chosen = 0.0, ""
        a = tokens(form(left))
        for right in sorted(rights):
            b = tokens(form(right))
            if a and b:
                score = 200.0 * subsequence(a, b) / (len(a) + len(b))
                if score > best + 1e-9:
                    best, chosen = score, form(right)
        out[left] = chosen if best >= threshold - 1e-9 else ""
    return out


def random_names(seed, longest, count=120):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randint(2, 8))) for _ in range(15)]

    def name():
        joined = "".join(rng.choice(words) + rng.choice(["", "", "/"]) for _ in range(rng.randint(1, 8)))
        return joined[: rng.randint(3, longest)]

    def changed(text):
        chars = list(text)
        for _ in range(rng.randint(0, 4)):
            if rng.random() < 0.5 and len(chars) > 3:
                del chars[rng.randrange(len(chars))]
            else:
                chars.insert(rng.randrange(len(chars) + 1), rng.choice("abcd_/ "))
        return "".join(chars)

    rights = sorted({name() for _ in range(count)})
    lefts = sorted({changed(rng.choice(rights)) for _ in range(count)})
    return lefts, rights


@pytest.mark.parametrize("seed,longest,threshold", [(1, 28, 95), (2, 60, 95), (3, 45, 90), (4, 20, 85), (5, 40, 100), (6, 45, 80), (7, 30, 70), (8, 12, 60)])
def test_best_matches_equal_comparing_every_pair(spark, seed, longest, threshold):
    lefts, rights = random_names(seed, longest)
    left = spark.createDataFrame([(x,) for x in lefts], "name string")
    right = spark.createDataFrame([(x,) for x in rights], "company_name string")
    found = match.best_matches(left, right, "name", "company_name", threshold).collect()
    wanted = brute_force(lefts, rights, threshold)
    assert {r["name"]: r["matches"] for r in found} == wanted
    assert sum(v != "" for v in wanted.values()) > 10
    assert len(found) == len(lefts)


def test_nulls_and_empty_names_take_no_part(spark):
    left = spark.createDataFrame([("--",), ("Acme Inc",), (None,)], "name string")
    right = spark.createDataFrame([(".",), ("acme",), (None,), ("a-cme",)], "company_name string")
    found = match.best_matches(left, right, "name", "company_name")
    assert {r["name"]: r["matches"] for r in found.collect()} == {"--": "", "Acme Inc": "acme", None: ""}
    merged = match.merge_matches(found, right.withColumn("Company_name_url", F.col("company_name")))
    assert sorted(r["company_name"] for r in merged.collect()) == ["a-cme", "acme"]


def test_ties_go_to_the_first_entry(spark):
    left = spark.createDataFrame([("abcdefghijkl",)], "name string")
    right = spark.createDataFrame([("abcdefghijklz", 2), ("abcdefghijkly", 1)], "company_name string, at int")
    by_name = match.best_matches(left, right, "name", "company_name").head()
    by_position = match.best_matches(left, right.withColumn("at", -F.col("at")), "name", "company_name", entry_order="at").head()
    assert (by_name["matches"], by_position["matches"]) == ("abcdefghijkly", "abcdefghijklz")


def test_threshold_is_checked(spark):
    for threshold in (50, 101):
        with pytest.raises(ValueError):
            match.best_matches(spark.range(1), spark.range(1), "id", "id", threshold)


@pytest.mark.parametrize("threshold", [60, 66, 75])
def test_short_names_at_low_thresholds(spark, threshold):
    rights = ["a", "b", "ab", "ba", "abc", "cab", "xyz", "aaa", "aab", "zz"]
    lefts = rights + ["aa", "abx", "xa", "c", "axbycz", "zyx", "q"]
    left = spark.createDataFrame([(x,) for x in lefts], "name string")
    right = spark.createDataFrame([(x,) for x in rights], "company_name string")
    found = match.best_matches(left, right, "name", "company_name", threshold).collect()
    assert {r["name"]: r["matches"] for r in found} == brute_force(lefts, rights, threshold)


def test_very_long_names(spark):
    rng = random.Random(5)
    rights = ["".join(rng.choice("abcdefgh") for _ in range(400)) for _ in range(6)]
    lefts = [r[:50] + r[55:300] + "hg" + r[300:] for r in rights] + ["ab" * 200]
    left = spark.createDataFrame([(x,) for x in lefts], "name string")
    right = spark.createDataFrame([(x,) for x in rights], "company_name string")
    found = match.best_matches(left, right, "name", "company_name", 95).collect()
    assert {r["name"]: r["matches"] for r in found} == brute_force(lefts, rights, 95)


#: Rows that a name of 30, 60 and 80 characters emits, by threshold; the README states them.
EMITTED = {95: [15, 126, 330], 85: [120, 816, 1771], 70: [105, 406, 703], 60: [171, 630, 1081]}


def test_rows_emitted_for_a_name(spark):
    rng = random.Random(6)
    names = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)) for n in (30, 60, 80)]
    rows = spark.createDataFrame([(n, len(n)) for n in names], "form string, size int")
    for threshold, wanted in EMITTED.items():
        most = next(m for step, m in match.STEPS if step <= threshold)
        emitted = match._keys(rows, {"a": 0.5, "b": 0.5}, threshold / 100, most).groupBy("size").count().orderBy("size").collect()
        assert [r["count"] for r in emitted] == wanted
        assert sum(wanted) == match._emitted({30: 1, 60: 1, 80: 1}, threshold / 100, most)


def test_rarity_of_unknown_characters_and_few_shares(spark, monkeypatch):
    """The order by rarity is only a matter of speed."""
    lefts, rights = random_names(12, 30, 60)
    monkeypatch.setattr(match, "MOST_CHARACTERS", 2)
    left = spark.createDataFrame([(x,) for x in [*lefts, "\ue000\ue001x🙂🙂", "🙂y"]], "name string")
    right = spark.createDataFrame([(x,) for x in [*rights, "\ue000\ue001x🙂", "🙂yz"]], "company_name string")
    found = {r["name"]: r["matches"] for r in match.best_matches(left, right, "name", "company_name", 75).collect()}
    assert {n: found[n] for n in lefts} == brute_force(lefts, [*rights], 75)


def test_directory_and_counts(spark):
    urls = spark.createDataFrame(
        [("x/organization/b",), ("x/organization/b",), ("y/organization/b",), ("x/person/c",), ("x/organization/%2",),
         ("x/organization/",), (None,)],
        "Company_name_url string",
    )
    assert [tuple(r) for r in match.company_directory(urls).collect()] == [("b", "x/organization/b")]
    names = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "name string")
    counts = metrics.most_frequent_first(match.employers(names), "name").collect()
    assert [tuple(r) for r in counts] == [("a", 2), ("b", 1)]
