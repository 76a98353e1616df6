import datetime as dt
import html as html_lib
import random
import re

from pyspark.sql import functions as F

from jobloom.functions import dates, names, text

SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0      　"


def test_clean_text_matches_its_definition(evaluate):
    rng = random.Random(1)
    samples = ["a<br>b", "", None, "<<p>x>y", " A \xa0 b <i\n>C</i> "]
    samples += ["".join(rng.choice(SPACES + "aB<>é") for _ in range(40)) for _ in range(50)]
    wanted = [
        None if s is None else re.sub(r"\s+", " ", re.sub("<[^>]+>", "", s)).strip().lower() for s in samples
    ]
    assert evaluate(text.clean_text, samples) == wanted


def test_days_since_posted(evaluate):
    ages = ["Today", "Just posted", "30+ days", "", None, "posted 4 of 7 days"]
    assert evaluate(text.days_since_posted, ages) == [0, 0, 30, None, None, 4]


def test_days_since_posted_text(evaluate):
    posted = [
        "Posted 5 days ago", "30+ days ago", "Posted Today", "on 12 Jul", "on 12 July", "on 1 JUN", "on 31 Feb", None, "",
    ]
    days = evaluate(lambda s: dates.days_since_posted_text(s, dt.date(2024, 7, 26), 2024), posted)
    assert days == [5, 30, 0, 14, None, 55, None, None, None]


def test_experience(evaluate):
    samples = ["3-5 years", "2 to 4 years, 7+ years", "5 Years", "x12 years", "3\xa0years and 4 yearsx", None]
    assert evaluate(text.experience_years, samples) == [["3-5"], ["2 to 4", "7+"], [], [], ["3"], None]
    assert evaluate(text.experience_range, ["3 - 8 Years", "none given", None]) == ["3-8", "nonegiven", None]


def test_salaries(evaluate):
    samples = ["$1,200.50 - $2,000 a week, $30 per hour, $9 a month", "$5–$6\xa0per day", "none"]
    found = [[tuple(x) for x in row] for row in evaluate(text.salaries, samples)]
    assert found == [
        [("$1,200.50 - $2,000", "a", "week"), ("$30", "per", "hour")], [("$5–$6", "per", "day")], [],
    ]


def test_titles_and_addresses(spark, evaluate):
    rows = spark.createDataFrame(
        [("Acme Engineer", "Acme"), (" Lead ", None), ("Lead", "")], "title string, name string"
    )
    short = rows.select(text.without_employer(F.col("title"), F.col("name")).alias("v")).collect()
    assert [r["v"] for r in short] == ["Engineer", "Lead", "Lead"]
    assert evaluate(text.role_label, ["data_scientist", "data-engineer"]) == ["DATA SCIENTIST", "DATA ENGINEER"]
    assert evaluate(text.url_quote, ["a b*~/é?&+"]) == ["a%20b%2A~/%C3%A9%3F%26%2B"]
    assert evaluate(text.file_token, ["a b c"]) == ["a_b_c"]
    assert evaluate(lambda s: text.page_url(s, F.lit(20)), ["u?q=1", None]) == ["u?q=1&start=20", None]
    assert evaluate(lambda s: text.prefixed("https://x/", s), ["me", None]) == ["https://x/me", None]


def test_lists_as_text(evaluate):
    assert evaluate(text.text_to_list, ["['a', \"it's\"]", "[]", None]) == [["a", "it's"], [], None]
    assert evaluate(lambda s: text.text_to_list(text.list_to_text(F.array(s, s))), ["q\"'"]) == [["q\"'"] * 2]


def test_iso_parsing(evaluate):
    assert evaluate(dates.iso_date, ["2024-07-09"]) == [dt.date(2024, 7, 9)]
    assert evaluate(dates.iso_timestamp, ["2024-07-09T01:02:03Z", "2024-07-09T01:02:03"]) == [
        dt.datetime(2024, 7, 9, 1, 2, 3)
    ] * 2
    assert dates.short_stamp(dt.date(2024, 8, 9)) == "2024-8-9"
    assert dates.short_stamp(dt.date(2024, 8, 9), with_day=False) == "2024-8"
    assert evaluate(lambda s: dates.run_stamp(dt.date(2024, 8, 9)), ["x"]) == ["2024-08-09"]


def test_employer_names(evaluate):
    assert evaluate(names.clean_employer_name, ["ITT, Inc.", "it-t", "The A & B LLC", "Garage AG", None]) == [
        "itt,", "itt", "ab", "garage", None,
    ]
    assert evaluate(names.match_form, ["ITT, Inc.", "--", "a/b_c"]) == ["itt", "", "a b_c"]
    assert evaluate(names.company_slug, ["https://x/organization/abc", "organization/%e6", "organization/", None]) == [
        "abc", None, None, None,
    ]
    assert evaluate(names.company_slug, ["organization/a/organization/b", "no slug"]) == ["b", "no slug"]


def test_unescape_state(evaluate):
    assert evaluate(names.unescape_state, ["&a;q;", "&l;a&g;&s;&q;&a;"]) == ['"', "<a>'\"&"]
    assert html_lib.unescape("&amp;") == "&"


def test_token_sort_ratio(evaluate):
    def ratio(other):
        return lambda s: names.token_sort_ratio(s, F.lit(other))

    assert evaluate(ratio("salsa"), ["salla", "", None]) == [80.0, 0.0, None]
    assert evaluate(ratio("b  a"), ["a b", "a"]) == [100.0, 50.0]
    assert evaluate(ratio(""), [""]) == [100.0]


def test_common_subsequence_lengths_equal_the_table():
    import random

    from jobloom.functions.subsequence import common_lengths

    def table(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return row[-1]

    rng = random.Random(1)
    sides = [["".join(rng.choice("abcé🙂 ") for _ in range(rng.choice([0, 1, 5, 63, 64, 65, 129]))) for _ in range(120)] for _ in range(2)]
    assert common_lengths(*sides).tolist() == [table(a, b) for a, b in zip(*sides)]
    assert common_lengths([], []).tolist() == [] and common_lengths(["", "a"], ["", ""]).tolist() == [0, 0]


def test_squashed_spaces_and_single_blanks(evaluate):
    signs = ["a", " ", " ", "\t", "\n", "\x1c", "\x85", "\u00a0", "\u2003", "\u3000", "\u200b", "\u00e9", "\U0001d400", "-"]
    rng = random.Random(7)
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 12))) for _ in range(400)]
    space = "[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
    assert evaluate(text.squash_spaces, texts) == [re.sub(space, " ", t).strip(" ") for t in texts]
    assert not re.search(text.RUN_OF_SPACE.split("(?<=")[0], "single blanks (and signs) stay")
