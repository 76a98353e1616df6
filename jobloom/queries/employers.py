"""Queries on employer names: cleaning, similarity, the fuzzy match and what follows from it."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobloom import lexicon
from jobloom.functions import names
from jobloom.operators import match, metrics
from jobloom.queries.patterns import SPACE
from jobloom.queries.registry import Derived, literal, query

# Names of three lengths out of parts; the directory and the postings take different lengths of a part's name.
_BRAND = "replace(p_brand, '#', '')"


def _base(selector: str) -> str:
    return f"""CASE {selector} WHEN 0 THEN p_name WHEN 1 THEN p_name || ' ' || {_BRAND}
        WHEN 2 THEN p_name || ' ' || {_BRAND} || ' ' || p_type
        ELSE p_name || ' ' || {_BRAND} || ' ' || p_type || ' holding company' END"""


_COMPANIES = Derived("part", {"p_partkey": "p_partkey", "company": f"lower({_base('p_partkey % 4')})"}, costly=True)
_SLUGS = Derived(
    _COMPANIES,
    {"p_partkey": "p_partkey", "slug": "replace(company, ' ', CASE p_partkey % 7 WHEN 0 THEN '' ELSE '-' END)"},
)
COMPANY_URLS = Derived(
    _SLUGS,
    {
        "Company_name_url": """'https://dir.example/' || CASE p_partkey % 50 WHEN 0 THEN 'organization/%e6'
            WHEN 1 THEN 'organization/' WHEN 2 THEN 'person/' || slug ELSE 'organization/' || slug END"""
    },
)
_NAMES = Derived(
    "part", {"p_partkey": "p_partkey", "base": _base("CAST(floor(p_partkey / 4) AS INT) % 4")}, costly=True
)
# One character lost, one gained, or three changed; then the legal forms and a leading article.
_MISTYPED = Derived(
    _NAMES,
    {
        "p_partkey": "p_partkey",
        "typed": """CASE p_partkey % 5 WHEN 1 THEN substr(base, 1, 4) || substr(base, 6)
            WHEN 2 THEN substr(base, 1, 6) || 'x' || substr(base, 7)
            WHEN 3 THEN 'q' || substr(base, 1, 3) || substr(base, 5, 5) || 'z' || substr(base, 10) ELSE base END""",
    },
)
POSTED = Derived(
    _MISTYPED,
    {
        "p_partkey": "p_partkey",
        "name": """CASE p_partkey % 6 WHEN 0 THEN 'The ' || typed WHEN 1 THEN typed || ' LLC'
            WHEN 2 THEN typed || ', Inc.' WHEN 3 THEN replace(typed, ' ', ' & ')
            WHEN 4 THEN CASE WHEN p_partkey % 60 = 4 THEN NULL ELSE typed END ELSE typed END""",
    },
)


def _clean_sql(name: str) -> str:
    for part in lexicon.NAME_NOISE:
        name = f"replace({name}, {literal(part)}, '')"
    return f"regexp_replace(lower({name}), {literal(SPACE)}, '', 'g')"


def _form_sql(name: str) -> str:
    return f"trim(regexp_replace({_clean_sql(name)}, '[^\\p{{L}}\\p{{N}}_]', ' ', 'g'))"


def _sorted_sql(form: str) -> str:
    return f"array_to_string(list_sort(list_filter(string_split({form}, ' '), lambda x: x <> '')), ' ')"


def _lcs_sql(a: str, b: str) -> str:
    """Rows of the table of common subsequence lengths, folded character by character."""
    inner = f"""list_reduce(list_transform(range(1, length({b}) + 1), lambda j: [j]),
        lambda acc, j: list_append(acc, CASE WHEN substr({b}, j[1], 1) = substr({a}, i[1], 1) THEN prev[j[1]] + 1
        ELSE greatest(acc[-1], prev[j[1] + 1]) END), [0::BIGINT])"""
    return f"""list_reduce(list_transform(range(1, length({a}) + 1), lambda i: [i]), lambda prev, i: {inner},
        list_transform(range(0, length({b}) + 1), lambda z: 0::BIGINT))[-1]"""


@query(f"SELECT p_partkey, {_clean_sql('name')} AS cleaned, {_form_sql('name')} AS form FROM {POSTED.sql()} p")
def clean_company_name(spark, sf_dir):
    name = F.col("name")
    return POSTED.frame(spark, sf_dir).select(
        "p_partkey", names.clean_employer_name(name).alias("cleaned"), names.match_form(name).alias("form")
    )


PAIRS = Derived("part", {"p_partkey": "p_partkey", "a": "p_name || ', ' || p_type", "b": "lower(p_type) || ' ' || p_name"})
_A, _B = _sorted_sql("a"), _sorted_sql("b")


@query(
    f"""SELECT p_partkey, round({_lcs_sql('x', 'y')} * 200.0::DOUBLE / (length(x) + length(y)), 6) AS score
    FROM (SELECT p_partkey, {_A} AS x, {_B} AS y FROM {PAIRS.sql()} p)"""
)
def token_sort_scores(spark, sf_dir):
    score = names.token_sort_ratio(F.col("a"), F.col("b"))
    return PAIRS.frame(spark, sf_dir).select("p_partkey", F.round(score, 6).alias("score"))


THRESHOLD = 95
_BUDGET = f"CAST(floor(length(l.form) * {2 * (100 - THRESHOLD)}.0 / {THRESHOLD}.0 + 1e-9) AS INT)"
_DIRECTORY_SQL = f"""(SELECT company_name, min("Company_name_url") AS "Company_name_url" FROM (
    SELECT *, split_part("Company_name_url", 'organization/', -1) AS company_name FROM {COMPANY_URLS.sql()} u
    WHERE contains("Company_name_url", 'organization')) WHERE company_name <> '' AND NOT starts_with(company_name, '%')
    GROUP BY company_name)"""
_MATCH_CTE = f"""WITH employers AS (SELECT name, count(*) AS job_counts, {_form_sql('name')} AS processed
    FROM {POSTED.sql()} p WHERE name IS NOT NULL GROUP BY name),
    l AS (SELECT DISTINCT {_sorted_sql('processed')} AS form FROM employers WHERE processed <> ''),
    directory AS (SELECT *, {_form_sql('company_name')} AS processed FROM {_DIRECTORY_SQL} d),
    r AS (SELECT {_sorted_sql('processed')} AS form, min(company_name) AS first, arg_min(processed, company_name) AS processed
        FROM directory WHERE processed <> '' GROUP BY 1),
    near AS (SELECT l.form AS a, r.form AS b, r.first, r.processed FROM l, r
        WHERE abs(length(l.form) - length(r.form)) <= {_BUDGET} AND levenshtein(l.form, r.form) <= {_BUDGET}),
    scored AS (SELECT *, {_lcs_sql('a', 'b')} * 200.0::DOUBLE / (length(a) + length(b)) AS score FROM near),
    best AS (SELECT * FROM scored WHERE score >= {THRESHOLD} - 1e-9
        QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, first) = 1),
    matched AS (SELECT name, job_counts, coalesce(best.processed, '') AS matches, round(score, 6) AS score
        FROM employers e LEFT JOIN best ON {_sorted_sql('e.processed')} = best.a)"""


def _matched(spark, sf_dir):
    directory = match.company_directory(COMPANY_URLS.frame(spark, sf_dir))
    found = match.best_matches(
        match.employers(POSTED.frame(spark, sf_dir)), directory, "name", "company_name", THRESHOLD
    )
    return found, directory


@query(f"{_MATCH_CTE} SELECT name, job_counts, matches, score FROM matched")
def fuzzy_match(spark, sf_dir):
    found, _ = _matched(spark, sf_dir)
    return found.select("name", "job_counts", "matches", F.round("score", 6).alias("score"))


@query(
    f"""{_MATCH_CTE} SELECT name AS employer_name, company_name, "Company_name_url" FROM matched m
    LEFT JOIN directory d ON m.matches = d.processed WHERE matches <> ''"""
)
def match_merge(spark, sf_dir):
    found, directory = _matched(spark, sf_dir)
    return match.merge_matches(found, directory)


@query(
    f"""{_MATCH_CTE} SELECT count(*) FILTER (WHERE matches <> '') AS matched, count(*) AS total,
    avg(CASE WHEN matches <> '' THEN 1.0 ELSE 0.0 END) AS match_rate FROM matched"""
)
def employer_match_rate(spark, sf_dir):
    found, _ = _matched(spark, sf_dir)
    return metrics.match_rate(found)
