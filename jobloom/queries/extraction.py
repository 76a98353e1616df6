"""Queries on posting text: relevance, tools, skills, experience, salary, dates."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import functions as F

from jobloom import lexicon
from jobloom.functions import dates, terms, text
from jobloom.once import computed_once
from jobloom.operators import dedupe, facts
from jobloom.plans import postings as plans
from jobloom.queries import patterns
from jobloom.queries.registry import Derived, literal, query, table

# Postings out of documents: four known roles and one unknown, term phrases in mixed case, three documents per key.
POSTINGS = Derived(
    "documents",
    {
        "doc_id": "doc_id",
        "key": "CAST(doc_id - doc_id % 3 AS STRING)",
        "job_role": """CASE doc_id % 5 WHEN 0 THEN 'DATA ANALYST' WHEN 1 THEN 'DATA ENGINEER'
            WHEN 2 THEN 'DATA SCIENTIST' WHEN 3 THEN 'MACHINE LEARNING ENGINEER' ELSE 'CLOUD ENGINEER' END""",
        "scraped": "DATE '2024-05-01' + CAST((doc_id * 7) % 90 AS INT)",
        "description": """text || CASE doc_id % 7
            WHEN 0 THEN ' Needs Python, SQL; Power BI. C, and machine learning, data visualization, statistics, NLP'
            WHEN 1 THEN ' communication skills; Accuracy, teamwork. sql server, big data, data pipeline, ETL, spark, r'
            WHEN 2 THEN ' Deep Learning, PyTorch. scikit-learn, CI/CD; natural language processing, AI algorithms'
            WHEN 3 THEN ' extract, transform, load (etl) processes; ML nlp data mining, excel. Tableau, dashboards. EDA PhD or Bachelor of Science'
            WHEN 4 THEN ' problem-solving, leadership; hadoop, c++ , ms access. data governance real-time processing'
            WHEN 5 THEN ' Written and Oral Communication; big data, aws, azure, gcp; kafka. use r and  C  git '
            ELSE '' END""",
    },
    costly=True,
)

_SPECIAL = re.compile(r"([\\^$.|?*+()\[\]{}])")
_NOT_WORD = r"[^\p{L}\p{N}_]"
_WORD = r"[\p{L}\p{N}_]"
_FOLDED = "lower(translate(description, 'İıſK', 'iisk'))"


def _quoted(term: str) -> str:
    return _SPECIAL.sub(r"\\\1", term)


def _word_test(column: str, term: str) -> str:
    term = term.lower()
    before = f"(^|{_NOT_WORD})" if term[0].isalnum() else _WORD
    after = f"($|{_NOT_WORD})" if term[-1].isalnum() else _WORD
    return f"regexp_matches({column}, {literal(before + _quoted(term) + after)})"


def _list_sql(tests: list[tuple[str, str]], ordered: bool = True) -> str:
    items = ", ".join(f"CASE WHEN {test} THEN {literal(name)} END" for test, name in tests)
    found = f"list_filter([{items}], lambda x: x IS NOT NULL)"
    return f"array_to_string({'list_sort(list_distinct(' + found + '))' if ordered else found}, '|')"


def _count_sql(role_terms) -> str:
    whens = []
    for role, words in role_terms.items():
        total = " + ".join(f"CAST({_word_test('low', w)} AS INT)" for w in words)
        whens.append(f"WHEN '{role}' THEN {total}")
    return f"CASE job_role {' '.join(whens)} END"


def _index_sql(mapping) -> str:
    return "CASE job_role " + " ".join(f"WHEN '{r}' THEN {i}" for r, i in mapping.items()) + " END"


def _relevant_sql(role_terms, index, more_than: int) -> str:
    return f"""SELECT doc_id, job_role, CAST({_index_sql(index)} AS BIGINT) AS job_ind,
        CAST(keyword_count AS BIGINT) AS keyword_count FROM (
        SELECT *, {_count_sql(role_terms)} AS keyword_count FROM (
        SELECT *, lower(description) AS low FROM {POSTINGS.sql()} p)) WHERE keyword_count > {more_than}"""


def _relevant(spark, sf_dir, role_terms, index, more_than):
    role = F.col("job_role")
    count = terms.role_term_count(F.col("description"), role, role_terms).cast("bigint")
    rows = computed_once(POSTINGS.frame(spark, sf_dir), {"keyword_count": count}, ["doc_id", "job_role"])
    return facts.relevant(rows, more_than).select(
        "doc_id", "job_role", facts.lookup(role, index).cast("bigint").alias("job_ind"), "keyword_count"
    )


@query(_relevant_sql(lexicon.ROLE_TERMS_A, lexicon.ROLE_INDEX_A, plans.RELEVANT_A))
def role_keyword_count(spark, sf_dir):
    return _relevant(spark, sf_dir, lexicon.ROLE_TERMS_A, lexicon.ROLE_INDEX_A, plans.RELEVANT_A)


@query(_relevant_sql(lexicon.ROLE_TERMS_B, lexicon.ROLE_INDEX_B, plans.RELEVANT_B))
def role_keyword_count_b(spark, sf_dir):
    return _relevant(spark, sf_dir, lexicon.ROLE_TERMS_B, lexicon.ROLE_INDEX_B, plans.RELEVANT_B)


def _delimited_tests(column: str, name) -> list[tuple[str, str]]:
    return [
        (f"regexp_matches({column}, {literal('[.; ,]' + _quoted(t.lower()) + '[.; ,]')})", name(t.lower()))
        for t in lexicon.TOOLS
    ]


@query(
    f"""SELECT doc_id, {_list_sql(_delimited_tests('low', lambda t: t.strip(' .,;')))} AS tools
    FROM (SELECT doc_id, {_FOLDED} AS low FROM {POSTINGS.sql()} p)"""
)
def tools_delimited(spark, sf_dir):
    found = terms.delimited_terms(F.col("description"), lexicon.TOOLS)
    return POSTINGS.frame(spark, sf_dir).select("doc_id", F.array_join(found, "|").alias("tools"))


@query(
    f"""SELECT doc_id, {_list_sql(_delimited_tests('low', lambda t: re.sub('[.; ,]', '', t)))} AS tools
    FROM (SELECT doc_id, lower(description) AS low FROM {POSTINGS.sql()} p)"""
)
def tools_first_match(spark, sf_dir):
    found = terms.delimited_terms_squeezed(F.col("description"), lexicon.TOOLS)
    return POSTINGS.frame(spark, sf_dir).select("doc_id", F.array_join(found, "|").alias("tools"))


# Words that occur in the documents by themselves, some inside one another.
COMMON_WORDS = ("the", "and", "with", "from", "that", "the and", "le", "de la", "und", "que")
_GROUPS = {
    "tools": lexicon.TOOLS_WORDS, "soft_skills": lexicon.SOFT_SKILLS, "industry_skills": lexicon.INDUSTRY_SKILLS,
    "education": lexicon.EDUCATION, "common": COMMON_WORDS,
}
_GROUPS_SQL = ", ".join(
    f"{_list_sql([(_word_test('low', t), t.lower()) for t in words])} AS {name}" for name, words in _GROUPS.items()
)


@query(f"SELECT doc_id, {_GROUPS_SQL} FROM (SELECT doc_id, {_FOLDED} AS low FROM {POSTINGS.sql()} p)")
def skills_word(spark, sf_dir):
    found = POSTINGS.frame(spark, sf_dir).select(
        "doc_id", terms.word_term_groups(F.col("description"), _GROUPS).alias("g")
    )
    return found.select("doc_id", *[F.array_join(f"g.{n}", "|").alias(n) for n in _GROUPS])


_SUBSTRING = {
    "soft_skills": lexicon.lowered(lexicon.SOFT_SKILLS),
    "industry_skills": lexicon.lowered(lexicon.INDUSTRY_SKILLS),
    "education": lexicon.EDUCATION + ("The", "and"),
}
_SUBSTRING_SQL = ", ".join(
    f"{_list_sql([(f'contains(description, {literal(t)})', t.lower()) for t in words], ordered=False)} AS {name}"
    for name, words in _SUBSTRING.items()
)


@query(f"SELECT doc_id, {_SUBSTRING_SQL} FROM {POSTINGS.sql()} p")
def skills_substring(spark, sf_dir):
    body = F.col("description")
    found = {n: F.array_join(terms.substring_terms(body, words), "|") for n, words in _SUBSTRING.items()}
    return POSTINGS.frame(spark, sf_dir).select("doc_id", *[c.alias(n) for n, c in found.items()])


# --- fact tables -----------------------------------------------------------------------------------------------------

_RELEVANT_A = f"""(SELECT *, {_count_sql(lexicon.ROLE_TERMS_A)} AS keyword_count
    FROM (SELECT *, lower(description) AS low, {_FOLDED} AS folded FROM {POSTINGS.sql()} p))"""
_OUTPUTS_SQL = f"""(SELECT *, month(scraped) AS m FROM {_RELEVANT_A} WHERE keyword_count > {plans.RELEVANT_A}
    QUALIFY row_number() OVER (PARTITION BY key, month(scraped), job_role ORDER BY scraped, job_role, doc_id) = 1)"""


def _details(spark, sf_dir):
    return POSTINGS.frame(spark, sf_dir).withColumnsRenamed({"job_role": "Job Role", "scraped": "date_of_scrape"})


def _outputs(spark, sf_dir):
    """Relevant postings, one per key, month and role, with their skills.

    The skills are found before the postings are brought together by key, so the texts stay where they were read.
    """
    groups = {"Soft Skills": lexicon.SOFT_SKILLS, "Industry Skills": lexicon.INDUSTRY_SKILLS}
    postings = plans.postings_a(_details(spark, sf_dir), with_tools=False)
    found = computed_once(postings, {"g": terms.word_term_groups(F.col("description"), groups)})
    skilled = found.withColumns({n: F.col(f"g.`{n}`") for n in groups}).drop("g", "description")
    return dedupe.one_per_role_and_month(skilled, ["doc_id"])


def _fact_sql(tests: list[tuple[str, str]], column: str, synonyms: bool, keep_empty: bool) -> str:
    items = ", ".join(f"CASE WHEN {test} THEN {literal(name)} END" for test, name in tests)
    found = f"list_sort(list_distinct(list_filter([{items}], lambda x: x IS NOT NULL)))"
    name = "skill"
    if synonyms:
        whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in lexicon.SKILL_SYNONYMS.items())
        name = f"CASE skill {whens} ELSE skill END"
    unfold = f"unnest(CASE WHEN len({found}) = 0 THEN [NULL] ELSE {found} END)" if keep_empty else f"unnest({found})"
    return f"""SELECT key, CAST(m AS BIGINT) AS month, job_role, {name} AS {column}
        FROM (SELECT key, m, job_role, {unfold} AS skill FROM {_OUTPUTS_SQL})"""


def _fact_columns(rows, column: str, name: str):
    return rows.select(
        "key", F.col("Month").cast("bigint").alias("month"), F.col("Job Role").alias("job_role"),
        F.col(f"`{column}`").alias(name),
    )


@query(
    _fact_sql(
        [(f"regexp_matches(folded, {literal('[.; ,]' + _quoted(t.lower()) + '[.; ,]')})", t.lower().strip(" .,;"))
         for t in lexicon.TOOLS],
        "tool", False, False,
    )
)
def skill_facts_tools(spark, sf_dir):
    relevant = dedupe.one_per_role_and_month(plans.postings_a(_details(spark, sf_dir)), ["doc_id"])
    return _fact_columns(facts.tool_facts(relevant), "Tools", "tool")


@query(_fact_sql([(_word_test("folded", t), t.lower()) for t in lexicon.SOFT_SKILLS], "soft_skill", False, True))
def skill_facts_soft(spark, sf_dir):
    return _fact_columns(facts.soft_skill_facts(_outputs(spark, sf_dir)), "Soft Skills", "soft_skill")


@query(
    _fact_sql([(_word_test("folded", t), t.lower()) for t in lexicon.INDUSTRY_SKILLS], "industry_skill", True, True)
)
def skill_facts_industry(spark, sf_dir):
    return _fact_columns(facts.industry_skill_facts(_outputs(spark, sf_dir)), "Industry Skills", "industry_skill")


_TOOL_FACTS = _fact_sql(
    [(f"regexp_matches(folded, {literal('[.; ,]' + _quoted(t.lower()) + '[.; ,]')})", t.lower().strip(" .,;"))
     for t in lexicon.TOOLS],
    "tool", False, False,
)


@query(f"SELECT tool, month, job_role, count(*) AS postings FROM ({_TOOL_FACTS}) GROUP BY tool, month, job_role")
def tool_demand(spark, sf_dir):
    """Which tools each role asks for in a month."""
    found = skill_facts_tools(spark, sf_dir)
    return found.groupBy("tool", "month", "job_role").agg(F.count(F.lit(1)).alias("postings"))


# --- single fields ---------------------------------------------------------------------------------------------------

AGES = Derived(
    "orders",
    {
        "o_orderkey": "o_orderkey",
        "age": """CASE o_orderkey % 6 WHEN 0 THEN 'Today' WHEN 1 THEN 'Just posted' WHEN 2 THEN '30+ days ago'
            WHEN 3 THEN 'Posted ' || CAST(o_orderkey % 29 AS STRING) || ' days ago' WHEN 4 THEN '' END""",
        "posted": """CASE o_orderkey % 6 WHEN 0 THEN 'Posted Today' WHEN 1 THEN '30+ days ago'
            WHEN 2 THEN 'Posted ' || CAST(o_orderkey % 29 AS STRING) || ' days ago'
            WHEN 3 THEN 'on ' || CAST(1 + o_orderkey % 28 AS STRING) || ' Jul'
            WHEN 4 THEN 'on ' || CAST(1 + o_orderkey % 28 AS STRING) || ' July' END""",
    },
)


@query(
    f"""SELECT o_orderkey, CASE WHEN age IN ('Today', 'Just posted') THEN 0
    ELSE TRY_CAST(regexp_extract(age, '(\\d+)', 1) AS BIGINT) END AS days_ago FROM {AGES.sql()} a"""
)
def days_ago_a(spark, sf_dir):
    days = text.days_since_posted(F.col("age")).cast("bigint")
    return AGES.frame(spark, sf_dir).select("o_orderkey", days.alias("days_ago"))


REF_DATE = dt.date(2024, 8, 9)


@query(
    f"""SELECT o_orderkey, CAST(CASE WHEN contains(posted, 'Today') THEN 0 WHEN contains(posted, '30+') THEN 30
    WHEN contains(posted, 'days ago') THEN TRY_CAST(split_part(posted, ' ', 2) AS INT)
    ELSE date_diff('day', TRY_CAST(try_strptime(regexp_extract(posted, '(\\d+ Jul)$', 1) || ' 2024', '%d %b %Y') AS DATE),
    DATE '{REF_DATE}') END AS BIGINT) AS days_ago FROM {AGES.sql()} a"""
)
def days_ago_b(spark, sf_dir):
    days = dates.days_since_posted_text(F.col("posted"), REF_DATE, 2024).cast("bigint")
    return AGES.frame(spark, sf_dir).select("o_orderkey", days.alias("days_ago"))


OFFERS = Derived(
    "lineitem",
    {
        "l_orderkey": "l_orderkey",
        "l_linenumber": "l_linenumber",
        "requirement": """CASE l_linenumber % 4
            WHEN 0 THEN 'at least ' || CAST(CAST(floor(l_quantity) AS INT) AS STRING) || '+ years of SQL and 2 to 4 years of R'
            WHEN 1 THEN CAST(CAST(floor(l_quantity) AS INT) AS STRING) || '-' || CAST(CAST(floor(l_quantity) AS INT) + 3 AS STRING)
                || ' years, 5 Years in total'
            WHEN 2 THEN CAST(CAST(floor(l_quantity) AS INT) AS STRING) || ' - 60 Years' ELSE 'none' END""",
        "pay": """CASE l_linenumber % 3
            WHEN 0 THEN 'pays $' || CAST(CAST(floor(l_extendedprice) AS INT) AS STRING) || '.50 - $99,000 a year plus $'
                || CAST(CAST(floor(l_quantity) AS INT) AS STRING) || ' per hour'
            WHEN 1 THEN '$' || CAST(CAST(floor(l_quantity) AS INT) AS STRING) || ' a month' ELSE '$1,200–$2,000 per week' END""",
    },
    costly=True,
)


@query(
    f"""SELECT l_orderkey, l_linenumber, array_to_string(
    regexp_extract_all(requirement, '\\b({patterns.EXPERIENCE}){patterns.SPACE}*years\\b', 1), '|') AS experience
    FROM {OFFERS.sql()} o"""
)
def experience_a(spark, sf_dir):
    found = text.experience_years(F.col("requirement"))
    return OFFERS.frame(spark, sf_dir).select("l_orderkey", "l_linenumber", F.array_join(found, "|").alias("experience"))


@query(
    f"""SELECT l_orderkey, l_linenumber, replace(split_part(requirement, 'Years', 1), ' ', '') AS experience
    FROM {OFFERS.sql()} o"""
)
def experience_b(spark, sf_dir):
    found = text.experience_range(F.col("requirement"))
    return OFFERS.frame(spark, sf_dir).select("l_orderkey", "l_linenumber", found.alias("experience"))


def _salary_sql(group: int) -> str:
    return f"array_to_string(regexp_extract_all(pay, {literal(patterns.SALARY)}, {group}), '|')"


@query(
    f"""SELECT l_orderkey, l_linenumber, {_salary_sql(1)} AS amounts, {_salary_sql(2)} AS pers, {_salary_sql(3)} AS units
    FROM {OFFERS.sql()} o"""
)
def salary_extract(spark, sf_dir):
    rows = OFFERS.frame(spark, sf_dir).withColumn("s", text.salaries(F.col("pay")))
    return rows.select(
        "l_orderkey", "l_linenumber",
        F.array_join("s.amount", "|").alias("amounts"), F.array_join("s.per", "|").alias("pers"),
        F.array_join("s.unit", "|").alias("units"),
    )


@query(
    """SELECT o_orderkey, CAST(day(o_orderdate) AS BIGINT) AS day, CAST(month(o_orderdate) AS BIGINT) AS month,
    CAST(year(o_orderdate) AS BIGINT) AS year, strftime(o_orderdate, '%Y-%m-%d') AS stamp FROM orders"""
)
def date_parts(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("stamp"))
    parts = dates.with_date_parts(rows.withColumn("scraped", dates.iso_date(F.col("stamp"))), "scraped")
    return parts.select(
        "o_orderkey", "stamp",
        *[F.col(c).cast("bigint").alias(c.lower()) for c in ("day", "Month", "Year")],
    )


TITLES = Derived(
    "part",
    {
        "p_partkey": "p_partkey",
        "title": "p_brand || '/' || p_name || ' & Co*~é'",
        "role": "replace(p_name, ' ', '_') || '-' || lower(p_type)",
        "employer": "CASE p_partkey % 3 WHEN 0 THEN p_brand WHEN 1 THEN '' END",
    },
)


@query(
    f"""SELECT p_partkey, upper(translate(role, '_-', '  ')) AS role_label, replace(title, ' ', '_') AS token,
    replace(url_encode(title), '%2F', '/') AS quoted, 'https://jobs.example/?q=' || p_partkey || '&start=' || 10 AS url,
    trim(CASE WHEN employer <> '' THEN replace(title, employer, '') ELSE title END) AS short_title
    FROM {TITLES.sql()} t"""
)
def title_forms(spark, sf_dir):
    title = F.col("title")
    search = F.concat(F.lit("https://jobs.example/?q="), F.col("p_partkey").cast("string"))
    return TITLES.frame(spark, sf_dir).select(
        "p_partkey",
        text.role_label(F.col("role")).alias("role_label"),
        text.file_token(title).alias("token"),
        text.url_quote(title).alias("quoted"),
        text.page_url(search, F.lit(10)).alias("url"),
        text.without_employer(title, F.col("employer")).alias("short_title"),
    )


@query("SELECT l_orderkey, l_linenumber, round(l_discount * 100, 2) AS change FROM lineitem")
def percent_change(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", text.percent(F.col("l_discount")).alias("change")
    )
