"""Whole flows over the standard tables: board B over two runs, and from employer names to contacts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from jobloom import lexicon
from jobloom.once import computed_once
from jobloom.plans import employers as employer_plans
from jobloom.plans import postings as plans
from jobloom.queries.extraction import POSTINGS, _count_sql, _delimited_tests, _list_sql
from jobloom.queries.pages import _ABOUT, _URL, _clean_sql, _company_pages, _detail_pages, _script
from jobloom.queries import patterns
from jobloom.queries.registry import Derived, literal, query
from jobloom.scratch import materialize, scratch_path
from jobloom.sources import files

FIRST, SECOND = dt.date(2024, 7, 26), dt.date(2024, 7, 27)

BOARD_B = (
    "posted string, location string, jobType string, description string, name string, title string, feed string, "
    "`Job Role` string, date_of_scrape date, Job_ind int, keyword_count int, days_ago int, experience string, "
    "Tools array<string>, `Soft Skills` array<string>, `Industry Skills` array<string>, education array<string>, "
    "day int, Month int, Year int"
)

# Job pages around the derived postings; line breaks become spaces, as parsers may change them.
_JOBS = Derived(
    POSTINGS,
    {
        "doc_id": "doc_id",
        "job_role": "job_role",
        "shown": "replace(replace(replace(replace(description, chr(13), ' '), chr(10), ' '), '&', '&amp;'), '<', '&lt;')",
    },
)


def _job_pages(spark, sf_dir):
    html = F.concat(
        F.lit('<h1 class="info-position">Title</h1><p class="jd-timeVal">'), (F.col("doc_id") % 28).cast("string"),
        F.lit(' days ago</p><p class="jd-timeVal">x</p><article class="job-description">'), F.col("shown"),
        F.lit('</article><div class="candidate-profile"><p class="value">1 - '), (F.col("doc_id") % 9).cast("string"),
        F.lit(' Years</p><p class="value">x</p><p class="value">Master, PhD</p></div>'),
    )
    url = F.concat(F.lit("https://jobs.example/"), F.col("doc_id").cast("string"))
    pages = computed_once(_JOBS.frame(spark, sf_dir), {"url": url, "html": html}, ["doc_id", "job_role"])
    return pages.withColumnRenamed("job_role", "Job Role")


_SHOWN = f"""regexp_replace(regexp_replace(replace(replace(description, chr(13), ' '), chr(10), ' '),
    {literal('^' + patterns.SPACE + '+')}, ''), {literal(patterns.SPACE + '+$')}, '')"""


@query(
    f"""SELECT 'https://jobs.example/' || doc_id AS feed, job_role, CAST(keyword_count AS BIGINT) AS keyword_count,
    CAST(CASE job_role {' '.join(f"WHEN '{r}' THEN {i}" for r, i in lexicon.ROLE_INDEX_B.items())} END AS BIGINT) AS job_ind,
    CASE WHEN doc_id % 2 = 0 THEN '{FIRST}' ELSE '{SECOND}' END AS run_date, '1-' || (doc_id % 9) AS experience,
    {_list_sql(_delimited_tests('low', lambda t: t.replace(' ', '').strip('.,;')))} AS tools,
    {_list_sql([(f"contains(description, {literal(t)})", t) for t in lexicon.lowered(lexicon.SOFT_SKILLS)], ordered=False)}
    AS soft_skills, 'phd|master' AS education, '' || (doc_id % 28) || ' days ago' AS posted
    FROM (SELECT *, {_count_sql(lexicon.ROLE_TERMS_B)} AS keyword_count FROM (
    SELECT * REPLACE ({_SHOWN} AS description), lower({_SHOWN}) AS low FROM {POSTINGS.sql()} p)) WHERE keyword_count > 0"""
)
def board_b_production(spark, sf_dir):
    """Two runs, the second over all pages: it parses and adds only what the first has not taken in."""
    path = scratch_path(spark, "board-b")
    pages = _job_pages(spark, sf_dir)
    for run_date, found in ((FIRST, pages.filter(F.col("doc_id") % 2 == 0)), (SECOND, pages)):
        plans.run_board_b(found.drop("doc_id"), path, run_date, BOARD_B)
    rows = plans.production(spark, path, SECOND, BOARD_B)
    return rows.select(
        "feed", F.col("Job Role").alias("job_role"), F.col("keyword_count").cast("bigint").alias("keyword_count"),
        F.col("Job_ind").cast("bigint").alias("job_ind"), F.col("run_date").cast("string").alias("run_date"), "experience",
        F.array_join("Tools", "|").alias("tools"), F.array_join("Soft Skills", "|").alias("soft_skills"),
        F.array_join("education", "|").alias("education"), "posted",
    )


# --- board A ---------------------------------------------------------------------------------------------------------

# Two postings share a page, that of the even document; every eleventh detail page is broken.
_BOARD_A = f"""(SELECT key, job_role, {_count_sql(lexicon.ROLE_TERMS_A)} AS keyword_count, low,
    {_list_sql(_delimited_tests('low', lambda t: t.strip(' .,;')))} AS tools FROM (
    SELECT CAST(l.doc_id - l.doc_id % 2 AS STRING) AS key, l.job_role, d.low FROM {POSTINGS.sql()} l
    JOIN (SELECT doc_id, {_clean_sql(_ABOUT)} AS low FROM {POSTINGS.sql()} p WHERE doc_id % 11 <> 0) d
    ON d.doc_id = l.doc_id - l.doc_id % 2))"""
_OUTPUTS_A = f"(SELECT * FROM {_BOARD_A} WHERE keyword_count > {plans.RELEVANT_A})"


def _pages_a(spark, sf_dir):
    """Search pages with the document's number, and detail pages."""
    listed = POSTINGS.frame(spark, sf_dir)
    card = F.struct(
        F.lit("employer").alias("company"), (F.col("doc_id") - F.col("doc_id") % 2).cast("string").alias("jobkey"),
        F.col("job_role").alias("displayTitle"), F.lit("here").alias("formattedLocation"),
    )
    cards = F.to_json(F.struct(F.struct(F.struct(F.array(card).alias("results")).alias("mosaicProviderJobCardsModel")).alias("metaData")))
    html = F.concat(
        _script('window.mosaic.providerData["mosaic-provider-jobcards"]=', cards),
        _script("window._initialData=", F.lit('{"searchTitleBarModel":{"totalNumResults":1},"zonedProviders":{}}')),
    )
    searches = listed.select("doc_id", F.col("job_role").alias("Job Role"), html.alias("html"))
    details = _detail_pages(spark, sf_dir, "doc_id").filter(F.col("doc_id") % 2 == 0).select("html")
    return searches, details


def _board_a(spark, sf_dir):
    """Search pages of two passes, the second over all listings, and detail pages, to the five tables."""
    searches, details = _pages_a(spark, sf_dir)
    passes = [searches.filter(F.col("doc_id") % 3 > 0).drop("doc_id"), searches.drop("doc_id")]
    return plans.run_board_a(passes, details, scratch_path(spark, "board-a"), FIRST)


def _shown_a(rows):
    return rows.select(
        "key", F.col("Job Role").alias("job_role"), F.col("keyword_count").cast("bigint").alias("keyword_count"),
        F.array_join("Tools", "|").alias("tools"), F.col("date_of_scrape").cast("string").alias("scraped"),
    )


@query(f"SELECT key, job_role, CAST(keyword_count AS BIGINT) AS keyword_count, tools, '{FIRST}' AS scraped FROM {_OUTPUTS_A}")
def board_a_outputs(spark, sf_dir):
    return _shown_a(spark.read.parquet(_board_a(spark, sf_dir)["outputs"]))


_RUN_A = f"CASE WHEN CAST(key AS BIGINT) % 4 = 0 THEN '{FIRST}' ELSE '{SECOND}' END"


def _two_runs_a(spark, sf_dir):
    """A run over every other pair of listings, then one a day later over all, repeated; the pages are read once for all."""
    searches, details = _pages_a(spark, sf_dir)
    details = materialize(plans.pages_a(details), "board-a-pages")
    out = scratch_path(spark, "board-a-runs")
    for run_date, found in ((FIRST, searches.filter(F.col("doc_id") % 4 < 2)), (SECOND, searches), (SECOND, searches)):
        paths = plans.run_board_a([found.drop("doc_id")], details, out, run_date)
    return paths


@query(f"SELECT key, job_role, CAST(keyword_count AS BIGINT) AS keyword_count, tools, {_RUN_A} AS scraped FROM {_OUTPUTS_A}")
def board_a_two_runs(spark, sf_dir):
    """What the first run has found keeps its date; the second adds the rest."""
    return _shown_a(spark.read.parquet(_two_runs_a(spark, sf_dir)["outputs"]))


@query(
    f"""SELECT key, job_role, '{FIRST}' AS scraped FROM {_BOARD_A}
    WHERE job_role IN ({', '.join(literal(r) for r in lexicon.ROLE_INDEX_A)})"""
)
def board_a_search_files(spark, sf_dir):
    """The detail rows of a run as a file for each search, read back with role and date from the names."""
    searches, details = _pages_a(spark, sf_dir)
    rows = materialize(plans.board_a_details([searches.drop("doc_id")], details, FIRST), "board-a-details")
    folders = plans.export_searches(rows, scratch_path(spark, "searches"))
    back = files.read_csv(spark, folders, "key string, description string", with_file=True)
    named = files.with_file_columns(back, F.element_at(F.split("_file", "/"), -2)).where("description IS NOT NULL")
    return named.select("key", F.col("Job Role").alias("job_role"), F.col("date_of_scrape").cast("string").alias("scraped"))


@query(
    f"""SELECT key, job_role, CAST(keyword_count AS BIGINT) AS keyword_count, tools, '{FIRST}' AS scraped FROM {_OUTPUTS_A}
    QUALIFY row_number() OVER (PARTITION BY key ORDER BY job_role) = 1"""
)
def board_a_without_dup(spark, sf_dir):
    return _shown_a(spark.read.parquet(_board_a(spark, sf_dir)["outputs_without_dup"]))


@query(
    f"""SELECT skill, job_role, count(*) AS n FROM (SELECT job_role, unnest(string_split(nullif(tools, ''), '|')) AS skill
    FROM {_OUTPUTS_A}) GROUP BY skill, job_role"""
)
def board_a_facts(spark, sf_dir):
    rows = spark.read.parquet(_board_a(spark, sf_dir)["tools"])
    return rows.groupBy(F.col("Tools").alias("skill"), F.col("Job Role").alias("job_role")).agg(F.count("*").alias("n"))


_EMPLOYED = Derived("orders", {"name": "CASE WHEN o_orderkey % 40 = 0 THEN NULL ELSE 'The ' || o_custkey || ' LLC' END"})
_DIRECTORY = Derived("customer", {"Company_name_url": _URL})


@query(
    f"""SELECT name, person, profile, job_title FROM (SELECT DISTINCT name FROM {_EMPLOYED.sql()} e) LEFT JOIN (
    SELECT 'The ' || c_custkey || ' LLC' AS employer, 'person ' || i || ' of ' || c_name AS person,
    CASE WHEN c_custkey % 7 <> i THEN 'https://www.linkedin.com/in/in-' || i || '-' || c_custkey END AS profile,
    c_mktsegment AS job_title FROM customer, (VALUES (1), (2)) v(i) WHERE c_custkey % 17 > 4) ON name = employer"""
)
def employer_contacts(spark, sf_dir):
    """Names matched to the directory, company pages parsed into tables, people joined back to all employers."""
    table, log, out = (scratch_path(spark, n) for n in ("matched", "log", "companies"))
    posted = _EMPLOYED.frame(spark, sf_dir)
    matched = employer_plans.match_employers(posted, _DIRECTORY.frame(spark, sf_dir), table, log, FIRST)
    employer_plans.collect_companies(_company_pages(spark, sf_dir), out, log, FIRST)
    rows = employer_plans.employer_contacts(spark, posted, matched, out, FIRST)
    return rows.select(
        "name", F.col("People Name").alias("person"), F.col("Linkedin Profile").alias("profile"),
        F.col("Job Title").alias("job_title"),
    )
