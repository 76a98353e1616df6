"""From detail rows to the consolidated postings and the skill fact tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom import lexicon
from jobloom.functions.dates import days_since_posted_text, short_stamp, with_date_parts
from jobloom.functions.terms import (
    delimited_terms, delimited_terms_squeezed, role_term_count, substring_terms, term_counts,
)
from jobloom.functions.text import experience_range
from jobloom.once import computed_once
from jobloom.operators import contacts, dedupe, facts, incremental
from jobloom.scratch import materialize
from jobloom.sources import boards
from jobloom.sources.files import write_csv, write_table

RELEVANT_A = 3
RELEVANT_B = 0
COUNTS, _TOOLS = "_counts", "_tools"


def postings_a(
    details: DataFrame,
    role_terms: Mapping[str, Sequence[str]] = lexicon.ROLE_TERMS_A,
    tools: Sequence[str] = lexicon.TOOLS,
    more_than: int = RELEVANT_A,
    with_tools: bool = True,
) -> DataFrame:
    """Board A detail rows with ``date_of_scrape`` and ``Job Role`` to relevant postings.

    The relevance filter comes first, so the tools are looked for only in the postings that stay, and only if asked for.
    """
    text, role = F.col("description"), F.col("Job Role")
    counted = computed_once(details, {"keyword_count": role_term_count(text, role, role_terms)})
    dated = _relevant_a(counted, more_than)
    return computed_once(dated, {"Tools": delimited_terms(text, tools)}) if with_tools else dated


def _relevant_a(counted: DataFrame, more_than: int) -> DataFrame:
    indexed = facts.relevant(counted, more_than)
    return with_date_parts(indexed.withColumn("Job_ind", facts.lookup(F.col("Job Role"), lexicon.ROLE_INDEX_A)))


def consolidate_a(postings: DataFrame, out: str, tiebreak: Sequence[str], include_year: bool = False) -> dict[str, str]:
    """Write the consolidated postings and, from that table, the deduplicated postings and the three fact tables."""
    spark = postings.sparkSession
    paths = {
        n: f"{out}/{n}" for n in ("outputs", "outputs_without_dup", "soft_skills", "industry_skills", "tools")
    }
    write_table(dedupe.one_per_role_and_month(postings, tiebreak, include_year), paths["outputs"])
    outputs = spark.read.parquet(paths["outputs"])
    write_table(dedupe.one_per_month(outputs, tiebreak, include_year), paths["outputs_without_dup"])
    write_table(facts.soft_skill_facts(outputs), paths["soft_skills"])
    write_table(facts.industry_skill_facts(outputs), paths["industry_skills"])
    write_table(facts.tool_facts(outputs), paths["tools"])
    return paths


def board_a_details(
    passes: Sequence[DataFrame], details: DataFrame, run_date: dt.date, site: str = ""
) -> DataFrame:
    """Detail rows of one run over stored pages, with the date and the role of the search.

    ``passes`` are the search pages (html, ``Job Role``) of each pass, ``details`` the detail pages (html). A listing counts
    once for a role; its page's details are joined to it.
    """
    return _listed(passes, boards.parse_detail_pages(details, site=site), run_date)


def _listed(passes: Sequence[DataFrame], details: DataFrame, run_date: dt.date) -> DataFrame:
    role = ["Job Role"]
    listed = [boards.listing_rows(boards.parse_listing_pages(pages), [F.col("`Job Role`")]) for pages in passes]
    listings = dedupe.merge_passes(listed, ["title"], within=role)
    return contacts.with_details(listings, details).withColumn("date_of_scrape", F.lit(run_date))


def pages_a(
    details: DataFrame,
    site: str = "",
    role_terms: Mapping[str, Sequence[str]] = lexicon.ROLE_TERMS_A,
    tools: Sequence[str] = lexicon.TOOLS,
    more_than: int = RELEVANT_A,
) -> DataFrame:
    """Detail pages (html) read for ``board_a_postings``: detail rows with the count of each role's terms and the tools.

    A page is read once for all roles, however many list it, and its terms come first. One that has too few for any role has no
    relevant posting; what is searched for lists, and later sent to the join, are the others.
    """
    read, text = boards.read_detail_pages(details, site=site), F.col("description")
    counted = computed_once(read, {COUNTS: term_counts(text, role_terms)})
    enough = reduce(or_, [F.col(COUNTS)[role] > more_than for role in role_terms])
    found = counted.where(F.col("key").isNotNull() & enough)
    return computed_once(boards.with_lists(found), {_TOOLS: delimited_terms(text, tools)})


def board_a_postings(
    passes: Sequence[DataFrame], pages: DataFrame, run_date: dt.date, more_than: int = RELEVANT_A
) -> DataFrame:
    """``postings_a`` of ``board_a_details``, out of ``pages_a``."""
    rows = _listed(passes, pages, run_date)
    counts = [F.when(F.col("Job Role") == role, F.col(COUNTS)[role]) for role in pages.schema[COUNTS].dataType.names]
    dated = _relevant_a(rows.withColumn("keyword_count", F.coalesce(*counts)), more_than)
    others = [F.col(f"`{c}`") for c in dated.columns if c not in (COUNTS, _TOOLS, "Tools")]
    return dated.select(*others, F.col(_TOOLS).alias("Tools"))


def export_searches(rows: DataFrame, out: str, roles: Sequence[str] = tuple(lexicon.ROLE_INDEX_A)) -> list[str]:
    """Write the detail rows of a run as CSV, a folder for each role and date, in the order of age, and return the folders.

    The folders are named as ``with_file_columns`` reads them. ``rows`` should be a written table: it is read for each role.
    """
    folders = []
    dates = sorted(r["d"] for r in rows.select(F.col("date_of_scrape").cast("string").alias("d")).distinct().collect())
    for role in roles:
        for date in dates:
            folder = f"{out}/jobs_detail_{role.lower().replace(' ', '_')}_{date}.csv"
            own = rows.where((F.col("Job Role") == role) & (F.col("date_of_scrape") == F.lit(date).cast("date")))
            write_csv(own.sort(F.col("days_ago").asc_nulls_last(), "key"), folder)
            folders.append(folder)
    return folders


def run_board_a(
    passes: Sequence[DataFrame], details: DataFrame, out: str, run_date: dt.date, tiebreak: Sequence[str] = ("title",),
    site: str = "",
) -> dict[str, str]:
    """One run from stored pages to the five tables of board A, which hold the postings of all runs.

    ``details`` are detail pages (html), or ``pages_a`` of them, written once where several runs have the same pages.
    The relevant postings of a run, their skills extracted, become its partition of ``postings``; a repeated run replaces
    it. The five tables are then made anew from all partitions, so no text of an earlier run is searched again.
    """
    pages = details if COUNTS in details.columns else pages_a(details, site)
    rows = board_a_postings(passes, pages, run_date)
    runs = f"{out}/postings"
    incremental.write_run(rows, runs, run_date)
    found = rows.sparkSession.read.option("mergeSchema", "true").parquet(runs).drop(incremental.RUN)
    return consolidate_a(found, out, tiebreak)


def postings_b(
    details: DataFrame,
    ref_date: dt.date,
    year: int,
    role_terms: Mapping[str, Sequence[str]] = lexicon.ROLE_TERMS_B,
    more_than: int = RELEVANT_B,
) -> DataFrame:
    """Board B detail rows with ``date_of_scrape`` and ``Job Role`` to relevant postings."""
    text, role = F.col("description"), F.col("Job Role")
    counted = computed_once(details, {"keyword_count": role_term_count(text, role, role_terms)})
    extracted = facts.relevant(counted, more_than).withColumns(
        {
            "Job_ind": facts.lookup(role, lexicon.ROLE_INDEX_B),
            "days_ago": days_since_posted_text(F.col("posted"), ref_date, year),
            "experience_years": experience_range(F.col("Experience")),
            "Tools": delimited_terms_squeezed(text, lexicon.TOOLS),
            "Soft Skills": substring_terms(text, lexicon.lowered(lexicon.SOFT_SKILLS)),
            "Industry Skills": substring_terms(text, lexicon.lowered(lexicon.INDUSTRY_SKILLS)),
            "education_terms": substring_terms(F.col("Education"), lexicon.EDUCATION),
        }
    )
    renamed = extracted.drop("Experience", "Education").withColumnsRenamed(
        {"experience_years": "experience", "education_terms": "education"}
    )
    return with_date_parts(renamed)


def run_board_b(pages: DataFrame, table: str, run_date: dt.date, schema: str) -> None:
    """One run over stored job pages (url, html, ``Job Role``): pages of known postings are dropped unparsed.

    The relevant postings become the run's partition of the cumulative table, which has the given ``schema``.
    """
    spark = pages.sparkSession
    others = incremental.table_without(spark, table, schema, run_date).select(F.col("feed").alias("url")).distinct()
    # Addresses alone settle what is known. The known ones are few or many; either way no page text is compared.
    known = materialize(pages.select("url").distinct().join(others, "url", "left_semi"), "known-pages")
    fresh = pages.join(known, "url", "left_anti")
    details = boards.parse_job_pages(fresh, keep=["Job Role"]).withColumn("date_of_scrape", F.lit(run_date))
    rows = postings_b(details, run_date, run_date.year)
    incremental.write_run(rows.sortWithinPartitions("Month", "Job_ind"), table, run_date)


def export_dated(spark: SparkSession, table: str, out: str, run_date: dt.date, schema: str) -> dict[str, str]:
    """Write what a run has added, and all postings as of it, as CSV in folders that carry the run's date."""
    paths = {kind: f"{out}/{kind}_jobs_{short_stamp(run_date)}" for kind in ("new", "all")}
    write_csv(incremental.only_run(spark, table, schema, run_date), paths["new"])
    write_csv(incremental.table_as_of(spark, table, schema, run_date), paths["all"])
    return paths


def production(spark: SparkSession, table: str, run_date: dt.date, schema: str) -> DataFrame:
    """All postings of the cumulative table as of a run, each part by month and role index, as the runs wrote them."""
    rows = incremental.table_as_of(spark, table, schema, run_date)
    return rows.sortWithinPartitions(F.col("Month").asc_nulls_last(), F.col("Job_ind").asc_nulls_last(), "feed")
