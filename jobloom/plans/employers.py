"""From employer names in the postings to company facts and contacts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from jobloom import schemas
from jobloom.operators import contacts as contact_ops
from jobloom.operators import incremental, match, metrics
from jobloom.scratch import materialize
from jobloom.sources import companies
from jobloom.sources.files import append_metrics, write_table


def match_employers(
    postings: DataFrame, company_urls: DataFrame, table: str, log: str, run_date: dt.date, threshold: float = 95.0
) -> DataFrame:
    """Match the employers of the postings, log the rate, add companies not matched before; returns the new ones."""
    spark = postings.sparkSession
    directory = match.company_directory(company_urls)
    matched = materialize(
        match.best_matches(match.employers(postings), directory, "name", "company_name", threshold), "matched"
    )
    append_metrics(metrics.stamped(metrics.match_rate(matched), run_date), f"{log}/match_rate")
    incremental.add_run(match.merge_matches(matched, directory), table, "Company_name_url", run_date)
    return incremental.only_run(spark, table, schemas.MATCHED, run_date)


def collect_companies(
    pages: DataFrame, out: str, log: str, run_date: dt.date, keep_without_people: bool = False
) -> None:
    """Parse stored company pages (url, html) once into the company, people and error tables."""
    parsed = materialize(companies.parse_company_pages(pages), "company-pages")
    people = companies.people(parsed)
    append_metrics(metrics.stamped(people.agg({"*": "count"}).toDF("people"), run_date), f"{log}/people")
    append_metrics(
        metrics.stamped(
            metrics.distinct_count(people, "Company Name", "companies_with_people"), run_date
        ),
        f"{log}/companies_with_people",
    )
    incremental.upsert_run(people, f"{out}/people", run_date)
    incremental.upsert_run(companies.company_info(parsed, keep_without_people=keep_without_people), f"{out}/company_info", run_date)
    incremental.upsert_run(companies.page_errors(parsed), f"{out}/errors", run_date)


def employer_contacts(
    spark: SparkSession, postings: DataFrame, matched: DataFrame, out: str, run_date: dt.date
) -> DataFrame:
    """Write and return the contacts of all employers of the postings."""
    people = incremental.table_as_of(spark, f"{out}/people", schemas.PEOPLE, run_date)
    write_table(contact_ops.contacts(postings, matched, people), f"{out}/contact")
    return spark.read.parquet(f"{out}/contact")
