"""Contacts of the employers in the postings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.operators.joins import left_join
from jobloom.scratch import materialize

CONTACT = ("Company Name", "Name from URL", "People Name", "Linkedin Profile", "Job Title")


def contacts(postings: DataFrame, matched: DataFrame, people: DataFrame) -> DataFrame:
    """Every employer of the postings with the people of its matched company; nulls where there are none.

    The employer names are written once, so the postings are read once.
    """
    names = materialize(postings.select("name").distinct(), "employers")
    companies = matched.select("employer_name", "company_name")
    who = people.select(*[F.col(f"`{c}`") for c in CONTACT])
    placed = materialize(left_join(names, companies, "name", "employer_name"), "placed")  # a left join reads its sides twice
    return left_join(placed, who, "company_name", "Name from URL").select("name", *[F.col(f"`{c}`") for c in CONTACT])


def with_details(listings: DataFrame, details: DataFrame) -> DataFrame:
    """Listings with the details of their page, nulls where the page gave none, newest first within each part.

    A total order would move every description once more; parts in order are what a file of results needs.
    """
    extra = details.filter(F.col("key").isNotNull()).drop("companyName", "parsed")
    joined = listings.join(extra, "key", "left")  # a key of very many listings is split, and has one detail page
    return joined.sortWithinPartitions(F.col("days_ago").asc_nulls_last(), F.col("key"))
