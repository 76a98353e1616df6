"""Stored company and person pages, read through the JSON state they carry, and site maps."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom import schemas
from jobloom.functions.dates import iso_timestamp
from jobloom.functions.names import company_slug, unescape_state
from jobloom.functions.text import percent, prefixed
from jobloom.once import computed_once
from jobloom.sources.boards import embedded, is_broken, number, parse_json, whole_number

# The two places of the state, the keys of its parts, the messages of the error table.
STATE = r'(?is)<script[^>]*\bid="ng-state"[^>]*>(.*?)</script>'
ESCAPED_STATE = r'(?is)<script[^>]*\bid="client-app-state"[^>]*>(.*?)</script>'
ORGANIZATION_KEY = "entities/organizations/"
PEOPLE_KEY = "/data/searches/contacts"
PERSON_KEY = "data/entities"
NO_STATE = "HttpState key not found"
NO_PEOPLE = "No employee information"
NO_ORGANIZATION = "No organization information"
INVALID = "invalid JSON"
PROFILE_PREFIX = "https://www.linkedin.com/in/"

_CACHE = "HttpState map<string,struct<data:string>>"


def page_state(html: Column) -> Column:
    """The state's JSON text: the plain script if present, else the escaped one."""
    return F.coalesce(embedded(html, STATE), unescape_state(embedded(html, ESCAPED_STATE)))


def cache_entry(cache: Column, key_part: str) -> Column:
    """Data of the first cache entry whose key contains ``key_part``; null if there is none."""
    hits = F.map_filter(cache, lambda key, _: key.contains(key_part))
    return F.get(F.map_values(hits), F.lit(0))["data"]


def values_of(items: Column) -> Column:
    """A list without its nulls, null if there is no list."""
    return F.filter(items, lambda v: v.isNotNull())


def parse_company_pages(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Add ``organization`` and ``employees`` structs and ``error`` to stored company pages; the page text is dropped."""
    kept = [c for c in pages.columns if c != html]
    state = computed_once(pages, {"state": parse_json(page_state(F.col(html)), _CACHE)}, kept)
    documents = {
        "organization": parse_json(cache_entry(F.col("state.HttpState"), ORGANIZATION_KEY), schemas.ORGANIZATION),
        "employees": parse_json(cache_entry(F.col("state.HttpState"), PEOPLE_KEY), schemas.EMPLOYEES),
        "_invalid": F.col("state").isNull() | is_broken("state"),
        "_no_state": F.col("state.HttpState").isNull(),
    }
    parsed = computed_once(state, documents, kept)
    broken = is_broken("organization") | is_broken("employees")
    error = (
        F.when(F.col("_invalid"), F.lit(INVALID))
        .when(F.col("_no_state"), F.lit(NO_STATE))
        .when(F.col("organization").isNull(), F.lit(NO_ORGANIZATION))
        .when(F.col("employees").isNull(), F.lit(NO_PEOPLE))
        .when(broken, F.lit(INVALID))
    )
    return parsed.withColumn("error", error).drop("_invalid", "_no_state")


def organization_fields(org: str = "organization") -> dict[str, Column]:
    """The forty fields of an organization document."""
    # The paths inside the document. Counts and sums come as text there or as numbers, see ``whole_number``.
    cards, about = f"{org}.cards", f"{org}.cards.company_about_fields2"
    extended, semrush = f"{cards}.overview_fields_extended", f"{cards}.semrush_summary"

    def place(i: int) -> Column:
        return F.get(F.col(f"{about}.location_identifiers"), F.lit(i))["value"]

    return {
        "id": F.col(f"{org}.properties.identifier.permalink"),
        "name": F.col(f"{org}.properties.title"),
        "logo": F.col(f"{org}.properties.identifier.image_id"),
        "description": F.col(f"{cards}.overview_description.description"),
        "city": place(0),
        "state": place(1),
        "about": F.col(f"{cards}.about_short_description.short_description"),
        "country": place(2),
        "size": F.col(f"{about}.num_employees_enum"),
        "linkedin": F.col(f"{cards}.social_fields.linkedin.value"),
        "facebook": F.col(f"{cards}.social_fields.facebook.value"),
        "twitter": F.col(f"{cards}.social_fields.twitter.value"),
        "email": F.col(f"{cards}.contact_fields.contact_email"),
        "phone": F.col(f"{cards}.contact_fields.phone_number"),
        "website": F.col(f"{about}.website.value"),
        "ipo_status": F.col(f"{about}.ipo_status"),
        "rank_org_company": whole_number(F.col(f"{about}.rank_org_company")),
        "semrush_global_rank": whole_number(F.col(f"{semrush}.semrush_global_rank")),
        "semrush_visits_latest_month": whole_number(F.col(f"{semrush}.semrush_visits_latest_month")),
        "semrush_visits_latest_month_change": number(F.col(f"{cards}.semrush_rank_headline.semrush_visits_mom_pct")),
        "semrush_id": F.col(f"{semrush}.identifier.permalink"),
        "semrush": F.col(f"{semrush}.identifier.uuid"),
        "categories": values_of(F.col(f"{extended}.categories.value")),
        "legal_name": F.col(f"{extended}.legal_name"),
        "operating_status": F.col(f"{extended}.operating_status"),
        "last_funding_type": F.col(f"{extended}.last_funding_type"),
        "founded_on": F.col(f"{extended}.founded_on.value"),
        "advisors": whole_number(F.col(f"{cards}.advisors_headline.num_current_advisor_positions")),
        "similar": values_of(F.col(f"{cards}.org_similarity_org_list.identifier.value")),
        "funding_rounds": whole_number(F.col(f"{cards}.funding_rounds_summary.num_funding_rounds")),
        "funding_usd": number(F.col(f"{cards}.funding_rounds_summary.funding_total.value_usd")),
        "acquisitions": values_of(F.col(f"{cards}.acquisitions_list.acquiree_identifier.value")),
        "investments": values_of(F.col(f"{cards}.investments_list.organization_identifier.value")),
        "lead_investments": whole_number(F.col(f"{cards}.investments_headline.num_lead_investments")),
        "investors": values_of(F.col(f"{cards}.investors_list.investor_identifier.value")),
        "lead_investors": whole_number(F.col(f"{cards}.investors_headline.num_lead_investors")),
        "total_products_active": whole_number(F.col(f"{cards}.technology_highlights.siftery_num_products")),
        "active_tech_count": whole_number(F.col(f"{cards}.technology_highlights.builtwith_num_technologies_used")),
        "location_groups": values_of(F.col(f"{extended}.location_group_identifiers.value")),
        "event_appearances": whole_number(F.col(f"{cards}.event_appearances_headline.num_event_appearances")),
    }


def organizations(parsed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    rows = parsed.filter(F.col("organization").isNotNull())
    return rows.select(*keep, *[c.alias(n) for n, c in organization_fields().items()])


def company_info(parsed: DataFrame, url: str = "url", keep_without_people: bool = False) -> DataFrame:
    """One row per company; companies whose page lists no people are left out unless asked for."""
    usable = F.col("error").isNull()
    if keep_without_people:
        usable = usable | (F.col("error") == NO_PEOPLE)
    f = organization_fields()
    return parsed.filter(usable).select(
        f["semrush"].alias("Company ID"),
        f["name"].alias("Company Name"),
        company_slug(F.col(url)).alias("Name from URL"),
        F.coalesce(f["description"], f["about"]).alias("Description"),
        f["size"].alias("Company Size"),
        f["city"].alias("City"),
        f["state"].alias("State"),
        f["country"].alias("Country"),
        f["categories"].alias("Business Category"),
        f["founded_on"].alias("Founded at (Date)"),
        f["ipo_status"].alias("IPO status"),
        f["email"].alias("E-mail"),
        f["phone"].alias("Phone:"),
        f["linkedin"].alias("Linkedin"),
        f["facebook"].alias("Facebook"),
        f["twitter"].alias("Twitter"),
        f["funding_rounds"].alias("Funding Rounds"),
        f["funding_usd"].alias("Funding Total (USD)"),
        f["acquisitions"].alias("Acquisitions"),
        f["investments"].alias("Investments"),
        f["lead_investments"].alias("Lead Investments"),
        f["investors"].alias("Investors"),
        f["lead_investors"].alias("Lead Investors"),
        f["total_products_active"].alias("Total Products Active"),
        f["active_tech_count"].alias("Active Tech Count"),
        f["semrush_visits_latest_month"].alias("Monthly Visits"),
        percent(f["semrush_visits_latest_month_change"]).alias("Monthly Visits Change(%)"),
        f["similar"].alias("Similar Companies"),
    )


def people(parsed: DataFrame, url: str = "url") -> DataFrame:
    """One row per listed person, with the company's columns; a missing handle gives a null profile."""
    f = organization_fields()
    return (
        parsed.filter(F.col("error").isNull())
        .select(
            f["semrush"].alias("Company ID"),
            f["name"].alias("Company Name"),
            company_slug(F.col(url)).alias("Name from URL"),
            F.explode("employees.entities").alias("e"),
        )
        .select(
            "Company ID", "Company Name", "Name from URL",
            F.col("e.properties.name").alias("People Name"),
            prefixed(PROFILE_PREFIX, F.col("e.properties.linkedin")).alias("Linkedin Profile"),
            F.get(
                F.col("e.related_entities.`contact_item.has_contact_item.forward`.entities"), F.lit(0)
            )["properties"]["job_title"].alias("Job Title"),
            F.col("e.properties.job_levels").alias("Job Category"),
            F.col("e.properties.job_departments").alias("Departments"),
        )
    )


def page_errors(parsed: DataFrame, url: str = "url") -> DataFrame:
    """The dead letters: message and address of every page that gave no company row."""
    return parsed.filter(F.col("error").isNotNull()).select(
        F.col("error").alias("msg"), F.concat(F.col(url), F.lit("/people")).alias("urls")
    )


# The fields of a person's investing overview.
INVESTING = (
    "num_current_advisor_jobs", "num_founded_organizations", "num_portfolio_organizations", "rank_principal_investor",
)


def parse_person_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Person pages to the eighteen fields of a person document."""
    names = [c for c in pages.columns if c != html]
    kept = [F.col(f"`{c}`") for c in names]
    state = computed_once(pages, {"state": parse_json(page_state(F.col(html)), _CACHE)}, names)
    document = parse_json(cache_entry(F.col("state.HttpState"), PERSON_KEY), schemas.PERSON)
    person = computed_once(state, {"p": document}, names)
    props, overview = "p.properties", "p.cards.overview_fields"
    social, headline = "p.cards.overview_fields2", "p.cards.investor_overview_headline"
    return person.select(
        *kept,
        F.col(f"{props}.identifier.value").alias("name"),
        F.col(f"{props}.title").alias("title"),
        F.col(f"{props}.short_description").alias("description"),
        F.col(f"{props}.layout_id").alias("type"),
        F.col(f"{overview}.gender").alias("gender"),
        values_of(F.col(f"{overview}.location_group_identifiers.value")).alias("location_groups"),
        values_of(F.col(f"{overview}.location_identifiers.value")).alias("location"),
        whole_number(F.col("p.cards.jobs_summary.num_current_jobs")).alias("current_jobs"),
        whole_number(F.col("p.cards.jobs_summary.num_past_jobs")).alias("past_jobs"),
        values_of(F.col("p.cards.education_image_list.school")).alias("education"),
        F.when(F.col(headline).isNotNull(), F.struct(*[whole_number(F.col(f"{headline}.{n}")).alias(n) for n in INVESTING]))
        .alias("investing_overview"),
        F.col(f"{social}.linkedin.value").alias("linkedin"),
        F.col(f"{social}.twitter.value").alias("twitter"),
        F.col(f"{social}.facebook.value").alias("facebook"),
        whole_number(F.col(f"{headline}.num_current_advisor_jobs")).alias("current_advisor_jobs"),
        whole_number(F.col(f"{headline}.num_founded_organizations")).alias("founded_orgs"),
        whole_number(F.col(f"{headline}.num_portfolio_organizations")).alias("portfolio_orgs"),
        whole_number(F.col(f"{headline}.rank_principal_investor")).alias("rank_principal_investor"),
    )


def read_sitemaps(
    spark: SparkSession, path: str | list[str], target: str | None = None, min_last_modified: dt.datetime | None = None
) -> DataFrame:
    """(url, last_modified) from site map files, plain or gzipped; both filters are optional, the bound is inclusive."""
    raw = spark.read.format("xml").options(rowTag="url").schema(schemas.SITEMAP).load(path)
    entries = raw.select(F.col("loc").alias("url"), iso_timestamp(F.col("lastmod")).alias("last_modified"))
    if target is not None:
        entries = entries.filter(F.col("url").contains(target))
    if min_last_modified is not None:
        entries = entries.filter(F.col("last_modified") >= F.lit(min_last_modified).cast("timestamp_ntz"))
    return entries


def read_sitemap_index(spark: SparkSession, path: str | list[str], target: str | None = None) -> DataFrame:
    """Addresses of the site maps named by an index."""
    raw = spark.read.format("xml").options(rowTag="sitemap").schema("loc string").load(path)
    urls = raw.select(F.col("loc").alias("url"))
    return urls if target is None else urls.filter(F.col("url").contains(target))
