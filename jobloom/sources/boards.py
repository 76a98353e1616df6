"""Stored pages of the two job boards, read into listing and detail rows."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom import lexicon, schemas
from jobloom.functions.terms import word_term_groups
from jobloom.functions.text import (
    clean_text, days_since_posted, experience_years, prefixed, salaries, without_employer,
)
from jobloom.once import computed_once
from jobloom.sources.job_page import FIELDS, with_job_page_fields

# Where board A pages carry their data. (?d) makes the dot stop at line feeds only. Data that may hold any text
# reach to the end of the script; the JSON reader stops by itself where the value ends.
LISTING_DATA = r'(?s)window.mosaic.providerData\["mosaic-provider-jobcards"\]=(\{.*?)(?:</script>|\z)'
LISTING_TOTAL = r'(?d)_initialData=(\{.*"zonedProviders":\{\}\});'
DETAIL_START = "_initialData="

_STRICT = {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": "_bad"}


def parse_json(text: Column, schema: str) -> Column:
    """Strict parse into a struct; its field ``_bad`` holds the text where it is not valid JSON of that shape."""
    return F.from_json(text, f"{schema}, _bad string", _STRICT)


def is_broken(parsed: str) -> Column:
    """Whether the text of a parsed column is not JSON at all. A field of another shape than declared is null by itself."""
    bad = F.col(f"{parsed}._bad")
    return bad.isNotNull() & F.get_json_object(bad, "$").isNull()


def number(text: Column) -> Column:
    """A number that JSON holds as a number or as text; null if it is none."""
    return text.try_cast("double")


def whole_number(text: Column) -> Column:
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))


def embedded(html: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(html, pattern, 1), F.lit(""))


def script_data(html: Column, start: str) -> Column:
    """What follows the first ``start`` with a brace behind it, from the brace to the end of the script; null without one."""
    at = F.locate(start + "{", html)
    return F.when(at > 0, F.substring_index(F.substr(html, at + F.lit(len(start))), "</script>", 1))


def parse_listing_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add ``listing`` (job cards and total) and ``parse_error`` to stored search pages."""
    kept = [c for c in pages.columns if c != html]
    columns = {
        "_cards": parse_json(embedded(F.col(html), LISTING_DATA), schemas.LISTING_STATE),
        "_info": parse_json(embedded(F.col(html), LISTING_TOTAL), schemas.LISTING_INFO),
    }
    parsed = computed_once(pages, columns, kept)
    missing = F.col("_cards").isNull() | F.col("_info").isNull()
    broken = is_broken("_cards") | is_broken("_info")
    return parsed.withColumns(
        {
            "parse_error": F.when(missing, F.lit("Could not find required data in the result")).when(
                broken, F.lit("invalid JSON")
            ),
            "listing": F.struct(
                F.col("_cards.metaData.mosaicProviderJobCardsModel.results").alias("results"),
                whole_number(F.col("_info.searchTitleBarModel.totalNumResults")).alias("total"),
            ),
        }
    ).drop("_cards", "_info")


def listing_rows(parsed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per job card: name, key, title, location."""
    return (
        parsed.filter(F.col("parse_error").isNull())
        .select(*keep, F.explode("listing.results").alias("card"))
        .select(
            *keep,
            F.col("card.company").alias("name"),
            F.col("card.jobkey").alias("key"),
            F.col("card.displayTitle").alias("title"),
            F.col("card.formattedLocation").alias("location"),
        )
    )


def read_detail_pages(pages: DataFrame, html: str = "html", site: str = "") -> DataFrame:
    """Board A detail pages to their data and the clean ``description``; nulls, but for ``parsed``, without valid data.

    ``_about`` is the description as the page has it, for ``with_lists``. ``site`` precedes the employer's relative address
    in ``link``.
    """
    names = [c for c in pages.columns if c != html]
    kept = [F.col(f"`{c}`") for c in names]
    parsed = parse_json(script_data(F.col(html), DETAIL_START), schemas.DETAIL_STATE)
    state = computed_once(pages, {"state": parsed}, names)
    valid = F.col("state").isNotNull() & ~is_broken("state")
    info, employer_page = "state.jobInfoWrapperModel.jobInfoModel", (
        F.col("state.hostQueryExecutionResult.data.jobData.results")[0]["job"]
    )
    fields = state.select(
        *kept,
        valid.alias("parsed"),
        F.col("state.jobKey").alias("key"),
        F.col(f"{info}.jobInfoHeaderModel.companyName").alias("companyName"),
        F.col(f"{info}.jobMetadataHeaderModel.jobType").alias("jobType"),
        F.coalesce("state.hiringInsightsModel.age", F.lit("")).alias("posted"),
        number(F.col(f"{info}.jobInfoHeaderModel.companyReviewModel.ratingsModel.rating")).alias("rating"),
        employer_page["url"].alias("feed"),
        F.coalesce(employer_page["employer"]["relativeCompanyPageUrl"], F.lit("")).alias("_employer_page"),
        F.coalesce(F.col(f"{info}.sanitizedJobDescription"), F.lit("")).alias("_about"),
    )
    flat = computed_once(fields, {"description": F.when(F.col("parsed"), clean_text(F.col("_about")))})
    columns = {
        "key": F.col("key"),
        "companyName": F.col("companyName"),
        "jobType": F.col("jobType"),
        "posted": F.col("posted"),
        "days_ago": days_since_posted(F.col("posted")),
        "rating": F.col("rating"),
        "feed": F.col("feed"),
        "link": prefixed(site, F.col("_employer_page")),
        "_about": F.col("_about"),
    }
    values = [F.when(F.col("parsed"), c).alias(n) for n, c in columns.items()]
    return flat.select(*kept, "parsed", *values, "description")


def with_lists(
    read: DataFrame,
    tools: Sequence[str] = lexicon.TOOLS_WORDS,
    soft_skills: Sequence[str] = lexicon.SOFT_SKILLS,
    industry_skills: Sequence[str] = lexicon.INDUSTRY_SKILLS,
    education: Sequence[str] = lexicon.EDUCATION,
) -> DataFrame:
    """Detail rows out of ``read_detail_pages``: the description is read once for the four lists."""
    groups = {
        "Tools": tools, "Soft Skills": soft_skills, "Industry Skills": industry_skills, "education": education,
    }
    about = F.col("_about")
    found = computed_once(read, {"_terms": word_term_groups(about, groups)})
    lists = {
        "experience": experience_years(about),
        "salary": salaries(about),
        "education": F.col("_terms.education"),
        "Tools": F.col("_terms.Tools"),
        "Soft Skills": F.col("_terms.`Soft Skills`"),
        "Industry Skills": F.col("_terms.`Industry Skills`"),
    }
    shown = {n: F.when(F.col("parsed"), c) for n, c in lists.items()}
    first, last = ["experience", "salary", "education"], ["Tools", "Soft Skills", "Industry Skills"]
    others = [c for c in read.columns if c not in ("_about", "feed", "link", "description")]
    order = [*others, *first, "feed", "link", *last, "description"]
    return found.select(*[shown[c].alias(c) if c in shown else F.col(f"`{c}`") for c in order])


def parse_detail_pages(
    pages: DataFrame,
    html: str = "html",
    site: str = "",
    tools: Sequence[str] = lexicon.TOOLS_WORDS,
    soft_skills: Sequence[str] = lexicon.SOFT_SKILLS,
    industry_skills: Sequence[str] = lexicon.INDUSTRY_SKILLS,
    education: Sequence[str] = lexicon.EDUCATION,
) -> DataFrame:
    """Board A detail pages to detail rows; a page without valid data yields a row with a null key."""
    return with_lists(read_detail_pages(pages, html, site), tools, soft_skills, industry_skills, education)


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a tag, in double quotes, single quotes or none; empty if there is none."""
    found = F.regexp_extract(tag, rf"""(?is)\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    return F.regexp_replace(found, r"""^["']|["']$""", "")


def _unescaped(text: Column) -> Column:
    """Character references of addresses decoded: the four of XML, the apostrophe, and numbers below 128."""
    for code in re.findall(r"\S", "&/=?#%+:;,._-~'\"<>"):  # what addresses write as a number
        text = F.regexp_replace(text, rf"&#(?:0*{ord(code)}|[xX]0*(?i:{ord(code):x}));", code)
    for name, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(sign))
    return text


def link_targets(html: Column, classes: Sequence[str] | None = None) -> Column:
    """Addresses of the links of a page, in page order; with ``classes``, of links whose class attribute is one of them."""
    tags = F.regexp_extract_all(html, F.lit(r"""(?is)<a\s(?:[^>"']|"[^"]*+"|'[^']*+')*+>"""), F.lit(0))
    if classes is not None:
        tags = F.filter(tags, lambda t: _attribute(t, "class").isin(*classes))
    tags = F.filter(tags, lambda t: t.rlike(r"(?is)\shref\s*="))
    return F.transform(tags, lambda t: _unescaped(_attribute(t, "href")))


# The classes of the links to job pages on board B.
JOB_LINK_CLASSES = (
    "info-position logo-true", "info-position logo-false",
    "info-position logo-true web-job", "info-position logo-false web-job",
)


def job_urls(
    pages: DataFrame, html: str = "html", classes: Sequence[str] = JOB_LINK_CLASSES, keep: Sequence[str] = ()
) -> DataFrame:
    """Distinct addresses of the job pages linked from board B search pages; ``keep`` adds the columns (the role, say)
    within which an address counts once."""
    kept = [F.col(f"`{c}`") for c in keep]
    return pages.select(*kept, F.explode(link_targets(F.col(html), classes)).alias("job_listing_url")).distinct()


def parse_job_pages(
    pages: DataFrame, url: str = "url", html: str = "html", keep: Sequence[str] = ()
) -> DataFrame:
    """Board B job pages to detail rows. The nesting of the fields needs a parser, hence the Arrow-batched function."""
    names = {f"_{i}": c for i, c in enumerate(keep)}  # what is kept may have the name of a field
    kept = [F.col(f"`{c}`").alias(n) for n, c in names.items()]
    record = with_job_page_fields(pages.select(*kept, F.col(url).alias("feed"), F.col(html).alias("_page")), "_page")
    return record.select(
        *[F.col(n).alias(c) for n, c in names.items()], *FIELDS[:-1],
        without_employer(F.col("title"), F.col("name")).alias("title"), "feed",
    )


def first_tag_text(html: Column, tag: str) -> Column:
    """Text of the first element with the tag, without inner tags; null if there is none."""
    inner = embedded(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>")
    return F.trim(F.regexp_replace(inner, "<[^>]+>", ""))
