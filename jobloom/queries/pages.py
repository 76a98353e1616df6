"""Queries on stored pages: text, links, records, embedded JSON, company and person documents, site maps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobloom import lexicon
from jobloom.functions import text
from jobloom.functions.names import company_slug
from jobloom.once import computed_once
from jobloom.queries.extraction import COMMON_WORDS, POSTINGS, _list_sql, _word_test
from jobloom.queries import patterns
from jobloom.queries.registry import Derived, literal, query, table
from jobloom.scratch import scratch_path
from jobloom.sources import boards, companies

_SPACES = literal(patterns.SPACE + "+")


def _clean_sql(html: str) -> str:
    return f"lower(trim(regexp_replace(regexp_replace({html}, '<[^>]+>', '', 'g'), {_SPACES}, ' ', 'g')))"


@query(f"SELECT page_id, {_clean_sql('html')} AS body FROM pages")
def clean_html(spark, sf_dir):
    return table(spark, sf_dir, "pages", costly=True).select("page_id", text.clean_text(F.col("html")).alias("body"))


@query(
    """SELECT page_id, replace(unnest(regexp_extract_all(html, '(?i)<a\\s[^>]*?href="([^"]*)"', 1)), '&amp;', '&') AS link
    FROM pages"""
)
def page_links(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.explode(boards.link_targets(F.col("html"))).alias("link"))


_JOB_LINK = """'<div><a class="info-position logo-' || CASE page_id % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false web-job'
    ELSE 'other' END || CASE WHEN page_id % 2 = 0 THEN '" href="' || replace(url, '&', '&amp;') || '">x'
    ELSE '" href=' || chr(39) || replace(url, '&', '&#38;') || chr(39) || '>x' END || '</a><a href="/about">y</a></div>' || html"""
JOB_PAGES = Derived("pages", {"page_id": "page_id", "url": "url", "html": _JOB_LINK})


@query("SELECT DISTINCT url AS job_listing_url FROM pages WHERE page_id % 3 < 2")
def job_urls(spark, sf_dir):
    """Links to job pages have one of four classes; the other links of the pages do not count."""
    return boards.job_urls(JOB_PAGES.frame(spark, sf_dir))


_TITLE = r"(?is)<title\b[^>]*>(.*?)</title>"
_H1 = r"(?is)<h1\b[^>]*>(.*?)</h1>"


def _tag_sql(pattern: str) -> str:
    return f"trim(regexp_replace(nullif(regexp_extract(html, {literal(pattern)}, 1), ''), '<[^>]+>', '', 'g'))"


@query(f"SELECT page_id, {_tag_sql(_TITLE)} AS title, {_tag_sql(_H1)} AS heading FROM pages")
def page_titles(spark, sf_dir):
    html = F.col("html")
    return table(spark, sf_dir, "pages", costly=True).select(
        "page_id", boards.first_tag_text(html, "title").alias("title"), boards.first_tag_text(html, "h1").alias("heading")
    )


# Job pages of board B with the page's own address and a fixed frame around values from the documents.
_BODY = """regexp_replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[\\r\\n]+', ' ')"""
RECORD_PAGES = {
    "url": "'https://jobs.example/' || doc_id",
    "html": f"""'<html><body><h1 class="info-position big">' || source || ' Analyst' || '</h1>'
        || '<p class="jd-timeVal"> Posted ' || (doc_id % 28) || ' days ago </p>'
        || '<div class="candidate-profile"><div><p class="heading">Experience</p><p class="value"> '
        || (doc_id % 9) || ' - ' || (doc_id % 9 + 3) || ' Years</p></div><div><p class="value"><a href="#">' || lang
        || '</a></p></div><div><p class="value">Bachelor, ' || source || '</p></div></div>'
        || '<article class="job-description">' || {_BODY} || '<p class="heading">Employment Type</p></article>'
        || '<div class="job-description"><p class="heading">Employment Type</p><br><ul><li>Full '
        || (doc_id % 3) || '</li></ul></div>'
        || CASE doc_id % 4 WHEN 0 THEN '' ELSE '<div class="jd-company-desc ng-box"><p class="heading">'
        || source || '</p></div>' END || '</body></html>'""",
}
_RECORDS = Derived("documents", RECORD_PAGES, costly=True)


@query(
    f"""SELECT 'https://jobs.example/' || doc_id AS feed, 'Posted ' || (doc_id % 28) || ' days ago' AS posted,
    (doc_id % 9) || ' - ' || (doc_id % 9 + 3) || ' Years' AS experience, lang AS location, 'Full ' || (doc_id % 3) AS job_type,
    'Bachelor, ' || source AS education, CASE WHEN doc_id % 4 <> 0 THEN source END AS name,
    CASE WHEN doc_id % 4 <> 0 THEN 'Analyst' ELSE source || ' Analyst' END AS title,
    regexp_replace(regexp_replace(text, '[\\r\\n]+', ' ', 'g'), '^{patterns.SPACE}+', '') || 'Employment Type' AS description
    FROM documents"""
)
def page_record(spark, sf_dir):
    rows = boards.parse_job_pages(_RECORDS.frame(spark, sf_dir))
    return rows.select(
        "feed", "posted", F.col("Experience").alias("experience"), "location", F.col("jobType").alias("job_type"),
        F.col("Education").alias("education"), "name", "title", "description",
    )


# --- JSON in pages ---------------------------------------------------------------------------------------------------


def _script(prefix: str, json: Column, suffix: str = ";") -> Column:
    return F.concat(F.lit(f"<script>{prefix}"), json, F.lit(f"{suffix}</script>"))


def _cards(spark, sf_dir):
    """Search pages out of parts: two cards each, some broken, some without the total."""
    p = F.col("p_partkey")
    card = [
        F.struct(
            F.when(p % 4 != 0, F.col("p_brand")).alias("company"),
            F.concat(p.cast("string"), F.lit(f"-{i}")).alias("jobkey"),
            F.col("p_name").alias("displayTitle"),
            F.col("p_type").alias("formattedLocation"),
        )
        for i in (1, 2)
    ]
    data = F.to_json(
        F.struct(F.struct(F.struct(F.array(*card).alias("results")).alias("mosaicProviderJobCardsModel")).alias("metaData")),
        {"ignoreNullFields": "false"},
    )
    info = F.concat(
        F.lit('{"searchTitleBarModel":{"totalNumResults":'), F.col("p_size").cast("string"),
        F.lit('},"pageLinks":[],"zonedProviders":{}}'),
    )
    broken = F.when(p % 11 == 5, F.replace(data, F.lit('"results":'), F.lit('"results"'))).otherwise(data)
    html = F.concat(
        F.lit("<html>"), _script('window.mosaic.providerData["mosaic-provider-jobcards"]=', broken),
        F.when(p % 11 == 0, F.lit("")).otherwise(_script("window._initialData=", info)), F.lit("</html>"),
    )
    return computed_once(table(spark, sf_dir, "part", costly=True), {"html": html}, ["p_partkey"])


@query(
    """SELECT p_partkey, CASE WHEN p_partkey % 4 <> 0 THEN p_brand END AS name,
    p_partkey || '-' || unnest([1, 2]) AS key, p_name AS title, p_type AS location
    FROM part WHERE p_partkey % 11 NOT IN (0, 5)"""
)
def embedded_json_listing(spark, sf_dir):
    return boards.listing_rows(boards.parse_listing_pages(_cards(spark, sf_dir)), ["p_partkey"])


@query(
    """SELECT p_partkey, CASE p_partkey % 11 WHEN 0 THEN 'Could not find required data in the result'
    WHEN 5 THEN 'invalid JSON' END AS error, CAST(CASE WHEN p_partkey % 11 <> 0 THEN p_size END AS BIGINT) AS total FROM part"""
)
def listing_errors(spark, sf_dir):
    parsed = boards.parse_listing_pages(_cards(spark, sf_dir))
    return parsed.select("p_partkey", F.col("parse_error").alias("error"), F.col("listing.total").alias("total"))


def _detail_pages(spark, sf_dir, page_key: str = "key"):
    """Detail pages out of the derived postings, the description marked up; every eleventh is broken."""
    d = F.col("doc_id")
    job = F.struct(
        F.concat(F.lit("/job/"), d.cast("string")).alias("url"),
        F.struct(F.when(d % 5 != 0, F.concat(F.lit("/cmp/"), F.col("key"))).alias("relativeCompanyPageUrl")).alias("employer"),
    )
    info = F.struct(
        F.concat(F.lit("<b>"), F.col("description"), F.lit("</b> {x}; pays $10 per hour for 3+ years")).alias(
            "sanitizedJobDescription"
        ),
        F.struct(F.col("job_role").alias("jobType")).alias("jobMetadataHeaderModel"),
        F.struct(
            F.col("key").alias("companyName"),
            F.struct(F.struct((d % 5 / 2).alias("rating")).alias("ratingsModel")).alias("companyReviewModel"),
        ).alias("jobInfoHeaderModel"),
    )
    data = F.struct(
        F.col(page_key).cast("string").alias("jobKey"),
        F.struct(F.concat((d % 31).cast("string"), F.lit(" days ago")).alias("age")).alias("hiringInsightsModel"),
        F.struct(
            F.struct(F.struct(F.array(F.struct(job.alias("job"))).alias("results")).alias("jobData")).alias("data")
        ).alias("hostQueryExecutionResult"),
        F.struct(info.alias("jobInfoModel")).alias("jobInfoWrapperModel"),
    )
    json = F.to_json(data)
    # One number may come as text, and a description may hold what looks like the end of the data.
    json = F.when(d % 4 == 1, F.regexp_replace(json, r'"rating":([0-9.]+)', '"rating":"$1"')).otherwise(json)
    broken = F.when(d % 11 == 0, F.substring(json, F.lit(2), F.length(json))).otherwise(json)
    return computed_once(POSTINGS.frame(spark, sf_dir), {"html": _script("window._initialData=", broken)}, ["doc_id"])


_ABOUT = "'<b>' || description || '</b> {x}; pays $10 per hour for 3+ years'"
_FOLDED_ABOUT = f"lower(translate({_ABOUT}, 'İıſK', 'iisk'))"
_DETAIL_OK = "doc_id % 11 <> 0"
_SKILLS_SQL = ", ".join(
    f"CASE WHEN ok THEN {_list_sql([(_word_test('low', t), t.lower()) for t in words])} END AS {name}"
    for name, words in (
        ("tools", lexicon.TOOLS_WORDS), ("soft_skills", lexicon.SOFT_SKILLS),
        ("industry_skills", lexicon.INDUSTRY_SKILLS + COMMON_WORDS), ("education", lexicon.EDUCATION),
    )
)


@query(
    f"""SELECT doc_id, CAST(ok AS BIGINT) AS ok, CASE WHEN ok THEN key END AS key, CASE WHEN ok THEN key END AS company,
    CASE WHEN ok THEN job_role END AS job_type, CASE WHEN ok THEN (doc_id % 31) || ' days ago' END AS posted,
    CASE WHEN ok THEN CAST(doc_id % 31 AS BIGINT) END AS days_ago, CASE WHEN ok THEN (doc_id % 5) / 2.0::DOUBLE END AS rating,
    CASE WHEN ok THEN array_to_string(regexp_extract_all({_ABOUT}, '\\b({patterns.EXPERIENCE}){patterns.SPACE}*years\\b', 1), '|') END
    AS experience, CASE WHEN ok THEN array_to_string(regexp_extract_all({_ABOUT}, {literal(patterns.SALARY)}, 0), '|') END AS salary,
    CASE WHEN ok THEN '/job/' || doc_id END AS feed,
    CASE WHEN ok THEN 'https://board.example' || CASE WHEN doc_id % 5 <> 0 THEN '/cmp/' || key ELSE '' END END AS link,
    CASE WHEN ok THEN {_clean_sql(_ABOUT)} END AS description, {_SKILLS_SQL}
    FROM (SELECT *, {_DETAIL_OK} AS ok, {_FOLDED_ABOUT} AS low FROM {POSTINGS.sql()} p)"""
)
def embedded_json_detail(spark, sf_dir):
    rows = boards.parse_detail_pages(
        _detail_pages(spark, sf_dir), site="https://board.example",
        industry_skills=lexicon.INDUSTRY_SKILLS + COMMON_WORDS,
    )
    statements = F.transform("salary", lambda s: F.concat(s["amount"], F.lit(" "), s["per"], F.lit(" "), s["unit"]))
    return rows.select(
        "doc_id", F.col("parsed").cast("bigint").alias("ok"), "key", F.col("companyName").alias("company"),
        F.col("jobType").alias("job_type"), "posted", F.col("days_ago").cast("bigint").alias("days_ago"), "rating",
        F.array_join("experience", "|").alias("experience"), F.array_join(statements, "|").alias("salary"), "feed", "link",
        "description", F.array_join("Tools", "|").alias("tools"), F.array_join("Soft Skills", "|").alias("soft_skills"),
        F.array_join("Industry Skills", "|").alias("industry_skills"), F.array_join("education", "|").alias("education"),
    )


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, 'none' AS missing FROM events")
def event_props_json(spark, sf_dir):
    props = boards.parse_json(F.col("props"), "k bigint, other string")
    rows = table(spark, sf_dir, "events").select("event_id", props.alias("p"))
    return rows.select("event_id", "p.k", F.coalesce("p.other", F.lit("none")).alias("missing"))


# --- company and person documents ------------------------------------------------------------------------------------


def _named(value: Column) -> Column:
    return F.struct(value.alias("value"))


def _escaped(json: Column) -> Column:
    for sequence, char in (("&a;", "&"), ("&q;", '"'), ("&s;", "'"), ("&l;", "<"), ("&g;", ">")):
        json = F.replace(json, F.lit(char), F.lit(sequence))
    return json


def _state_page(json: Column, escaped: Column) -> Column:
    return F.when(
        escaped, F.concat(F.lit('<body><script id="client-app-state" type="x">'), _escaped(json), F.lit("</script></body>"))
    ).otherwise(F.concat(F.lit('<body><script id="ng-state" type="x">'), json, F.lit("</script></body>")))


def _company_pages(spark, sf_dir):
    """Company pages out of customers: plain and escaped state; without state, broken, without people or organization."""
    c = F.col("c_custkey")
    key, segment = c.cast("string"), F.col("c_mktsegment")
    places = F.array(*[_named(F.concat(F.lit(f"{w} & "), F.col("c_nationkey").cast("string"))) for w in ("city", "state")])
    organization = F.struct(
        F.struct(F.col("c_name").alias("title"), F.struct(key.alias("permalink")).alias("identifier")).alias("properties"),
        F.struct(
            F.struct(F.when(c % 2 == 0, F.lit('about "us"')).alias("description")).alias("overview_description"),
            F.struct(F.lit("short").alias("short_description")).alias("about_short_description"),
            F.struct(
                places.alias("location_identifiers"), segment.alias("num_employees_enum"), F.lit("private").alias("ipo_status")
            ).alias("company_about_fields2"),
            F.struct(F.concat(F.lit("<m>@"), key).alias("contact_email")).alias("contact_fields"),
            F.struct(
                c.alias("semrush_visits_latest_month"), F.struct(F.concat(F.lit("uuid-"), key).alias("uuid")).alias("identifier")
            ).alias("semrush_summary"),
            F.struct((c % 8 / 16).alias("semrush_visits_mom_pct")).alias("semrush_rank_headline"),
            F.struct(
                F.array(_named(segment), _named(F.lit(None).cast("string")), _named(F.lit("IT's"))).alias("categories"),
                _named(F.lit("2001-02-03")).alias("founded_on"),
            ).alias("overview_fields_extended"),
            F.struct(
                c.alias("num_funding_rounds"), F.struct(F.col("c_acctbal").alias("value_usd")).alias("funding_total")
            ).alias("funding_rounds_summary"),
            F.when(c % 3 == 0, F.array(F.struct(_named(key).alias("investor_identifier")))).alias("investors_list"),
        ).alias("cards"),
    )
    person = [
        F.struct(
            F.struct(
                F.concat(F.lit(f"person {i} of "), F.col("c_name")).alias("name"),
                F.when(c % 7 != i, F.concat(F.lit(f"in-{i}-"), key)).alias("linkedin"),
                F.array(F.lit("l1"), segment).alias("job_levels"), F.array(F.lit("d1")).alias("job_departments"),
            ).alias("properties"),
            F.struct(
                F.struct(F.array(F.struct(F.struct(segment.alias("job_title")).alias("properties"))).alias("entities")).alias(
                    "contact_item.has_contact_item.forward"
                )
            ).alias("related_entities"),
        )
        for i in (1, 2)
    ]
    people = F.struct(F.struct(F.array(*person).alias("entities")).alias("data"))
    org_key = F.concat(F.lit("GET/v4/data/entities/organizations/"), key)
    entry = F.to_json(F.struct(organization.alias("data")))
    # The same number comes as a number, as text, or with a fraction.
    rounds = r'"num_funding_rounds":([0-9]+)'
    entry = (
        F.when(c % 3 == 1, F.regexp_replace(entry, rounds, '"num_funding_rounds":"$1"'))
        .when(c % 3 == 2, F.regexp_replace(entry, rounds, '"num_funding_rounds":$1.0')).otherwise(entry)
    )
    parts = F.concat_ws(
        ",",
        F.lit('"GET/v4/other":{"data":{}}'),
        F.when(c % 17 != 4, F.concat(F.lit('"'), org_key, F.lit('":'), entry)),
        F.when(c % 17 != 3, F.concat(F.lit('"POST/v4/data/searches/contacts?x":'), F.to_json(people))),
    )
    json = (
        F.when(c % 17 == 0, F.lit('{"other":1}'))
        .when(c % 17 == 1, F.concat(F.lit('{"HttpState":{'), parts))
        .otherwise(F.concat(F.lit('{"HttpState":{'), parts, F.lit("}}")))
    )
    page = F.when(c % 17 == 2, F.lit("<body></body>")).otherwise(_state_page(json, c % 2 == 1))
    url = F.concat(F.lit("https://dir.example/organization/"), key)
    return computed_once(table(spark, sf_dir, "customer", costly=True), {"url": url, "html": page}, [])


_URL = "'https://dir.example/organization/' || c_custkey"
_USABLE = "c_custkey % 17 > 4"


@query(
    f"""SELECT 'uuid-' || c_custkey AS company_id, c_name AS company, c_custkey::STRING AS slug,
    CASE WHEN c_custkey % 2 = 0 THEN 'about "us"' ELSE 'short' END AS description, c_mktsegment AS size,
    'city & ' || c_nationkey AS city, 'state & ' || c_nationkey AS state, NULL::STRING AS country,
    c_mktsegment || '|IT''s' AS categories, '2001-02-03' AS founded, 'private' AS ipo, '<m>@' || c_custkey AS email,
    c_custkey AS rounds, c_acctbal AS usd, CASE WHEN c_custkey % 3 = 0 THEN c_custkey::STRING END AS investors,
    c_custkey AS visits, round((c_custkey % 8) / 16.0::DOUBLE * 100, 2) AS change FROM customer WHERE {_USABLE}"""
)
def app_state_company(spark, sf_dir):
    info = companies.company_info(companies.parse_company_pages(_company_pages(spark, sf_dir)))
    return info.select(
        F.col("Company ID").alias("company_id"), F.col("Company Name").alias("company"),
        F.col("Name from URL").alias("slug"), F.col("Description").alias("description"),
        F.col("Company Size").alias("size"), F.col("City").alias("city"), F.col("State").alias("state"),
        F.col("Country").alias("country"), F.array_join("Business Category", "|").alias("categories"),
        F.col("Founded at (Date)").alias("founded"), F.col("IPO status").alias("ipo"), F.col("E-mail").alias("email"),
        F.col("Funding Rounds").alias("rounds"), F.col("Funding Total (USD)").alias("usd"),
        F.array_join("Investors", "|").alias("investors"), F.col("Monthly Visits").alias("visits"),
        F.col("Monthly Visits Change(%)").alias("change"),
    )


@query(
    """SELECT c_custkey::STRING AS id, c_name AS name, 'city & ' || c_nationkey AS city, NULL::STRING AS country,
    c_mktsegment || '|IT''s' AS categories, NULL::STRING AS similar_names, CAST(NULL AS BIGINT) AS advisors
    FROM customer WHERE c_custkey % 17 > 2 AND c_custkey % 17 <> 4"""
)
def organization_documents(spark, sf_dir):
    rows = companies.organizations(companies.parse_company_pages(_company_pages(spark, sf_dir)))
    return rows.select(
        "id", "name", "city", "country", F.array_join("categories", "|").alias("categories"),
        F.array_join("similar", "|").alias("similar_names"), "advisors",
    )


@query(
    f"""SELECT 'uuid-' || c_custkey AS company_id, c_name AS company, c_custkey::STRING AS slug,
    'person ' || i || ' of ' || c_name AS person,
    CASE WHEN c_custkey % 7 <> i THEN 'https://www.linkedin.com/in/in-' || i || '-' || c_custkey END AS profile,
    c_mktsegment AS job_title, 'l1|' || c_mktsegment AS category, 'd1' AS departments
    FROM customer, (VALUES (1), (2)) v(i) WHERE {_USABLE}"""
)
def people_explode(spark, sf_dir):
    rows = companies.people(companies.parse_company_pages(_company_pages(spark, sf_dir)))
    lists = {c: F.array_join(c, "|") for c in ("Job Category", "Departments")}
    return rows.withColumns(lists).toDF(
        "company_id", "company", "slug", "person", "profile", "job_title", "category", "departments"
    )


@query(
    f"""SELECT CASE c_custkey % 17 WHEN 0 THEN 'HttpState key not found' WHEN 3 THEN 'No employee information'
    WHEN 4 THEN 'No organization information' ELSE 'invalid JSON' END AS msg, {_URL} || '/people' AS urls
    FROM customer WHERE c_custkey % 17 <= 4"""
)
def parse_errors(spark, sf_dir):
    return companies.page_errors(companies.parse_company_pages(_company_pages(spark, sf_dir)))


def _person_pages(spark, sf_dir):
    s = F.col("s_suppkey")
    person = F.struct(
        F.struct(
            _named(F.col("s_name")).alias("identifier"), F.lit("boss").alias("title"),
            F.when(s % 2 == 0, F.lit("<words>")).alias("short_description"), F.lit("person").alias("layout_id"),
        ).alias("properties"),
        F.struct(
            F.struct(
                F.lit("x").alias("gender"),
                F.array(_named(F.lit("a")), _named(F.lit(None).cast("string")), _named(F.lit("b"))).alias("location_identifiers"),
            ).alias("overview_fields"),
            F.struct(s.alias("num_current_jobs"), F.lit(2).alias("num_past_jobs")).alias("jobs_summary"),
            F.array(F.struct(_named(F.col("s_name")).alias("school"))).alias("education_image_list"),
            F.struct(_named(s.cast("string")).alias("linkedin")).alias("overview_fields2"),
            F.struct((s % 5).alias("num_founded_organizations")).alias("investor_overview_headline"),
        ).alias("cards"),
    )
    entry = F.to_json(F.struct(person.alias("data")))
    json = F.concat(F.lit('{"HttpState":{"GET/v4/data/entities/people/x":'), entry, F.lit("}}"))
    return computed_once(table(spark, sf_dir, "supplier"), {"html": _state_page(json, s % 2 == 0)}, ["s_suppkey"])


@query(
    """SELECT s_suppkey, s_name AS name, 'boss' AS title, CASE WHEN s_suppkey % 2 = 0 THEN '<words>' END AS description,
    'person' AS type, 'x' AS gender, 'a|b' AS location, NULL::STRING AS location_groups, s_suppkey AS current_jobs,
    CAST(2 AS BIGINT) AS past_jobs, s_name AS education, s_suppkey::STRING AS linkedin, NULL::STRING AS twitter,
    CAST(s_suppkey % 5 AS BIGINT) AS founded_orgs, CAST(s_suppkey % 5 AS BIGINT) AS overview_founded,
    CAST(NULL AS BIGINT) AS portfolio_orgs FROM supplier"""
)
def person_record(spark, sf_dir):
    rows = companies.parse_person_pages(_person_pages(spark, sf_dir))
    return rows.select(
        "s_suppkey", "name", "title", "description", "type", "gender", F.array_join("location", "|").alias("location"),
        F.array_join("location_groups", "|").alias("location_groups"), "current_jobs", "past_jobs",
        F.array_join("education.value", "|").alias("education"), "linkedin", "twitter", "founded_orgs",
        F.col("investing_overview.num_founded_organizations").alias("overview_founded"), "portfolio_orgs",
    )


# --- site maps and slugs ---------------------------------------------------------------------------------------------

BOUND = dt.datetime(2024, 7, 11)
PER_DOCUMENT = 1000


def _write_documents(rows, number: Column, entry: Column, head: str, tail: str, folder: str, gzip: bool = False) -> None:
    """XML documents of at most a thousand entries, one to a file."""
    documents = rows.groupBy(F.floor(number / PER_DOCUMENT)).agg(F.array_join(F.collect_list(entry), "\n").alias("body"))
    text_rows = documents.select(F.concat(F.lit(head + "\n"), F.col("body"), F.lit("\n" + tail)))
    text_rows.write.option("maxRecordsPerFile", 1).option("compression", "gzip" if gzip else "none").text(folder)


@query(
    f"""SELECT url, strftime(TIMESTAMP '2024-07-01' + to_days(CAST(page_id % 28 AS INT)), '%Y-%m-%d %H:%M:%S') AS modified
    FROM pages WHERE contains(url, '/en/') AND TIMESTAMP '2024-07-01' + to_days(CAST(page_id % 28 AS INT)) >= TIMESTAMP '{BOUND}'"""
)
def sitemap_entries(spark, sf_dir):
    """The pages written as gzipped site maps with a name space, read back with both filters."""
    folder = scratch_path(spark, "sitemap")
    day = F.date_add(F.to_date(F.lit("2024-07-01")), (F.col("page_id") % 28).cast("int"))
    entry = F.concat(
        F.lit("<url><loc>"), F.replace(F.col("url"), F.lit("&"), F.lit("&amp;")), F.lit("</loc><lastmod>"),
        day.cast("string"), F.lit("T00:00:00Z</lastmod></url>"),
    )
    frame = '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'
    _write_documents(table(spark, sf_dir, "pages"), F.col("page_id"), entry, frame, "</urlset>", folder, gzip=True)
    found = companies.read_sitemaps(spark, folder, "/en/", BOUND)
    return found.select("url", F.date_format("last_modified", "yyyy-MM-dd HH:mm:ss").alias("modified"))


@query("SELECT 'https://dir.example/maps/organizations-' || s_suppkey || '.xml.gz' AS url FROM supplier WHERE s_suppkey % 2 = 0")
def sitemap_index(spark, sf_dir):
    folder = scratch_path(spark, "sitemap-index")
    s = F.col("s_suppkey")
    kind = F.when(s % 2 == 0, F.lit("organizations")).otherwise(F.lit("people"))
    entry = F.concat(
        F.lit("<sitemap><loc>https://dir.example/maps/"), kind, F.lit("-"), s.cast("string"),
        F.lit(".xml.gz</loc></sitemap>"),
    )
    _write_documents(table(spark, sf_dir, "supplier"), s, entry, "<sitemapindex>", "</sitemapindex>", folder)
    return companies.read_sitemap_index(spark, folder, "organizations")


SLUGS = Derived(
    "part",
    {
        "p_partkey": "p_partkey",
        "url": """'https://dir.example/' || CASE p_partkey % 5 WHEN 0 THEN 'organization/' || replace(p_name, ' ', '-')
            WHEN 1 THEN 'organization/%e6' WHEN 2 THEN 'organization/' WHEN 3 THEN 'person/' || p_partkey
            ELSE 'organization/old/organization/' || lower(p_type) END""",
    },
)


@query(
    f"""SELECT p_partkey, CASE WHEN slug <> '' AND NOT starts_with(slug, '%') THEN slug END AS slug FROM (
    SELECT p_partkey, split_part(url, 'organization/', -1) AS slug FROM {SLUGS.sql()} s WHERE contains(url, 'organization'))"""
)
def company_slugs(spark, sf_dir):
    urls = SLUGS.frame(spark, sf_dir).filter(F.col("url").contains("organization"))
    return urls.select("p_partkey", company_slug(F.col("url")).alias("slug"))
