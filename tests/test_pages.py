import datetime as dt
import gzip
import json
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from jobloom.sources import boards, companies, job_page

LISTING = {"metaData": {"mosaicProviderJobCardsModel": {"results": [
    {"company": "Acme", "jobkey": "k1", "displayTitle": "Analyst; {x}", "formattedLocation": "Riyadh", "other": [1]},
    {"company": None, "jobkey": "k2", "displayTitle": "Engineer", "formattedLocation": None},
]}}}
INFO = '{"searchTitleBarModel":{"totalNumResults":7},"pageLinks":[{"label":"2"}],"zonedProviders":{}}'


def search_page(data, info=INFO):
    return (
        f'<script>window.mosaic.providerData["mosaic-provider-jobcards"]={data};</script>'
        f"<script>window._initialData={info};</script>"
    )


def frame(spark, pages):
    return spark.createDataFrame(list(enumerate(pages)), "page_id int, html string")


def test_listing_pages(spark):
    pages = [search_page(json.dumps(LISTING)), "<html></html>", search_page('{"metaData":oops}'), None]
    parsed = boards.parse_listing_pages(frame(spark, pages))
    assert [r["parse_error"] for r in parsed.orderBy("page_id").collect()] == [
        None, "Could not find required data in the result", "invalid JSON", "Could not find required data in the result",
    ]
    assert parsed.filter("page_id = 0").head()["listing"]["total"] == 7
    rows = boards.listing_rows(parsed).orderBy("key").collect()
    assert [tuple(r) for r in rows] == [("Acme", "k1", "Analyst; {x}", "Riyadh"), (None, "k2", "Engineer", None)]


def test_detail_pages(spark):
    about = "<b>SQL</b>, Python; 3-5 years. Communication skills, Master &amp; NLP. $10 per hour\nData  Mining"
    full = {
        "jobKey": "k1",
        "hiringInsightsModel": {"age": "Just posted"},
        "hostQueryExecutionResult": {"data": {"jobData": {"results": [
            {"job": {"url": "http://j/1", "employer": {"relativeCompanyPageUrl": "/cmp/a"}}}
        ]}}},
        "jobInfoWrapperModel": {"jobInfoModel": {
            "sanitizedJobDescription": about,
            "jobMetadataHeaderModel": {"jobType": "Full-time"},
            "jobInfoHeaderModel": {"companyName": "Acme", "companyReviewModel": {"ratingsModel": {"rating": 4}}},
        }},
    }
    pages = [f"<script>_initialData={json.dumps(full)};</script>", '_initialData={"jobKey":"k2"};', "no data", "_initialData={x};"]
    rows = boards.parse_detail_pages(frame(spark, pages), site="https://site").orderBy("page_id").collect()
    first = rows[0].asDict(recursive=True)
    assert first["days_ago"] == 0 and first["rating"] == 4.0 and first["feed"] == "http://j/1"
    assert first["link"] == "https://site/cmp/a" and first["experience"] == ["3-5"]
    assert first["salary"] == [{"amount": "$10", "per": "per", "unit": "hour"}]
    assert first["Tools"] == ["python", "sql"] and first["education"] == ["master"]
    assert first["Soft Skills"] == ["communication", "communication skills"]
    assert first["Industry Skills"] == ["nlp"]
    assert first["description"].startswith("sql, python;") and first["description"].endswith("hour data mining")
    second = rows[1].asDict()
    assert second["parsed"] and second["posted"] == "" and second["description"] == "" and second["days_ago"] is None
    assert second["link"] == "https://site" and second["Tools"] == []
    assert [r["key"] for r in rows] == ["k1", "k2", None, None] and not rows[3]["parsed"]


def test_links(spark):
    html = (
        '<a href="/x?a=1&amp;b=2" class="info-position logo-true">t</a><a class="info-position logo-true extra" href="/no">'
        '<A class="info-position logo-false web-job" data-x="1" HREF="/y">u</A><abbr href="/z"><a name="q">'
    )
    rows = frame(spark, [html, html, None])
    every = rows.select(boards.link_targets(F.col("html")).alias("l")).head()["l"]
    assert every == ["/x?a=1&b=2", "/no", "/y"]
    assert {r["job_listing_url"] for r in boards.job_urls(rows).collect()} == {"/x?a=1&b=2", "/y"}


JOB_PAGE = """<html><head><script>var a = "<p class='jd-timeVal'>no</p>";</script></head><body>
<h1 class="info-position big"> Acme Data Engineer </h1><p class="jd-timeVal"> Posted Today </p>
<div class="candidate-profile"><div><p class="heading">Experience</p><p class="value"> 3 - 8 Years</div>
<div><p class="value"><a href="#">Riyadh</a> <a>Jeddah</a></p></div><div><p class="value">Bachelor of X </p></div></div>
<article class="job-description"> We use <b>SQL</b> &amp; more<br>now <style>p{}</style></article>
<div class="job-description"><p class="heading">Type</p><ul><li>no</li></ul><p class="heading">Employment Type</p>
<div><ul><li>Full</li> <li>Time</li></ul></div></div>
<div class="jd-company-desc ng-box"><div><p class="heading">Acme</p></div></div></body></html>"""


def test_job_pages(spark):
    pages = spark.createDataFrame([("u1", JOB_PAGE), ("u2", "<h1 class='info-position'>Lead</h1>"), ("u3", None)], "url string, html string")
    rows = {r["feed"]: r.asDict() for r in boards.parse_job_pages(pages).collect()}
    assert rows["u1"] == {
        "posted": "Posted Today", "Experience": "3 - 8 Years", "location": "Riyadh", "jobType": "Full Time",
        "Education": "Bachelor of X ", "description": "We use SQL & morenow", "name": "Acme", "title": "Data Engineer",
        "feed": "u1",
    }
    assert rows["u2"]["title"] == "Lead" and rows["u2"]["name"] is None
    assert all(v is None for k, v in rows["u3"].items() if k != "feed")


def organization(**cards):
    return {"properties": {"title": "Acme & Co", "identifier": {"permalink": "acme"}}, "cards": cards}


PEOPLE = {"entities": [
    {"properties": {"name": "P 1", "linkedin": "p1", "job_levels": ["l"], "job_departments": []},
     "related_entities": {"contact_item.has_contact_item.forward": {"entities": [{"properties": {"job_title": "CEO"}}]}}},
    {"properties": {"name": "P 2"}, "related_entities": {}},
]}


def state(org=None, people=None):
    cache = {"GET/other": {"data": {"a": 1}}}
    if org is not None:
        cache["GET/v4/data/entities/organizations/acme?x"] = {"data": org}
        cache["GET/v4/data/entities/organizations/second"] = {"data": {"properties": {"title": "no"}}}
    if people is not None:
        cache["POST/v4/data/searches/contacts"] = {"data": people}
    return json.dumps({"HttpState": cache})


def company_page(text, escaped=False):
    if escaped:
        for char, sequence in (("&", "&a;"), ('"', "&q;"), ("'", "&s;"), ("<", "&l;"), (">", "&g;")):
            text = text.replace(char, sequence)
        return f'<script id="ng-state"></script><script id="client-app-state" type="json">{text}</script>'
    return f'<script type="json" id="ng-state">{text}</script>'


CARDS = {
    "about_short_description": {"short_description": "short"},
    "company_about_fields2": {"location_identifiers": [{"value": "C"}, {"value": "S"}]},
    "semrush_summary": {"identifier": {"uuid": "u-1"}, "semrush_visits_latest_month": 12},
    "semrush_rank_headline": {"semrush_visits_mom_pct": -0.12345},
    "overview_fields_extended": {"categories": [{"value": "x"}, {"value": None}, {"value": "y"}]},
    "investors_list": [{"investor_identifier": {"value": "only"}}],
}


def test_company_pages(spark):
    pages = {
        "plain": company_page(state(organization(**CARDS), PEOPLE)),
        "escaped": company_page(state(organization(overview_description={"description": "<d>'s"}), PEOPLE), True),
        "alone": company_page(state(organization())),
        "headless": company_page(state(None, PEOPLE)),
        "stateless": company_page('{"a":1}'),
        "broken": company_page('{"HttpState":{'),
        "blank": "<html></html>",
    }
    rows = [(f"https://d/organization/{k}", v) for k, v in pages.items()]
    parsed = companies.parse_company_pages(spark.createDataFrame(rows, "url string, html string")).cache()
    errors = {r["urls"].split("/")[-2]: r["msg"] for r in companies.page_errors(parsed).collect()}
    assert errors == {
        "alone": companies.NO_PEOPLE, "headless": companies.NO_ORGANIZATION, "stateless": companies.NO_STATE,
        "broken": companies.INVALID, "blank": companies.INVALID,
    }
    info = {r["Name from URL"]: r for r in companies.company_info(parsed).collect()}
    assert set(info) == {"plain", "escaped"}
    plain = info["plain"]
    assert plain["Company Name"] == "Acme & Co" and plain["Description"] == "short" and plain["Company ID"] == "u-1"
    assert (plain["City"], plain["State"], plain["Country"]) == ("C", "S", None)
    assert plain["Business Category"] == ["x", "y"] and plain["Investors"] == ["only"] and plain["Acquisitions"] is None
    assert abs(plain["Monthly Visits Change(%)"] + 12.35) < 0.011 and plain["Monthly Visits"] == 12
    assert info["escaped"]["Description"] == "<d>'s"
    assert companies.company_info(parsed, keep_without_people=True).count() == 3
    people = companies.people(parsed).filter("`Name from URL` = 'plain'").orderBy("`People Name`").collect()
    assert people[0]["Linkedin Profile"].endswith("/in/p1") and people[0]["Job Title"] == "CEO"
    assert people[1]["Linkedin Profile"] is None and people[1]["Job Title"] is None
    assert len(companies.organization_fields()) == 40
    assert companies.organizations(parsed).count() == 3


def test_person_pages(spark):
    person = {"properties": {"identifier": {"value": "P"}, "title": "t"}, "cards": {
        "overview_fields": {"location_identifiers": [{"value": "a"}, {"value": None}]},
        "investor_overview_headline": {"num_founded_organizations": 2},
    }}
    text = json.dumps({"HttpState": {"x": {"data": {}}, "GET/v4/data/entities/people/p": {"data": person}}})
    rows = companies.parse_person_pages(frame(spark, [company_page(text), company_page(text, True), None])).orderBy("page_id")
    first, second, third = rows.collect()
    assert first["name"] == second["name"] == "P" and first["location"] == ["a"] and first["founded_orgs"] == 2
    assert third["name"] is None and len(rows.columns) == 19


def test_sitemaps(spark, tmp_path):
    name_space = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
    entries = "".join(
        f"<url><loc>https://d/organization/{i}?a&amp;b</loc><lastmod>2024-07-0{i}T00:00:00Z</lastmod></url>" for i in (1, 2, 3)
    )
    (tmp_path / "m.xml.gz").write_bytes(gzip.compress(f"<urlset {name_space}>{entries}</urlset>".encode()))
    bound = dt.datetime(2024, 7, 2)
    found = companies.read_sitemaps(spark, str(tmp_path / "m.xml.gz"), "organization", bound).orderBy("url").collect()
    assert [tuple(r) for r in found] == [
        (f"https://d/organization/{i}?a&b", dt.datetime(2024, 7, i)) for i in (2, 3)
    ]
    assert companies.read_sitemaps(spark, str(tmp_path / "m.xml.gz")).count() == 3
    index = f"<sitemapindex {name_space}><sitemap><loc>u/organizations-1</loc></sitemap><sitemap><loc>u/people-1</loc></sitemap></sitemapindex>"
    (tmp_path / "index.xml").write_text(index)
    urls = companies.read_sitemap_index(spark, str(tmp_path / "index.xml"), "organizations").collect()
    assert [r["url"] for r in urls] == ["u/organizations-1"]


def test_parsing_is_evaluated_once(spark):
    parsed = companies.parse_company_pages(spark.createDataFrame([("u", "h")], "url string, html string"))
    plan = companies.page_errors(parsed)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("entities map") + plan.count("from_json(StructField(HttpState") <= 1


def test_blocks_end_paragraphs_and_items():
    page = '<div class="candidate-profile"><p class="value">3 - 5 Years<div>x</div><p class="value">y<p class="value"> z <ul><li>a<li>b</ul></div>'
    record = job_page._board_b_record(page)
    assert (record["Experience"], record["Education"]) == ("3 - 5 Years", " z ")
    items = job_page._Page("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>")
    assert [items.text(e) for e in items.all("li")] == ["a", "bc", "c", "d"]


@pytest.mark.parametrize("tag", ["<li>", "<b>", "<p>x", "<div>x"])
def test_unclosed_tags_take_linear_time(tag):
    def seconds(n):
        start = time.perf_counter()
        job_page._board_b_record((tag + "text ") * n)
        return time.perf_counter() - start

    seconds(500)
    assert min(seconds(8000) for _ in range(3)) < 8 * max(min(seconds(2000) for _ in range(3)), 0.005)


def test_links_in_any_quoting(spark):
    html = """<a class='info-position logo-true' href='/1?a=1&#38;b=2'>x</a><a href=/2 class="info-position logo-true">y</a>
    <A title=">" CLASS="info-position logo-false" HREF = "/3">z</A><a class="other" href="/4">w</a><abbr href="/5">"""
    pages = spark.createDataFrame([(html, "R1"), (html, "R1"), (html, "R2")], "html string, role string")
    found = boards.job_urls(pages, keep=["role"]).collect()
    assert sorted((r["role"], r["job_listing_url"]) for r in found) == [
        (role, url) for role in ("R1", "R2") for url in ("/1?a=1&b=2", "/2", "/3")
    ]


def test_few_job_pages_are_objects_at_a_time(spark, monkeypatch):
    page = '<h1 class="info-position">Title {}</h1>'
    taken, whole = [], job_page._board_b_record
    monkeypatch.setattr(job_page, "_board_b_record", lambda html: taken.append(html) or whole(html))
    pages = [None if k % 7 == 0 else page.format(k) for k in range(1000)]
    batch = pa.RecordBatch.from_pydict({"feed": [str(k) for k in range(1000)], "page": pages})
    out = job_page._fields_of_batches([batch], "page")
    first = next(out)
    assert len(taken) == first.num_rows == job_page.SLICE
    titles = [t for part in [first, *out] for t in part.column("title").to_pylist()]
    assert titles == [None if p is None else f"Title {k}" for k, p in enumerate(pages)]


def test_kept_columns_may_be_named_like_fields(spark):
    rows = [("u1", '<h1 class="info-position">Title</h1>', "kept")]
    found = boards.parse_job_pages(spark.createDataFrame(rows, "url string, html string, posted string"), keep=["posted"])
    assert found.columns[0] == "posted" and found.drop("posted").columns[:2] == ["Experience", "location"]
    assert found.select("title", "feed").first() == ("Title", "u1")
