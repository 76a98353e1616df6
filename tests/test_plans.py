import datetime as dt
import json

from pyspark.sql import functions as F

from jobloom import schemas
from jobloom.operators import contacts, dedupe
from jobloom.plans import employers as employer_plans
from jobloom.plans import postings as plans
from jobloom.sources import boards, files
from tests.test_pages import JOB_PAGE, PEOPLE, company_page, organization, search_page, state

BODY = "We want SQL, Python, Hadoop, Spark, Kafka, ETL and NLP. Communication skills"


def detail_page(key, body):
    return "<script>_initialData=" + json.dumps(
        {"jobKey": key, "hiringInsightsModel": {"age": "3 days ago"},
         "jobInfoWrapperModel": {"jobInfoModel": {"sanitizedJobDescription": body}}}
    ) + ";</script>"


def test_board_a_from_pages_to_facts(spark, tmp_path):
    cards = [{"company": f"Acme {i}", "jobkey": f"k{i}", "displayTitle": "t", "formattedLocation": "l"} for i in (1, 2, 3)]
    found = search_page(json.dumps({"metaData": {"mosaicProviderJobCardsModel": {"results": cards}}}))
    searches = spark.createDataFrame([(found,), ("<html>",)], "html string")
    listings = boards.listing_rows(boards.parse_listing_pages(searches))
    listings = dedupe.merge_passes([listings, listings], ["title"])
    pages = spark.createDataFrame(
        [(detail_page("k1", BODY),), (detail_page("k2", "We want nothing"),), ("no data",)], "html string"
    )
    details = contacts.with_details(listings, boards.parse_detail_pages(pages))
    assert [r["key"] for r in details.collect()][-1] == "k3" and details.count() == 3
    folder = tmp_path / "details"
    for role, day in (("data_engineer", "2024-07-22"), ("data_scientist", "2024-07-23"), ("cook", "2024-07-23")):
        files.write_csv(details.coalesce(1), str(tmp_path / "parts"))
        folder.mkdir(exist_ok=True)
        part = next((tmp_path / "parts").glob("*.csv"))
        (folder / f"jobs_detail_{role}_{day}.csv").write_text(part.read_text())
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in details.schema.fields)
    stored = files.with_file_columns(files.read_csv(spark, str(folder), schema, with_file=True))
    postings = plans.postings_a(stored)
    assert {(r["key"], r["Job Role"], r["Job_ind"]) for r in postings.collect()} == {
        ("k1", "DATA ENGINEER", 2), ("k1", "DATA SCIENTIST", 3),
    }
    out = plans.consolidate_a(postings, str(tmp_path / "out"), ["feed"])
    tables = {n: spark.read.parquet(p) for n, p in out.items()}
    assert tables["outputs"].count() == 2 and tables["outputs_without_dup"].count() == 1
    assert tables["outputs_without_dup"].head()["Job Role"] == "DATA ENGINEER"
    tools = {r["Tools"] for r in tables["tools"].collect()}
    assert tools == {"sql", "python", "hadoop", "spark", "kafka"}
    assert {r["Industry Skills"] for r in tables["industry_skills"].collect()} == {"etl", "natural language processing"}
    assert {r["Soft Skills"] for r in tables["soft_skills"].collect()} == {"communication", "communication skills"}


def test_board_a_counts_pages_once_for_all_roles(spark, tmp_path):
    bodies = {
        "k0": BODY, "k1": "<b>Python</b>,  R; SQL\u00a0 and statistics; airflow for 3+ years", "k2": "SQL, Python, R", "k3": "",
        "k4": "kafka, airflow. redshift; snowflake, spark. ETL", "k5": BODY,
    }
    pages = spark.createDataFrame([*[(detail_page(k, b),) for k, b in bodies.items()], ("none",), (None,)], "html string")
    roles = ["DATA ENGINEER", "DATA SCIENTIST", "DATA ANALYST", "CLOUD ENGINEER", None]
    cards = [{"company": "a", "jobkey": f"k{i}", "displayTitle": "t", "formattedLocation": "l"} for i in (0, 1, 2, 3, 4, 9)]
    found = search_page(json.dumps({"metaData": {"mosaicProviderJobCardsModel": {"results": cards}}}))
    passes = [spark.createDataFrame([(found, r) for r in roles], "html string, `Job Role` string")]
    day = dt.date(2024, 7, 22)
    wanted = plans.postings_a(plans.board_a_details(passes, pages, day))
    read = plans.pages_a(pages)
    assert {r["key"] for r in read.collect()} == {"k0", "k1", "k4", "k5"}  # the others have too few terms of any role
    rows = plans.board_a_postings(passes, read, day)
    assert rows.dtypes == wanted.dtypes and wanted.count() > 4
    assert sorted(map(repr, rows.collect())) == sorted(map(repr, wanted.collect()))
    raw, once = (plans.run_board_a(passes, d, str(tmp_path / n), day) for n, d in (("raw", pages), ("once", read)))
    for name in raw:
        tables = [sorted(map(repr, spark.read.parquet(paths[name]).collect())) for paths in (raw, once)]
        assert tables[0] == tables[1] and tables[0]


BOARD_B = (
    "posted string, location string, jobType string, description string, name string, title string, feed string, "
    "`Job Role` string, date_of_scrape date, Job_ind int, keyword_count int, days_ago int, experience string, "
    "Tools array<string>, `Soft Skills` array<string>, `Industry Skills` array<string>, education array<string>, "
    "day int, Month int, Year int"
)


def test_board_b_runs(spark, tmp_path):
    table = str(tmp_path / "postings_b")
    page = JOB_PAGE.replace("We use", "We use Python, Power BI, accuracy")

    def run(day, urls):
        rows = [(u, page if i % 2 == 0 else "<p>nothing</p>", "DATA ENGINEER") for i, u in enumerate(urls)]
        pages = spark.createDataFrame(rows, "url string, html string, `Job Role` string")
        plans.run_board_b(pages, table, dt.date(2024, 7, day), BOARD_B)
        return plans.production(spark, table, dt.date(2024, 7, day), BOARD_B)

    first = run(1, ["a", "b", "c"])
    assert sorted(r["feed"] for r in first.collect()) == ["a", "c"]
    row = first.filter("feed = 'a'").head()
    assert row["Tools"] == ["powerbi", "python", "sql"] and row["Soft Skills"] == ["accuracy"] and row["days_ago"] == 0
    assert row["experience"] == "3-8" and row["education"] == ["bachelor"] and row["Job_ind"] == 2
    assert sorted(r["feed"] for r in run(2, ["d", "x", "a"]).collect()) == ["a", "c", "d"]
    assert sorted(r["feed"] for r in run(2, ["d", "x", "a"]).collect()) == ["a", "c", "d"]


def test_employers_from_names_to_contacts(spark, tmp_path):
    table, log, out = (str(tmp_path / n) for n in ("matched", "log", "out"))
    postings = spark.createDataFrame(
        [("Acme, Inc.",), ("Acme, Inc.",), ("Digital Grid",), ("Unknown Traders",), (None,)], "name string"
    )
    urls = spark.createDataFrame(
        [(f"https://d/organization/{s}",) for s in ("acme", "digital-grid", "digitalgrid", "other")] + [("https://d/x",)],
        schemas.COMPANY_URLS,
    )
    day = dt.date(2024, 8, 9)
    fresh = employer_plans.match_employers(postings, urls, table, log, day)
    assert {(r["employer_name"], r["company_name"]) for r in fresh.collect()} == {
        ("Acme, Inc.", "acme"), ("Digital Grid", "digital-grid"), ("Digital Grid", "digitalgrid"),
    }
    rate = spark.read.parquet(f"{log}/match_rate").head()
    assert (rate["matched"], rate["total"]) == (2, 3)
    pages = spark.createDataFrame(
        [("https://d/organization/acme", company_page(state(organization(), PEOPLE))),
         ("https://d/organization/digitalgrid", company_page(state(organization())))],
        "url string, html string",
    )
    for _ in range(2):
        employer_plans.collect_companies(pages, out, log, day)
    assert spark.read.parquet(f"{out}/people").count() == 2
    assert spark.read.parquet(f"{out}/company_info").count() == 1
    assert spark.read.parquet(f"{out}/errors").head()["msg"] == "No employee information"
    contact = employer_plans.employer_contacts(spark, postings, fresh, out, day)
    assert contact.filter("name = 'Acme, Inc.'").count() == 2
    assert contact.filter(F.col("name").isNull()).count() == 1
    assert contact.filter("name = 'Digital Grid' AND `People Name` IS NULL").count() == 2
    again = employer_plans.match_employers(postings, urls, table, log, dt.date(2024, 8, 10))
    assert again.count() == 0
