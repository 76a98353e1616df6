"""Queries on posting tables: keep-first, two passes, joins, counts, incremental runs, file exchange."""

from __future__ import annotations

import datetime as dt
import bz2
import gzip

from pyspark.sql import functions as F

from jobloom import schemas
from jobloom.functions.dates import iso_date
from jobloom.operators import contacts, dedupe, facts, incremental, metrics
from jobloom.plans import postings as plans
from jobloom.queries.registry import Derived, query, table
from jobloom.scratch import scratch_path
from jobloom.sources import files
from jobloom.streaming.ingest import ingest_new

# --- keep-first ------------------------------------------------------------------------------------------------------

SIGHTINGS = Derived(
    "events",
    {
        "event_id": "event_id",
        "key": "CAST(user_id AS STRING)",
        "Job Role": "event_type",
        "date_of_scrape": "CAST(ts AS DATE)",
        "Month": "CAST(month(ts) AS INT)",
        "Year": "CAST(year(ts) AS INT)",
    },
)
_ROLE_SQL = f"""SELECT * FROM {SIGHTINGS.sql()} s QUALIFY row_number() OVER
    (PARTITION BY key, "Month", "Job Role" ORDER BY date_of_scrape, event_id) = 1"""
_SHOWN = 'event_id, key, "Job Role" AS job_role, CAST(date_of_scrape AS STRING) AS scraped'


def _shown(rows):
    return rows.select(
        "event_id", "key", F.col("Job Role").alias("job_role"), F.col("date_of_scrape").cast("string").alias("scraped")
    )


@query(f"SELECT {_SHOWN} FROM ({_ROLE_SQL})")
def postings_dedupe_role(spark, sf_dir):
    return _shown(dedupe.one_per_role_and_month(SIGHTINGS.frame(spark, sf_dir), ["event_id"]))


@query(
    f"""SELECT {_SHOWN} FROM ({_ROLE_SQL}) QUALIFY row_number() OVER
    (PARTITION BY key, "Month" ORDER BY date_of_scrape, "Job Role", event_id) = 1"""
)
def postings_dedupe_month(spark, sf_dir):
    roles = dedupe.one_per_role_and_month(SIGHTINGS.frame(spark, sf_dir), ["event_id"])
    return _shown(dedupe.one_per_month(roles, ["event_id"]))


@query(
    f"""SELECT {_SHOWN} FROM {SIGHTINGS.sql()} s QUALIFY row_number() OVER
    (PARTITION BY key, "Month", "Year" ORDER BY date_of_scrape, "Job Role", event_id) = 1"""
)
def postings_dedupe_year(spark, sf_dir):
    return _shown(dedupe.one_per_month(SIGHTINGS.frame(spark, sf_dir), ["event_id"], include_year=True))


LISTED = Derived(
    "orders",
    {
        "o_orderkey": "o_orderkey",
        "key": "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END",
        "name": "o_orderpriority",
        "title": "o_orderstatus",
    },
)


@query(
    f"""SELECT o_orderkey, key, name, title FROM (
    SELECT 0 AS pass, * FROM {LISTED.sql()} a WHERE o_orderkey % 2 = 0
    UNION ALL SELECT 1 AS pass, * FROM {LISTED.sql()} b WHERE o_orderkey % 2 = 1 OR o_orderkey % 3 = 0)
    QUALIFY row_number() OVER (PARTITION BY key ORDER BY pass, name, o_orderkey) = 1"""
)
def two_pass_listings(spark, sf_dir):
    listed = LISTED.frame(spark, sf_dir)
    parity = F.col("o_orderkey") % 2
    first, second = listed.filter(parity == 0), listed.filter((parity == 1) | (F.col("o_orderkey") % 3 == 0))
    merged = dedupe.by_name(dedupe.merge_passes([first, second], ["o_orderkey"]))
    return merged.select("o_orderkey", "key", "name", "title")


@query(f"SELECT CAST(count(*) - count(DISTINCT coalesce(key, 'none')) AS BIGINT) AS duplicates FROM {LISTED.sql()} l")
def duplicate_keys(spark, sf_dir):
    return dedupe.duplicate_count(LISTED.frame(spark, sf_dir), ["key"])


@query(
    """SELECT event_type, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events
    QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) <= 1000"""
)
def capped_listing(spark, sf_dir):
    """At most a thousand results per search, the earliest first."""
    capped = dedupe.keep_first_n(table(spark, sf_dir, "events"), ["event_type"], ["ts", "event_id"], 1000)
    return capped.select("event_type", "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"))


@query(
    """SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders"""
)
def distinct_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    return metrics.distinct_values(rows, ["o_custkey", "o_orderstatus", "o_orderpriority"])


# --- joins -----------------------------------------------------------------------------------------------------------


@query(
    """SELECT CAST(d.doc_id AS STRING) AS key, d.lang AS name, d.source AS title, CAST(l.quality AS BIGINT) AS days_ago,
    CAST(l.toxic AS BIGINT) AS rating FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
)
def details_left_join(spark, sf_dir):
    key = F.col("doc_id").cast("string").alias("key")
    listings = table(spark, sf_dir, "documents").select(key, F.col("lang").alias("name"), F.col("source").alias("title"))
    details = table(spark, sf_dir, "labels").select(
        key, F.lit("x").alias("companyName"), F.col("quality").cast("bigint").alias("days_ago"),
        F.col("toxic").cast("bigint").alias("rating"),
    )
    return contacts.with_details(listings, details)


PLACED = Derived(
    "customer",
    {
        "name": "c_mktsegment",
        "employer_name": "c_mktsegment",
        "company_name": "CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE CAST(c_custkey AS STRING) END",
        "seller": "c_nationkey",
    },
)
SELLERS = Derived(
    "supplier",
    {
        "Company Name": "s_name",
        "Name from URL": "CASE WHEN s_suppkey % 10 = 1 THEN NULL ELSE CAST(s_suppkey AS STRING) END",
        "People Name": "s_name",
        "Linkedin Profile": "CAST(s_nationkey AS STRING)",
        "Job Title": "CAST(s_suppkey % 7 AS STRING)",
    },
)


@query(
    f"""SELECT n.name, "Company Name" AS company, "Name from URL" AS slug, "People Name" AS person,
    "Linkedin Profile" AS profile, "Job Title" AS job_title
    FROM (SELECT DISTINCT name FROM {PLACED.sql()} a) n
    LEFT JOIN {PLACED.sql()} c ON n.name = c.employer_name LEFT JOIN {SELLERS.sql()} s ON company_name = "Name from URL" """
)
def contact_join(spark, sf_dir):
    placed = PLACED.frame(spark, sf_dir)
    rows = contacts.contacts(placed, placed, SELLERS.frame(spark, sf_dir))
    return rows.toDF("name", "company", "slug", "person", "profile", "job_title")


# --- counts ----------------------------------------------------------------------------------------------------------

EMPLOYED = Derived(
    "orders", {"o_orderkey": "o_orderkey", "name": "CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE o_custkey END"}
)


@query(f"SELECT name, count(*) AS job_counts FROM {EMPLOYED.sql()} e WHERE name IS NOT NULL GROUP BY name")
def job_counts(spark, sf_dir):
    counts = metrics.value_counts(EMPLOYED.frame(spark, sf_dir), "name")
    return metrics.most_frequent_first(counts, "name")


@query(f"SELECT count(DISTINCT name) AS companies, count(*) AS postings FROM {EMPLOYED.sql()} e")
def distinct_companies(spark, sf_dir):
    rows = EMPLOYED.frame(spark, sf_dir)
    return rows.agg(F.count_distinct("name").alias("companies"), F.count(F.lit(1)).alias("postings"))


MATCHED = Derived(
    "orders",
    {"matches": "CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN o_orderstatus END", "o_orderkey": "o_orderkey"},
)


@query(
    f"""SELECT count(*) FILTER (WHERE matches <> '') AS matched, count(*) AS total,
    avg(CASE WHEN matches <> '' THEN 1.0 ELSE 0.0 END) AS match_rate FROM {MATCHED.sql()} m"""
)
def match_rate(spark, sf_dir):
    return metrics.match_rate(MATCHED.frame(spark, sf_dir))


@query(
    f"""SELECT '2024-08-09' AS run_date, count(*) AS total FROM {MATCHED.sql()} m
    UNION ALL SELECT '2024-08-10' AS run_date, count(*) AS total FROM {MATCHED.sql()} m WHERE matches <> ''"""
)
def run_log(spark, sf_dir):
    """Two runs append their metrics to one log."""
    path = scratch_path(spark, "run-log")
    rows = MATCHED.frame(spark, sf_dir)
    for day, found in ((9, rows), (10, rows.filter(F.col("matches") != ""))):
        counted = found.agg(F.count(F.lit(1)).alias("total"))
        files.append_metrics(metrics.stamped(counted, dt.date(2024, 8, day)), path)
    return spark.read.parquet(path).select(F.col("run_date").cast("string").alias("run_date"), "total")


# --- what is new -----------------------------------------------------------------------------------------------------

FEEDS = Derived(
    "pages",
    {
        "page_id": "page_id",
        "feed": "CASE WHEN page_id % 40 = 0 THEN NULL ELSE url END",
        "run": "CAST(page_id % 3 AS BIGINT)",
        "size": "CAST(length(html) AS BIGINT)",
    },
)
_SEEN = f"(SELECT feed FROM {FEEDS.sql()} x WHERE run = 0 AND page_id % 2 = 0)"
_NEW = f"NOT EXISTS (SELECT 1 FROM {_SEEN} k WHERE k.feed IS NOT DISTINCT FROM f.feed)"


def _feeds(spark, sf_dir):
    """The feeds and those of them that an earlier run has seen."""
    feeds = FEEDS.frame(spark, sf_dir)
    return feeds, feeds.filter((F.col("run") == 0) & (F.col("page_id") % 2 == 0)).select("feed")


@query(f"SELECT page_id, feed FROM {FEEDS.sql()} f WHERE {_NEW}")
def new_urls_only(spark, sf_dir):
    feeds, seen = _feeds(spark, sf_dir)
    return incremental.new_rows(feeds, seen, "feed").select("page_id", "feed")


@query(
    f"""SELECT CAST(sum(CASE WHEN {_NEW} THEN 0 ELSE 1 END) AS BIGINT) AS old_count,
    CAST(sum(CASE WHEN {_NEW} THEN 1 ELSE 0 END) AS BIGINT) AS new_count FROM {FEEDS.sql()} f"""
)
def seen_new_counts(spark, sf_dir):
    feeds, seen = _feeds(spark, sf_dir)
    return incremental.seen_new_counts(feeds, seen, "feed")


@query(
    f"""SELECT NULL::BIGINT AS page_id, feed, NULL::BIGINT AS size FROM {_SEEN}
    UNION ALL SELECT page_id, feed, size FROM {FEEDS.sql()} f WHERE {_NEW}"""
)
def incremental_append(spark, sf_dir):
    feeds, seen = _feeds(spark, sf_dir)
    return incremental.append_new(seen, feeds.select("page_id", "feed", "size"), "feed").select("page_id", "feed", "size")


@query(
    """SELECT DISTINCT o_custkey, o_orderstatus, NULL::STRING AS priority FROM orders WHERE o_orderkey % 2 = 0
    UNION SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority AS priority FROM orders
    WHERE o_orderkey % 2 = 1 OR o_orderkey % 3 = 0"""
)
def upsert_distinct(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    parity = F.col("o_orderkey") % 2
    before = orders.filter(parity == 0).select("o_custkey", "o_orderstatus")
    rows = orders.filter((parity == 1) | (F.col("o_orderkey") % 3 == 0)).select(
        "o_custkey", "o_orderstatus", F.col("o_orderpriority").alias("priority")
    )
    return incremental.upsert_distinct(before, rows)


@query(f"SELECT page_id, feed, '2024-07-0' || (run + 1) AS run_date FROM {FEEDS.sql()} f WHERE run <= 1")
def snapshot_as_of(spark, sf_dir):
    """Three runs over growing input, the first repeated; the state after the second."""
    feeds = FEEDS.frame(spark, sf_dir).select("page_id", "feed", "run")
    path = scratch_path(spark, "snapshots")
    for run in (0, 1, 0, 2):
        incremental.add_run(
            feeds.filter(F.col("run") <= run).drop("run"), path, "page_id", dt.date(2024, 7, 1 + run)
        )
    schema = "page_id bigint, feed string"
    state = incremental.table_as_of(spark, path, schema, dt.date(2024, 7, 2))
    return state.select("page_id", "feed", F.col("run_date").cast("string").alias("run_date"))


@query(
    f"""SELECT page_id, feed, 'new_jobs_2024-7-2' AS export FROM {FEEDS.sql()} f WHERE run = 1
    UNION ALL SELECT page_id, feed, 'all_jobs_2024-7-2' AS export FROM {FEEDS.sql()} f WHERE run <= 1"""
)
def dated_exports(spark, sf_dir):
    """Three runs; the exports of the second: what it added, and all that was there then."""
    feeds = FEEDS.frame(spark, sf_dir).select("page_id", "feed", "run")
    path, out = scratch_path(spark, "dated"), scratch_path(spark, "exports")
    for run in (0, 1, 2):
        incremental.add_run(feeds.filter(F.col("run") <= run).drop("run"), path, "page_id", dt.date(2024, 7, 1 + run))
    exports = plans.export_dated(spark, path, out, dt.date(2024, 7, 2), "page_id bigint, feed string")
    back = files.read_csv(spark, list(exports.values()), "page_id bigint, feed string", with_file=True)
    return back.select("page_id", "feed", F.element_at(F.split("_file", "/"), -2).alias("export"))


@query(f"SELECT page_id, feed, '2024-07-0' || (CASE WHEN run = 2 THEN 1 ELSE run + 1 END) AS run_date FROM {FEEDS.sql()} f")
def backfill_run(spark, sf_dir):
    """Two runs, then the first again with more rows: each key is written once."""
    feeds = FEEDS.frame(spark, sf_dir).select("page_id", "feed", "run")
    path = scratch_path(spark, "backfill")
    for day, held in ((1, feeds.filter("run = 0")), (2, feeds.filter("run <= 1")), (1, feeds)):
        incremental.add_run(held.drop("run"), path, "page_id", dt.date(2024, 7, day))
    state = incremental.table_as_of(spark, path, "page_id bigint, feed string", dt.date(2024, 7, 2))
    return state.select("page_id", "feed", F.col("run_date").cast("string").alias("run_date"))


@query("SELECT user_id, count(*) AS n FROM (SELECT DISTINCT user_id FROM events) GROUP BY user_id")
def stream_restart(spark, sf_dir):
    """Two arrivals, then a new checkpoint over the filled table reads both again: each key is there once."""
    landing, out = (scratch_path(spark, n) for n in ("landing", "restarted"))
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    first = scratch_path(spark, "checkpoint")
    for arrival, checkpoint in ((events.filter("event_id % 2 = 0"), first), (events, first), (events.limit(0), None)):
        arrival.write.mode("append").parquet(landing)
        checkpoint = checkpoint or scratch_path(spark, "checkpoint")
        ingest_new(spark, landing, events.schema, out, checkpoint, "user_id", ["event_id"]).awaitTermination()
    return spark.read.parquet(out).groupBy("user_id").agg(F.count("*").alias("n"))


@query("SELECT user_id, min(event_id) AS event_id FROM events GROUP BY user_id")
def incremental_stream(spark, sf_dir):
    """The events replayed as two arrivals, the second holding the first again; the first event per user is kept."""
    landing, out, checkpoint = (scratch_path(spark, n) for n in ("landing", "ingested", "checkpoint"))
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    early = events.filter(F.col("event_id") % 2 == 0)
    first = early.groupBy("user_id").agg(F.min("event_id").alias("event_id"))
    # The first arrival holds, of each user, what precedes the user's first even event and that event.
    known = events.join(first.withColumnRenamed("event_id", "upto"), "user_id").filter(F.col("event_id") <= F.col("upto"))
    for arrival in (known.drop("upto"), events):
        arrival.write.mode("append").parquet(landing)
        ingest_new(
            spark, landing, events.schema, out, checkpoint, "user_id", ["event_id"]
        ).awaitTermination()
    return spark.read.parquet(out).select("user_id", "event_id")


# --- files -----------------------------------------------------------------------------------------------------------


@query(
    """SELECT doc_id, lang, source, text, lang || '|it''s "' || source || '"' AS tags FROM documents"""
)
def csv_roundtrip_lists(spark, sf_dir):
    """Documents with a list column, written as CSV and read back."""
    path = scratch_path(spark, "csv")
    quoted = F.concat(F.lit("it's \""), F.col("source"), F.lit('"'))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", "text", F.array(F.col("lang"), quoted).alias("tags")
    )
    files.write_csv(rows, path)
    back = files.read_csv(spark, path, rows.schema)
    return back.select("doc_id", "lang", "source", "text", F.array_join("tags", "|").alias("tags"))


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'DATA SCIENTIST' ELSE 'DATA ENGINEER' END AS job_role,
    CASE WHEN o_orderkey % 2 = 0 THEN '2024-07-22' ELSE '2024-07-26' END AS scraped FROM orders"""
)
def filename_columns(spark, sf_dir):
    """Two sets of files whose names differ in style; the role and date come back from the name."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    styles = ("jobs_detail_data_scientist_2024-07-22.csv", "jobs-detail_data-engineer_2024-07-26.csv")
    folder = scratch_path(spark, "named")
    for parity, name in enumerate(styles):
        files.write_csv(orders.filter(F.col("o_orderkey") % 2 == parity), f"{folder}/{name}")
    parts = files.read_csv(spark, f"{folder}/*.csv", "o_orderkey bigint", with_file=True)
    # The writer makes a folder of parts per name, so the name is the last but one step of the path.
    name = F.element_at(F.split("_file", "/"), -2)
    return files.with_file_columns(parts, name).select(
        "o_orderkey", F.col("Job Role").alias("job_role"), F.col("date_of_scrape").cast("string").alias("scraped")
    )


@query("SELECT c_custkey, c_name FROM customer")
def empty_fallback(spark, sf_dir):
    """A first run: the cumulative table is not there yet, so every row is new."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    before = files.table_or_empty(spark, scratch_path(spark, "missing"), rows.schema)
    return incremental.append_new(before, rows, "c_custkey")


@query(
    """SELECT c_custkey, c_acctbal, 0::BIGINT AS is_error FROM customer WHERE c_custkey % 9 <> 0
    UNION ALL SELECT NULL, NULL, count(*) AS is_error FROM customer WHERE c_custkey % 9 = 0"""
)
def csv_bad_rows(spark, sf_dir):
    """Rows that do not fit the schema go to the error table, the others are read."""
    path = scratch_path(spark, "bad-rows")
    balance = F.when(F.col("c_custkey") % 9 == 0, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string"))
    files.write_csv(table(spark, sf_dir, "customer").select("c_custkey", balance.alias("c_acctbal")), path)
    good, bad = files.read_csv_checked(spark, path, "c_custkey bigint, c_acctbal double")
    errors = bad.agg(F.count(F.lit(1)).alias("is_error"))
    return good.select("c_custkey", "c_acctbal", F.lit(0).cast("bigint").alias("is_error")).unionByName(
        errors, allowMissingColumns=True
    )


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 2 THEN NULL ELSE c_name END AS c_name,
    CASE WHEN c_custkey % 3 = 1 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer"""
)
def csv_by_name(spark, sf_dir):
    """Three sets of files with swapped, missing and further columns come back under one schema."""
    path = scratch_path(spark, "unlike")
    rows, third = table(spark, sf_dir, "customer"), F.col("c_custkey") % 3
    files.write_csv(rows.filter(third == 0).select("c_acctbal", "c_name", "c_custkey"), f"{path}/swapped")
    files.write_csv(rows.filter(third == 1).select("c_name", "c_nationkey", "c_custkey"), f"{path}/without")
    files.write_csv(rows.filter(third == 2).select("c_custkey", "c_mktsegment", "c_acctbal"), f"{path}/other")
    return files.read_csv(spark, f"{path}/*", "c_custkey bigint, c_name string, c_acctbal double")


@query("SELECT c_name, count(*) AS n FROM customer GROUP BY c_name")
def csv_pruned(spark, sf_dir):
    """One column by its name, from files that hold it last."""
    path = scratch_path(spark, "pruned")
    files.write_csv(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_name"), path)
    return files.read_csv(spark, path, "c_name string").groupBy("c_name").agg(F.count("*").alias("n"))


@query(
    """SELECT count(*) AS n, 'row' AS what FROM customer UNION ALL SELECT 2, 'file cannot be read'
    UNION ALL SELECT 1, 'file is empty' UNION ALL SELECT 1, 'file does not fit the schema'"""
)
def csv_bad_files(spark, sf_dir):
    """Two damaged, a blank and an unlike file beside good ones: all good rows, and a report for each of the four."""
    path = scratch_path(spark, "bad-files")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    files.write_csv(rows, f"{path}/good")
    files.write_csv(rows.limit(1).select(F.lit("1").alias("elsewhere")), f"{path}/unlike")
    # The writer of text can make neither a damaged nor a blank file by itself: bytes go through the session's file system.
    context = spark.sparkContext
    plain = b"c_custkey,c_name\n" + b"1,x\n" * 5000
    cut = {f"damaged/part.csv.{end}": pack(plain) for end, pack in (("gz", gzip.compress), ("bz2", bz2.compress))}
    for name, content in [(name, packed[: len(packed) // 2]) for name, packed in cut.items()] + [("blank/part.csv", b"\n \n")]:
        target = context._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        stream = target.getFileSystem(context._jsc.hadoopConfiguration()).create(target)
        stream.write(bytearray(content))
        stream.close()
    good, bad = files.read_csv_checked(spark, f"{path}/*", rows.schema)
    found = good.agg(F.count("*").alias("n")).withColumn("what", F.lit("row"))
    return found.unionByName(bad.groupBy(F.col("msg").alias("what")).agg(F.count("*").alias("n")))


@query(
    """SELECT doc_id, source || ', "' || lang || '"' AS label, text || chr(10) || '"' || chr(13) || chr(10) || source AS body FROM documents"""
)
def csv_quoted_breaks(spark, sf_dir):
    """Files whose header and fields hold line breaks, quotes and delimiters; many tasks read a large one.

    Each task of the scan writes a file of its own, so no task reads more of the table than its part.
    """
    path = scratch_path(spark, "quoted-breaks")
    label = F.concat("source", F.lit(', "'), "lang", F.lit('"'))
    body = F.concat("text", F.lit('\n"\r\n'), "source")
    rows = table(spark, sf_dir, "documents").select(label.alias('the "short"\nlabel'), body.alias("body\n, all of it"), "doc_id")
    files.write_csv(rows, path)
    back = files.read_csv(spark, path, rows.schema)
    return back.toDF("label", "body", "doc_id")


@query("SELECT c_name AS company_url FROM customer")
def headerless_csv(spark, sf_dir):
    path = scratch_path(spark, "headerless")
    files.write_csv(table(spark, sf_dir, "customer").select("c_name"), path, header=False)
    return files.read_csv(spark, path, schemas.COMPANY_URLS, header=False).select(
        F.col("Company_name_url").alias("company_url")
    )


@query(
    """SELECT o_orderkey, CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '5-LOW' THEN 5 END AS BIGINT) AS role_index
    FROM orders"""
)
def role_index(spark, sf_dir):
    index = facts.lookup(F.col("o_orderpriority"), {"1-URGENT": 1, "5-LOW": 5})
    return table(spark, sf_dir, "orders").select("o_orderkey", index.cast("bigint").alias("role_index"))


@query(
    """SELECT o_orderkey, CAST(strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d') AS DATE)::STRING AS day FROM orders
    ORDER BY o_orderdate"""
)
def iso_dates(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("s"))
    parsed = rows.select("o_orderkey", iso_date(F.col("s")).alias("d"))
    return parsed.orderBy(F.col("d").asc_nulls_last(), "o_orderkey").select("o_orderkey", F.col("d").cast("string").alias("day"))
