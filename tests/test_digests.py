"""Cumulative tables by way of their digests."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from jobloom.operators import incremental
from jobloom.operators.digests import DIGEST, DigestIndex, digest_of

DAYS = [dt.date(2024, 7, d) for d in range(1, 6)]
SCHEMA = "k string, v int, `a b` array<string>"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def batches(seed):
    r = random.Random(seed)
    row = lambda: (r.choice(["a", "b", "c", None, "hot", "hot", "hot"]), r.choice([1, 2, None]), r.choice([["x"], [], None, ["x", None]]))
    return [[row() for _ in range(12)] for _ in DAYS]


@pytest.mark.parametrize("seed", [1, 2])
def test_upserted_rows_equal_loops_over_the_runs(spark, tmp_path, seed):
    path, seen = str(tmp_path / "t"), []
    for day, batch in zip(DAYS, batches(seed), strict=True):
        for _ in range(2 if day == DAYS[2] else 1):  # a repeated run
            incremental.upsert_run(spark.createDataFrame(batch, SCHEMA), path, day)
        fresh = [r for k, r in enumerate(batch) if r not in batch[:k] and r not in seen]
        seen += fresh
        found = incremental.only_run(spark, path, SCHEMA, day).drop("run_date")
        assert rows_of(found) == sorted(map(tuple, fresh), key=repr)


def test_runs_of_other_writers_and_other_sessions_are_digested(spark, tmp_path):
    path = str(tmp_path / "t")
    first, second = spark.createDataFrame([("a", 1, None)], SCHEMA), spark.createDataFrame([("a", 2, None), ("b", 1, None), (None, 1, None)], SCHEMA)
    incremental.write_run(first, path, DAYS[0])  # without digests
    incremental.add_run(second, path, "k", DAYS[1])
    assert rows_of(incremental.only_run(spark, path, SCHEMA, DAYS[1]).select("k")) == sorted([("b",), (None,)], key=repr)
    spark.sql(f"DROP TABLE {DigestIndex(spark, path, ['k']).name}")  # as a new session has no such name
    incremental.add_run(second, path, "k", DAYS[2])
    assert incremental.only_run(spark, path, SCHEMA, DAYS[2]).count() == 0
    assert DigestIndex(spark, path, ["k"]).runs() == {d.isoformat() for d in DAYS[:3]}


def test_a_run_that_shrinks_frees_its_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1, None), ("b", 1, None)], SCHEMA)
    incremental.add_run(rows, path, "k", DAYS[0])
    incremental.add_run(rows.where("k = 'a'"), path, "k", DAYS[0])
    incremental.add_run(rows, path, "k", DAYS[1])
    assert rows_of(incremental.only_run(spark, path, SCHEMA, DAYS[1]).select("k")) == [("b",)]


def test_the_history_is_not_exchanged(spark, tmp_path):
    path = str(tmp_path / "t")
    incremental.add_run(spark.range(100).selectExpr("cast(id AS string) AS k", "1 AS v", "null AS `a b`").selectExpr("k", "v"), path, "k", DAYS[0])
    index = DigestIndex(spark, path, ["k"])
    fresh = spark.range(50, 150).selectExpr("cast(id AS string) AS k").select(digest_of(["k"]).alias(DIGEST))
    found = index.known(fresh, DAYS[1])
    assert found.count() == 50
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    lines = plan.splitlines()
    scan = next(k for k, line in enumerate(lines) if "FileScan" in line and index.name in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    above, level = [], depth(lines[scan])
    for line in reversed(lines[:scan]):  # the nodes between the scan of the history and the top
        if depth(line) < level:
            above.append(line)
            level = depth(line)
        if "Join" in line:
            break
    assert above and "Join" in above[-1] and not any("Exchange" in line for line in above)
    assert "Bucketed: true" in lines[scan]


def test_digests_tell_nulls_from_empty_and_columns_apart(spark):
    rows = spark.createDataFrame([("", None), (None, ""), (None, None), ("", ""), ('"', "x"), ("", '"x')], "a string, b string")
    assert rows.select(digest_of(["a", "b"]).alias("d")).distinct().count() == 6
    assert rows.select(F.length(digest_of(["a", "b"]))).distinct().collect() == [(16,)]
