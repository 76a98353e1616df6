"""Operators that add to cumulative tables: new-only, append, upsert, snapshots.

A cumulative table is a folder with a partition per run. A run writes its own partition only and never touches the
others, so a repeated run replaces what it wrote before and nothing that is being read is overwritten. What any other run
has written, earlier or later, counts as seen, so an early run repeated with more rows adds no key a second time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom.operators.digests import RUN, DigestIndex
from jobloom.sources.files import table_or_empty


def new_rows(rows: DataFrame, seen: DataFrame, key: str, seen_key: str | None = None) -> DataFrame:
    """Rows whose key is not in ``seen``; null counts as a key. All rows if ``seen`` lacks the column."""
    seen_key = seen_key or key
    if seen_key not in seen.columns or key not in rows.columns:
        return rows
    known = seen.select(F.col(f"`{seen_key}`").alias("_seen")).distinct()
    return rows.join(known, F.col(f"`{key}`").eqNullSafe(F.col("_seen")), "left_anti")


def seen_new_counts(rows: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """How many rows have a key in ``seen`` and how many do not; null counts as a key.

    Rows are counted per key before they meet the seen keys, so a frequent key travels as one row.
    """
    known = seen.select(F.col(f"`{key}`").alias("_seen"), F.lit(True).alias("_old")).distinct()
    per_key = rows.groupBy(F.col(f"`{key}`").alias("_key")).agg(F.count(F.lit(1)).alias("n"))
    counted = per_key.join(known, F.col("_key").eqNullSafe(F.col("_seen")), "left")
    old = F.coalesce(F.col("_old"), F.lit(False))
    return counted.agg(
        F.coalesce(F.sum(F.when(old, F.col("n"))), F.lit(0)).alias("old_count"),
        F.coalesce(F.sum(F.when(~old, F.col("n"))), F.lit(0)).alias("new_count"),
    )


def append_new(previous: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The previous table and the rows with a new key; columns missing on one side are null there."""
    return previous.unionByName(new_rows(rows, previous, key), allowMissingColumns=True)


def upsert_distinct(previous: DataFrame, rows: DataFrame) -> DataFrame:
    """Both tables together without repeated rows."""
    return previous.unionByName(rows, allowMissingColumns=True).distinct()


def _with_run(schema: str | T.StructType) -> T.StructType:
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return T.StructType([f for f in fields.fields if f.name != RUN]).add(RUN, T.DateType())


def table_as_of(spark: SparkSession, path: str, schema: str | T.StructType, run_date: dt.date) -> DataFrame:
    """What the table held after the run of that date. Later partitions are not read."""
    return table_or_empty(spark, path, _with_run(schema)).filter(F.col(RUN) <= F.lit(run_date))


def table_before(spark: SparkSession, path: str, schema: str | T.StructType, run_date: dt.date) -> DataFrame:
    return table_or_empty(spark, path, _with_run(schema)).filter(F.col(RUN) < F.lit(run_date))


def table_without(spark: SparkSession, path: str, schema: str | T.StructType, run_date: dt.date) -> DataFrame:
    """What the other runs have written."""
    return table_or_empty(spark, path, _with_run(schema)).filter(F.col(RUN) != F.lit(run_date))


def only_run(spark: SparkSession, path: str, schema: str | T.StructType, run_date: dt.date) -> DataFrame:
    return table_or_empty(spark, path, _with_run(schema)).filter(F.col(RUN) == F.lit(run_date))


def write_run(rows: DataFrame, path: str, run_date: dt.date) -> None:
    """Write the rows as the partition of that run, in place of an earlier attempt of the same run, even if empty."""
    rows.write.mode("overwrite").parquet(f"{path}/{RUN}={run_date.isoformat()}")


def _write_indexed(rows: DataFrame, index: DigestIndex, path: str, run_date: dt.date) -> None:
    index.forget(run_date)
    write_run(rows, path, run_date)
    index.add(rows.sparkSession.read.schema(rows.schema).parquet(f"{path}/{RUN}={run_date.isoformat()}"), run_date)


def add_run(rows: DataFrame, path: str, key: str, run_date: dt.date) -> None:
    """Write the rows whose key no other run has; rows of one run that share a new key are all written. Null is a key."""
    index = DigestIndex(rows.sparkSession, path, [key])
    rows = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c != RUN])
    _write_indexed(index.unknown_rows(rows, run_date), index, path, run_date)


def upsert_run(rows: DataFrame, path: str, run_date: dt.date, columns: Sequence[str] | None = None) -> None:
    """Write the distinct rows that no other run has written."""
    columns = list(columns or [c for c in rows.columns if c != RUN])
    index = DigestIndex(rows.sparkSession, path, columns)
    fresh = rows.select(*[F.col(f"`{c}`") for c in columns]).distinct()
    _write_indexed(index.unknown_rows(fresh, run_date), index, path, run_date)
