"""Counts and rates over postings and matches, each as a DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, column: str, name: str = "job_counts") -> DataFrame:
    """How often each value occurs, nulls left out; unsorted."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(name))


def most_frequent_first(counts: DataFrame, column: str, name: str = "job_counts") -> DataFrame:
    return counts.orderBy(F.col(name).desc(), F.col(column))


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def distinct_count(df: DataFrame, column: str, name: str) -> DataFrame:
    """Number of distinct values, nulls left out."""
    return df.agg(F.count_distinct(column).alias(name))


def match_rate(matched: DataFrame, matches: str = "matches") -> DataFrame:
    """Matched rows, all rows and their ratio; an empty or null match is no match."""
    hit: Column = F.coalesce(F.col(matches) != "", F.lit(False))
    return matched.agg(
        F.count_if(hit).alias("matched"),
        F.count(F.lit(1)).alias("total"),
        F.avg(hit.cast("double")).alias("match_rate"),
    )


def stamped(metrics: DataFrame, run_date: dt.date) -> DataFrame:
    return metrics.withColumn("run_date", F.lit(run_date))
