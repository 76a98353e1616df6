"""Keep-first and distinct operators.

``keep_first`` filters ``row_number() <= n``: Spark turns this into a group limit that runs before the shuffle too, so a
task sends at most ``n`` rows of a key, however often the key occurs. For a larger ``n`` Spark has no such limit; there, keys with
more rows than twice ``n`` get a bound in the first column of the order, from a sketch of its quantiles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHARES = 64
#: Up to this many rows of a key Spark's own group limit works before the shuffle.
GROUP_LIMIT = 1000
#: Quantiles that are asked of a sketch, its error as a share of the rows (one in so many), and most keys that get a bound.
QUANTILES, ACCURACY, MOST_BOUNDED = 1000, 10_000, 10_000


def _sort_keys(order: Sequence[str | Column]) -> list[Column]:
    """Ascending with nulls last for names; columns as they come."""
    return [F.col(f"`{o}`").asc_nulls_last() if isinstance(o, str) else o for o in order]


def _first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int) -> DataFrame:
    window = W.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*_sort_keys(order))
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")


def _within_bounds(df: DataFrame, keys: Sequence[str], first: str, n: int) -> DataFrame:
    """``df`` without rows that cannot be among the first ``n`` of their key, of keys with more than twice ``n`` rows.

    A quantile of a key's values that at least ``n`` of them reach, by the sketch's error too, bounds the first ``n``. Nulls come
    last, so only keys with enough values get a bound. There is at most a key for every 2 ``n`` rows; if that is too many to send
    to all tasks, or if the column has no quantiles, nothing is cut.
    """
    kind = df.schema[first].dataType
    if not isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return df
    named = [F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(keys)]
    marks = [f"_key{i}" for i in range(len(keys))]
    values = df.select(*named, F.col(f"`{first}`").alias("_value"))
    counted = values.groupBy(*marks).agg(F.count("_value").alias("_n"))
    found = counted.where(F.col("_n") > 2 * n).limit(MOST_BOUNDED + 1).collect()
    if not found or len(found) > MOST_BOUNDED:
        return df
    hot = F.broadcast(df.sparkSession.createDataFrame(found, counted.schema))
    same = lambda rows: [F.col(f"`{k}`").eqNullSafe(rows[m]) for k, m in zip(keys, marks, strict=True)]
    there = df.select(*[F.col(f"`{k}`") for k in dict.fromkeys([*keys, first])]).join(hot, same(hot))
    grid = [k / QUANTILES for k in range(1, QUANTILES + 1)]
    sketch = there.groupBy(*marks, "_n").agg(F.percentile_approx(F.col(f"`{first}`"), grid, ACCURACY).alias("_at"))
    reached = F.ceil((F.lit(n) / F.col("_n") + 2.0 / ACCURACY) * QUANTILES).cast("int")
    bounds = sketch.select(*marks, F.get("_at", reached - 1).alias("_bound")).where("_bound IS NOT NULL")
    bounded = df.join(F.broadcast(bounds), same(bounds), "left")
    return bounded.where(F.col("_bound").isNull() | (F.col(f"`{first}`") <= F.col("_bound"))).drop(*marks, "_bound")


def keep_first_n(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows of each key; nulls are a key of their own. ``order`` should end in a unique column.

    Every task of the scan may send ``n`` rows of a frequent key, together too many for one task. So the rows of a key
    are first dealt out by a hash of their place in the order, cut to ``n`` in each share, and only then brought together.
    Above GROUP_LIMIT the rows of frequent keys are bounded before they are sent, so little more than ``n`` of them travel.
    """
    if n > GROUP_LIMIT:
        df = _within_bounds(df, keys, order[0], n)
    if n > 1:
        share = F.pmod(F.xxhash64(*[F.col(f"`{o}`") for o in order]), F.lit(SHARES))
        df = _first_rows(df.withColumn("_share", share), [*keys, "_share"], order, n).drop("_share")
    return _first_rows(df, keys, order, n)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    return _first_rows(df, keys, order, 1)


def _period(include_year: bool) -> list[str]:
    return ["Month", "Year"] if include_year else ["Month"]


def one_per_role_and_month(postings: DataFrame, tiebreak: Sequence[str], include_year: bool = False) -> DataFrame:
    """The earliest posting of each (key, Month, Job Role)."""
    keys = ["key", *_period(include_year), "Job Role"]
    return keep_first(postings, keys, ["date_of_scrape", "Job Role", *tiebreak])


def one_per_month(postings: DataFrame, tiebreak: Sequence[str], include_year: bool = False) -> DataFrame:
    """The earliest posting of each (key, Month), whatever the role."""
    return keep_first(postings, ["key", *_period(include_year)], ["date_of_scrape", "Job Role", *tiebreak])


def merge_passes(
    passes: Sequence[DataFrame], tiebreak: Sequence[str] = (), within: Sequence[str] = ()
) -> DataFrame:
    """Listings of several passes over a search: one row per key (and the columns ``within`` which it counts once, such as
    the role searched for), from the earliest pass, by name within a pass."""
    numbered = [p.withColumn("pass", F.lit(i)) for i, p in enumerate(passes)]
    merged = numbered[0]
    for other in numbered[1:]:
        merged = merged.unionByName(other)
    return keep_first(merged, [*within, "key"], ["pass", "name", *tiebreak]).drop("pass")


def by_name(listings: DataFrame) -> DataFrame:
    """Listings in the order of a listing file: by name, nulls last, the key as second criterion."""
    return listings.orderBy(F.col("name").asc_nulls_last(), F.col("key").asc_nulls_last())


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many rows repeat an earlier key; null counts as one key."""
    key = F.struct(*[F.col(f"`{k}`") for k in keys])
    # One row per key first: a key's repeats are counted where they lie, before the shuffle.
    per_key = df.groupBy(key.alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))
