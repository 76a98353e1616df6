"""Fingerprints of documents by one-permutation MinHash, in DataFrame functions alone.

Every five-word shingle is hashed once; the upper bits name its bin, and a bin keeps its least hash. An empty bin takes over
from an occupied one that a hash of both bins chooses, the same for every document, so all bins are usable (optimal
densification). Of each bin the four lowest bits are stored, packed into words of 64 bits. Bins that agree by accident, one in
sixteen, are allowed for in the likeness of two fingerprints.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobloom.llm.quality import words_of
from jobloom.once import computed_once

SHINGLE = 5
BIN_BITS, LOW_BITS = 7, 4
BINS = 1 << BIN_BITS
PER_WORD = 64 // LOW_BITS
#: What two fingerprints agree in by accident.
ACCIDENT = 1 / (1 << LOW_BITS)
_ONES = sum(1 << (LOW_BITS * k) for k in range(PER_WORD))


def _bin(h: Column) -> Column:
    return F.shiftright(h, 64 - BIN_BITS) + BINS // 2  # ascending with the hash


def fingerprinted(rows: DataFrame, text: str, name: str) -> DataFrame:
    """``rows`` with the array ``name`` of packed low bits of the text (null counts as empty).

    A text of fewer than five words is one shingle of all its words; texts without a word have one fingerprint in common.
    """
    keep = rows.columns
    rows = computed_once(rows, {"_words": words_of(F.coalesce(F.col(text), F.lit("")))})
    n = F.size("_words")
    long_ = F.transform(
        F.slice("_words", F.lit(1), F.greatest(n - SHINGLE + 1, F.lit(0))),
        lambda w, i: F.xxhash64(w, *[F.get("_words", i + k) for k in range(1, SHINGLE)]),
    )
    hashes = F.when(n >= SHINGLE, long_).otherwise(F.array(F.xxhash64(F.array_join("_words", " "))))
    rows = computed_once(rows, {"_h": F.sort_array(hashes)}, keep=keep)
    first = F.filter("_h", lambda h, i: (i == 0) | (_bin(h) != _bin(F.get("_h", i - 1))))
    rows = computed_once(rows, {"_f": first}, keep=keep)
    rows = computed_once(rows, {
        "_b": F.transform("_f", lambda h: _bin(h).cast("int")), "_low": F.transform("_f", lambda h: h.bitwiseAND(2**LOW_BITS - 1)),
    }, keep=keep)

    def chosen(j: Column) -> Column:
        """Place of the occupied bin that an empty bin takes over from."""
        order = F.transform("_b", lambda p, k: F.xxhash64(j, p).bitwiseAND(-BINS).bitwiseOR(k.cast("long")))
        return F.array_min(order).bitwiseAND(BINS - 1).cast("int")

    def full(j: Column) -> Column:
        at = F.array_position("_b", j)
        return F.when(at > 0, F.get("_low", (at - 1).cast("int"))).otherwise(F.get("_low", chosen(j)))

    bins = F.array(*[F.lit(j) for j in range(BINS)])
    values = F.when(F.size("_b") == BINS, F.col("_low")).otherwise(F.transform(bins, full))
    rows = computed_once(rows, {"_v": values}, keep=keep)
    word = lambda k: F.aggregate(
        F.slice("_v", k * PER_WORD + 1, PER_WORD), F.lit(0).cast("long"),
        lambda a, v: F.shiftleft(a, LOW_BITS).bitwiseOR(v),
    )
    return computed_once(rows, {name: F.array(*[word(k) for k in range(BINS // PER_WORD)])}, keep=keep)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two packed fingerprints, 0 to 1; null if either is."""
    def different(x: Column) -> Column:
        any_bit = x
        for k in range(1, LOW_BITS):
            any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(x, k))
        return F.bit_count(any_bit.bitwiseAND(_ONES)).cast("int")

    unlike = F.zip_with(a, b, lambda x, y: different(x.bitwiseXOR(y)))
    share = 1 - F.aggregate(unlike, F.lit(0), lambda s, x: s + x) / BINS
    return F.greatest((share - ACCIDENT) / (1 - ACCIDENT), F.lit(0.0))


def written(packed: Column) -> Column:
    """A packed fingerprint as hexadecimal text."""
    return F.array_join(F.transform(packed, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def _share(key: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds are less than the key, by binary search; -1 for a null key."""
    if not bounds:
        return F.when(key.isNull(), -1).otherwise(0)
    table = F.array(*[F.lit(b).cast("long") for b in bounds])
    steps = [1 << k for k in reversed(range(math.ceil(math.log2(len(bounds) + 1)) + 1))]
    seek = lambda at, s: F.when((at + s <= len(bounds)) & (F.get(table, at + s - 1) < key), at + s).otherwise(at)
    return F.when(key.isNull(), -1).otherwise(F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), seek))


def with_next(
    rows: DataFrame, key: str, carry: list[str], tie: str, prepare: Callable[[DataFrame], DataFrame] = lambda r: r
) -> DataFrame:
    """``rows`` with ``next_<c>`` of each column in ``carry``: its value in the row of the next lower key, circularly.

    ``prepare`` may add costly columns; it works once on each row, while ranges are found from the keys alone.

    Keys are dealt out in ranges, as many as there are shuffle partitions; a range is sorted by itself. The first row of
    each range, one a range, is also handed to the range above it. Null keys come last; equal keys are ordered by ``tie``.
    """
    spark = rows.sparkSession
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = [k / shares for k in range(1, shares)]
    found = rows.agg(F.percentile_approx(key, cuts, 10_000).alias("b")).first()["b"] if cuts else None
    rows = rows.withColumn("_share", _share(F.col(key), sorted(set(found or ()))))
    # First key of each range, then the rows that have it: as many as ranges, and what shares their keys.
    heads = rows.groupBy("_share").agg(F.max(key).alias("_top"))
    one = Window.partitionBy(F.lit(0))  # over one row for each range
    above = F.coalesce(F.lag("_share").over(one.orderBy(F.col("_share").desc())), F.min("_share").over(one))
    heads = heads.select(F.col("_share").alias("_of"), "_top", above.alias("_above"))
    first = rows.join(F.broadcast(heads), (F.col("_share") == F.col("_of")) & F.col(key).eqNullSafe(F.col("_top")))
    best = Window.partitionBy("_share").orderBy(tie)
    first = first.withColumn("_r", F.row_number().over(best)).where("_r = 1")
    first = first.select(*[F.col(c) for c in rows.columns if c != "_share"], F.col("_above").alias("_share"), F.lit(1).alias("_extra"))
    every = prepare(rows.withColumn("_extra", F.lit(0)).unionByName(first))
    order = Window.partitionBy("_share").orderBy("_extra", F.col(key).desc_nulls_last(), tie)
    every = every.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in carry])
    return every.where("_extra = 0").drop("_share", "_extra")


def compare_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last third is the beginning of the next document.

    A null text is empty. Documents follow each other by descending key, the first after the last; null keys come last, rows
    of one key are ordered by text. Repeated rows come back each; an empty table gives an empty result.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = with_next(rows, "key", ["text", "print"], "text", lambda r: fingerprinted(r, "text", "print"))
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut))
    rows = computed_once(rows, {"n_chars": n.cast("long"), "edited": edited}, keep=["key", "print", "next_print"])
    rows = rows.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    rows = fingerprinted(rows, "edited", "edited_print").drop("edited")
    return rows.select(
        F.col("key").alias(key), "n_chars", "edited_sha256", written(F.col("print")).alias("fingerprint"),
        written(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )


def fingerprint_documents(documents: DataFrame) -> DataFrame:
    """Result of the query: the fingerprints of every document and of its edited text."""
    return compare_edits(documents.select("doc_id", "text"))
