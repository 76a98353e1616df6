"""Best fuzzy match between two name columns without a cross join.

With ``n`` insertions and deletions between strings of lengths ``a`` and ``b`` the score is ``1 - n / (a + b)``; a score of at
least ``t`` means that they have at least ``t (a + b) / 2`` characters in common.

* Names equal after cleaning score 100 and are matched by an equi-join; only the rest goes on.
* Characters are numbered by their occurrence (``abca`` has a1, b1, c1, a2) and ordered by how rare they are in the directory. If
  two strings have ``c`` numbered characters in common, their ``m`` rarest common ones are among the ``a - c + m`` rarest of the
  one and the ``b - c + m`` rarest of the other. So a string emits every m of its rarest characters as a key, some tens of rows
  at a threshold of 95, and strings meet in an equi-join on it. Its condition also bounds the difference of the lengths, the
  places by rarity, and how many characters may differ in the parity of their number.
* Pairs that meet are scored. Every pair that reaches the threshold meets, so the result is that of comparing every pair.
* Low thresholds leave many characters without a counterpart. So they are approached in steps: a name that has found a partner at
  a higher step is settled, as nothing below can be better, and only the others go on.

The order by rarity may be any order that both sides share; it is taken from the frequencies of the directory's MOST_CHARACTERS
most frequent characters, which travel in the plan. The join of the unfolded sides asks for a merge join: their size is estimated
from the rows before unfolding, so a broadcast could be chosen for a table many times larger than the limit. A skewed key is split
by adaptive execution.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.functions.names import company_slug, match_form, similarity, sort_tokens
from jobloom.operators.joins import left_join
from jobloom.operators.metrics import value_counts
from jobloom.scratch import materialize

#: Lower thresholds would accept unlike names.
LEAST_THRESHOLD = 60
#: Thresholds at which names are settled on the way down, and how many rare characters make a key from there on.
STEPS = ((95, 4), (85, 3), (70, 2), (0, 2))
#: In a directory of more names than this, a key has one character more.
LARGE_DIRECTORY = 1_000_000
MOST_CHARACTERS = 1000
FIRST_RANK = 0xE000  # ranks of characters are written as characters from here on
UNFOLDED_PER_TASK = 500_000


def _bit_number(char: Column) -> Column:
    """Which of 37 bits a character flips; the modulus keeps the letters and digits of cleaned names apart."""
    return F.pmod(F.ascii(char), F.lit(37)).cast("int")


def _parities(text: Column) -> Column:
    """One bit per character, flipped by each occurrence, so an edit changes one bit."""

    def flip(bits: Column, char: Column) -> Column:
        return bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), _bit_number(char)))

    return F.aggregate(F.split(text, ""), F.lit(0).cast("bigint"), flip)


def _common(a: Column, b: Column, t: float) -> Column:
    """How many characters two strings of these lengths have in common at least, if they reach the threshold."""
    return F.ceil((a + b) * t / 2 - 1e-9).cast("int")


def _edits(a: Column, b: Column, t: float) -> Column:
    return F.floor((a + b) * (1 - t) + 1e-9)


def character_shares(directory: DataFrame) -> dict[str, float]:
    """The most frequent characters of ``form``, most frequent first, and their share of all."""
    counts = directory.select(F.explode(F.split("form", "")).alias("char")).groupBy("char").agg(F.count("*").alias("n"))
    top = counts.orderBy(F.desc("n"), "char").limit(MOST_CHARACTERS).collect()
    total = sum(r["n"] for r in top)
    return {r["char"]: r["n"] / total for r in top}


def _by_rarity(text: Column, shares: dict[str, float]) -> Column:
    """The numbered characters of ``text``, the rarest first: the k-th occurrence of one of share p is as rare as p to the power k."""
    logs = [math.log(p) for p in shares.values()]
    ranks = "".join(chr(FIRST_RANK + k) for k in range(len(logs)))
    rarest = min(logs, default=0.0) - 1
    table = F.array(*[F.lit(x) for x in (*logs, rarest)])

    def numbered(char: Column, place: Column) -> Column:
        begun = F.substring(text, F.lit(1), place + 1)
        number = F.length(begun) - F.length(F.replace(begun, char, F.lit("")))
        rank = F.ascii(F.translate(char, "".join(shares), ranks)) - FIRST_RANK
        known = (rank >= 0) & (rank < len(logs))
        share = F.get(table, F.when(known, rank).otherwise(len(logs)))
        return F.struct((share * number).alias("rarity"), F.concat(char, number).alias("char"))

    return F.array_sort(F.transform(F.split(text, ""), numbered))["char"]


def _keys(rows: DataFrame, shares: dict[str, float], t: float, most: int) -> DataFrame:
    """``rows`` (with ``form`` and ``size``) with ``bits``, ``key``, ``m`` and ``last``, the place by rarity of a key's last character.

    The shortest partner within reach has the fewest characters in common, which bounds the places. ``m`` is ``most``, or for short
    strings as many as they have in common with a partner that has fewer than that.
    """
    size, chars = F.col("size"), F.col("_chars")
    rows = rows.withColumns({"bits": _parities(F.col("form")), "_chars": _by_rarity(F.col("form"), shares)})
    fewest = _common(size, F.ceil(size * t / (2 - t) - 1e-9), t)
    parts = []
    # Unequal strings with m characters in common at least have 2 m / t characters or fewer, and 1 / (1 - t) or more.
    for m in [m for m in range(1, most + 1) if m == most or t <= 2 * m * (1 - t)]:
        reach = size if m < most else F.least(size, size - F.greatest(fewest, F.lit(most)) + most)
        part = rows.filter((size >= m) & (fewest <= m) if m < most else size >= m)
        for i in range(1, m + 1):
            begin = F.lit(1) if i == 1 else F.col(f"_{i - 1}") + 1
            part = part.withColumn(f"_{i}", F.explode(F.sequence(begin, (reach - m + i).cast("int"))))
        key = F.xxhash64(*[F.get(chars, F.col(f"_{i}") - 1) for i in range(1, m + 1)]).alias("key")
        parts.append(part.select(*[c for c in rows.columns if c != "_chars"], key, F.lit(m).alias("m"), F.col(f"_{m}").alias("last")))
    out = parts[-1]
    for part in parts[:-1]:
        out = out.unionByName(part)
    return out


def near_matches(probes: DataFrame, directory: DataFrame, shares: dict[str, float], t: float, most: int) -> DataFrame:
    """(form, score, first) of all pairs of a probe and a directory string (``form``, ``size``, ``first``) of at least that score."""
    left = _keys(probes.select("form", "size"), shares, t, most).alias("l")
    right = _keys(directory.select("form", "size", "first"), shares, t, most).withColumnRenamed("form", "entry").alias("r")
    a, b, m = F.col("l.size"), F.col("r.size"), F.col("l.m")
    common, edits = _common(a, b, t), _edits(a, b, t)
    able = (
        (m == F.col("r.m")) & (m == F.least(common, F.lit(most))) & (F.abs(a - b) <= edits)
        & (F.col("l.last") <= a - common + m) & (F.col("r.last") <= b - common + m)
        & (F.bit_count(F.col("l.bits").bitwiseXOR(F.col("r.bits"))) <= edits)
    )
    met = left.join(right.hint("merge"), (F.col("l.key") == F.col("r.key")) & able)
    pairs = met.select("l.form", "r.entry", "r.first").distinct()
    scored = pairs.withColumn("score", similarity(F.col("form"), F.col("entry")))
    return scored.filter(F.col("score") >= t * 100 - 1e-9).select("form", "score", "first")


def _spread(rows: DataFrame, unfolded: int) -> DataFrame:
    """Rows dealt out for the ``unfolded`` rows they become: few bytes now, many rows later, and a task for each part."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(cores, -(-unfolded // UNFOLDED_PER_TASK)), "size", "form")


def _emitted(lengths: dict[int, int], t: float, most: int) -> int:
    """An upper bound of the number of keys of strings of these lengths."""

    def common(a: int, b: int) -> int:
        return math.ceil((a + b) * t / 2 - 1e-9)

    return sum(n * math.comb(min(a, a - common(a, math.ceil(a * t / (2 - t) - 1e-9)) + most), most) for a, n in lengths.items())


def _lengths(rows: DataFrame) -> dict[int, int]:
    """How many strings have each length; there are no more of these than the longest has characters."""
    return {r["size"]: r["count"] for r in rows.groupBy("size").count().collect()}


def _best(found: DataFrame) -> DataFrame:
    """(_form, matches, score): the first of the highest scored partners of each form."""
    best = found.groupBy("form").agg(F.min(F.struct((-F.col("score")).alias("loss"), "first")).alias("best"))
    return best.select(
        F.col("form").alias("_form"), F.col("best.first.processed").alias("matches"), (-F.col("best.loss")).alias("score")
    )


def best_matches(
    names: DataFrame,
    directory: DataFrame,
    name: str,
    entry: str,
    threshold: float = 95.0,
    entry_order: str | None = None,
) -> DataFrame:
    """``names`` (one row per name) with ``processed``, ``matches`` and ``score`` of the best directory entry.

    ``matches`` is the cleaned form of the entry, empty if none reaches the threshold, which lies between 60 and 100. Equal scores
    go to the entry that is first by ``entry_order``, by default the entry itself. Names and entries that are null or empty after
    cleaning take no part. The cleaned names of both sides are written once, as every step reads them, and so are the best
    entries; what is returned only joins the written tables. The work per name grows as the threshold falls.
    """
    if not LEAST_THRESHOLD <= threshold <= 100:
        raise ValueError(f"threshold must lie between {LEAST_THRESHOLD} and 100")
    order = F.col(entry_order or entry)
    processed = match_form(F.col(name))
    left = materialize(
        names.withColumn("processed", processed).withColumn("_form", sort_tokens(F.col("processed"))), "match-names"
    )
    probes = (
        left.filter(F.col("_form") != "").select(F.col("_form").alias("form")).distinct()
        .withColumn("size", F.length("form"))
    )
    cleaned = directory.select(match_form(F.col(entry)).alias("processed"), order.alias("position"))
    entries = materialize(
        cleaned.filter(F.col("processed") != "")
        .withColumn("form", sort_tokens(F.col("processed")))
        .groupBy("form")
        .agg(F.min(F.struct("position", "processed")).alias("first"))
        .withColumn("size", F.length("form")),
        "match-entries",
    )
    best = _best(probes.join(entries, "form").select("form", F.lit(100.0).alias("score"), "first"))
    if threshold < 100:
        still_open = probes.join(entries.select("form"), "form", "left_anti")
        shares, sizes = character_shares(entries), [_lengths(probes), _lengths(entries)]
        more = int(sum(sizes[1].values()) > LARGE_DIRECTORY)
        for step, most in STEPS:
            t, most = max(step, threshold) / 100, most + more
            here, there = (_spread(rows, _emitted(n, t, most)) for rows, n in zip((still_open, entries), sizes, strict=True))
            found = materialize(_best(near_matches(here, there, shares, t, most)), "match-found")
            best = best.unionByName(found)
            if step <= threshold:
                break
            still_open = materialize(still_open.join(found, F.col("form") == F.col("_form"), "left_anti"), "match-open")
    return (
        left.join(best, "_form", "left")
        .withColumn("matches", F.coalesce("matches", F.lit("")))
        .drop("_form")
    )


def company_directory(urls: DataFrame, url: str = "Company_name_url") -> DataFrame:
    """Company URLs with their slug, one row per slug (the first URL)."""
    companies = urls.filter(F.col(url).contains("organization")).select(F.col(url).alias("Company_name_url"))
    slugs = companies.select(company_slug(F.col("Company_name_url")).alias("company_name"), "Company_name_url")
    return (
        slugs.filter(F.col("company_name").isNotNull())
        .groupBy("company_name")
        .agg(F.min("Company_name_url").alias("Company_name_url"))
    )


def employers(postings: DataFrame, name: str = "name") -> DataFrame:
    """Distinct employer names with their number of postings."""
    return value_counts(postings, name)


def merge_matches(matched: DataFrame, directory: DataFrame, name: str = "name") -> DataFrame:
    """Matched employers with every company that has the matched cleaned name.

    Both sides are written once, as the join reads them twice; the directory is cleaned once for each of its rows.
    """
    companies = materialize(
        directory.select("company_name", "Company_name_url", match_form(F.col("company_name")).alias("processed_company_name")),
        "match-companies",
    )
    hits = matched.filter(F.col("matches") != "").select(F.col(name).alias("employer_name"), "matches")
    hits = materialize(hits, "match-hits")
    return left_join(hits, companies, "matches", "processed_company_name").select(
        "employer_name", "company_name", "Company_name_url"
    )
