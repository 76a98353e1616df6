"""Mixing overlapping sources to target weights by a minimum-cost flow.

Documents are aggregated by membership pattern, the set of sources that hold them. Each pattern offers its words once for
nothing and again at a cost that grows with every repetition; a flow routes this capacity to the quotas of the sources at
the least cost, so nothing is repeated before everything else that may serve a quota has been used. Seeded documents then
fill what the flow takes of each pattern. Totals by pattern reach the driver where there are few; where there are more, targets are
aggregates over the table of sources, a source that overlaps no other gets its target straight away, and the flow is solved
in tasks, for each component of overlapping sources by itself.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobloom.llm.common import WORD
from jobloom.llm.components import components
from jobloom.scratch import materialize

#: Patterns that the driver may hold; more stay in tables.
MAX_PATTERNS = 4096
#: Shares by hash in which the documents of a pattern are added up before single ones are looked at.
SHARES = 1 << 14


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def code_points(name: str | None) -> tuple:
    """Sort key of a source: by code point, null last."""
    return (name is None, [ord(c) for c in name or ""])


def targets(sizes: Mapping[str | None, int], weights: Sequence[float], share: float, most: float) -> dict:
    """Words wanted of each source: ``share`` of all words by weight, at most ``most`` times what the source has.

    Weights repeat over the sources by code point, null last. What goes beyond a source's limit is shared among the others
    by weight until none is above.
    """
    names = sorted(sizes, key=code_points)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    wanted, left, open_ = {}, share * sum(sizes.values()), list(names)
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if weight[s] * unit > most * sizes[s]]
        if not full:
            return wanted | {s: weight[s] * unit for s in open_}
        for s in full:
            wanted[s] = float(most * sizes[s])
            left -= wanted[s]
        open_ = [s for s in open_ if s not in wanted]
    return wanted


def route(patterns: Mapping[tuple, float], wanted: Mapping, passes: int) -> dict[tuple[tuple, object], float]:
    """Words that each pattern gives to each of its sources, by successive cheapest paths.

    The k-th pass over a pattern costs k, so costs are convex. A pattern and a source that have only each other need no path. Of
    the others the residual network is small: patterns and sources.
    """
    tiny = 1e-6
    holders = Counter(s for p in patterns for s in p)
    alone = [p for p in patterns if len(p) == 1 and holders[p[0]] == 1]
    direct = {(p, p[0]): min(float(wanted.get(p[0], 0.0)), passes * patterns[p]) for p in alone}
    direct = {k: f for k, f in direct.items() if f > tiny}
    patterns = {p: n for p, n in patterns.items() if len(p) > 1 or holders[p[0]] > 1}
    used = dict.fromkeys(patterns, 0.0)
    flow: dict[tuple[tuple, object], float] = {}
    among = {s for p in patterns for s in p}
    left = {s: w for s, w in wanted.items() if s in among}
    while True:
        # Cheapest way from a pattern with words to offer to each node; moving words between patterns takes back a flow.
        cost = {p: int(used[p] // patterns[p] if patterns[p] - used[p] % patterns[p] > tiny else used[p] // patterns[p] + 1) + 1
                for p in patterns if patterns[p] * passes - used[p] > tiny}
        came: dict = dict.fromkeys(cost)
        front = dict(cost)
        source_cost: dict = {}
        changed = True
        while changed:
            changed = False
            for p, c in list(front.items()):
                for s in p:
                    if c < source_cost.get(s, float("inf")):
                        source_cost[s], came[("source", s)] = c, p
                        changed = True
            for (p, s), f in flow.items():
                if f > tiny and source_cost.get(s, float("inf")) < front.get(p, float("inf")):
                    front[p], came[p] = source_cost[s], s
                    changed = True
        open_ = [s for s in left if left[s] > tiny and s in source_cost]
        if not open_:
            return direct | {k: f for k, f in flow.items() if f > tiny}
        end = min(open_, key=lambda s: (source_cost[s], code_points(s)))
        steps, s = [], end
        while True:
            p = came[("source", s)]
            steps.append((p, s))
            if came[p] is None and p in cost and front[p] == cost[p]:
                break
            s = came[p]
            steps.append((p, s))
        start = steps[-1][0]
        room = patterns[start] - used[start] % patterns[start]
        amount = min([left[end], room if room > tiny else patterns[start]] + [flow[x] for x in steps[1::2]])
        for k, x in enumerate(steps):
            flow[x] = flow.get(x, 0.0) + (amount if k % 2 == 0 else -amount)
        used[start] += amount
        left[end] -= amount


PLAN = "pattern array<string>, n long, whole int, quota double, bounds array<double>"
FACTS = "source string, source_size long, target double"


def share_out(p: tuple, n: int, taken: Mapping, passes: int) -> tuple:
    """A row of PLAN: how often a pattern is taken whole, words wanted beyond that, and the parts of its sources."""
    q = sum(taken.values())
    whole = min(passes, int((q + 1e-6) // n)) if n else 0
    edge, bounds = 0.0, []
    for s in p:
        edge += taken[s] / q if q else 0.0
        bounds.append(edge)
    return list(p), n, whole, max(0.0, q - whole * n) if whole < passes else 0.0, bounds


def planned(patterns: Mapping[tuple, int], weights: Sequence[float], share: float, passes: int) -> tuple[list, list]:
    """Rows of PLAN and FACTS from all totals by pattern."""
    sizes: dict = {}
    for p, n in patterns.items():
        for s in p:
            sizes[s] = sizes.get(s, 0) + n
    wanted = targets(sizes, weights, share, passes)
    flow = route({p: float(n) for p, n in patterns.items() if n}, wanted, passes)
    plan = [share_out(p, n, {s: flow.get((p, s), 0.0) for s in p}, passes) for p, n in patterns.items()]
    return plan, [(s, sizes[s], wanted[s]) for s in sizes]


def target_table(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """``targets`` over a table of ``source`` and ``source_size``: FACTS.

    A source's place is its place in its sorted part and the rows of the parts before; the words for a unit of weight grow
    with each aggregate until no further source has reached its limit.
    """
    spark = sizes.sparkSession
    ordered = sizes.orderBy(F.col("source").isNull(), "source")
    ordered = materialize(ordered.withColumn("at", F.monotonically_increasing_id()), "sources")
    part, before, total = F.shiftright("at", 33).cast("int").alias("part"), [], 0
    for r in sorted(ordered.groupBy(part).agg(F.count("*").alias("rows")).collect()):
        before.append((r["part"], total))
        total += r["rows"]
    before = F.broadcast(spark.createDataFrame(before, "part int, before long"))  # a row for each part of the sort
    place = F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    rows = ordered.withColumn("part", part).join(before, "part").withColumn("weight", weight)
    rows = materialize(rows.select("source", "source_size", "weight", (F.lit(float(most)) * F.col("source_size")).alias("limit")), "sources")
    words, unit, full = share * (rows.agg(F.sum("source_size")).first()[0] or 0), 0.0, -1
    while True:
        over = F.col("weight") * unit > F.col("limit")
        w, used, n = rows.agg(
            F.sum(F.when(~over, F.col("weight"))), F.coalesce(F.sum(F.when(over, F.col("limit"))), F.lit(0.0)), F.count_if(over)
        ).first()
        if not w or n == full:
            return rows.select("source", "source_size", F.least(F.col("weight") * unit, "limit").alias("target"))
        unit, full = (words - used) / w, n


def planned_in_tables(totals: DataFrame, weights: Sequence[float], share: float, passes: int) -> tuple[DataFrame, DataFrame]:
    """PLAN and FACTS as tables from the table of totals (``pattern``, ``n``)."""
    sizes = totals.select("n", F.explode("pattern").alias("source")).groupBy("source").agg(F.sum("n").alias("source_size"))
    facts = materialize(target_table(sizes, weights, share, passes), "targets")
    name = lambda s: F.when(s.isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), s))  # noqa: E731  a null end is no vertex
    first = name(F.get("pattern", F.lit(0)))
    links = totals.where(F.size("pattern") > 1).select(first.alias("a"), F.explode(F.transform("pattern", name)).alias("b"))
    roots = components(links, "a", "b")
    rooted = totals.withColumn("vertex", first).join(roots, "vertex", "left").drop("vertex")
    wanted = facts.select(name(F.col("source")).alias("vertex"), "target")
    alone = rooted.where(F.col("root").isNull()).withColumn("vertex", first).join(wanted, "vertex", "left")
    q = F.coalesce("target", F.lit(0.0))
    whole = F.when(F.col("n") > 0, F.least(F.lit(passes), F.floor((q + 1e-6) / F.col("n")))).otherwise(0).cast("int")
    alone = alone.withColumn("whole", whole).select(
        "pattern", "n", "whole",
        F.when(F.col("whole") < passes, F.greatest(F.lit(0.0), q - F.col("whole") * F.col("n"))).otherwise(0.0).alias("quota"),
        F.transform("pattern", lambda s: F.when(q > 0, 1.0).otherwise(0.0)).alias("bounds"),
    )
    each = F.struct("pattern", "n", F.lit(None).cast("string").alias("source"), F.lit(None).cast("double").alias("target"))
    ends = wanted.withColumn("source", F.expr("IF(vertex = 'null', NULL, substring(vertex, 2))")).join(roots, "vertex")
    nodes = rooted.where(F.col("root").isNotNull()).select("root", each.alias("node")).unionByName(
        ends.select("root", F.struct(
            F.lit(None).cast("array<string>").alias("pattern"), F.lit(None).cast("long").alias("n"), "source", "target",
        ).alias("node"))
    ).select("root", "node.*")

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        is_pattern = rows["pattern"].notna()
        given = sorted(rows[is_pattern][["pattern", "n"]].itertuples(index=False), key=lambda r: [code_points(s) for s in r.pattern])
        patterns = {tuple(r.pattern): int(r.n) for r in given}
        ends = rows[~is_pattern]
        target = {s if isinstance(s, str) else None: t for s, t in zip(ends["source"], ends["target"], strict=True)}
        flow = route({p: float(n) for p, n in patterns.items() if n}, target, passes)
        plan = [share_out(p, n, {s: flow.get((p, s), 0.0) for s in p}, passes) for p, n in patterns.items()]
        return pd.DataFrame(plan, columns=["pattern", "n", "whole", "quota", "bounds"])

    plan = alone.unionByName(nodes.groupBy("root").applyInPandas(solve, PLAN))
    return materialize(plan, "plan"), facts


def fill(rows: DataFrame, quota: Column, order: Sequence[str]) -> DataFrame:
    """``rows`` (pattern, size, hash, ...) with ``in_``: those that, taken in the order of their hash, stay within ``quota``.

    Rows are added up by pattern and share of the hash range first; only the share in which the quota ends is sorted.
    """
    share = F.shiftrightunsigned("hash", 50).cast("int")
    rows = rows.withColumn("share", share)
    before = Window.partitionBy("pattern").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("pattern", "share").agg(F.sum("size").alias("here"))
    sums = sums.withColumn("base", F.coalesce(F.sum("here").over(before), F.lit(0)))
    rows = rows.join(sums, ["pattern", "share"])
    at_end = (F.col("base") < quota) & (F.col("base") + F.col("here") > quota)
    within = Window.partitionBy("pattern", "share").orderBy("hash", *order).rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.where(at_end).withColumn("in_", F.col("base") + F.sum("size").over(within) <= quota)
    outside = rows.where(~at_end).withColumn("in_", F.col("base") + F.col("here") <= quota)
    return outside.unionByName(inside).drop("share", "here", "base")


RESULT = ("size", "pattern", "copies", "credited")


def mix(
    docs: DataFrame, key: str, text: str, sources: Column, weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5, passes: int = 2, seed: int = 42, keep: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Copies of each document that the mix takes, and the targets of the sources.

    ``sources`` is the array of the sources that hold a document; null in it is a source of its own. The first result has
    the key, the columns in ``keep`` (which also settle ties), ``size`` (words), ``pattern``, ``copies`` (0 to ``passes``)
    and ``credited`` (the source of each copy), a row for each document. The second has ``source``, ``source_size`` and
    ``target``. A null or wordless text has size 0 and is never taken. Repeated rows are documents of their own. The same rows and seed give the same result,
    whatever their order. An empty table gives empty results. Documents are taken whole: when the mix is
    done no further one fits into what is open of a pattern, and none goes above it, but that a pattern with no document
    that fits takes its smallest one where this is nearer to what is wanted than nothing. Any number of patterns
    is taken; sources that overlap, directly or by way of others, are one flow, which one task solves. The key and the kept
    columns may have any names; one that is called as a column of the result comes back with an underscore behind it. Other
    columns are not read.
    """
    spark = docs.sparkSession
    named = [key, *keep]
    ids = [f"_id{k}" for k in range(len(named))]
    light = docs.select(
        *[F.col(f"`{name}`").alias(i) for name, i in zip(named, ids, strict=True)], word_count(F.col(f"`{text}`")).alias("size"),
        F.array_sort(F.array_distinct(sources)).alias("pattern"), F.xxhash64(F.lit(seed), F.col(f"`{key}`")).alias("hash"),
    )
    light = materialize(light.withColumn("row_id", F.monotonically_increasing_id()), "sizes")  # tells repeated rows apart
    totals = light.groupBy("pattern").agg(F.sum("size").alias("n"))
    few = totals.limit(MAX_PATTERNS + 1).collect()
    if len(few) <= MAX_PATTERNS:
        plan, facts = planned({tuple(r["pattern"]): r["n"] for r in few}, weights, share, passes)
        plan, facts = F.broadcast(spark.createDataFrame(plan, PLAN)), F.broadcast(spark.createDataFrame(facts, FACTS))
        sent = F.broadcast
    else:
        plan, facts = planned_in_tables(materialize(totals, "totals"), weights, share, passes)
        sent = lambda rows: rows
    known = light.join(plan, "pattern").where("size > 0")
    taken = F.col("whole") + F.col("in_").cast("int")
    chosen = materialize(fill(known, F.col("quota"), ["size", *ids]).withColumn("copies", taken).drop("in_"), "filled")
    wanted_of = F.col("whole") * F.col("n") + F.col("quota")
    big = F.struct("size", "hash", *[F.col(c).isNull() for c in ids], *ids, "row_id")
    while True:  # each round halves what is open of a pattern at least, or leaves nothing that fits it
        got = chosen.groupBy("pattern").agg(F.sum(F.col("size") * F.col("copies")).alias("got"))
        rest = chosen.join(sent(got), "pattern")  # a row for each pattern
        rest = rest.withColumn("rest", wanted_of - F.col("got")).drop("got")
        fits = (F.col("copies") < passes) & (F.col("size") <= F.col("rest"))
        fresh = F.col("copies") <= F.col("whole")  # these come before a further copy of others
        best = rest.where(fits).groupBy("pattern").agg(
            F.coalesce(F.max(F.when(fresh, big)), F.max(big)).alias("best"), F.max(fresh).alias("only_fresh")
        )
        best = materialize(best.select("pattern", "only_fresh", F.col("best.size").alias("most"), F.col("best.row_id").alias("best_id")), "best")
        if best.isEmpty():
            break
        rest = rest.join(sent(best), "pattern", "left")
        # The largest that fits is over half of what is open and enters alone, or all that fit are under it.
        able = fits & (fresh | ~F.col("only_fresh"))
        alone = 2 * F.col("most") > F.col("rest")
        turn = F.coalesce(able & (~alone | (F.col("row_id") == F.col("best_id"))), F.lit(False))
        more = fill(rest.where(turn), F.col("rest"), ["size", *ids])
        more = more.withColumn("copies", F.col("copies") + F.col("in_").cast("int")).drop("in_")
        chosen = materialize(rest.where(~turn).unionByName(more).drop("rest", "only_fresh", "most", "best_id"), "filled")
    # A pattern that would get nothing, as all its documents are above what it may get, takes its smallest where that is nearer.
    small = chosen.groupBy("pattern").agg(F.min(big).alias("small"), F.max("copies").alias("any"), F.first("quota").alias("open"))
    small = small.where((F.col("any") == 0) & (F.col("small.size") < 2 * F.col("open"))).select(F.col("small.row_id").alias("row_id"), F.lit(1).alias("one"))
    chosen = chosen.join(small, "row_id", "left").withColumn("copies", F.col("copies") + F.coalesce("one", F.lit(0))).drop("one")
    spot = F.pmod(F.xxhash64(F.lit(seed + 1), F.col(ids[0])), F.lit(1 << 30)) / (1 << 30)
    owner = F.element_at("pattern", F.least(F.size("pattern"), F.size(F.filter("bounds", lambda b: b <= spot)) + 1))
    chosen = chosen.select(*ids, "size", "pattern", "copies", owner.alias("owner"))
    empty = light.where("size = 0").select(
        *ids, "size", "pattern", F.lit(0).alias("copies"), F.lit(None).cast("string").alias("owner")
    )
    found = chosen.unionByName(empty).withColumn("credited", F.array_repeat("owner", F.col("copies")))
    back = [F.col(i).alias(name if name not in RESULT else f"{name}_") for name, i in zip(named, ids, strict=True)]
    return found.select(*back, *RESULT), facts


def mix_documents(documents: DataFrame) -> DataFrame:
    """Result of the query: what the mix takes of every document."""
    found, facts = mix(documents.select("doc_id", "text", "source"), "doc_id", "text", F.array("source"))
    return found.join(facts, F.element_at("pattern", 1).eqNullSafe(facts["source"])).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )
