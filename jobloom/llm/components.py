"""Connected components of a graph given by its edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.scratch import materialize


def _state(edges: DataFrame) -> tuple:
    """A digest of a set of edges that any order of its rows leaves the same."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.sum(F.shiftright(h, 20)), F.bit_xor(h)).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``vertex`` and ``root``, the least vertex of its component, for each vertex that has a link.

    In a large star every vertex hangs its larger neighbours on its least neighbour, in a small star the others; when the
    edges no longer change they are stars around the roots. A round is written to shared storage before the next, so lineage
    stays short; the number of rounds grows with the logarithm of the largest component. Vertices of very many links
    are handled by sums per task and joins that can be split. Null ends and loops are ignored.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
    )
    edges = materialize(edges.distinct(), "edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large, "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v")))
        edges = materialize(small.where("u <> v").distinct(), "edges")
        before, state = state, _state(edges)
        if before == state:
            break
    roots = edges.select(F.col("v").alias("vertex"), F.col("v").alias("root")).distinct()
    return roots.unionByName(edges.select(F.col("u").alias("vertex"), F.col("v").alias("root")))
