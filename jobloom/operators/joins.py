"""Left join that stays even when a key is frequent on the right."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """``left`` with the columns of every row of ``right`` that has its key, nulls where there is none.

    Adaptive execution can split a frequent key of either side of an inner join, but only of the left side of an outer
    one. So the rows with a partner come from an inner join, the others from an anti-join with the distinct keys.
    Column names of the two sides must differ. Null keys have no partner.
    """
    here, there = F.col(f"`{left_key}`"), F.col(f"`{right_key}`")
    paired = left.join(right, here == there)
    keys = right.select(there.alias("_right_key")).distinct()
    alone = left.join(keys, here == F.col("_right_key"), "left_anti")
    return paired.unionByName(alone, allowMissingColumns=True)
