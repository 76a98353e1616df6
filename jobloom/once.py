"""Columns that are computed once per row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(rows: DataFrame, columns: Mapping[str, Column], keep: Sequence[str] | None = None) -> DataFrame:
    """``rows`` with costly columns added; ``keep`` names the old columns to keep, by default all.

    The optimizer copies the expression of a projected column into a filter on it, once for every mention. A column
    that comes out of a generator is not copied: the generator below, of one row each, is evaluated a single time.
    """
    kept = [F.col(f"`{c}`") for c in (rows.columns if keep is None else keep) if c not in columns]
    fields = F.struct(*[c.alias(name) for name, c in columns.items()])
    return rows.select(*kept, F.inline(F.array(fields)))
