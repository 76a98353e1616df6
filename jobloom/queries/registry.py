"""Registry of the queries over the standard tables, each with an SQL text that states the same result."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from jobloom.session import apply_settings

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under the name of its function."""

    def register(run: Query) -> Query:
        def with_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(apply_settings(spark), sf_dir)

        QUERIES[run.__name__] = with_settings
        if sql is not None:
            ORACLE[run.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str, costly: bool = False) -> DataFrame:
    """A standard table. With ``costly`` work per row ahead, one in fewer parts than cores is dealt out to all cores.

    A table of more parts, as any large one is, stays as it is read, without a shuffle.
    """
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if costly and rows.rdd.getNumPartitions() < cores else rows


class Derived:
    """Input columns computed from a table, or from other such columns, by expressions both SQL dialects read alike."""

    def __init__(self, source: str | Derived, columns: Mapping[str, str], costly: bool = False):
        self.source, self.columns, self.costly = source, dict(columns), costly

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        exprs = [f"{expression} AS `{name}`" for name, expression in self.columns.items()]
        if isinstance(self.source, Derived):
            rows = self.source.frame(spark, sf_dir)
        else:
            rows = table(spark, sf_dir, self.source, self.costly)
        return rows.selectExpr(*exprs)

    def sql(self) -> str:
        exprs = ", ".join(f'{expression} AS "{name}"' for name, expression in self.columns.items())
        source = f"{self.source.sql()} AS s" if isinstance(self.source, Derived) else self.source
        return f"(SELECT {exprs} FROM {source})"


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"
