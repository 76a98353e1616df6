"""What a cumulative table already holds, as digests in a side table that is bucketed by them.

Each run of the table has a partition of 128-bit digests, of its rows or of its keys, dealt into a fixed number of buckets. New
digests are sent to the buckets; the history stays where it lies: it is neither exchanged nor are its other columns read. A run
without its partition, as it was written by other means or the writer was lost in between, is digested before it is asked.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RUN, DIGEST = "run_date", "digest"
BUCKETS = 64


def digest_of(columns: Sequence[str]) -> Column:
    """128 bits of the values of the columns, nulls among them."""
    values = F.struct(*[F.col(f"`{c}`").alias(str(k)) for k, c in enumerate(columns)])
    return F.unhex(F.md5(F.to_json(values, {"ignoreNullFields": "false"}).cast("binary")))


class _Folder:
    """A folder by way of the session's file systems."""

    def __init__(self, spark: SparkSession, place: str):
        self.path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
        self.files = self.path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def mkdirs(self) -> None:
        self.files.mkdirs(self.path)

    def delete(self) -> None:
        self.files.delete(self.path, True)


class DigestIndex:
    """The digests of ``columns`` of the table at ``path``, whose runs are folders ``run_date=...``."""

    def __init__(self, spark: SparkSession, path: str, columns: Sequence[str], buckets: int = BUCKETS):
        self.spark, self.path, self.columns = spark, path.rstrip("/"), list(columns)
        mark = hashlib.md5("\n".join([*self.columns, str(buckets)]).encode()).hexdigest()[:12]
        self.place = f"{self.path}/_digests_{mark}"  # the underscore hides it from readers of the table
        self.name = f"digests_{hashlib.md5(self.place.encode()).hexdigest()}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({DIGEST} BINARY, {RUN} DATE) USING parquet PARTITIONED BY ({RUN}) "
            f"CLUSTERED BY ({DIGEST}) INTO {buckets} BUCKETS LOCATION '{self.place}'"
        )
        self._folder(self.place).mkdirs()
        spark.sql(f"MSCK REPAIR TABLE {self.name} SYNC PARTITIONS")  # what other sessions have written

    def _folder(self, place: str) -> _Folder:
        return _Folder(self.spark, place)

    def digested(self, rows: DataFrame) -> DataFrame:
        return rows.select(digest_of(self.columns).alias(DIGEST))

    def runs(self) -> set[str]:
        return {r[0].split("=", 1)[1] for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()}

    def forget(self, run_date: dt.date) -> None:
        """Before a run is written: a writer that is lost then leaves no digests of what is no more."""
        if run_date.isoformat() in self.runs():
            self.spark.sql(f"ALTER TABLE {self.name} DROP PARTITION ({RUN} = DATE'{run_date.isoformat()}')")
            self._folder(f"{self.place}/{RUN}={run_date.isoformat()}").delete()

    def add(self, rows: DataFrame, run_date: dt.date) -> None:
        """The digests of a run, in place of what it had."""
        view = f"{self.name}_rows"
        self.digested(rows).distinct().createOrReplaceTempView(view)
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.name} PARTITION ({RUN} = DATE'{run_date.isoformat()}') SELECT {DIGEST} FROM {view}")
        self.spark.catalog.dropTempView(view)

    def complete(self, run_date: dt.date) -> None:
        """Digest the runs that the table has and the index lacks, but for ``run_date``."""
        try:
            stored = self.spark.read.parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return
        there = {r[0] for r in stored.select(RUN).distinct().collect()}  # a row for each run
        for other in sorted(there - {dt.date.fromisoformat(r) for r in self.runs()} - {run_date}):
            self.add(stored.where(F.col(RUN) == F.lit(other)), other)

    def known(self, digests: DataFrame, run_date: dt.date) -> DataFrame:
        """Those of ``digests`` that other runs have; of the history, matches alone leave their buckets."""
        history = self.spark.table(self.name).where(F.col(RUN) != F.lit(run_date)).select(DIGEST)
        return history.join(digests.select(DIGEST).hint("shuffle_hash"), DIGEST, "left_semi").distinct()

    def unknown_rows(self, rows: DataFrame, run_date: dt.date) -> DataFrame:
        """The rows whose digest no other run has. ``rows`` is read twice."""
        self.complete(run_date)
        marked = rows.withColumn("_digest", digest_of(self.columns))
        known = self.known(marked.select(F.col("_digest").alias(DIGEST)).distinct(), run_date)
        return marked.join(known, F.col("_digest") == F.col(DIGEST), "left_anti").drop("_digest")
