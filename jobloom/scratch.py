"""Places for intermediate tables that must outlive the executors that wrote them."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder named by ``spark.checkpoint.dir``; only a local session may do without one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not re.fullmatch(r"local(\[.*\])?", context.master):  # not local-cluster, whose executors are apart
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = _local_roots.get(context.applicationId)
        if root is None:
            root = _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="jobloom-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back, so that several consumers share the work and the lineage ends here."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
