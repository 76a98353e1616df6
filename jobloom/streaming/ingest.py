"""Incremental ingestion of a landing folder into a cumulative table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from jobloom.operators.dedupe import keep_first
from jobloom.operators.incremental import new_rows
from jobloom.sources.files import table_or_empty

BATCH = "batch"


def _add_batch(batch: DataFrame, batch_id: int, table: str, key: str, order: Sequence[str]) -> None:
    """Add the first row of every key that is not in the table, to the batch's partition.

    Nothing is replaced: a replayed batch finds its keys there, and so does a stream that starts anew over a filled table
    because its checkpoint was lost.
    """
    stored = T.StructType(batch.schema.fields).add(BATCH, T.LongType())
    present = table_or_empty(batch.sparkSession, table, stored)
    fresh = keep_first(new_rows(batch, present, key), [key], order)
    fresh.write.mode("append").parquet(f"{table}/{BATCH}={batch_id}")


def ingest_new(
    spark: SparkSession,
    landing: str,
    schema: str | T.StructType,
    table: str,
    checkpoint: str,
    key: str,
    order: Sequence[str],
    file_format: str = "parquet",
    max_files: int | None = None,
) -> StreamingQuery:
    """Start a stream that takes what is in ``landing`` now, adds unseen keys to ``table`` and ends."""
    reader = spark.readStream.format(file_format).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        reader.load(landing)
        .writeStream.foreachBatch(lambda df, batch_id: _add_batch(df, batch_id, table, key, order))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_within_horizon(rows: DataFrame, key: str, time: str, horizon: str) -> DataFrame:
    """A stream without repeats of a key inside the horizon, for streams whose full past is too long to keep."""
    return rows.withWatermark(time, horizon).dropDuplicatesWithinWatermark([key])
