"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters that are not blanks of ASCII.
WORD = r"[^\x20\x09-\x0D]+"
find_words = re.compile(WORD).findall


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A standard table, by Spark's reader alone."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: Column, n: int) -> Column:
    """crc32 of the key written as text, modulo n; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % n


def lower_ascii(text: str) -> str:
    """A-Z in lower case, everything else as it is."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def gathered(batches: Iterable[pd.DataFrame], column: str, chars: int) -> Iterator[pd.DataFrame]:
    """The same rows in larger frames of about ``chars`` characters, so that work per frame is shared by more rows.

    Nothing is cut: a single text longer than that comes whole.
    """
    held: list[pd.DataFrame] = []
    size = 0
    for batch in batches:
        ends = batch[column].str.len().fillna(0).to_numpy().cumsum()
        cuts = np.flatnonzero(np.diff(ends // chars)) + 1 if len(ends) else []
        for start, stop in pairwise([0, *cuts, len(batch)]):
            part = batch.iloc[start:stop]
            held.append(part)
            size += int(part[column].str.len().fillna(0).sum())
            if size >= chars:
                yield pd.concat(held, ignore_index=True)
                held, size = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def give_back() -> None:
    """Return freed memory to the system: a Python worker waits for its next task with what the last one held."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def in_slices(run: Callable[[Iterable[pd.DataFrame]], Iterator[pd.DataFrame]], schema: pa.Schema, rows: int = 256) -> Callable:
    """``run`` over frames as a function over Arrow batches, of which only a slice at a time becomes Python objects."""

    def frames(batches: Iterable[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                yield batch.slice(start, rows).to_pandas()

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in run(frames(batches)):
            yield pa.RecordBatch.from_pandas(frame, schema, preserve_index=False)
        give_back()

    return apply


def appended(
    run: Callable[[list], dict[str, list]], text: str, types: dict[str, pa.DataType], chars: int
) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function over Arrow batches that adds the columns which ``run`` gives for the texts of a group of rows.

    Groups hold about ``chars`` characters, or one longer text. Other columns pass as they are and never become Python objects.
    """

    def finished(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(parts).combine_chunks()
        found = run(table.column(text).to_pylist())
        for name, kind in types.items():
            table = table.append_column(name, pa.array(found[name], kind))
        yield from table.to_batches()

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            lengths = pc.fill_null(pc.utf8_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
            start = 0
            for stop, length in enumerate(lengths.tolist(), 1):
                size += length
                if size >= chars:
                    yield from finished([*held, batch.slice(start, stop - start)])
                    held, size, start = [], 0, stop
            if start < batch.num_rows:
                held.append(batch.slice(start))
        if held:
            yield from finished(held)
        held.clear()
        give_back()

    return apply


#: Rows of a batch between Spark and Python where the session has left Spark's default of ten thousand: whole texts are long.
BATCH_ROWS = 250


def modest_batches(spark: SparkSession) -> None:
    """Bound the memory of batches of texts; a session that has set its own number of rows keeps it.

    The number is read when a plan is made, after an operator has returned, so it is set in the session for good.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH_ROWS))
