"""Records of CSV files, dealt out to many tasks also where quoted fields span lines.

A large file is read in blocks of lines, and a line may lie within a quoted field that began blocks before. What a line does to
that is a function of whether it begins inside a field: a quote opens a field only behind a delimiter, so lines say so by
themselves, for either beginning. A first pass composes these functions for every block and takes the first record of each file,
which is its header, line breaks and all. The functions are then applied block by block within each file, a row for each block, and
tell every block how it begins. In a second pass each task puts the records of its block together; what a block has of a record
that crosses its ends is a fragment, and the fragments of a record are joined at the end. Without such records nothing is joined.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.scratch import materialize

#: Blocks that begin inside a field are sent to all tasks up to this number, and joined with the lines beyond.
MOST_SENT = 100_000
WHOLE, OPEN, REST = 0, 1, 2  # a record; one that goes on behind its block; lines of one that began before


def ends_inside(line: str, inside: bool, delimiter: str = ",") -> bool:
    """Whether the end of the line is inside a quoted field, if its beginning is or is not."""
    at = 0
    while True:
        if inside:
            while True:
                quote = line.find('"', at)
                if quote < 0:
                    return True
                at = quote + 2
                if line[quote + 1 : at] != '"':
                    break
            at = line.find(delimiter, quote + 1)  # what follows a closing quote belongs to the field
            if at < 0:
                return False
            at += 1
        inside = line.startswith('"', at)
        if inside:
            at += 1
            continue
        at = line.find(delimiter, at)
        if at < 0:
            return False
        at += 1


def lines(spark: SparkSession, path: str | list[str], without: Sequence[str] = (), skip_damaged: bool = False) -> DataFrame:
    """``file``, ``block`` (where it begins), ``id`` (ascending within a block) and ``value`` of every line.

    Files in ``without`` are not opened; with ``skip_damaged`` a file ends where it can be read no further.
    """
    read = spark.read.option("lineSep", "\n").option("ignoreCorruptFiles", str(skip_damaged).lower()).text(path)
    if without:  # a condition on the file alone, which Spark applies to its listing
        read = read.where(~F.col("_metadata.file_path").isin(list(without)))
    return read.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), "value",
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """Slices of the batch that are of one block, with its file and where it begins."""
    if not batch.num_rows:
        return
    files, blocks = batch.column("file"), batch.column("block")
    if batch.num_rows == 1:
        changes = []
    else:
        differ = pc.or_(pc.not_equal(files[1:], files[:-1]), pc.not_equal(blocks[1:], blocks[:-1]))
        changes = (pc.indices_nonzero(differ).to_numpy() + 1).tolist()
    for start, stop in zip([0, *changes], [*changes, batch.num_rows], strict=True):
        yield files[start].as_py(), blocks[start].as_py(), batch.slice(start, stop - start)


def _quoted(values: pa.Array) -> list[int]:
    return pc.indices_nonzero(pc.match_substring(values, '"')).to_pylist()


class _Block:
    """What is known of a block after some of its lines."""

    def __init__(self, file: str, block: int):
        self.file, self.block = file, block
        self.from_out, self.from_in = False, True
        self.header: list[str] | None = None if block else []  # lines of the first record, in the first block only
        self.done = bool(block)

    def add(self, values: pa.Array) -> None:
        if not self.done:
            for line in values.to_pylist():
                if self.header or line.strip(" \t\r"):
                    inside = ends_inside(line, bool(self.header) and self.header_open)
                    self.header.append(line)
                    self.header_open = inside
                    if not inside:
                        self.done = True
                        break
        for k in _quoted(values):
            line = values[k].as_py()
            self.from_out, self.from_in = ends_inside(line, self.from_out), ends_inside(line, self.from_in)

    def row(self) -> tuple:
        header = "\n".join(self.header).removesuffix("\r") if self.header else None
        return self.file, self.block, self.from_out, self.from_in, header


_BLOCKS = pa.schema([("file", pa.string()), ("block", pa.int64()), ("from_out", pa.bool_()), ("from_in", pa.bool_()), ("header", pa.string())])


def _block_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now = None
    rows: list[tuple] = []
    for batch in batches:
        for file, block, part in _runs(batch):
            if now is None or (now.file, now.block) != (file, block):
                if now is not None:
                    rows.append(now.row())
                now = _Block(file, block)
            now.add(part.column("value"))
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(_BLOCKS.names, r, strict=True)) for r in rows], _BLOCKS)
            rows = []
    if now is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(_BLOCKS.names, now.row(), strict=True))], _BLOCKS)


def blocks_of(rows: DataFrame) -> DataFrame:
    """For every block that has lines: how it ends from either beginning, and in the first the ``header`` of the file."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    found = rows.select("file", "block", "value").mapInArrow(_block_rows, "file string, block long, from_out boolean, from_in boolean, header string")
    return materialize(found, "csv-blocks")


def begun_inside(blocks: DataFrame) -> DataFrame:
    """(file, block) of the blocks that begin inside a quoted field."""
    several = blocks.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("block", "from_out", "from_in"))).alias("parts")).where(F.size("parts") > 1)

    def further(seen: Column, part: Column) -> Column:
        inside = F.element_at(seen, -1)["inside"]
        ends = F.when(inside, part["from_in"]).otherwise(part["from_out"])
        return F.concat(seen, F.array(F.struct(part["block"].alias("block"), ends.alias("inside"))))

    begin = F.array(F.struct(F.lit(-1).cast("long").alias("block"), F.lit(False).alias("inside")))
    ends = F.aggregate("parts", begin, further)  # a state behind each block, one row for each block of a file
    states = F.transform(F.col("parts"), lambda p, k: F.struct(p["block"].alias("block"), F.get(ends, k)["inside"].alias("inside")))
    return several.select("file", F.inline(states)).where("inside").select("file", "block")


_PIECES = pa.schema([("file", pa.string()), ("block", pa.int64()), ("id", pa.int64()), ("kind", pa.int32()), ("first", pa.bool_()), ("text", pa.string())])


class _Collector:
    """Puts the lines of one block after another together to records and fragments."""

    def __init__(self) -> None:
        self.now: tuple[str, int] | None = None
        self.held: list[str] = []
        self.out: list[tuple] = []

    def begin(self, now: tuple[str, int], inside: bool) -> None:
        self.end()
        self.now, self.inside, self.kind = now, inside, REST if inside else WHOLE
        self.searching = now[1] == 0  # for the first record of the file that is not blank

    def end(self) -> None:
        if self.held:
            self.finish(OPEN if self.kind == WHOLE else REST)

    def finish(self, kind: int) -> None:
        text = self.held[0] if len(self.held) == 1 else "\n".join(self.held)
        first = self.searching and bool(text.strip(" \t\r\n"))
        self.searching &= not first
        self.out.append((*self.now, self.id, kind, first, text))
        self.held, self.kind = [], WHOLE

    def add(self, line: str, line_id: int, quoted: bool) -> None:
        if not self.held:
            self.id = line_id
        self.held.append(line)
        if quoted:
            self.inside = ends_inside(line, self.inside)
        if not self.inside:
            self.finish(self.kind)

    def taken(self) -> Iterator[pa.RecordBatch]:
        if self.out:
            columns = zip(zip(*self.out, strict=True), _PIECES, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(values, f.type) for values, f in columns], schema=_PIECES)
            self.out = []


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and fragments of the lines (``file``, ``block``, ``id``, ``value``, ``inside``), which come block by block in order."""
    collector = _Collector()
    for batch in batches:
        for file, block, part in _runs(batch):
            if (file, block) != collector.now:
                collector.begin((file, block), bool(part.column("inside")[0].as_py()))
            values, start = part.column("value"), part.column("id")[0].as_py()
            quoted = set(_quoted(values))
            for k, line in enumerate(values.to_pylist()):
                collector.add(line, start + k, k in quoted)
        yield from collector.taken()
    collector.end()
    yield from collector.taken()


def records(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """``file``, ``block``, ``id``, ``first`` and ``text`` of every record of ``rows`` (what ``lines`` gives).

    ``first`` marks the first record of a file that is not blank, which is its header if it has one. A field that is not closed
    goes on to the end of its file.
    """
    inside = materialize(begun_inside(blocks).withColumn("inside", F.lit(True)), "csv-inside")
    n = inside.limit(MOST_SENT + 1).count()
    if n == 0:
        marked = rows.withColumn("inside", F.lit(False))
    elif n <= MOST_SENT:
        marked = rows.join(F.broadcast(inside), ["file", "block"], "left")
    else:
        marked = rows.join(inside, ["file", "block"], "left").repartition("file", "block").sortWithinPartitions("file", "block", "id")
    marked = marked.select("file", "block", "id", "value", F.coalesce("inside", F.lit(False)).alias("inside"))
    found = marked.mapInArrow(_pieces, "file string, block long, id long, kind int, first boolean, text string")
    whole = found.where(F.col("kind") == WHOLE)
    if n:
        order = F.struct("block", F.when(F.col("kind") == REST, 0).otherwise(1).alias("k"))
        fragments = found.where(F.col("kind") != WHOLE).withColumn("at", order)
        # All behind an opening one, up to the next, are of its record: in order of the blocks, as many openings as before it.
        opened = fragments.where(F.col("kind") == OPEN).groupBy("file").agg(F.sort_array(F.collect_list("at")).alias("openings"))
        number = F.size(F.filter("openings", lambda o: o <= F.col("at")))
        joined = fragments.join(opened, "file").groupBy("file", number.alias("number")).agg(
            F.min("block").alias("block"), F.min_by("id", "at").alias("id"), F.max("first").alias("first"),
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "text"))), lambda f: f["text"]), "\n").alias("text"),
        )
        whole = whole.drop("kind").unionByName(joined.drop("number"))
    else:
        whole = found  # what is open at the end of a block is so at the end of its file
    return whole.select("file", "block", "id", "first", F.regexp_replace("text", "\r$", "").alias("text"))
