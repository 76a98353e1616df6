"""The trie of conversation prefixes: which beginnings conversations share, and what storing each once would save.

A node is a distinct sequence of first turns. It is named by its depth and a digest of 128 bits, the exclusive or of digests of
(depth, turn) along the path, so digests of a long conversation come from blocks of it that are added up afterwards.

* Tasks enter the digests of all prefixes into a count-min sketch of two lanes whose counters end at two. The lanes are merged
  by Spark, cell range by cell range; the sketch has a bounded size, whatever the number of prefixes.
* An estimate of one proves that only one conversation has the prefix, and so every longer one of that conversation: these nodes,
  the tails, are given out by the task that holds them.
* Only prefixes that may be shared are grouped by their digest. A prefix that only seemed shared comes out with one member, so the
  result does not depend on the sketch.

The smallest member of a node owns it. A conversation owns the nodes from some depth of its path on, so what is summed over a
subtree is the sum of what each of its conversations owns in all, less what the owner of the subtree's top owns above that top: one
more grouping of the same rows, and no row for a node and its ancestor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobloom.llm.common import give_back
from jobloom.scratch import materialize

#: Rows of one key that a task adds up in order; further blocks are offset by the sums of the blocks before.
BLOCK = 512
#: Cells of a lane of the sketch: four for each prefix, between these bounds. A cell takes two bits.
LEAST_CELLS, MOST_CELLS, CELLS_A_PREFIX = 1 << 12, 1 << 25, 4
RANGE, FIRST_MERGES = 1 << 15, 64
#: Characters of joined ids that travel as one row.
JOINED_CHARS = 1 << 14
NODE = ["depth", "p1", "p2"]
PARENT = ["up", "q1", "q2"]


def numbered(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """``rows`` with ``place``, 1, 2, ... within ``key`` by ``order``, as a written table.

    Rows are sorted by ranges over all tasks, so a key with any share of the rows is spread over many. Each task numbers its own,
    and the numbers go on from one task to the next: the last key of every task, a row each, passes the driver.
    """
    schema = rows.select("*", F.lit(0).alias("_part"), F.lit(0).cast("long").alias("_local"), F.lit(False).alias("_last")).schema
    ranged = rows.repartitionByRange(F.col(key), *order).sortWithinPartitions(F.col(key), *order)

    def of_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key_now, local_now = None, None, 0

        def with_last(batch: pa.RecordBatch, final: bool) -> pa.RecordBatch:
            last = np.zeros(batch.num_rows, bool)
            last[-1] = final
            return batch.append_column("_last", pa.array(last))

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key)
            new = np.ones(len(keys), bool)
            new[1:] = pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
            at = np.arange(len(keys))
            start = np.maximum.accumulate(np.where(new, at, 0))
            local = at - start + 1
            if keys[0].as_py() == key_now:
                local[start == 0] += local_now
            key_now, local_now = keys[-1].as_py(), int(local[-1])
            if held is not None:
                yield with_last(held, False)
            held = batch.append_column("_local", pa.array(local, pa.int64()))
        if held is not None:
            yield with_last(held, True)

    local = materialize(ranged.withColumn("_part", F.spark_partition_id()).mapInArrow(of_task, schema), "numbered")
    ends = sorted(local.where("_last").select("_part", key, "_local").collect(), key=lambda r: r["_part"])
    before, run = [], None
    for r in ends:
        run = (r[key], run[1] + r["_local"]) if run and run[0] == r[key] else (r[key], r["_local"])
        before.append((r["_part"], *run))
    following = [(here["_part"], run_key, n) for (_, run_key, n), here in zip(before, ends[1:], strict=False)]
    kind = rows.schema[key].dataType.simpleString()
    offsets = rows.sparkSession.createDataFrame(following, f"_part int, _key {kind}, _before long")
    here = (local["_part"] == offsets["_part"]) & (local[key] == offsets["_key"])
    joined = local.join(F.broadcast(offsets), here, "left").drop(offsets["_part"])  # a row for each task
    return joined.withColumn("place", F.col("_local") + F.coalesce("_before", F.lit(0))).drop("_part", "_key", "_before", "_local", "_last")


def running(rows: DataFrame, key: str, depth: str, values: Mapping[str, tuple], merged: Mapping[str, Column]) -> DataFrame:
    """``rows`` (a written table) with values added up along ``depth`` within ``key``, block by block.

    ``values`` gives for each new column the aggregate function of a column and that column; ``merged`` how the value within the
    block (the column) and that of all blocks before (``_before_`` and its name) make the whole.
    """
    blocked = rows.withColumn("_block", F.floor(F.col(depth) / BLOCK).cast("long"))
    within = Window.partitionBy(key, "_block").orderBy(depth).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = blocked.groupBy(key, "_block").agg(*[f(c).alias(name) for name, (f, c) in values.items()])
    long = totals.withColumn("_blocks", F.count("*").over(Window.partitionBy(key))).where("_blocks > 1")
    offsets = long.select(key, "_block", *[F.sum(name).over(earlier).alias(f"_before_{name}") if f is F.sum else f(name).over(earlier).alias(f"_before_{name}") for name, (f, _) in values.items()])
    out = blocked.withColumns({name: f(c).over(within) for name, (f, c) in values.items()})
    out = out.join(offsets, [key, "_block"], "left").withColumns(dict(merged))
    return out.drop("_block", *[f"_before_{name}" for name in values])


def numbered_turns(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv``, ``place`` (from 1), ``a`` and ``b`` (a digest of role and text) and ``bytes`` of the text, for every turn.

    Turns are ordered by their number, null first; of one number by their digests. Null roles and texts are empty. Rows without a
    key belong to no conversation and are left out. Texts do not leave the task that reads them.
    """
    said, words = F.coalesce(F.col(f"`{role}`"), F.lit("")), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    digest = F.md5(F.concat_ws(":", F.octet_length(said).cast("string"), said, words).cast("binary"))
    rows = turns.where(F.col(f"`{key}`").isNotNull()).select(
        F.col(f"`{key}`").alias("conv"), F.col(f"`{turn}`").alias("turn"),
        F.conv(F.substring(digest, 1, 16), 16, -10).cast("long").alias("a"), F.conv(F.substring(digest, 17, 16), 16, -10).cast("long").alias("b"),
        F.octet_length(words).cast("long").alias("bytes"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("a"), F.col("b")]
    return numbered(rows, "conv", order).drop("turn")


class Sketch:
    """Count-min counters that end at two, as two bits a cell: seen, and seen again."""

    def __init__(self, cells: int):
        self.cells = cells
        self.seen = np.zeros((2, cells), bool)
        self.again = np.zeros((2, cells), bool)

    def add(self, p1: np.ndarray, p2: np.ndarray) -> None:
        for lane, p in enumerate((p1, p2)):
            cell, n = np.unique(p & (self.cells - 1), return_counts=True)
            self.again[lane, cell[self.seen[lane, cell] | (n > 1)]] = True
            self.seen[lane, cell] = True

    def rows(self, part: int) -> Iterator[dict]:
        """The ranges of cells in which something was seen."""
        for lane in range(2):
            for k in range(0, self.cells, RANGE):
                seen, again = self.seen[lane, k : k + RANGE], self.again[lane, k : k + RANGE]
                if seen.any():
                    yield {"lane": lane, "cells": k, "part": part % FIRST_MERGES, "seen": np.packbits(seen).tobytes(), "again": np.packbits(again).tobytes()}


def _merged(group: pd.DataFrame) -> pd.DataFrame:
    seen = again = None
    for s, t in zip(group["seen"], group["again"], strict=True):
        s, t = np.frombuffer(s, np.uint8), np.frombuffer(t, np.uint8)
        seen, again = (s, t) if seen is None else (seen | s, again | t | (seen & s))
    return pd.DataFrame({"lane": group["lane"].iloc[:1], "cells": group["cells"].iloc[:1], "part": group["part"].iloc[:1], "seen": [seen.tobytes()], "again": [again.tobytes()]})


def sketched(paths: DataFrame, prefixes: int) -> list[np.ndarray]:
    """For each lane the packed bits of the cells that at least two prefixes of ``paths`` fall into; bounded by MOST_CELLS."""
    cells = LEAST_CELLS
    while cells < min(MOST_CELLS, CELLS_A_PREFIX * prefixes):
        cells *= 2

    def of_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, part = None, 0
        for batch in batches:
            if batch.num_rows:
                sketch, part = sketch or Sketch(cells), batch.column("part")[0].as_py()
                sketch.add(batch.column("p1").to_numpy(), batch.column("p2").to_numpy())
        if sketch:
            yield from pa.Table.from_pylist(list(sketch.rows(part)), kinds).to_batches()
        give_back()

    kinds = pa.schema([("lane", pa.int32()), ("cells", pa.int32()), ("part", pa.int32()), ("seen", pa.binary()), ("again", pa.binary())])
    schema = "lane int, cells int, part int, seen binary, again binary"
    parts = paths.select("p1", "p2", F.spark_partition_id().alias("part")).mapInArrow(of_task, schema)
    parts = parts.groupBy("lane", "cells", "part").applyInPandas(_merged, schema)  # so that no group holds a row of every task
    merged = parts.groupBy("lane", "cells").applyInPandas(_merged, schema)
    lanes = [np.zeros(cells // 8, np.uint8) for _ in range(2)]
    for r in merged.select("lane", "cells", "again").collect():  # two bits of at most MOST_CELLS cells
        again = np.frombuffer(r["again"], np.uint8)
        lanes[r["lane"]][r["cells"] // 8 : r["cells"] // 8 + len(again)] = again
    return lanes


def screened(paths: DataFrame, lanes: list[np.ndarray]) -> DataFrame:
    """``paths`` with ``shared`` and ``up_shared``: whether the sketch leaves it open that others have the prefix, or its parent."""
    mask = len(lanes[0]) * 8 - 1
    sent = paths.sparkSession.sparkContext.broadcast(lanes)

    def open_(p1: np.ndarray, p2: np.ndarray) -> np.ndarray:
        bits = [lane[(p & mask) >> 3] >> (7 - ((p & mask) & 7)).astype(np.uint8) & 1 for lane, p in zip(sent.value, (p1, p2), strict=True)]
        return (bits[0] & bits[1]).astype(bool)

    def of_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p1, p2, q1, q2 = (batch.column(c).to_numpy() for c in ("p1", "p2", "q1", "q2"))
            top = batch.column("up").to_numpy() == 0  # the root is not in the sketch
            yield batch.append_column("shared", pa.array(open_(p1, p2))).append_column("up_shared", pa.array(top | open_(q1, q2)))

    return paths.mapInArrow(of_task, paths.withColumns({"shared": F.lit(True), "up_shared": F.lit(True)}).schema)


def ends_digests(ends: DataFrame) -> DataFrame:
    """For each node (NODE) the SHA-256 of the ``conv`` of its rows in ascending order, joined by commas, as ``ends_sha256``.

    Rows are sorted by ranges over all tasks and joined to texts of about JOINED_CHARS; these are hashed in order, one node's in one
    task, which holds one text at a time. So much is in the nature of a digest of all ids.
    """
    ranged = ends.select(*NODE, "conv").repartitionByRange(*NODE, "conv").sortWithinPartitions(*NODE, "conv")
    kind = ends.schema["conv"].dataType.simpleString()

    def chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, held, size = None, None, [], 0
        for batch in batches:
            out = []
            for *here, conv in zip(*(batch.column(c).to_pylist() for c in (*NODE, "conv")), strict=True):
                if held and (here != node or size >= JOINED_CHARS):
                    out.append((*node, first, ",".join(held)))
                    held, size = [], 0
                if not held:
                    node, first = here, conv
                held.append(str(conv))
                size += len(held[-1]) + 1
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate([pa.int64()] * 3 + [batch.column("conv").type, pa.string()])], [*NODE, "first", "ids"])
            last_type = batch.column("conv").type
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*node, first, ",".join(held)), [pa.int64()] * 3 + [last_type, pa.string()], strict=True)], [*NODE, "first", "ids"])

    def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, hashing = None, None

        def finished(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate([pa.int64()] * 3 + [pa.string()])], [*NODE, "ends_sha256"])

        for batch in batches:
            out = []
            for *here, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids")), strict=True):
                if here != node:
                    if hashing:
                        out.append((*node, hashing.hexdigest()))
                    node, hashing = here, hashlib.sha256(ids.encode())
                else:
                    hashing.update(("," + ids).encode())
            yield finished(out)
        if hashing:
            yield finished([(*node, hashing.hexdigest())])

    types = "depth long, p1 long, p2 long"
    joined = ranged.mapInArrow(chunks, f"{types}, first {kind}, ids string")
    dealt = joined.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return dealt.select(*NODE, "ids").mapInArrow(digests, f"{types}, ends_sha256 string")


def with_digests(paths: DataFrame) -> DataFrame:
    """``paths`` (``conv``, ``depth``, ``a``, ``b``, a written table) with the names of each prefix (NODE) and of its parent (PARENT)."""
    paths = paths.withColumns({"u1": F.xxhash64("a", "b", "depth"), "u2": F.xxhash64("depth", "b", "a", F.lit(1))})
    merged = {c: F.col(c).bitwiseXOR(F.coalesce(f"_before_{c}", F.lit(0))) for c in ("p1", "p2")}
    out = running(paths, "conv", "depth", {"p1": (F.bit_xor, "u1"), "p2": (F.bit_xor, "u2")}, merged)
    return out.withColumns({"up": F.col("depth") - 1, "q1": F.col("p1").bitwiseXOR(F.col("u1")), "q2": F.col("p2").bitwiseXOR(F.col("u2"))}).drop("a", "b", "u1", "u2")


def prefix_trie(paths: DataFrame, members: DataFrame) -> DataFrame:
    """A row for every node of the trie of ``members`` (``conv``, ``size``), whose turns are ``paths``.

    ``paths`` has ``conv``, ``depth`` (1 to size, each once), ``a`` and ``b`` (a turn's digest) and ``bytes``; ``members`` has each
    ``conv`` once. Both must be written tables, as they are read several times. The result has ``conv`` (the smallest member),
    ``depth``, ``parent_conv`` (null at the root), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``. A
    table without members gives no node, one whose members have no turns gives the root.
    """
    sized = paths.join(members, "conv").withColumn("end", F.col("depth") == F.col("size")).drop("size")
    known = materialize(with_digests(materialize(sized, "trie-turns")), "trie-paths")
    marked = materialize(screened(known, sketched(known, known.count())), "trie-screened")
    nil = F.lit(None).cast("long")
    roots = members.select(
        "conv", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("bytes"), (F.col("size") == 0).alias("end"),
        F.lit(0).cast("long").alias("p1"), F.lit(0).cast("long").alias("p2"), nil.alias("up"), nil.alias("q1"), nil.alias("q2"),
        F.lit(True).alias("shared"), F.lit(False).alias("up_shared"),
    )
    heads, tails = marked.where("shared").unionByName(roots), marked.where("NOT shared")

    nodes = heads.groupBy(*NODE).agg(
        F.count("*").alias("n_convs"), F.min("conv").alias("owner"), F.max("bytes").alias("bytes"),
        *[F.max(c).alias(c) for c in (*PARENT, "up_shared")],
    )
    nodes = materialize(nodes.withColumn("weight", (F.col("n_convs") - 1) * F.col("bytes")), "trie-nodes")
    as_parent = [F.col(here).alias(name) for here, name in zip(PARENT, NODE, strict=True)]
    children = nodes.where("up_shared").select(*as_parent).unionAll(tails.where("up_shared").select(*as_parent))
    children = materialize(children.groupBy(*NODE).agg(F.count("*").alias("n_children")), "trie-children")

    childless = nodes.join(children, NODE, "left_anti").select(F.col("owner").alias("conv"), F.lit(0).cast("long").alias("weight"), F.lit(1).alias("leaf"))
    owned = nodes.select(F.col("owner").alias("conv"), "weight", F.lit(0).alias("leaf")).unionAll(childless)
    owned = owned.unionAll(tails.where("end").select("conv", F.lit(0).cast("long").alias("weight"), F.lit(1).alias("leaf")))
    owned = owned.groupBy("conv").agg(F.sum("weight").alias("weight"), F.sum("leaf").alias("leaf"))
    sums = heads.select(*NODE, "conv").join(owned, "conv").groupBy(*NODE).agg(F.sum("weight").alias("all_weight"), F.sum("leaf").alias("n_leaves"))

    whole = {"owned": F.col("owned") + F.coalesce("_before_owned", F.lit(0))}
    tops = running(nodes, "owner", "depth", {"owned": (F.sum, "weight")}, whole)  # down to the node itself
    tops = tops.join(sums, NODE).join(children, NODE, "left").join(ends_digests(heads.where("end")), NODE, "left")
    above = nodes.select(*[F.col(here).alias(name) for here, name in zip(NODE, PARENT, strict=True)], F.col("owner").alias("parent"))
    nobody = F.sha2(F.lit(b""), 256)
    columns = ["conv", "depth", "parent_conv", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    shared = tops.join(above, PARENT, "left").select(
        F.col("owner").alias("conv"), "depth",
        F.when(F.col("depth") > 0, F.coalesce("parent", "owner")).alias("parent_conv"),  # a parent that is not shared has the same member
        "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), F.col("n_leaves").cast("long").alias("n_leaves"),
        (F.col("all_weight") - F.col("owned") + F.col("weight")).alias("saved_tokens"),
        F.coalesce("ends_sha256", nobody).alias("ends_sha256"),
    )

    def alone(rows: DataFrame, parent: Column) -> DataFrame:
        """Nodes with one member, known without its neighbours."""
        one = F.lit(1).cast("long")
        return rows.select(
            "conv", "depth", parent.alias("parent_conv"), one.alias("n_convs"), F.when(F.col("end"), 0).otherwise(1).cast("long").alias("n_children"),
            one.alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
            F.when(F.col("end"), F.sha2(F.col("conv").cast("string").cast("binary"), 256)).otherwise(nobody).alias("ends_sha256"),
        )

    hanging = alone(tails.where("up_shared").join(above, PARENT), F.col("parent"))
    return shared.select(columns).unionByName(hanging).unionByName(alone(tails.where("NOT up_shared"), F.col("conv")))


def rebuild(places: DataFrame, step: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of another: paths and members for ``prefix_trie``.

    Conversation c takes the first h turns of c - c % step, h being crc32 of c's decimal digits modulo ``most``, and goes on with
    its own turns after its first h.
    """
    sizes = materialize(places.groupBy("conv").agg(F.count("*").alias("own")), "conversation-sizes")
    convs = sizes.withColumns({
        "base": F.col("conv") - F.col("conv") % step, "h": F.crc32(F.col("conv").cast("string").cast("binary")) % most,
    })
    bases = sizes.select(F.col("conv").alias("base"), F.col("own").alias("there"))
    convs = convs.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("there", F.lit(0))))
    convs = convs.withColumn("size", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    convs = materialize(convs.select("conv", "base", "h", "taken", "size"), "conversations")
    own = places.join(convs, "conv").where(F.col("place") > F.col("h"))
    own = own.select("conv", (F.col("taken") + F.col("place") - F.col("h")).alias("depth"), "a", "b", "bytes")
    begun = places.where(F.col("place") < most).withColumnRenamed("conv", "base").join(convs.where("taken > 0"), "base")
    begun = begun.where(F.col("place") <= F.col("taken")).select("conv", F.col("place").alias("depth"), "a", "b", "bytes")
    return own.unionByName(begun), convs.select("conv", "size")


def trie_conversations(conversations: DataFrame) -> DataFrame:
    """Result of the query: the prefix trie of all rebuilt conversations."""
    paths, members = rebuild(numbered_turns(conversations))
    found = prefix_trie(paths, members)
    return found.withColumnsRenamed({"conv": "conv_id", "parent_conv": "parent_conv_id"})
