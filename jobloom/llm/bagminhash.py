"""Near-duplicates by BagMinHash over multisets of word shingles.

The weight of a shingle is how often it stands in the text. Weights are discretised by whole numbers and covered by the
intervals [0, 1), [1, 2), [2, 4), [4, 8) and so on. Each shingle and interval has a Poisson process in time, of a rate that
is the interval's length times the number of registers; every point of it falls on a register and on a place in the
interval, whose binary digits are the path down the tree of halves. A point counts where its place is below the weight. A
register keeps the earliest point of the whole text, so two texts agree in it with the probability of their weighted Jaccard
similarity. Points are made in time order and only up to the time by which all registers are filled, which is short for a
large text: the work of a text is about its shingles plus registers * log(registers).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom.llm.common import gathered, in_slices, modest_batches
from jobloom.llm.components import components
from jobloom.llm.shingles import Shingler, mixed, numbered
from jobloom.scratch import materialize

#: Registers in bands of four: a pair of similarity 0.8 shares none of the 24 bands in 3 of a million cases.
BANDS, ROWS = 24, 4
REGISTERS = BANDS * ROWS
THRESHOLD = 0.8
#: Further texts of a bucket that all others of it are compared with.
PIVOTS = 3
#: A block of the last comparison: texts, shingles, and shingles looked at together.
BLOCK_TEXTS, BLOCK_SHINGLES, COLUMNS = 256, 2_000_000, 8192
FRAME_CHARS = 500_000
_GAMMA, _OTHER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(owner: np.ndarray, value: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Registers (earliest times) of ``n`` texts from their distinct shingles; infinite where a text has none."""
    registers = np.full(n * REGISTERS, np.inf)
    total = np.bincount(owner, weight, n)
    # One process for each shingle and interval that begins below its weight.
    levels = np.ceil(np.log2(weight)).astype(np.int64) + 1
    shingle = np.repeat(np.arange(len(owner)), levels)
    level = np.arange(len(shingle)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level == 0, 0.0, 2.0 ** (level - 1))
    length = np.where(level == 0, 1.0, low)
    seed = mixed(value[shingle] + level.astype(np.uint64) * _OTHER)
    text, limit = owner[shingle], weight[shingle]

    needed = total > 0
    until = np.where(needed, (np.log(REGISTERS) + 3) / np.maximum(total, 1), 0.0)
    while needed.any():
        run = np.flatnonzero(needed[text])
        time = np.zeros(len(run))
        step = 0
        while len(run):
            step += 1
            draw = mixed(seed[run] + np.uint64(step * int(_GAMMA) & 0xFFFFFFFFFFFFFFFF))
            time -= np.log(_uniform(draw)) / (length[run] * REGISTERS)
            early = time < until[text[run]]
            run, time, draw = run[early], time[early], draw[early]
            place = mixed(draw ^ _OTHER)
            register = (place >> np.uint64(32)) % np.uint64(REGISTERS)
            height = low[run] + length[run] * ((place & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32)
            counts = height < limit[run]
            spot = text[run[counts]] * REGISTERS + register[counts].astype(np.int64)
            np.minimum.at(registers, spot, time[counts])
        open_ = np.isinf(registers.reshape(n, REGISTERS)).any(axis=1) & (total > 0)
        until[open_] *= 2
        needed = open_
    return registers.reshape(n, REGISTERS)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band: equal where all its registers are."""
    bits = registers.view(np.uint64).reshape(len(registers), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _GAMMA, bits.shape[:2])
    for r in range(ROWS):
        key = mixed(key + bits[:, :, r])
    return key.view(np.int64)


BANDED = pa.schema([("node", pa.binary()), ("bands", pa.list_(pa.int64()))])
BAGGED = pa.schema([("node", pa.binary()), ("bag", pa.binary())])


def _bands(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    shingler = Shingler()
    for frame in gathered(frames, "text", FRAME_CHARS):
        owner, value, weight = numbered(*shingler.shingles(frame["text"]))
        keys = band_keys(signatures(owner, value, weight, len(frame)))
        some = np.bincount(owner, minlength=len(frame)) > 0
        yield pd.DataFrame({"node": frame["node"], "bands": [k if s else [] for k, s in zip(keys, some, strict=True)]})


def _bags(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each text as a sorted set of 64-bit numbers, one for each time that a shingle stands in it."""
    shingler = Shingler()
    for frame in gathered(frames, "text", FRAME_CHARS):
        owner, value, weight = numbered(*shingler.shingles(frame["text"]))
        again = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
        item, of = mixed(np.repeat(value, weight) + again.astype(np.uint64) * _OTHER), np.repeat(owner, weight)
        item = item[np.lexsort((item, of))]
        ends = np.cumsum(np.bincount(of, minlength=len(frame)))
        bags = [item[a:b].tobytes() for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        yield pd.DataFrame({"node": frame["node"], "bag": bags})


def _similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    found = []
    for x, y in zip(a, b, strict=True):
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        both = np.concatenate([x, y])
        both.sort(kind="stable")
        common = int((both[1:] == both[:-1]).sum())
        found.append(common / max(1, len(both) - common))
    return pd.Series(found, dtype="float64")


def text_id(text: Column) -> Column:
    """128 bits that stand for a text; null for null."""
    return F.unhex(F.md5(text.cast("binary")))


def _verified(pairs: DataFrame, bags: DataFrame, *keep: str) -> DataFrame:
    """``pairs`` (a, b, columns to keep) of texts with their similarity: the overlap of their multisets of shingles, counted in full.

    Bags go along with the second text of a pair, of which a text has few; the first may be that of very many pairs.
    """
    pairs = pairs.join(bags.select(F.col("node").alias("b"), F.col("bag").alias("bag_b")), "b")
    pairs = pairs.join(bags.select(F.col("node").alias("a"), F.col("bag").alias("bag_a")).hint("merge"), "a")
    likeness = F.pandas_udf(_similarity, T.DoubleType())
    return pairs.select("a", "b", *keep, likeness("bag_a", "bag_b").alias("similarity"))


def _of_several(rows: DataFrame) -> DataFrame:
    """``rows`` (bucket, root, ...) of the buckets that hold more than one class."""
    several = rows.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y")
    return rows.join(several.select("bucket"), "bucket", "left_semi")


def _undecided(places: DataFrame, root: DataFrame) -> DataFrame:
    """Texts of the buckets that hold more than one class, with their class."""
    rows = places.join(root.withColumnRenamed("vertex", "node"), "node", "left")
    return _of_several(rows.withColumn("root", F.coalesce("root", "node")))


def _alone(nodes: DataFrame, bags: DataFrame) -> DataFrame:
    """For each of ``nodes``, its shingles (n) and those of them (u) that no other of the nodes has."""
    own = bags.join(nodes.select("node").distinct(), "node", "left_semi")
    each = own.mapInPandas(_items, "node binary, item long")
    single = each.groupBy("item").agg(F.min("node").alias("node"), F.count("*").alias("k")).where("k = 1")
    single = single.groupBy("node").agg(F.count("*").alias("u"))
    sized = own.select("node", (F.length("bag") / 8).cast("long").alias("n"))
    return sized.join(single, "node", "left").fillna(0, "u")


def _items(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        bags = [np.frombuffer(b, np.int64) for b in frame["bag"]]
        node = np.repeat(frame["node"].to_numpy(), [len(b) for b in bags])
        yield pd.DataFrame({"node": node, "item": np.concatenate(bags) if bags else np.zeros(0, np.int64)})


def _overlaps(bags: list[np.ndarray]) -> np.ndarray:
    """Sizes of the overlaps of all pairs of a block of bags, by products of matrices of bounded size."""
    owner = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    _, item, times = np.unique(np.concatenate(bags), return_inverse=True, return_counts=True)
    shared = times[item] > 1
    owner, item = owner[shared], np.unique(item[shared], return_inverse=True)[1]
    order = np.argsort(item, kind="stable")
    owner, item = owner[order], item[order]
    common = np.zeros((len(bags), len(bags)))
    for low in range(0, int(item[-1]) + 1 if len(item) else 0, COLUMNS):
        part = slice(*np.searchsorted(item, [low, low + COLUMNS]))
        has = np.zeros((len(bags), COLUMNS), np.float32)
        has[owner[part], item[part] - low] = 1
        common += has @ has.T
    return common


def _links_of_block(frame: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links between texts of different classes in a block, as many as it takes to join the classes that are linked."""
    common, n = _overlaps([np.frombuffer(b, np.uint64) for b in frame["bag"]]), frame["n"].to_numpy()
    root = np.unique(np.array([bytes(r).hex() for r in frame["root"]]), return_inverse=True)[1]
    linked = common >= threshold * (n[:, None] + n[None, :] - common)
    one, two = np.nonzero(np.triu(linked & (root[:, None] != root[None, :])))
    above = list(range(len(frame)))

    def top(k: int) -> int:
        while above[k] != k:
            above[k] = above[above[k]]
            k = above[k]
        return k

    kept = []
    for k, (x, y) in enumerate(zip(root[one].tolist(), root[two].tolist(), strict=True)):
        x, y = top(x), top(y)
        if x != y:
            above[x] = y
            kept.append(k)
    node = frame["node"].to_numpy()
    return pd.DataFrame({"a": node[one[kept]], "b": node[two[kept]]}, columns=["a", "b"])


def _late_links(open_: DataFrame, bags: DataFrame, threshold: float) -> DataFrame:
    """Links between the classes of a bucket, found block by block: a block meets itself and each other block of its bucket.

    ``open_`` has bucket, node, root and n. The bound on a block holds for its texts and for their shingles, so one task
    holds two blocks at most, and nothing but links leaves it.
    """
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_TEXTS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    rows = open_.join(open_.groupBy("bucket").agg(blocks.alias("blocks")), "bucket")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("node", "root", "n", "bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    found = rows.join(bags, "node").groupBy("bucket", "i", "j").applyInPandas(
        lambda frame: _links_of_block(frame, threshold), "a binary, b binary"
    )
    return found.distinct()


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The key of each document and ``class_id``, the least key of the documents it is linked with, over any number of links.

    A link joins equal texts, and texts whose multisets of five-word shingles have a Jaccard similarity of ``threshold`` or
    more (down to about 0.8 no such pair escapes the bands). A null text is linked with none: its class is its own key. Empty
    and wordless texts are linked with equal ones only. Repeated rows and repeated keys come back as often. An empty table
    gives an empty result.

    All texts of a bucket are compared with its first, then with the PIVOTS texts nearest to that, which in a group of
    copies are the least changed ones. Where a bucket still holds several classes, the texts that may yet have a link
    (shingles that no other of them has are in no overlap) are compared in blocks, inside tasks.
    """
    modest_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), text_id(F.col(text)).alias("node"))
    known = rows.where("text IS NOT NULL")
    banded = known.select("node", "text").mapInArrow(in_slices(_bands, BANDED), "node binary, bands array<long>")
    nodes = materialize(banded.groupBy("node").agg(F.first("bands").alias("bands")), "bands")
    places = nodes.select("node", F.explode("bands").alias("bucket"))
    buckets = places.groupBy("bucket").agg(F.min("node").alias("a"), F.count("*").alias("k")).where("k > 1")
    places = materialize(places.join(buckets.select("bucket", "a"), "bucket"), "places")
    texts = known.groupBy("node").agg(F.first("text").alias("text"))  # one copy of a text leaves each task
    texts = texts.join(places.select("node").distinct(), "node", "left_semi")
    bags = materialize(texts.mapInArrow(in_slices(_bags, BAGGED), "node binary, bag binary"), "bags")

    pairs = places.where("node <> a").select("a", F.col("node").alias("b")).distinct()
    checked = materialize(_verified(pairs, bags), "pairs")
    enough = F.col("similarity") >= threshold
    first = checked.where(enough).select("a", "b")
    root = materialize(components(first, "a", "b"), "roots")

    far = checked.select("a", F.col("b").alias("node"), (1 - F.col("similarity")).alias("far"))
    open_ = materialize(_undecided(places, root).join(far, ["a", "node"]).drop("a"), "open")  # first texts are done with
    near = Window.partitionBy("bucket").orderBy("far", "node")
    pivots = open_.withColumn("r", F.row_number().over(near)).where(F.col("r") <= PIVOTS)
    pivots = pivots.select("bucket", F.col("node").alias("a"), F.col("root").alias("of"))
    pairs = open_.join(pivots, "bucket").where((F.col("root") != F.col("of")) & (F.col("node") != F.col("a")))
    pairs = pairs.groupBy("a", F.col("node").alias("b")).agg(F.min("of").alias("of"))
    second = materialize(_verified(pairs, bags, "of").where(enough), "links")

    # A text linked with a pivot goes by the pivot's class from here on; whole classes are joined at the end.
    now = second.groupBy(F.col("b").alias("node")).agg(F.min("of").alias("of"))
    open_ = open_.join(now, "node", "left").withColumn("root", F.coalesce("of", "root"))
    open_ = _of_several(open_.select("bucket", "node", "root"))
    open_ = materialize(open_.join(_alone(open_, bags), "node"), "open")
    open_ = open_.where(F.col("n") - F.col("u") >= threshold * F.col("n"))
    third = materialize(_late_links(open_.drop("u"), bags, threshold), "links")
    root = materialize(components(first.unionByName(second.select("a", "b")).unionByName(third), "a", "b"), "roots")

    # Counts by class first: a class may hold a third of all rows.
    members = rows.select("key", "node").join(root.withColumnRenamed("vertex", "node"), "node", "left")
    members = members.withColumn("class", F.coalesce("root", "node"))
    least = members.where("class IS NOT NULL").groupBy("class").agg(F.min("key").alias("least"))
    found = members.join(least, "class", "left")
    return found.select(F.col("key").alias(key), F.coalesce("least", "key").alias("class_id"))


def class_documents(documents: DataFrame) -> DataFrame:
    """Result of the query: the class of every document."""
    return classes(documents.select("doc_id", "text"))
