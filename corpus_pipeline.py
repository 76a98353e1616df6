"""A training corpus from raw documents: each stage reads what the one before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next stage's
documents. All but the last return the columns of ``documents``; repeated ids stay apart.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.llm import bagminhash, bpe, language, mixing, pii
from jobloom.llm.common import read, remainder
from jobloom.scratch import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their language as ``lang``, ``und`` where none could be learnt; null texts and those without a letter go."""
    found = language.identify(docs.select(*COLUMNS), learn_from=remainder(F.col("doc_id"), 4) != 2)
    found = found.where((F.col("score") > 0) | F.col("text").rlike(r"\p{L}"))
    return found.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def with_row(docs: DataFrame) -> DataFrame:
    """``docs`` with ``row``, a digest of all columns: what names a row from one reading to the next."""
    rows = docs.select(*COLUMNS)
    return rows.withColumn("row", F.md5(F.to_json(F.struct(*COLUMNS)).cast("binary")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: that of the least id, and of its rows the one of the least digest.

    Null texts are in no class and stay.
    """
    rows = with_row(docs)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    known = rows.where("text IS NOT NULL")
    classes = bagminhash.classes(known.select(place.alias("place"), "text"), key="place")
    kept = classes.select(F.col("class_id.row").alias("row")).distinct()
    one_each = known.join(kept, "row", "left_semi").dropDuplicates(["row"])
    return one_each.select(*COLUMNS).unionByName(docs.where("text IS NULL").select(*COLUMNS))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, spans of personal data replaced by their kind; ``n_chars`` is that of the new text."""
    found = pii.redact(pii.detect(docs.select(*COLUMNS)))
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each copy that it takes of a document."""
    rows = with_row(docs)
    found, _ = mixing.mix(rows, "doc_id", "text", F.array("source"), keep=["row"])
    wanted = found.groupBy("row").agg(F.sum("copies").alias("copies")).where("copies > 0")
    copies = rows.dropDuplicates(["row"]).join(wanted, "row")
    return copies.select(*COLUMNS, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*COLUMNS)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (packed, little-endian, 32 bits) of every document of the mix, and the text that they decode to."""
    found = bpe.encode(docs.select(*COLUMNS), bpe.public_vocabulary())
    return found.select("doc_id", "lang", "source", "n_tokens", "ids", "decoded")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language", identify_languages),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode_texts),
]
#: No SQL states models and similarities; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each written before the next begins."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
