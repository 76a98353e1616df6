"""The queries of this subpackage: each applies its operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from jobloom.llm import alignment, archive, archive_sql, bagminhash, bpe, extraction, fingerprints, language, mixing, pii, quality, quality_sql, scoring, trie, trie_sql, urls
from jobloom.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bagminhash": lambda spark, sf_dir: bagminhash.class_documents(read(spark, sf_dir, "documents")),
    "op2_quality": lambda spark, sf_dir: quality.judge_documents(read(spark, sf_dir, "documents")),
    "op3_language": lambda spark, sf_dir: language.identify_documents(read(spark, sf_dir, "documents")),
    "op4_bpe": lambda spark, sf_dir: bpe.encode_documents(read(spark, sf_dir, "documents")),
    "op5_urls": lambda spark, sf_dir: urls.judge_pages(read(spark, sf_dir, "pages")),
    "op6_scoring": lambda spark, sf_dir: scoring.score_documents(read(spark, sf_dir, "documents")),
    "op7_fingerprints": lambda spark, sf_dir: fingerprints.fingerprint_documents(read(spark, sf_dir, "documents")),
    "op8_html": lambda spark, sf_dir: extraction.extract_pages(read(spark, sf_dir, "pages")),
    "op9_pii": lambda spark, sf_dir: pii.detect_documents(read(spark, sf_dir, "documents")),
    "op10_mixing": lambda spark, sf_dir: mixing.mix_documents(read(spark, sf_dir, "documents")),
    "op11_archive": lambda spark, sf_dir: archive.archive_pages(read(spark, sf_dir, "pages")),
    "op12_alignment": lambda spark, sf_dir: alignment.align_documents(read(spark, sf_dir, "documents")),
    "op13_trie": lambda spark, sf_dir: trie.trie_conversations(read(spark, sf_dir, "conversations")),
    "pipeline": corpus_pipeline.run,
}
#: The others rest on models, signatures or seeded hashes, which SQL does not state; tests/llm compares them otherwise.
ORACLE: dict[str, str] = {"op2_quality": quality_sql.SQL, "op11_archive": archive_sql.SQL, "op13_trie": trie_sql.SQL} | (
    {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
)
