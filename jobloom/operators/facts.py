"""Posting columns, the relevance filter and the skill fact tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.lexicon import SKILL_SYNONYMS


def lookup(value: Column, mapping: Mapping[str, int | str]) -> Column:
    """The value's entry in a constant map; null if it has none."""
    out = F.lit(None)
    for key, entry in mapping.items():
        out = F.when(value == key, F.lit(entry)).otherwise(out)
    return out


def relevant(postings: DataFrame, more_than: int) -> DataFrame:
    """Postings with more than so many role terms; a null count fails."""
    return postings.filter(F.col("keyword_count") > more_than)


def canonical_skills(skills: Column, synonyms: Mapping[str, str] = SKILL_SYNONYMS) -> Column:
    """Synonyms replaced one by one; a name that results twice stays twice."""
    return F.transform(
        skills, lambda s: F.coalesce(F.create_map(*[F.lit(x) for kv in synonyms.items() for x in kv])[s], s)
    )


def skill_facts(
    postings: DataFrame,
    column: str,
    keep: Sequence[str] = ("key", "Month", "Job Role"),
    keep_empty: bool = True,
    synonyms: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per posting and distinct skill. With ``keep_empty`` a posting without skills keeps one row with null."""
    skills = F.array_sort(F.array_distinct(F.col(f"`{column}`")))
    if synonyms:
        skills = canonical_skills(skills, synonyms)
    unfold = F.explode_outer if keep_empty else F.explode
    return postings.select(*[F.col(f"`{k}`") for k in keep], unfold(skills).alias(column))


def soft_skill_facts(postings: DataFrame) -> DataFrame:
    return skill_facts(postings, "Soft Skills")


def industry_skill_facts(postings: DataFrame) -> DataFrame:
    return skill_facts(postings, "Industry Skills", synonyms=SKILL_SYNONYMS)


def tool_facts(postings: DataFrame) -> DataFrame:
    return skill_facts(postings, "Tools", keep_empty=False).filter(F.col("Tools").isNotNull())
