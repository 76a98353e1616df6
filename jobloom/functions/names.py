"""Employer names: cleaning, slugs and similarity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobloom.functions.subsequence import common_subsequence_length
from jobloom.functions.terms import WORD_CHAR
from jobloom.functions.text import SPACE
from jobloom.lexicon import NAME_NOISE


def clean_employer_name(name: Column, noise: tuple[str, ...] = NAME_NOISE) -> Column:
    """Legal forms and filler deleted in list order, then lower case without white space."""
    out = name
    for part in noise:
        out = F.replace(out, F.lit(part), F.lit(""))
    return F.regexp_replace(F.lower(out), SPACE, "")


def match_form(name: Column) -> Column:
    """The form in which names are compared: cleaned, every other character than a letter, digit or ``_`` a space."""
    cleaned = F.regexp_replace(clean_employer_name(name), "[^" + WORD_CHAR[1:], " ")
    return F.trim(F.lower(cleaned))


def company_slug(url: Column) -> Column:
    """The part of a company URL after the last ``organization/``; null if empty or percent-encoded from the start."""
    slug = F.substring_index(url, "organization/", -1)
    return F.when((slug != "") & ~slug.startswith("%"), slug)


def unescape_state(text: Column) -> Column:
    """Undo the escaping of page state; ``&a;`` comes first, so ``&a;q;`` ends as a quote."""
    # Escape sequences and what they stand for, in order.
    for sequence, char in (("&a;", "&"), ("&q;", '"'), ("&s;", "'"), ("&l;", "<"), ("&g;", ">")):
        text = F.replace(text, F.lit(sequence), F.lit(char))
    return text


def sort_tokens(text: Column) -> Column:
    words = F.filter(F.split(text, SPACE + "+"), lambda w: w != "")
    return F.array_join(F.array_sort(words), " ")


def similarity(a: Column, b: Column) -> Column:
    """100 x (1 - insertions and deletions / total length)."""
    total = F.length(a) + F.length(b)
    return F.when(total == 0, F.lit(100.0)).otherwise(common_subsequence_length(a, b) * 200.0 / total)


def token_sort_ratio(a: Column, b: Column) -> Column:
    return similarity(sort_tokens(a), sort_tokens(b))
