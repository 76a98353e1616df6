"""Lexicon extraction as ``Column`` functions.

Word and delimited extraction read the text once, whatever the number of terms (word extraction once more if some terms
begin with no word character): one regular expression whose alternatives share their prefixes captures the longest term of a
position. The shorter terms that also hold at that position are prefixes of the captured one, so they follow from a constant
map. Most positions are settled by the character there, so that costs most: an expression begins with a class of single
characters, which Java looks up in a table, and only where it fits come Unicode classes and alternatives.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_CHAR = r"[\p{L}\p{N}_]"
DELIMITER = "[.; ,]"

# Word characters written one by one: a range, or what is not Latin-1, would make the class a chain of comparisons.
_PLAIN_WORD = "abcdefghijklmnopqrstuvwxyz0123456789_"
_HEADS_TOGETHER = 6

_JAVA_SPECIAL = re.compile(r"([\\^$.|?*+()\[\]{}&#~\-])")


def quote(term: str) -> str:
    """The term as a literal inside a Java regular expression."""
    return _JAVA_SPECIAL.sub(r"\\\1", term)


def fold_case(text: Column) -> Column:
    """Lower case in which the four letters that case-blind matching equates with ASCII letters become those letters."""
    special = F.when(text.rlike("[İıſK]"), F.translate(text, "İıſK", "iisk")).otherwise(text)
    return F.lower(special)


def _is_word(char: str) -> bool:
    return char == "_" or char.isalnum()


def _word_end(term: str) -> str:
    return f"(?!{WORD_CHAR})" if _is_word(term[-1]) else f"(?={WORD_CHAR})"


def _word_start(term: str) -> str:
    return f"(?<!{WORD_CHAR})" if _is_word(term[0]) else f"(?<={WORD_CHAR})"


def _prefix_tree(terms: Sequence[str], end) -> str:
    """Alternatives for ``terms`` with shared prefixes, longest first; ``end(term)`` is what must follow a term."""
    by_head: dict[str, list[str]] = {}
    for term in sorted(set(terms)):
        by_head.setdefault(term[0], []).append(term)

    def branch(group: list[str], depth: int) -> str:
        shared = depth
        while all(len(t) > shared and t[shared] == group[0][shared] for t in group):
            shared += 1
        text = quote(group[0][depth:shared])
        longer: dict[str, list[str]] = {}
        for t in group:
            if len(t) > shared:
                longer.setdefault(t[shared], []).append(t)
        options = [branch(g, shared) for g in longer.values()]
        options += [end(t) for t in group if len(t) == shared]
        return text + (options[0] if len(options) == 1 else f"(?:{'|'.join(options)})")

    return "|".join(branch(g, 0) for g in by_head.values())


def _heads(terms: Sequence[str]) -> str:
    return "".join(sorted({quote(t[0]) for t in terms}))


def _tree_by_heads(terms: Sequence[str], end) -> str:
    """As ``_prefix_tree``, a few first characters at a time: most words begin no term and fail a few classes."""
    heads = sorted({t[0] for t in terms})
    parts = []
    for i in range(0, len(heads), _HEADS_TOGETHER):
        group = [t for t in terms if t[0] in heads[i : i + _HEADS_TOGETHER]]
        parts.append(f"(?=[{_heads(group)}])(?:{_prefix_tree(group, end)})")
    return f"(?:{'|'.join(parts)})"


def word_pattern(terms: Sequence[str]) -> str:
    """For terms that begin with a word character, in a text after a blank: the character before a term is matched."""
    tree = _tree_by_heads(terms, _word_end)
    return f"[^{_PLAIN_WORD}](?=[{_heads(terms)}])(?<!{WORD_CHAR})(?=({tree}))"


def sign_pattern(terms: Sequence[str]) -> str:
    """For terms that begin with another character, which a word character must precede."""
    return f"(?=[{_heads(terms)}])(?<={WORD_CHAR})(?=({_tree_by_heads(terms, _word_end)}))"


def delimited_pattern(terms: Sequence[str]) -> str:
    return f"{DELIMITER}(?=({_tree_by_heads(terms, lambda _: '(?=' + DELIMITER + ')')}))"


def _words(text: Column, terms: Sequence[str]) -> Column:
    """The term that each position of the text captures as a whole word."""
    worded, signed = [t for t in terms if _is_word(t[0])], [t for t in terms if not _is_word(t[0])]
    found = []
    if worded:
        found.append(_captured(F.concat(F.lit(" "), text), word_pattern(worded)))
    if signed:
        found.append(_captured(text, sign_pattern(signed)))
    return F.concat(*found) if found else F.array().cast("array<string>")


def _captured(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def _implied(terms: Sequence[str], holds) -> dict[str, list[str]]:
    """For each term, the other terms that are certain to be present where it is captured."""
    out = {}
    for long in terms:
        inner = [t for t in terms if t != long and long.startswith(t) and holds(t, long[len(t)])]
        if inner:
            out[long] = inner
    return out


def _word_holds(term: str, following: str) -> bool:
    return _is_word(term[-1]) != _is_word(following)


def _delimited_holds(term: str, following: str) -> bool:
    return following in ".; ,"


def _present(captured: Column, implied: Mapping[str, Sequence[str]]) -> Column:
    """Distinct terms of the text: those captured and those implied by them."""
    found = F.array_distinct(captured)
    if not implied:
        return found
    together = F.map_from_arrays(
        F.array(*[F.lit(t) for t in implied]), F.array(*[F.array(*map(F.lit, (t, *v))) for t, v in implied.items()])
    )
    return F.array_distinct(F.flatten(F.transform(found, lambda t: F.coalesce(together[t], F.array(t)))))


def _rename(found: Column, names: Mapping[str, str]) -> Column:
    """Replace captured terms by the names they are reported under."""
    changed = {k: v for k, v in names.items() if k != v}
    if not changed:
        return found
    lookup = F.create_map(*[F.lit(x) for kv in changed.items() for x in kv])
    return F.array_distinct(F.transform(found, lambda t: F.coalesce(lookup[t], t)))


def word_terms(text: Column, terms: Sequence[str]) -> Column:
    """Terms present as whole words, ignoring case, in their lower-case form; sorted, empty for a null text."""
    low = [t.lower() for t in terms]
    found = _present(_words(fold_case(F.coalesce(text, F.lit(""))), low), _implied(low, _word_holds))
    return F.array_sort(found)


def word_term_groups(text: Column, groups: Mapping[str, Sequence[str]]) -> Column:
    """``word_terms`` for several lists at once, from a single reading of the text; a struct with a field per list."""
    low = sorted({t.lower() for terms in groups.values() for t in terms})
    found = _present(_words(fold_case(F.coalesce(text, F.lit(""))), low), _implied(low, _word_holds))
    return _by_group(found, groups, F.array_sort)


def _by_group(found: Column, groups: Mapping[str, Sequence[str]], value) -> Column:
    """A struct with a field per list: ``value`` of those found that are in the list."""
    # One element evaluates the search once; the lambda then refers to its result for every list.
    struct = F.transform(
        F.array(found),
        lambda all_found: F.struct(
            *[
                value(F.array_intersect(all_found, F.array(*[F.lit(t.lower()) for t in dict.fromkeys(terms)]))).alias(name)
                for name, terms in groups.items()
            ]
        ),
    )
    return struct[0]


def delimited_terms(text: Column, terms: Sequence[str]) -> Column:
    """Tools that stand between two delimiters, ignoring case, without outer delimiters; empty for a null text."""
    low = [t.lower() for t in terms]
    folded = fold_case(F.coalesce(text, F.lit("")))
    found = _present(_captured(folded, delimited_pattern(low)), _implied(low, _delimited_holds))
    return F.array_sort(_rename(found, {t: t.strip(" .,;") for t in low}))


def delimited_terms_squeezed(text: Column, terms: Sequence[str]) -> Column:
    """As ``delimited_terms`` on lower-cased text, with every delimiter deleted from the names; null for a null text."""
    low = [t.lower() for t in terms]
    found = _present(_captured(F.lower(text), delimited_pattern(low)), _implied(low, _delimited_holds))
    squeezed = _rename(found, {t: re.sub(DELIMITER, "", t) for t in low})
    return F.when(text.isNotNull(), F.array_sort(squeezed))


def substring_terms(text: Column, terms: Sequence[str]) -> Column:
    """Terms contained anywhere, case-sensitive, in list order and lower case; empty for a null text.

    One reading of the text captures the longest term at each position; terms that begin a captured one follow from it.
    """
    distinct = list(dict.fromkeys(terms))
    heads = "".join(sorted({quote(t[0]) for t in distinct}))
    pattern = f"(?=[{heads}])(?=({_prefix_tree(distinct, lambda _: '')}))"
    found = _present(_captured(F.coalesce(text, F.lit("")), pattern), _implied(distinct, lambda term, following: True))
    listed = F.array_intersect(F.array(*[F.lit(t) for t in distinct]), found)
    return F.transform(listed, lambda t: F.lower(t))


def term_count(text: Column, terms: Sequence[str]) -> Column:
    """How many of the terms occur as whole words in the lower-cased text."""
    low = [t.lower() for t in terms]
    found = _present(_words(F.lower(F.coalesce(text, F.lit(""))), low), _implied(low, _word_holds))
    return F.size(found)


def term_counts(text: Column, groups: Mapping[str, Sequence[str]]) -> Column:
    """``term_count`` for several lists at once, from a single reading of the text; a struct with a field per list."""
    low = sorted({t.lower() for terms in groups.values() for t in terms})
    found = _present(_words(F.lower(F.coalesce(text, F.lit(""))), low), _implied(low, _word_holds))
    return _by_group(found, groups, F.size)


def role_term_count(text: Column, role: Column, role_terms: Mapping[str, Sequence[str]]) -> Column:
    """``term_count`` with the list of the row's role; null for a role without a list."""
    count = F.when(F.lit(False), F.lit(None).cast("int"))
    for name, terms in role_terms.items():
        count = count.when(role == name, term_count(text, terms))
    return count
