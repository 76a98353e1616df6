"""String functions on posting text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobloom.functions.terms import WORD_CHAR

# Every character Unicode calls white space, and the four ASCII separators; a class that Java and RE2 read alike.
SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
TAG = "<[^>]+>"

# Runs of white space but for a single blank before a visible ASCII character, which may stay. That is most of a text, so it is
# settled by classes of single characters, which Java looks up in a table.
_VISIBLE = "".join(("\\" if not chr(c).isalnum() else "") + chr(c) for c in range(0x21, 0x7F))
RUN_OF_SPACE = rf"[^{_VISIBLE}](?:(?<! )|(?![{_VISIBLE}]))(?<={SPACE}){SPACE}*+"

# The shapes of an experience and of a salary statement.
EXPERIENCE = rf"\d+\+?|\d+-\d+|\d+{SPACE}*to{SPACE}*\d+"
AMOUNT = r"\$[\d,]+(?:\.\d{1,2})?"
SALARY = rf"({AMOUNT}(?:{SPACE}*[-–]{SPACE}*{AMOUNT})?){SPACE}*(a|per){SPACE}*(day|year|hour|week)"


def squash_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, RUN_OF_SPACE, " "))


def clean_text(html: Column) -> Column:
    """Tags removed without a trace, white space squashed, lower case."""
    return F.lower(squash_spaces(F.regexp_replace(html, TAG, "")))


def first_integer(text: Column) -> Column:
    return F.regexp_extract(text, r"(\d+)", 1).try_cast("int")


def days_since_posted(age: Column) -> Column:
    """Board A: 0 for a posting of today, else the first number of the text, else null."""
    return F.when(age.isin("Today", "Just posted"), F.lit(0)).otherwise(first_integer(age))


def experience_years(text: Column) -> Column:
    """Board A: every ``N``, ``N+``, ``N-M`` or ``N to M`` that precedes the word ``years``."""
    pattern = rf"(?=[0123456789])(?<!{WORD_CHAR})({EXPERIENCE}){SPACE}*years(?!{WORD_CHAR})"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def experience_range(text: Column) -> Column:
    """Board B: what stands before the first ``Years``, without spaces; the whole text if the word is missing."""
    return F.replace(F.substring_index(text, "Years", 1), F.lit(" "), F.lit(""))


def salaries(text: Column) -> Column:
    """Every amount or range with its period, as ``array<struct<amount,per,unit>>``."""
    found = F.regexp_extract_all(text, F.lit(SALARY), F.lit(0))
    return F.transform(
        found,
        lambda m: F.struct(
            F.regexp_extract(m, SALARY, 1).alias("amount"),
            F.regexp_extract(m, SALARY, 2).alias("per"),
            F.regexp_extract(m, SALARY, 3).alias("unit"),
        ),
    )


def without_employer(title: Column, name: Column) -> Column:
    """The title with the employer's name deleted; only trimmed where there is no name."""
    has_name = name.isNotNull() & (name != "")
    return F.trim(F.when(has_name, F.replace(title, name, F.lit(""))).otherwise(title))


def role_label(role: Column) -> Column:
    return F.upper(F.translate(role, "_-", "  "))


def file_token(title: Column) -> Column:
    return F.replace(title, F.lit(" "), F.lit("_"))


def url_quote(text: Column) -> Column:
    """Percent-encoding that keeps letters, digits and ``_.-~/``."""
    out = F.url_encode(text)
    for encoded, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        out = F.replace(out, F.lit(encoded), F.lit(wanted))
    return out


def page_url(url: Column, offset: Column) -> Column:
    """A search URL moved to a result offset."""
    return F.concat(url, F.lit("&start="), offset.cast("string"))


def prefixed(prefix: str, value: Column) -> Column:
    """``prefix`` + value; null stays null."""
    return F.concat(F.lit(prefix), value)


def list_to_text(items: Column) -> Column:
    return F.to_json(items)


def text_to_list(text: Column) -> Column:
    """A list written as text with either kind of quote."""
    return F.from_json(text, "array<string>", {"allowSingleQuotes": "true"})


def percent(ratio: Column) -> Column:
    return F.round(ratio * 100, 2)
