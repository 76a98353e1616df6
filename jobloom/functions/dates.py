"""Date functions; the reference date is always an argument, never the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.functions.text import SPACE, squash_spaces


def iso_date(text: Column) -> Column:
    return F.to_date(text, "yyyy-MM-dd")


def iso_timestamp(text: Column) -> Column:
    """An ISO timestamp with or without the closing ``Z``, read as UTC wall time."""
    return F.to_timestamp_ntz(F.btrim(text, F.lit("Z")))


def days_since_posted_text(posted: Column, ref_date: dt.date, year: int) -> Column:
    """Board B: days since posting from ``Today``, ``30+``, ``N days ago`` or a day and short month of ``year``."""
    day_month = F.regexp_extract(posted, rf"\b(\d{{1,2}}{SPACE}+[A-Za-z]+)\b", 1)
    dated = F.concat_ws(" ", F.initcap(F.regexp_replace(day_month, SPACE + "+", " ")), F.lit(str(year)))
    posted_on = F.to_date(F.try_to_timestamp(dated, F.lit("d MMM yyyy")))
    second_word = F.get(F.split(squash_spaces(posted), " "), F.lit(1))
    return (
        F.when(posted.contains("Today"), F.lit(0))
        .when(posted.contains("30+"), F.lit(30))
        .when(posted.contains("days ago"), second_word.try_cast("int"))
        .otherwise(F.datediff(F.lit(ref_date), posted_on))
    )


def with_date_parts(df: DataFrame, date: str = "date_of_scrape") -> DataFrame:
    return df.withColumns({"day": F.day(date), "Month": F.month(date), "Year": F.year(date)})


def run_stamp(run_date: dt.date) -> Column:
    return F.date_format(F.lit(run_date), "yyyy-MM-dd")


def short_stamp(run_date: dt.date, with_day: bool = True) -> str:
    """``year-month[-day]`` without padding, as used in the names of dated exports."""
    parts = [run_date.year, run_date.month] + ([run_date.day] if with_day else [])
    return "-".join(map(str, parts))

