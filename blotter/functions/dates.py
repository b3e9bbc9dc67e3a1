"""Parts of dates kept as text, ``MM/dd/yyyy hh:mm:ss a``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_year(date: Column) -> Column:
    return F.substring(date, 7, 4)


def text_month(date: Column) -> Column:
    return F.substring(date, 1, 2)


def in_year(date: Column, year: int | str, stored_year: Column | None = None) -> Column:
    """Compares text with text, so a malformed date is dropped instead of failing a cast.

    ``stored_year`` is a column that holds the year as a number, for example one the table is
    partitioned by: then only that partition is read.
    """
    named = text_year(date) == F.lit(str(year))
    return named if stored_year is None else (stored_year == F.lit(int(year))) & named
