"""Words and lines of a text as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters between words.
SPACE = " \t\n\u000b\f\r"
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACES)).otherwise(
        F.array().cast("array<string>")
    )


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def worded_lines(text: Column) -> Column:
    r"""The \n-split lines that hold a word."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.filter(lines, lambda line: F.length(F.btrim(line, F.lit(SPACE))) > 0)
