"""Cleaning of codes, money and lists kept as text."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_token(text: Column, separators: str = ";:-") -> Column:
    """Text before the first of the separator characters; blank stays blank, null stays null."""
    listed = "".join(f"\\{character}" for character in separators)
    return F.split(text, f"[{listed}]", 2).getItem(0)


def parse_money(text: Column) -> Column:
    """``$33,887`` to 33887.0; text that is no amount gives null."""
    return F.regexp_replace(text, "[$,]", "").try_cast("double")


def decode(code: Column, labels: Mapping[str, str]) -> Column:
    """Label of a code, null for a code without one."""
    table = F.create_map(*(F.lit(item) for item in chain.from_iterable(labels.items())))
    return F.try_element_at(table, code)
