"""Column expressions. Every function takes a column and returns a column."""

from blotter.functions.clock import time_segment
from blotter.functions.dates import in_year, text_month, text_year
from blotter.functions.geo import haversine_km, morton_key
from blotter.functions.text import decode, first_token, parse_money

__all__ = [
    "decode",
    "first_token",
    "haversine_km",
    "morton_key",
    "in_year",
    "parse_money",
    "text_month",
    "text_year",
    "time_segment",
]
