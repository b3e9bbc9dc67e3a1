"""Operators on DataFrames."""

from blotter.operators.copartition import Copartitioned, copartition
from blotter.operators.joins import equi_join, fits_broadcast, measured_bytes, pair_join
from blotter.operators.lookups import min_per_key, semi_join
from blotter.operators.prefilter import might_match
from blotter.operators.ranking import top_k, top_n_per_group

__all__ = [
    "Copartitioned",
    "copartition",
    "equi_join",
    "fits_broadcast",
    "measured_bytes",
    "might_match",
    "min_per_key",
    "pair_join",
    "semi_join",
    "top_k",
    "top_n_per_group",
]
