"""The four reports, and partial results to keep them up to date."""

from blotter.plans.distances import (
    compare_join_rows,
    compare_joins,
    compare_rows,
    counts_by_division,
    distance_by_division,
)
from blotter.plans.maintained import (
    maintain,
    merge_counts,
    merge_lookups,
    month_counts,
    top_months_of,
)
from blotter.plans.months import top_months, top_months_sql
from blotter.plans.segments import busiest_segments, street_segments, street_segments_sql
from blotter.plans.victims import (
    victims_by_income,
    victims_by_income_sql,
    victims_by_zip,
    zip_lookup,
)

__all__ = [
    "busiest_segments",
    "compare_join_rows",
    "compare_joins",
    "compare_rows",
    "counts_by_division",
    "distance_by_division",
    "maintain",
    "merge_counts",
    "merge_lookups",
    "month_counts",
    "street_segments",
    "street_segments_sql",
    "top_months",
    "top_months_of",
    "top_months_sql",
    "victims_by_income",
    "victims_by_income_sql",
    "victims_by_zip",
    "zip_lookup",
]
