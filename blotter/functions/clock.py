"""Time-of-day segments of clock times written as HHMM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Segment name, first and last HHMM, both inclusive.
DAY_SEGMENTS = (
    ("Morning", 500, 1159),
    ("Afternoon", 1200, 1659),
    ("Evening", 1700, 2059),
)
NIGHT_START = 2100
NIGHT_END = 459
BOUNDED_NIGHT = ((2100, 2359), (0, 499))


def time_segment(time: Column, bounded: bool = False) -> Column:
    """Morning, Afternoon, Evening, Night or NA.

    ``bounded`` picks one of two rules for Night. Unbounded: from 2100 up or 459
    down, without limits. Bounded: 2100-2359 or 0-499. They differ on 460-499,
    above 2359 and below 0. Text that is no whole number gives NA.
    """
    hhmm = time.try_cast("bigint")
    if bounded:
        (late_from, late_to), (early_from, early_to) = BOUNDED_NIGHT
        night = hhmm.between(late_from, late_to) | hhmm.between(early_from, early_to)
    else:
        night = (hhmm >= NIGHT_START) | (hhmm <= NIGHT_END)

    segment = F.when(night, F.lit("Night"))
    for name, start, end in DAY_SEGMENTS:
        segment = segment.when(hhmm.between(start, end), F.lit(name))
    return segment.otherwise(F.lit("NA"))
