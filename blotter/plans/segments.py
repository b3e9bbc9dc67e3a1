"""Incidents on the street by time of day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.functions import time_segment
from blotter.functions.clock import BOUNDED_NIGHT, DAY_SEGMENTS, NIGHT_END, NIGHT_START
from blotter.operators import top_k

# Fixed value: the kind of premises counted.
STREET = "STREET"


def street_segments(incidents: DataFrame, bounded: bool = False) -> DataFrame:
    """incidents, time_segment, most first. ``bounded`` selects the rule for Night."""
    return _counts(incidents, bounded).orderBy(F.desc("incidents"), "time_segment")


def busiest_segments(incidents: DataFrame, k: int = 5, bounded: bool = True) -> DataFrame:
    """The k segments with the most incidents."""
    counts = _counts(incidents, bounded)
    return top_k(counts, "incidents", k, ascending=False, ties=["time_segment"])


def street_segments_sql(incidents: DataFrame, bounded: bool = False) -> DataFrame:
    """The same report as SQL."""
    if bounded:
        night = " OR ".join(f"hhmm BETWEEN {start} AND {end}" for start, end in BOUNDED_NIGHT)
    else:
        night = f"hhmm >= {NIGHT_START} OR hhmm <= {NIGHT_END}"
    branches = "\n".join(
        f"WHEN hhmm BETWEEN {start} AND {end} THEN '{name}'" for name, start, end in DAY_SEGMENTS
    )
    return incidents.sparkSession.sql(
        f"""
        WITH street AS (
            SELECT try_cast(`TIME OCC` AS bigint) AS hhmm
            FROM {{incidents}}
            WHERE `Premis Desc` = :premises
        )
        SELECT count(*) AS incidents,
               CASE {branches}
                    WHEN {night} THEN 'Night'
                    ELSE 'NA'
               END AS time_segment
        FROM street
        GROUP BY time_segment
        ORDER BY incidents DESC, time_segment
        """,
        args={"premises": STREET},
        incidents=incidents,
    )


def _counts(incidents: DataFrame, bounded: bool) -> DataFrame:
    segment = time_segment(F.col("TIME OCC"), bounded)
    return (
        incidents.where(F.col("Premis Desc") == STREET)
        .groupBy(segment.alias("time_segment"))
        .agg(F.count("*").alias("incidents"))
        .select("incidents", "time_segment")
    )
