"""Months with the most incidents of each year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.functions import text_month, text_year
from blotter.operators import top_n_per_group

TOP = 3


def top_months(incidents: DataFrame, n: int = TOP) -> DataFrame:
    """Year, Month, crime_total, rank for the n busiest months of each year, ties kept."""
    date = F.col("DATE OCC")
    monthly = incidents.groupBy(
        text_year(date).alias("Year"), text_month(date).alias("Month")
    ).agg(F.count("*").alias("crime_total"))
    return busiest_months(monthly, n)


def busiest_months(monthly: DataFrame, n: int = TOP) -> DataFrame:
    """The report from the counts: Year, Month, crime_total."""
    ranked = top_n_per_group(monthly, ["Year"], [F.desc("crime_total")], n)
    return ranked.orderBy("Year", "rank", "Month")


def top_months_sql(incidents: DataFrame, n: int = TOP) -> DataFrame:
    """The same report as SQL: year, month, crime_total, ranking."""
    return incidents.sparkSession.sql(
        """
        WITH monthly AS (
            SELECT substring(`DATE OCC`, 7, 4) AS year,
                   substring(`DATE OCC`, 1, 2) AS month,
                   count(*) AS crime_total
            FROM {incidents}
            GROUP BY ALL
        ),
        ranked AS (
            SELECT *, rank() OVER (PARTITION BY year ORDER BY crime_total DESC) AS ranking
            FROM monthly
        )
        SELECT * FROM ranked
        WHERE ranking <= :n
        ORDER BY year, ranking, month
        """,
        args={"n": n},
        incidents=incidents,
    )
