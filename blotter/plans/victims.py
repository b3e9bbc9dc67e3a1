"""Victims by descent in the areas with the lowest or highest income."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.functions import decode, first_token, in_year, parse_money
from blotter.operators import equi_join, measured_bytes, might_match, min_per_key, top_k
from blotter.operators.joins import BROADCAST_LIMIT
from blotter.sources import stored, stored_and_measured
from blotter.sources.extracts import year_column

# Descent codes and their labels.
DESCENTS = {
    "A": "Other Asian",
    "B": "Black",
    "C": "Chinese",
    "D": "Cambodian",
    "F": "Filipino",
    "G": "Guamanian",
    "H": "Hispanic/Latin/Mexican",
    "I": "American Indian/Alaskan Native",
    "J": "Japanese",
    "K": "Korean",
    "L": "Laotian",
    "O": "Other",
    "P": "Pacific Islander",
    "S": "Samoan",
    "U": "Hawaiian",
    "V": "Vietnamese",
    "W": "White",
    "X": "Unknown",
    "Z": "Asian Indian",
}

# Fixed value: the year reported on.
YEAR = 2015

AREAS = 3

#: Strategies of the SQL form and the hints they give.
SQL_HINTS = {None: None, "broadcast": "BROADCAST", "merge": "MERGE", "shuffle_hash": "SHUFFLE_HASH"}


def zip_lookup(geocode: DataFrame) -> DataFrame:
    """LAT, LON, zip_code: the smallest of the first ZIPs given for a point."""
    return min_per_key(geocode, ["LAT", "LON"], "ZIPcode", "zip_code", clean=first_token)


def clean_incomes(incomes: DataFrame) -> DataFrame:
    """zip, income as numbers."""
    return incomes.select(
        F.col("Zip Code").try_cast("bigint").alias("zip"),
        parse_money(F.col("Estimated Median Income")).alias("income"),
    )


def victims_by_zip(
    incidents: DataFrame,
    geocode: DataFrame,
    year: int = YEAR,
    strategy: str | None = None,
    prefilter: bool = False,
) -> DataFrame:
    """zip, victim_descent, victims; a code without a label is counted under null.

    Incidents are counted per point and label before they meet the lookup. Each point
    has one ZIP, so the counts can be added up afterwards, and a point or label with a
    large part of all incidents is folded in the map tasks instead of being shuffled.
    For ``broadcast`` the lookup is stored and measured at once, by a job that runs while the
    report is being built. ``prefilter`` also stores the lookup, and drops incidents at points that it lacks
    before they are shuffled; worth it where many points have no ZIP.
    """
    code = F.col("Vict Descent")
    rows = incidents.where(in_year(F.col("DATE OCC"), year, year_column(incidents)) & code.isNotNull())
    lookup, size = zip_lookup(geocode), None
    if prefilter:
        lookup = stored(lookup, "zip-lookup")
        rows = might_match(rows, lookup, ["LAT", "LON"])
    per_point = rows.groupBy("LAT", "LON", decode(code, DESCENTS).alias("victim_descent")).agg(
        F.count("*").alias("victims")
    )
    if strategy == "broadcast":
        lookup, size = stored_and_measured(lookup, "zip-lookup", measured_bytes(lookup))
    return (
        equi_join(per_point, lookup, ["LAT", "LON"], strategy, right_bytes=size)
        .groupBy(F.col("zip_code").try_cast("bigint").alias("zip"), "victim_descent")
        .agg(F.sum("victims").alias("victims"))
    )


def victims_by_income(
    incidents: DataFrame,
    geocode: DataFrame,
    incomes: DataFrame,
    lowest: bool = True,
    year: int = YEAR,
    areas: int = AREAS,
    strategy: str | None = None,
    prefilter: bool = False,
) -> DataFrame:
    """victim_descent, victims over the ZIPs with the lowest (highest) income, most first.

    Only ZIPs with victims are candidates. Each carries its counts along as a list, at
    most one entry per label, so incidents are read once although the ZIPs found in
    them decide which of them are reported.
    """
    per_zip = (
        victims_by_zip(incidents, geocode, year, strategy, prefilter)
        .groupBy("zip")
        .agg(F.collect_list(F.struct("victim_descent", "victims")).alias("counts"))
    )
    candidates = clean_incomes(incomes).where(F.col("income").isNotNull()).join(per_zip, "zip")
    return (
        top_k(candidates, "income", areas, ascending=lowest, ties=["zip"])
        .dropDuplicates(["zip"])
        .select(F.inline("counts"))
        .groupBy("victim_descent")
        .agg(F.sum("victims").alias("victims"))
        .orderBy(F.desc("victims"), "victim_descent")
    )


def victims_by_income_sql(
    incidents: DataFrame,
    geocode: DataFrame,
    incomes: DataFrame,
    lowest: bool = True,
    year: int = YEAR,
    areas: int = AREAS,
    strategy: str | None = None,
) -> DataFrame:
    """The same report as one chain of SQL subqueries, with the join hint of a strategy.

    ``broadcast`` is measured first, as in :func:`victims_by_zip`, and is a merge join if the
    lookup is too large.
    """
    if strategy not in SQL_HINTS:
        raise ValueError(f"no join hint in SQL for strategy: {strategy}")
    lookup, hint = zip_lookup(geocode), SQL_HINTS[strategy]
    if strategy == "broadcast":
        lookup, size = stored_and_measured(lookup, "zip-lookup", measured_bytes(lookup))
        hint = hint if size <= BROADCAST_LIMIT else SQL_HINTS["merge"]
    chosen = f"/*+ {hint}(lookup) */" if hint else ""
    years = "TRUE" if year_column(incidents) is None else f"occ_year = {int(year)}"
    direction = "ASC" if lowest else "DESC"
    labels = "\n".join(f"WHEN '{code}' THEN '{label}'" for code, label in DESCENTS.items())
    return incidents.sparkSession.sql(
        f"""
        WITH lookup AS (
            SELECT LAT, LON, try_cast(zip_code AS bigint) AS zip
            FROM {{zips}}
        ),
        per_point AS (
            SELECT LAT, LON, CASE `Vict Descent` {labels} END AS victim_descent,
                   count(*) AS victims
            FROM {{incidents}}
            WHERE {years} AND substring(`DATE OCC`, 7, 4) = :year AND `Vict Descent` IS NOT NULL
            GROUP BY ALL
        ),
        per_label AS (
            SELECT {chosen} zip, victim_descent, sum(victims) AS victims
            FROM per_point JOIN lookup USING (LAT, LON)
            GROUP BY ALL
        ),
        per_zip AS (
            SELECT zip, collect_list(struct(victim_descent, victims)) AS counts
            FROM per_label
            GROUP BY zip
        ),
        money AS (
            SELECT try_cast(`Zip Code` AS bigint) AS zip,
                   try_cast(regexp_replace(`Estimated Median Income`, '[$,]', '') AS double)
                       AS income
            FROM {{incomes}}
        ),
        picked AS (
            SELECT zip, any_value(counts) AS counts
            FROM (
                SELECT zip, counts
                FROM money JOIN per_zip USING (zip)
                WHERE income IS NOT NULL
                ORDER BY income {direction}, zip
                LIMIT :areas
            )
            GROUP BY zip
        )
        SELECT victim_descent, sum(victims) AS victims
        FROM (SELECT inline(counts) FROM picked)
        GROUP BY victim_descent
        ORDER BY victims DESC, victim_descent
        """,
        args={"year": str(year), "areas": areas},
        incidents=incidents,
        incomes=incomes,
        zips=lookup,
    )
