"""A newer extract merged into a stored table, without building it anew."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from blotter.sources.extracts import REJECTED, ROWS_PER_FILE, YEAR_COLUMN, _typed, _year
from blotter.sources.layouts import INCIDENT_DATE, INCIDENT_RENAMES, INCIDENT_TYPES
from blotter.sources.lines import REASON, fitting, malformed, read_lines
from blotter.sources.scratch import delete, stored
from blotter.sources.tables import column, read_parquet, write_parquet

#: How a partition of the null year is named.
NULL_YEAR = "__HIVE_DEFAULT_PARTITION__"

#: Working column: what tells rows apart.
IDENTITY = "_identity"


def merge_extract(
    spark: SparkSession,
    parquet_path: str,
    new_path: str,
    key: str = "DR_NO",
    newest: Sequence[str] = (),
    types: Mapping[str, str] = INCIDENT_TYPES,
    renames: Mapping[str, str] = INCIDENT_RENAMES,
    date: str = INCIDENT_DATE,
    strict: bool = False,
    malformed_path: str | None = None,
) -> DataFrame:
    """Merge a CSV extract into the Parquet copy of ``build_incidents``; the table read back.

    A row of the extract takes the place of all stored rows with its ``key``; of several in the
    extract the one counts that is last by ``newest`` (nulls come first), then by its other values.
    A row without a key is one with all the same values. Stored rows whose key does not come up stay as
    they are, duplicates too.

    Only years are written that the extract touches: those of its rows, and those in which rows
    stood that it replaces, since a date may have been corrected. A year that loses all its rows goes. Of all
    other years the key is read, no more, and their files stay. The rows are worked out and
    stored before anything is overwritten, and merging an extract again changes nothing, so a
    run that broke off is run again.

    The extract must have the columns of the table. Lines that do not fit their header go to
    ``malformed_path``; without it they are an error, as they are with ``strict``, which refuses text that fits no
    type as well.
    """
    lines = read_lines(spark, new_path).withColumnsRenamed(dict(renames))
    seen = Observation()
    rows = fitting(lines.observe(seen, F.count(REASON).alias("malformed")), strict)
    rows = _typed(rows, types, strict).withColumn(YEAR_COLUMN, _year(date))
    table = read_parquet(spark, parquet_path)
    names = table.columns
    if set(rows.columns) != set(names):
        raise ValueError(f"columns {sorted(set(rows.columns) ^ set(names))} are not on both sides")
    fresh = stored(_newest(_identified(rows.select(*map(column, names)), key), newest, names), "fresh-rows")
    if malformed_path is not None:
        write_parquet(malformed(lines), malformed_path, "overwrite")
    elif seen.get["malformed"]:
        raise ValueError(f"{seen.get['malformed']} lines do not fit their header; say where they go")

    keys = fresh.select(IDENTITY)
    old = _identified(table, key)
    hit = old.join(keys, IDENTITY, "left_semi").select(YEAR_COLUMN)
    touched = _years(hit.unionAll(fresh.select(YEAR_COLUMN)))
    if not touched:
        return table.drop(REJECTED)
    kept = old.where(_in_years(touched)).join(keys, IDENTITY, "left_anti")
    merged = stored(kept.unionByName(fresh).select(*map(column, names)), "merged-years")
    write_parquet(
        merged.hint("rebalance", YEAR_COLUMN), parquet_path, "overwrite", [YEAR_COLUMN],
        partitionOverwriteMode="dynamic", maxRecordsPerFile=str(ROWS_PER_FILE),
    )
    # Only then do years go that have no row left, so that no row is missing in between.
    for year in touched - _years(merged.select(YEAR_COLUMN)):
        delete(spark, f"{parquet_path}/{YEAR_COLUMN}={NULL_YEAR if year is None else year}")
    spark.catalog.refreshByPath(parquet_path)
    return read_parquet(spark, parquet_path).drop(REJECTED)


def _identified(rows: DataFrame, key: str) -> DataFrame:
    whole = F.sha2(F.to_json(F.struct(*(column(name) for name in sorted(rows.columns)))), 256)
    named = F.concat(F.lit("key "), column(key).cast("string"))
    return rows.withColumn(IDENTITY, F.coalesce(named, F.concat(F.lit("row "), whole)))


def _newest(rows: DataFrame, newest: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One row per identity: the greatest, compared by ``newest`` and then by everything."""

    def ordered(name: str) -> Column:
        # Maps have no order; their entries have.
        return F.array_sort(F.map_entries(column(name))) if name == REJECTED else column(name)

    by = [column(name).alias(f"by{i}") for i, name in enumerate(newest)]
    row = F.struct(*by, F.struct(*(ordered(name).alias(f"c{i}") for i, name in enumerate(names))).alias("row"))
    best = rows.groupBy(IDENTITY).agg(F.max(row).alias("best")).select(IDENTITY, "best.row.*")
    return best.select(
        IDENTITY,
        *(
            (F.map_from_entries(f"c{i}") if name == REJECTED else F.col(f"c{i}")).alias(name)
            for i, name in enumerate(names)
        ),
    )


def _years(rows: DataFrame) -> set[int | None]:
    """The distinct years; four characters name one, so there are at most some thousands."""
    return {row[0] for row in rows.distinct().toLocalIterator()}


def _in_years(years: set[int | None]) -> Column:
    year = F.col(YEAR_COLUMN)
    named = year.isin(sorted(y for y in years if y is not None))
    return named | year.isNull() if None in years else named
