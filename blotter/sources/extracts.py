"""Combining raw extracts of one table into clean CSV and Parquet copies."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from blotter.functions import text_year
from blotter.sources.copies import CopyMismatch, compare_digests, digest
from blotter.sources.layouts import INCIDENT_DATE, INCIDENT_RENAMES, INCIDENT_TYPES
from blotter.sources.lines import MALFORMED, REASON, fitting, malformed, read_lines
from blotter.sources.scratch import exists, stored
from blotter.sources.tables import column, read_csv, read_parquet, write_csv, write_parquet

#: Partition column of the Parquet copy: the year a text date names, null for other text.
YEAR_COLUMN = "occ_year"

#: Working column of the Parquet copy: by column, the text that did not fit its type.
REJECTED = "_rejected"

#: Rows of one Parquet file at most.
ROWS_PER_FILE = 5_000_000


def combine(
    old: DataFrame,
    new: DataFrame,
    renames: Mapping[str, str],
    by_position: bool = False,
) -> DataFrame:
    """All rows of both extracts, after repairing column names; duplicates are kept."""
    old, new = (part.withColumnsRenamed(dict(renames)) for part in (old, new))
    return old.union(new) if by_position else old.unionByName(new)


def build_incidents(
    spark: SparkSession,
    old_path: str,
    new_path: str,
    csv_path: str,
    parquet_path: str,
    types: Mapping[str, str] = INCIDENT_TYPES,
    renames: Mapping[str, str] = INCIDENT_RENAMES,
    date: str | None = INCIDENT_DATE,
    strict: bool = False,
    mode: str = "error",
    malformed_path: str | None = None,
    verify: bool = False,
) -> DataFrame:
    """Combine two CSV extracts and store them as Parquet and as CSV.

    Both extracts are read as text and typed by name after the union, so their
    types cannot drift apart. The raw text is parsed once: the CSV copy is written
    from the stored Parquet table. Returns the table read back from Parquet.

    Nothing that is read is lost. A line that does not fit its header (see
    :func:`read_lines`) is no row of the copies; it stands, as it is in the file, in a table of its own at
    ``malformed_path``, by default the Parquet path with ``-malformed`` behind it. Text
    that does not fit its type is null in the Parquet copy, which keeps the
    text aside, see :func:`rejects`; the CSV copy has the text itself. ``strict`` makes
    either an error instead. If ``date`` names a column, the Parquet copy is partitioned by the
    year in it, ``occ_year``; a row whose date names no year is in a partition of its own.

    ``mode`` is ``error``, ``overwrite``, or ``resume``: a copy that is complete is kept and
    only what is missing is written, for a run that broke off between the two.

    ``verify`` reads both copies back and compares them, year by year, with each other and with the digest
    of the rows that was worked out while they were written; :class:`CopyMismatch` if they differ.
    """
    if mode not in ("error", "overwrite", "resume"):
        raise ValueError(f"unknown mode: {mode}")
    write = "overwrite" if mode != "error" else "error"
    malformed_path = malformed_path or f"{parquet_path.rstrip('/')}-malformed"
    lines = combine(read_lines(spark, old_path), read_lines(spark, new_path), renames)
    seen, written = Observation(), Observation()
    copied = mode != "resume" or not exists(spark, f"{parquet_path}/_SUCCESS")
    if copied:
        counted = lines.observe(seen, F.count(REASON).alias("malformed"))
        typed = _typed(fitting(counted, strict), types, strict)
        partitions = []
        if date is not None:
            # Rows of a year go together, in files of bounded size; a large year is split.
            typed = typed.withColumn(YEAR_COLUMN, _year(date)).hint("rebalance", YEAR_COLUMN)
            partitions = [YEAR_COLUMN]
        if verify:
            names = [name for name in typed.columns if name not in (REJECTED, YEAR_COLUMN)]
            # Behind the shuffle, where a task that is repeated counts once.
            typed = typed.observe(written, *digest([_written(name, types) for name in names]))
        write_parquet(
            typed, parquet_path, write, partitions, maxRecordsPerFile=str(ROWS_PER_FILE)
        )
    if mode != "resume" or not exists(spark, f"{malformed_path}/_SUCCESS"):
        # Lines that do not fit are looked for once more only if there are any.
        some = not copied or seen.get["malformed"] > 0
        write_parquet(malformed(lines) if some else spark.createDataFrame([], MALFORMED), malformed_path, write)
    table = read_parquet(spark, parquet_path)
    if mode != "resume" or not exists(spark, f"{csv_path}/_SUCCESS"):
        names = [name for name in table.columns if name not in (REJECTED, YEAR_COLUMN)]
        write_csv(table.select(*(_written(name, types) for name in names)), csv_path, write)
    if verify:
        verify_copies(spark, csv_path, parquet_path, types, date, written.get if copied else None)
    return table.drop(REJECTED)


def compare_copies(
    spark: SparkSession,
    csv_path: str,
    parquet_path: str,
    types: Mapping[str, str] = INCIDENT_TYPES,
    date: str | None = INCIDENT_DATE,
) -> DataFrame:
    """Both copies of :func:`build_incidents` by year: ``occ_year``, ``parquet_rows``, ``csv_rows``,
    ``matches``. Each copy is read once. Without ``date`` all rows are of the null year."""
    return compare_digests(*_digests(spark, csv_path, parquet_path, types, date), [YEAR_COLUMN], ["parquet", "csv"])


def verify_copies(
    spark: SparkSession,
    csv_path: str,
    parquet_path: str,
    types: Mapping[str, str] = INCIDENT_TYPES,
    date: str | None = INCIDENT_DATE,
    written: Mapping[str, object] | None = None,
) -> None:
    """:class:`CopyMismatch` unless both copies hold the same rows, and those that were ``written``."""
    parquet, csv = (stored(d, "copy-digests") for d in _digests(spark, csv_path, parquet_path, types, date))
    report = compare_digests(parquet, csv, [YEAR_COLUMN], ["parquet", "csv"]).where(~F.col("matches"))
    found = report.orderBy(YEAR_COLUMN).take(10)
    if found:
        raise CopyMismatch(f"the copies differ, first in {[row.asDict() for row in found]}")
    if written is not None:
        total = parquet.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("hashes"), F.lit(0))).first()
        if (total[0], int(total[1])) != (written["rows"], int(written["hashes"])):
            raise CopyMismatch(f"{total[0]} rows read back, {written['rows']} written, or other ones")


def _digests(spark, csv_path, parquet_path, types, date) -> tuple[DataFrame, DataFrame]:
    """By year, the digest of the Parquet copy and of the CSV copy, both as the text of the CSV copy."""
    parquet, csv = read_parquet(spark, parquet_path), read_csv(spark, csv_path)
    names = [name for name in parquet.columns if name not in (REJECTED, YEAR_COLUMN)]
    if csv.columns != names:
        raise CopyMismatch(f"columns {names} in Parquet, {csv.columns} in CSV")
    year = F.lit(None).cast("int") if date is None else _year(date)
    by_year = []
    for copy, values in ((parquet, [_written(n, types) for n in names]), (csv, [column(n) for n in names])):
        stored_year = F.col(YEAR_COLUMN) if YEAR_COLUMN in copy.columns else year
        by_year.append(copy.groupBy(stored_year.alias(YEAR_COLUMN)).agg(*digest(values)))
    return by_year[0], by_year[1]


def _year(date: str) -> Column:
    return text_year(column(date)).try_cast("int")


def year_column(incidents: DataFrame) -> Column | None:
    """The stored year of a table, if it has one."""
    return F.col(YEAR_COLUMN) if YEAR_COLUMN in incidents.columns else None


def rejects(spark: SparkSession, parquet_path: str) -> DataFrame:
    """The rows of a stored table that hold text which did not fit, once per such value.

    All columns of the table, and ``rejected_column`` and ``rejected_text``.
    """
    table = read_parquet(spark, parquet_path)
    return table.select(
        *(column(name) for name in table.columns if name != REJECTED),
        F.explode(REJECTED).alias("rejected_column", "rejected_text"),
    )


def count_rejects(spark: SparkSession, parquet_path: str) -> DataFrame:
    """rejected_column, values: how many texts did not fit, by column."""
    found = rejects(spark, parquet_path).groupBy("rejected_column")
    return found.agg(F.count("*").alias("values"))


def _typed(text: DataFrame, types: Mapping[str, str], strict: bool) -> DataFrame:
    """Columns with their types, and a map of the texts that do not fit."""
    listed = [name for name in text.columns if name in types]
    cast = {name: column(name).try_cast(types[name]) for name in listed}
    unfit = {name: column(name).isNotNull() & cast[name].isNull() for name in listed}
    if strict:
        for name in listed:
            message = F.concat(F.lit(f"{types[name]} expected in {name}, found: "), column(name))
            failed = F.raise_error(message).cast(types[name])
            cast[name] = F.when(unfit[name], failed).otherwise(cast[name])
    pairs = F.array(
        *(
            F.when(unfit[name], F.struct(F.lit(name).alias("key"), column(name).alias("value")))
            for name in listed
        )
    )
    kept = F.map_from_entries(F.filter(pairs, lambda pair: pair.isNotNull()))
    empty = F.create_map().cast("map<string,string>")
    return text.select(
        *(cast[name].alias(name) if name in cast else column(name) for name in text.columns),
        (kept if listed else empty).alias(REJECTED),
    )


def _written(name: str, types: Mapping[str, str]) -> Column:
    if name not in types:
        return column(name)
    text = F.try_element_at(column(REJECTED), F.lit(name))
    return F.coalesce(column(name).cast("string"), text).alias(name)
