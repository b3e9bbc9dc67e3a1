"""Extracts of one table whose columns have drifted apart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    TimestampNTZType,
)

from blotter.sources.tables import column

#: The column that says which extract a row is from.
ORIGIN = "origin"

#: Whole numbers by size, and the digits that hold all of them.
WHOLE = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 19}
MOST_DIGITS = 38


def reconcile(extracts: Mapping[str, DataFrame], renames: Mapping[str, str] | None = None) -> DataFrame:
    """All rows of all extracts in one shape, with their extract under ``origin``; duplicates are kept.

    Columns are matched by name after ``renames``, in the order in which they first come up. A column that an
    extract lacks is null there. Types that differ become one that holds every value of
    both: the larger whole number, a fraction where it is exact, else text. Nothing is read to
    find out.
    """
    parts = _renamed(extracts, renames)
    kinds = _kinds(parts)
    shaped = [
        df.select(
            F.lit(name).alias(ORIGIN),
            *(
                (column(c) if c in df.columns else F.lit(None)).cast(kind).alias(c)
                for c, kind in kinds.items()
            ),
        )
        for name, df in parts.items()
    ]
    return reduce(DataFrame.unionAll, shaped)


def drift(spark: SparkSession, extracts: Mapping[str, DataFrame], renames: Mapping[str, str] | None = None) -> DataFrame:
    """column, origin, found, became: where an extract lacks a column (``found`` is null) or has another type."""
    parts = _renamed(extracts, renames)
    rows = []
    for c, kind in _kinds(parts).items():
        for name, df in parts.items():
            found = df.schema[c].dataType if c in df.columns else None
            if found != kind:
                rows.append((c, name, found and found.simpleString(), kind.simpleString()))
    return spark.createDataFrame(rows, "column string, origin string, found string, became string")


def wider(kinds: Sequence[DataType]) -> DataType:
    """The narrowest type that holds every value of all of them."""
    return reduce(_wider, kinds)


def _wider(a: DataType, b: DataType) -> DataType:
    if a == b:
        return a
    if a in WHOLE and b in WHOLE:
        return max(a, b, key=WHOLE.__getitem__)
    for one, other in ((a, b), (b, a)):
        # A double holds whole numbers of up to 15 digits, an int among them but no long.
        if isinstance(one, DoubleType) and (isinstance(other, FloatType) or WHOLE.get(other, 99) <= 15):
            return one
        if isinstance(one, FloatType) and WHOLE.get(other, 99) <= 15:
            return one if WHOLE[other] <= 6 else DoubleType()
        if isinstance(one, TimestampNTZType) and isinstance(other, DateType):
            return one
        if isinstance(one, DecimalType) and (other in WHOLE or isinstance(other, DecimalType)):
            scale = max(one.scale, getattr(other, "scale", 0))
            whole = max(one.precision - one.scale, WHOLE.get(other) or other.precision - other.scale)
            if whole + scale <= MOST_DIGITS:
                return DecimalType(whole + scale, scale)
    for kind in (a, b):
        if kind.simpleString().startswith(("array", "map", "struct", "binary", "variant")):
            raise ValueError(f"no common type for {a.simpleString()} and {b.simpleString()}")
    return StringType()


def _renamed(extracts: Mapping[str, DataFrame], renames: Mapping[str, str] | None) -> dict[str, DataFrame]:
    parts = {name: df.withColumnsRenamed(dict(renames or {})) for name, df in extracts.items()}
    for name, df in parts.items():
        if ORIGIN in df.columns or len(set(df.columns)) < len(df.columns):
            raise ValueError(f"extract {name} has a column {ORIGIN} or a name twice")
    return parts


def _kinds(parts: Mapping[str, DataFrame]) -> dict[str, DataType]:
    found: dict[str, list[DataType]] = {}
    for df in parts.values():
        for field in df.schema.fields:
            found.setdefault(field.name, []).append(field.dataType)
    return {name: wider(kinds) for name, kinds in found.items()}
