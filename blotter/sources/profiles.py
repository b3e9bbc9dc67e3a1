"""What types the columns of a text table have, found in one scan that can be added to."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.sources.tables import column

#: Types from the narrowest on, and the counts of values that fit them. What fits long fits double.
KINDS = {"bigint": "longs", "double": "doubles", "timestamp_ntz": "timestamps"}

#: Text that is a number. Casts alone would also take ``5d`` and ``Infinity``.
LONG = r"^[+-]?[0-9]{1,19}$"
DOUBLE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
#: How dates and times are written if nothing else is said.
FORMATS = ("yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy hh:mm:ss a", "yyyy-MM-dd")

SUMS = ("rows", "nulls", *KINDS.values())
LEAST = ("least_long", "least_double", "first", "shortest")
MOST = ("most_long", "most_double", "last", "longest")


def type_profile(text: DataFrame, formats: tuple[str, ...] = FORMATS) -> DataFrame:
    """A row per column: how many values fit which type, and the extremes of those that do.

    ``column``, ``rows``, ``nulls``, ``longs``, ``doubles``, ``timestamps``; least and most of the longs, doubles
    and times, and of the length of all values. All columns are profiled in one scan, and map tasks
    send one row per column. Profiles of parts add up, see :func:`merge_profiles`.
    A table without rows has no profile rows.
    """
    values = F.explode(
        F.array(
            *(
                F.struct(F.lit(name).alias("column"), column(name).cast("string").alias("value"))
                for name in text.columns
            )
        )
    )
    listed = text.select(values.alias("v")).select("v.column", "v.value")
    value = F.col("value")
    long = F.when(value.rlike(LONG), value.try_cast("bigint"))
    double = F.when(value.rlike(DOUBLE), value.try_cast("double"))
    time = F.coalesce(*(F.try_to_timestamp(value, F.lit(f)).cast("timestamp_ntz") for f in formats))
    typed = listed.select(
        "column", "value", long.alias("long"), double.alias("double"), time.alias("time"), F.length(value).alias("size")
    )
    return typed.groupBy("column").agg(
        F.count("*").alias("rows"),
        F.count_if(value.isNull()).alias("nulls"),
        F.count("long").alias("longs"),
        F.count("double").alias("doubles"),
        F.count("time").alias("timestamps"),
        *(F.min(kind).alias(name) for kind, name in zip(("long", "double", "time", "size"), LEAST)),
        *(F.max(kind).alias(name) for kind, name in zip(("long", "double", "time", "size"), MOST)),
    )


def merge_profiles(*profiles: DataFrame) -> DataFrame:
    """The profile of all rows together, from profiles of parts of them."""
    return reduce(DataFrame.unionByName, profiles).groupBy("column").agg(
        *(F.sum(name).alias(name) for name in SUMS),
        *(F.min(name).alias(name) for name in LEAST),
        *(F.max(name).alias(name) for name in MOST),
    )


def profiled_types(profile: DataFrame) -> DataFrame:
    """The profile with ``type``, ``likely`` and ``misfits``.

    ``type`` is the narrowest of bigint, double, timestamp_ntz and string that holds all values; string if
    there are none. ``likely`` is the narrowest type but string that holds the most values, if it holds
    more than half of them, else string; ``misfits`` are the values it does not hold.
    """
    values = F.col("rows") - F.col("nulls")

    def narrowest(holds: dict[str, Column]) -> Column:
        return F.coalesce(*(F.when(held, kind) for kind, held in holds.items()), F.lit("string"))

    most = F.greatest(*KINDS.values())
    likely = narrowest({k: (F.col(n) == most) & (2 * most > values) for k, n in KINDS.items()})
    fit = F.when(2 * most > values, most).otherwise(values)
    whole = narrowest({k: (F.col(n) == values) & (values > 0) for k, n in KINDS.items()})
    return profile.withColumns({"type": whole, "likely": likely, "misfits": values - fit})


def types_of(profile: DataFrame) -> dict[str, str]:
    """What :func:`read_csv` takes as ``types``: the columns that are not text."""
    rows = profiled_types(profile).select("column", "type").where("type <> 'string'")
    return {row["column"]: row["type"] for row in rows.collect()}
