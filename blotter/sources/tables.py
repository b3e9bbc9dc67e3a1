"""CSV and Parquet tables: one file or a directory of parts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

#: Quotes are doubled inside quotes, and blanks belong to the value, on both ways.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

#: Stands for a missing value while a line is parsed. A field without quotes and content is
#: missing, quotes without content are the empty string; the reader tells them apart only
#: if missing values have a text of their own.
MISSING = "\u0000missing\u0000"


def column(name: str) -> Column:
    """A column by its exact name, also with blanks or dots in it."""
    escaped = name.replace("`", "``")
    return F.col(f"`{escaped}`")


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Give the listed columns a type; text that does not fit gives null."""
    return df.select(
        *(
            column(name).try_cast(types[name]).alias(name) if name in types else column(name)
            for name in df.columns
        )
    )


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str | None = None,
    types: Mapping[str, str] | None = None,
    infer: bool = False,
    multiline: bool = False,
    **options: str,
) -> DataFrame:
    """CSV with a header in each part.

    No full pass is spent on guessing types unless ``infer`` asks for it: give the
    whole ``schema`` in file order, or ``types`` for some columns by name, or
    neither and every column is text. A schema whose names differ from the header, or come
    in another order, is an error. ``multiline`` accepts line breaks inside quotes; such a
    file cannot be split, so one task reads all of it.
    """
    reader = spark.read.options(**CSV_OPTIONS).option("nullValue", MISSING)
    reader = reader.option("multiLine", multiline).option("enforceSchema", False).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    df = reader.csv(path if isinstance(path, str) else list(path))
    return cast_columns(df, types) if types else df


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "error", multiline: bool = False) -> None:
    """One part per partition, each with a header; :func:`read_csv` gives the same rows back.

    A line break inside a value would become two rows for a reader that splits files, so it
    is an error unless ``multiline`` says that the table will be read as such.
    """
    if not multiline:
        df = df.select(
            *(
                _on_one_line(field.name) if isinstance(field.dataType, StringType) else column(field.name)
                for field in df.schema.fields
            )
        )
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def write_parquet(
    df: DataFrame, path: str, mode: str = "error", partition_by: Sequence[str] = (), **options: str
) -> None:
    df.write.mode(mode).options(**options).partitionBy(*partition_by).parquet(path)


def _on_one_line(name: str) -> Column:
    message = F.lit(f"line break in column {name}; write it with multiline=True")
    broken = column(name).rlike("[\n\r]")
    return F.when(broken, F.raise_error(message).cast("string")).otherwise(column(name)).alias(name)
