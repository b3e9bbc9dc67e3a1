"""CSV lines that fit their header, and those that do not."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.sources.tables import CSV_OPTIONS, MISSING, column

#: Working columns: a line as it stands in the file, the file, and why the line does not fit.
LINE, FILE, REASON = "_line", "_file", "_reason"

#: A line is read whole, as one column: characters that text does not hold stand in for the comma and
#: the quote. The reader still drops the header of each part, and only that.
WHOLE_LINES = CSV_OPTIONS | {"sep": "\u0001", "quote": "", "escape": "\u0000"}

#: Columns of what is set aside.
MALFORMED = "file string, reason string, line string"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line below the headers: the columns of the header as text, ``_line``, ``_file``, ``_reason``.

    ``_reason`` is null for a line that has a field for each column of the header. Else it
    says what is wrong, and all columns are null: there are fewer or more fields, or an odd number
    of quotes, so that a quoted value runs on behind the end of the line. Lines of
    blanks only are no lines. A part whose header differs is an error; a table without a header
    has no columns and no lines.
    """
    names = spark.read.options(**CSV_OPTIONS).csv(path).columns
    if not names:
        return spark.createDataFrame([], f"{LINE} string, {FILE} string, {REASON} string")
    if taken := {LINE, FILE, REASON} & set(names):
        raise ValueError(f"names of working columns in the header: {sorted(taken)}")
    reader = spark.read.options(**WHOLE_LINES).option("enforceSchema", False)
    (header,) = reader.csv(path).columns
    whole = reader.schema(f"{_quoted(header)} string").csv(path)
    # The working column for lines that do not fit must not have a name that the header has.
    unfit = "_unfit" + "_" * max(map(len, names))
    schema = ", ".join(f"{_quoted(name)} string" for name in (*names, unfit))
    options = {key: value for key, value in CSV_OPTIONS.items() if key != "header"}
    options |= {"nullValue": MISSING, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": unfit}
    lines = whole.select(
        column(header).alias(LINE),
        F.col("_metadata.file_path").alias(FILE),
        F.from_csv(column(header), schema, options).alias("_parsed"),
    )
    quotes = F.length(LINE) - F.length(F.replace(F.col(LINE), F.lit('"'), F.lit("")))
    reason = F.when(quotes % 2 == 1, "odd number of quotes").when(
        F.col("_parsed").getField(unfit).isNotNull(), f"not {len(names)} fields"
    )
    judged = lines.withColumn(REASON, reason)
    fits = F.col(REASON).isNull()
    return judged.select(
        *(F.when(fits, F.col("_parsed").getField(name)).alias(name) for name in names), LINE, FILE, REASON
    )


def fitting(lines: DataFrame, strict: bool = False) -> DataFrame:
    """The rows of lines that fit. ``strict`` makes the others an error."""
    fits = F.col(REASON).isNull()
    if strict:
        message = F.concat(F.lit("malformed line, "), REASON, F.lit(": "), LINE)
        fits = F.when(fits, True).otherwise(F.raise_error(message).cast("boolean"))
    return lines.where(fits).drop(LINE, FILE, REASON)


def malformed(lines: DataFrame) -> DataFrame:
    """file, reason, line: the lines that do not fit, as they stand there."""
    return lines.where(F.col(REASON).isNotNull()).select(
        F.col(FILE).alias("file"), F.col(REASON).alias("reason"), F.col(LINE).alias("line")
    )


def _quoted(name: str) -> str:
    escaped = name.replace("`", "``")
    return f"`{escaped}`"
