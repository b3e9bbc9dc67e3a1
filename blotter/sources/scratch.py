"""Where intermediate tables are written."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from blotter.sources.tables import read_parquet, write_parquet

#: Paths given out since the last :func:`drop_scratch`.
_given: list[str] = []
#: Tables in the catalog over such paths.
_named: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder set as ``spark.checkpoint.dir``.

    Only a session within this process may do without that setting; it gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="blotter-")
    path = f"{base.rstrip('/')}/{name}-{uuid4().hex}"
    _given.append(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, computed once and read from a table from then on.

    This runs a job at once. The table stays until :func:`drop_scratch`.
    """
    path = scratch_path(df.sparkSession, name)
    write_parquet(df, path)
    return read_parquet(df.sparkSession, path)


def stored_and_measured(df: DataFrame, name: str, measure: Column) -> tuple[DataFrame, int]:
    """Like :func:`stored`, and an aggregate that was worked out while the rows were written."""
    seen = Observation()
    table = stored(df.observe(seen, measure.alias("measure")), name)
    return table, seen.get["measure"] or 0


def stored_in_buckets(df: DataFrame, name: str, buckets: int, by: Sequence[str]) -> DataFrame:
    """Like :func:`stored`, in ``buckets`` buckets by the hash of some columns, sorted by them.

    One file per bucket, so a bucket is read by one task and in order. The session's catalog knows
    the table, as files alone do not tell how they are bucketed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = f"blotter_{uuid4().hex}"
    dealt = df.repartition(buckets, *by).write.bucketBy(buckets, *by).sortBy(*by)
    dealt.option("path", path).saveAsTable(table, format="parquet")
    _named.append(table)
    return spark.table(table)


def drop_scratch(spark: SparkSession) -> None:
    """Delete the tables stored so far. Results that read them must have been used up."""
    while _named:
        spark.sql(f"DROP TABLE IF EXISTS {_named.pop()}")
    while _given:
        delete(spark, _given.pop())


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all below it, if it is there."""
    _file_system_call(spark, path, lambda fs, at: fs.delete(at, True))


def exists(spark: SparkSession, path: str) -> bool:
    return _file_system_call(spark, path, lambda fs, at: fs.exists(at))


def _file_system_call(spark: SparkSession, path: str, call):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return call(at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at)
