"""Tables laid out by place, so that a scan of an area skips what lies elsewhere."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.functions import morton_key
from blotter.sources.tables import column, write_parquet

#: Bytes of a row group. Each has the least and the largest value of every column beside it, by which readers skip it.
ROW_GROUP = 16 * 1024 * 1024

#: Working column: the place as a number.
PLACE = "_place"


def write_clustered(
    df: DataFrame,
    path: str,
    lat: str = "LAT",
    lon: str = "LON",
    files: int | None = None,
    row_group: int = ROW_GROUP,
    mode: str = "error",
    spread_by: Sequence[str] | None = None,
) -> None:
    """Write Parquet in the order of a Morton curve over two coordinates.

    Points near each other are near each other on the curve, so a file, and a row group of it, covers a small
    area. Readers need no more than conditions on the coordinates to skip the others. Rows are dealt to
    ``files`` (by default as many as shuffle partitions) by ranges of the curve; rows of one
    point are dealt by ``spread_by``, by default all plain columns, so that a point with a large part of all
    rows is more than one file. Rows without a coordinate come first.
    """
    spark = df.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = [f.name for f in df.schema.fields if f.dataType.simpleString().split("<")[0] not in ("map", "array", "struct", "variant")]
    told_apart = F.xxhash64(*map(column, spread_by or plain))
    placed = df.withColumn(PLACE, morton_key(column(lat), column(lon)))
    ranged = placed.repartitionByRange(files, F.col(PLACE), told_apart).sortWithinPartitions(PLACE)
    write_parquet(ranged.drop(PLACE), path, mode, **{"parquet.block.size": str(row_group)})
