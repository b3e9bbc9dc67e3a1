"""Inner joins with a selectable strategy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DataType,
    MapType,
    StringType,
    StructType,
    VariantType,
)

from blotter.sources import stored
from blotter.sources.tables import column

Key = str | tuple[str, str]

# Largest measured size of a table that is sent to every executor.
BROADCAST_LIMIT = 64 * 1024 * 1024

# A key with at most this many rows on a side is no burden for one task to read.
HOT_ROWS = 50_000

# A key with at most this many joined rows is no burden for one task to write.
HOT_PAIRS = 10_000_000

HINTS = ("merge", "shuffle_hash")

STRATEGIES = (None, "broadcast", *HINTS, "repartition", "shuffle_replicate_nl")

# Working columns: in how many pieces the rows of a key are cut on either side, and
# which piece of the left and of the right a row belongs to.
LEFT_PIECES, RIGHT_PIECES = "__left_pieces", "__right_pieces"
LEFT_PIECE, RIGHT_PIECE = "__left_piece", "__right_piece"
LEFT_ROWS, RIGHT_ROWS = "__left_rows", "__right_rows"


def equi_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[Key],
    strategy: str | None = None,
    partitions: int | None = None,
    broadcast_limit: int = BROADCAST_LIMIT,
    hot_rows: int = HOT_ROWS,
    hot_pairs: int = HOT_PAIRS,
    spread_by: Sequence[str] | None = None,
    right_bytes: int | None = None,
) -> DataFrame:
    """Inner join; the result has one column per name.

    All left columns stay in place, a right column replaces the left one of the same
    name, the other right columns follow. ``on`` holds names, or pairs of a left and
    a right name. Null keys match nothing. The strategies give the same rows:

    * ``None``: Spark chooses.
    * ``broadcast``: ``right`` goes to every executor if it measures at most
      ``broadcast_limit`` bytes, otherwise the join is done as ``merge``. Measuring runs a job
      while the join is being built, unless ``right_bytes`` says the size.
    * ``merge``: both sides are shuffled by key and sorted, which spills where memory ends;
      adaptive execution splits skewed partitions.
    * ``shuffle_hash``: both sides are shuffled by key, and a table of the right rows of a
      partition must fit into memory.
    * ``repartition``: as ``merge``. With ``partitions`` keys are counted first, by jobs that run
      while the join is being built, and those that are too much for a task are cut
      into pieces on their side and copied to each piece on the other: a key with more rows than an
      even share of a partition and than ``hot_rows``, or with more than ``hot_pairs`` joined rows.
      The piece of a row is a hash of its values, so repeated tasks give the same rows;
      ``spread_by`` names columns that tell rows apart on either side, else all are
      hashed and hence read.
    * ``shuffle_replicate_nl``: as ``merge``. A nested loop over all pairs of rows would give the
      same, but its work grows with the product of both sides.

    ``partitions`` is for ``merge``, ``shuffle_hash`` and ``repartition``, which shuffle both
    sides into that many partitions (at least ``spark.sql.shuffle.partitions``).
    """
    joined = _join(
        left, right, on, strategy, partitions, broadcast_limit, hot_rows, hot_pairs, spread_by, right_bytes
    )
    return joined.select(
        *(_side("r" if name in right.columns else "l", name) for name in left.columns),
        *(_side("r", name) for name in right.columns if name not in left.columns),
    )


def pair_join(
    left: DataFrame,
    right: DataFrame,
    on: Key,
    strategy: str | None = "repartition",
    partitions: int | None = None,
    broadcast_limit: int = BROADCAST_LIMIT,
    hot_rows: int = HOT_ROWS,
    hot_pairs: int = HOT_PAIRS,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Inner join on one key that keeps both rows apart: ``key``, ``left``, ``right``."""
    joined = _join(
        left, right, [on], strategy, partitions, broadcast_limit, hot_rows, hot_pairs, spread_by
    )
    key = on if isinstance(on, str) else on[0]
    return joined.select(
        _side("l", key).alias("key"),
        F.struct(*(_side("l", name) for name in left.columns)).alias("left"),
        F.struct(*(_side("r", name) for name in right.columns)).alias("right"),
    )


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT) -> bool:
    """Whether the rows of ``df`` measure at most ``limit`` bytes.

    A distributed sum over ``df``, which runs a job; one row comes back.
    """
    return df.agg(measured_bytes(df)).first()[0] <= limit


def measured_bytes(df: DataFrame) -> Column:
    """An aggregate: the bytes that the rows of ``df`` measure."""
    return F.coalesce(F.sum(_row_bytes(df.schema)), F.lit(0))


def common_type(df: DataFrame, other: DataFrame, name: str, other_name: str) -> str:
    """The type in which Spark compares two columns."""
    both = df.select(column(name).alias("k")).unionAll(other.select(column(other_name).alias("k")))
    return both.schema["k"].dataType.simpleString()


def _join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[Key],
    strategy: str | None,
    partitions: int | None,
    broadcast_limit: int,
    hot_rows: int,
    hot_pairs: int,
    spread_by: Sequence[str] | None,
    right_bytes: int | None = None,
) -> DataFrame:
    """The joined rows with the columns of both sides below the aliases l and r."""
    keys = [(key, key) if isinstance(key, str) else key for key in on]
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown join strategy: {strategy}")
    if partitions is not None and strategy not in (*HINTS, "repartition"):
        raise ValueError(f"a join of strategy {strategy} takes no number of partitions")

    if strategy is None:
        return _matched(left, right, keys)
    if strategy == "broadcast":
        if right_bytes is None:
            fits = fits_broadcast(right, broadcast_limit)
        else:
            fits = right_bytes <= broadcast_limit
        return _matched(left, F.broadcast(right) if fits else right.hint("merge"), keys)
    if strategy == "repartition" and partitions is not None:
        return _cut_join(left, right, keys, partitions, hot_rows, hot_pairs, spread_by)
    hint = "shuffle_hash" if strategy == "shuffle_hash" else "merge"
    return _shuffled(left, right, keys, partitions, hint)


def _matched(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]]) -> DataFrame:
    condition = [_side("l", a) == _side("r", b) for a, b in keys]
    return left.alias("l").join(right.alias("r"), condition, "inner")


def _shuffled(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[tuple[str, str]],
    partitions: int | None,
    hint: str = "merge",
) -> DataFrame:
    if partitions is not None:
        left = left.repartition(partitions, *(column(a) for a, _ in keys))
        right = right.repartition(partitions, *(column(b) for _, b in keys))
    return _matched(left, right.hint(hint), keys)


def _cut_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[tuple[str, str]],
    partitions: int,
    hot_rows: int,
    hot_pairs: int,
    spread_by: Sequence[str] | None,
) -> DataFrame:
    left_keys, right_keys = [a for a, _ in keys], [b for _, b in keys]
    left, right = left.where(_all_present(left_keys)), right.where(_all_present(right_keys))
    # Both sides must be cut by the same list, so it is worked out once and stored. Its length is
    # bounded by the result: each key in it has many rows there.
    hot = stored(
        _hot_keys(left, right, left_keys, right_keys, partitions, hot_rows, hot_pairs), "hot-keys"
    )
    if hot.isEmpty():
        return _shuffled(left, right, keys, partitions)
    left, right = _mark_hot(left, hot, left_keys), _mark_hot(right, hot, right_keys)
    left = left.withColumn(LEFT_PIECE, _own_piece(left, LEFT_PIECES, spread_by))
    left = left.withColumn(RIGHT_PIECE, _every_piece(RIGHT_PIECES))
    right = right.withColumn(RIGHT_PIECE, _own_piece(right, RIGHT_PIECES, spread_by))
    right = right.withColumn(LEFT_PIECE, _every_piece(LEFT_PIECES))
    keys = [*keys, (LEFT_PIECE, LEFT_PIECE), (RIGHT_PIECE, RIGHT_PIECE)]
    return _shuffled(left, right, keys, partitions)


def _own_piece(df: DataFrame, pieces: str, spread_by: Sequence[str] | None) -> Column:
    """One piece per row, spread evenly.

    The partition id tells copies of one row apart and, unlike a random number, is the
    same again when a lost task is repeated.
    """
    names = [name for name in spread_by or () if name in df.columns]
    told_apart = [column(name) for name in names] if names else _hashable(df.schema)
    return F.pmod(F.xxhash64(F.spark_partition_id(), *told_apart), F.col(pieces))


def _every_piece(pieces: str) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(pieces) - 1))


def _hot_keys(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    shares: int,
    hot_rows: int,
    hot_pairs: int,
) -> DataFrame:
    """Keys too big for one task, and the number of pieces to cut them into on either side.

    A piece has at most one of ``shares`` equal shares of the rows or ``hot_rows``, whichever is
    more, and a pair of pieces about ``hot_pairs`` joined rows. The larger side is cut first, as
    the other one is copied to each piece.
    """
    names = _key_columns(left_keys)
    l, r = F.col(LEFT_ROWS), F.col(RIGHT_ROWS)

    def counted(df: DataFrame, keys: Sequence[str], count: str) -> DataFrame:
        named = (column(key).alias(name) for key, name in zip(keys, names))
        return df.groupBy(*named).agg(F.count("*").alias(count))

    counts = counted(left, left_keys, LEFT_ROWS).join(counted(right, right_keys, RIGHT_ROWS), names, "full")
    counts = stored(counts, "key-counts")
    totals = counts.agg(F.coalesce(F.sum(l), F.lit(0)), F.coalesce(F.sum(r), F.lit(0))).first()
    most_left, most_right = (max(total / shares, hot_rows) for total in totals)
    pairs = F.ceil(l * r / F.lit(float(hot_pairs)))
    by_pairs = F.least(pairs, F.ceil(F.sqrt(pairs * l / r)))
    left_pieces = F.greatest(F.ceil(l / F.lit(most_left)), by_pairs, F.lit(1))
    right_pieces = F.greatest(F.ceil(r / F.lit(most_right)), F.ceil(pairs / left_pieces), F.lit(1))
    hot = (l > most_left) | (r > most_right) | (l * r > hot_pairs)
    return counts.where(l.isNotNull() & r.isNotNull() & hot).select(
        *names, left_pieces.alias(LEFT_PIECES), right_pieces.alias(RIGHT_PIECES)
    )


def _mark_hot(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each row with the number of pieces of its key, 1 unless it is hot."""
    condition = [column(key) == F.col(name) for key, name in zip(keys, _key_columns(keys))]
    marked = df.join(hot, condition, "left")
    return marked.select(
        *(column(name) for name in df.columns),
        *(F.coalesce(n, F.lit(1)).alias(n) for n in (LEFT_PIECES, RIGHT_PIECES)),
    )


def _key_columns(keys: Sequence) -> list[str]:
    return [f"__key_{i}" for i in range(len(keys))]


def _all_present(names: Sequence[str]) -> Column:
    present = F.lit(True)
    for name in names:
        present = present & column(name).isNotNull()
    return present


def _side(alias: str, name: str) -> Column:
    escaped = name.replace("`", "``")
    return F.col(f"{alias}.`{escaped}`")


def _is_nested(data_type: DataType) -> bool:
    return isinstance(data_type, ArrayType | MapType | StructType | VariantType)


def _hashable(schema: StructType) -> list[Column]:
    return [column(f.name) for f in schema.fields if not _is_nested(f.dataType)]


def _row_bytes(schema: StructType) -> Column:
    """Bytes of one row: 8 per plain value, plus the length of text and of nested values."""
    total = F.lit(8 * len(schema.fields)).cast("bigint")
    for field in schema.fields:
        value = column(field.name)
        if _is_nested(field.dataType):
            value = F.to_json(F.struct(value))
        elif not isinstance(field.dataType, StringType | BinaryType):
            continue
        total = total + F.coalesce(F.octet_length(value), F.lit(0))
    return total
