"""Two tables stored for joins on one key: shuffled and sorted once, joined any number of times."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.operators.joins import (
    HOT_PAIRS,
    HOT_ROWS,
    LEFT_PIECE,
    LEFT_PIECES,
    RIGHT_PIECE,
    RIGHT_PIECES,
    Key,
    _all_present,
    _every_piece,
    _hot_keys,
    _mark_hot,
    _own_piece,
    _side,
    common_type,
)
from blotter.sources import stored, stored_in_buckets
from blotter.sources.tables import column


@dataclass(frozen=True)
class Copartitioned:
    """Stored tables whose rows of one key are in buckets of the same number, sorted by key.

    Joins read bucket by bucket in ``partitions`` tasks and shuffle nothing; only the columns that are used
    are read. ``left`` and ``right`` are the tables, with the columns by which they are stored behind
    their own.
    """

    left: DataFrame
    right: DataFrame
    on: tuple[tuple[str, str], ...]
    stored_by: tuple[str, ...]
    left_columns: tuple[str, ...]
    right_columns: tuple[str, ...]
    partitions: int

    def join(self) -> DataFrame:
        """The rows and columns of ``equi_join``."""
        return self._joined().select(
            *(_side("r" if name in self.right_columns else "l", name) for name in self.left_columns),
            *(_side("r", name) for name in self.right_columns if name not in self.left_columns),
        )

    def pairs(self) -> DataFrame:
        """The rows and columns of ``pair_join``: ``key`` is the first one, as it is on the left."""
        return self._joined().select(
            _side("l", self.on[0][0]).alias("key"),
            F.struct(*(_side("l", name) for name in self.left_columns)).alias("left"),
            F.struct(*(_side("r", name) for name in self.right_columns)).alias("right"),
        )

    def _joined(self) -> DataFrame:
        condition = [_side("l", name) == _side("r", name) for name in self.stored_by]
        return self.left.alias("l").join(self.right.hint("merge").alias("r"), condition, "inner")


def copartition(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[Key],
    partitions: int,
    hot_rows: int = HOT_ROWS,
    hot_pairs: int = HOT_PAIRS,
    spread_by: Sequence[str] | None = None,
) -> Copartitioned:
    """Store both sides in ``partitions`` buckets by the keys of a join; runs jobs.

    Each side is shuffled once. Keys are compared in the type both sides have in common, and rows without a
    key, which no inner join returns, are not stored. Keys too big for a task (as ``equi_join`` counts
    them, with ``hot_rows``, ``hot_pairs`` and ``spread_by``) are cut into pieces on one
    side and copied to them on the other, so that no bucket is one key. Keys with fractions (float, double)
    are joined rightly, but Spark shuffles them again. The tables stay until
    ``drop_scratch``.
    """
    keys = [(key, key) if isinstance(key, str) else key for key in on]
    names = [f"__by_{i}" for i in range(len(keys))]
    sides = []
    for df, other, at in ((left, right, 0), (right, left, 1)):
        typed = df
        for name, key in zip(names, keys):
            kind = common_type(df, other, key[at], key[1 - at])
            typed = typed.withColumn(name, column(key[at]).cast(kind))
        sides.append(typed.where(_all_present(names)))
    hot = stored(_hot_keys(*sides, names, names, partitions, hot_rows, hot_pairs), "hot-keys")
    stored_by = names
    if not hot.isEmpty():
        stored_by = [*names, LEFT_PIECE, RIGHT_PIECE]
        sides = [_mark_hot(side, hot, names) for side in sides]
        own = ((LEFT_PIECE, LEFT_PIECES, RIGHT_PIECE, RIGHT_PIECES), (RIGHT_PIECE, RIGHT_PIECES, LEFT_PIECE, LEFT_PIECES))
        for k, (piece, pieces, other_piece, other_pieces) in enumerate(own):
            spread = sides[k].withColumn(piece, _own_piece(sides[k], pieces, spread_by))
            spread = spread.withColumn(other_piece, _every_piece(other_pieces))
            sides[k] = spread.drop(pieces, other_pieces)
    tables = [stored_in_buckets(side, "copartitioned", partitions, stored_by) for side in sides]
    return Copartitioned(
        *tables, tuple(keys), tuple(stored_by), tuple(left.columns), tuple(right.columns), partitions
    )

