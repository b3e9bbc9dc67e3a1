"""Exact top-k search by inner product with MaxScore.

Components are terms: the posting list of a component holds its value for every vector of a
shard. To make all impacts non-negative a list is read from its smallest value up where the
query is positive, and from its largest value down where it is negative; the query then has
a base score, and each term a bound |q| * (largest - smallest). With the k-th best score so
far as threshold, the terms with the smallest bounds whose sum cannot lift the base over
the threshold are non-essential. The essential lists are traversed whole; the others are
probed, largest bound first and ``PROBED`` at a time, for those vectors only whose score so
far plus the bounds left still beats the threshold. A shard is traversed in stretches, k vectors first and
each ``GROWTH`` times as long as the one before; the threshold, and with it the split, is worked out anew for each.
Vectors are kept in order of their id, so among equal scores the first stays.

Vectors are dealt to shards and queries to blocks, both by hash and of bounded size; a task
searches one shard for one block, and the best k of each shard are merged per query.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.sources import stored

SCALE = 64
SHARD = 8192
BLOCK = 2048
PROBED = 8
GROWTH = 8
LONG = (1 << 63) - 1


def integer_vectors(table: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id, v: floor(64 * x) of each component x.

    Rows take no part whose vec_id or vector is null, or whose vector holds a null or
    non-finite component. Of rows that share a vec_id the smallest vector (compared component
    by component) stands for all, so repeated rows count once.
    """
    x = F.col(vector)
    finite = F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf")))
    )
    rows = table.where(F.col("vec_id").isNotNull() & x.isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(x, lambda c: F.floor(c.cast("double") * SCALE).cast("long")).alias("v"),
    )
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def top_k(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: for each query the k best of all other vectors.

    Fewer than k if there are no more. Components that one vector has and another lacks
    count as 0. Equal scores are ranked by vec_id; scores that a long cannot hold are cut to
    its range. An empty table gives no row.
    """
    vectors = stored(vectors, "search-vectors")
    queries = vectors.where(is_query)
    shards = _parts(vectors.count(), SHARD)
    blocks = _parts(queries.count(), BLOCK)
    dealt = vectors.select(
        F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard"),
        F.explode(_numbers(blocks)).alias("block"),
        "vec_id",
        "v",
    )
    asked = queries.select(
        F.explode(_numbers(shards)).alias("shard"),
        F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block"),
        "vec_id",
        "v",
    )
    found = (
        dealt.groupBy("shard", "block")
        .cogroup(asked.groupBy("shard", "block"))
        .applyInArrow(_searcher(k), "query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _numbers(count: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))


def _parts(rows: int, size: int) -> int:
    return max(1, -(-rows // size))


def _searcher(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def search(shard: pa.Table, block: pa.Table) -> pa.Table:
        ids, vectors = _matrix(shard)
        asked, queries = _matrix(block)
        width = max(vectors.shape[1], queries.shape[1])
        vectors, queries = _widened(vectors, width), _widened(queries, width)
        order = np.argsort(ids, kind="stable")
        ids, lists = ids[order], np.ascontiguousarray(vectors[order].T)
        found = _best(ids, lists, asked, queries, k)
        names = ["query_id", "vec_id", "score"]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in found], names=names)

    return search


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors; short vectors are filled up with zeros."""
    ids = table.column("vec_id").to_numpy()
    v = table.column("v").combine_chunks()
    if not len(ids):
        return ids.astype(np.int64), np.zeros((0, 0), dtype=np.int64)
    lengths = v.value_lengths().to_numpy()
    values = v.flatten().to_numpy()
    width = int(lengths.max())
    if (lengths == width).all():
        return ids, values.reshape(len(ids), width)
    matrix = np.zeros((len(ids), width), dtype=np.int64)
    matrix[np.arange(width)[None, :] < lengths[:, None]] = values
    return ids, matrix


def _widened(matrix: np.ndarray, width: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, width - matrix.shape[1])))


def _best(ids, lists, asked, queries, k) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not len(ids) or not len(asked):
        return tuple(np.empty(0, dtype=np.int64) for _ in range(3))
    if not len(lists):  # only empty vectors: every score is 0
        lists, queries = np.zeros((1, len(ids)), np.int64), np.zeros((len(asked), 1), np.int64)
    low, high = lists.min(axis=1), lists.max(axis=1)
    # Sums of whole numbers stay exact in the narrowest kind that holds the largest of them.
    reach = 4 * sum(
        int(max(abs(int(a)), abs(int(b)))) * int(q)
        for a, b, q in zip(low, high, np.abs(queries).max(axis=0))
    )
    kind = np.float32 if reach < 1 << 24 else np.float64 if reach < 1 << 53 else object
    lists, low, high, weights = (x.astype(kind) for x in (lists, low, high, queries))
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for i, query_id in enumerate(asked):
        own = int(np.searchsorted(ids, query_id))
        own = own if own < len(ids) and ids[own] == query_id else -1
        places, scores = np.empty(0, dtype=np.int64), np.empty(0, dtype=kind)
        query = _Query(low, high, weights[i])
        begin, size = 0, k
        while begin < len(ids):
            threshold = scores.min() if len(scores) == k else None
            more, points = query.beating(lists, begin, begin + size, own, threshold)
            places, scores = _top(np.concatenate([places, more]), np.concatenate([scores, points]), k)
            begin, size = begin + size, GROWTH * size
        if kind is object:
            scores = np.array([min(max(int(s), -LONG - 1), LONG) for s in scores], dtype=np.int64)
        out.append((np.full(len(places), query_id), ids[places], scores.astype(np.int64)))
    return tuple(np.concatenate(column) for column in zip(*out))


def _top(places: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best; places rise with the ids, so the first of equal scores wins."""
    if len(places) > 8 * k and scores.dtype != object:
        enough = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        places, scores = places[enough], scores[enough]
    if scores.dtype == object:
        best = np.array(sorted(range(len(places)), key=lambda i: (-scores[i], places[i]))[:k], dtype=np.int64)
    else:
        best = np.lexsort((places, -scores))[:k]
    return places[best], scores[best]


class _Query:
    """The weights of a query, and the terms by bound."""

    def __init__(self, low: np.ndarray, high: np.ndarray, weight: np.ndarray) -> None:
        self.weight = weight
        # Adding up q * x gives base + impacts once the base of the terms not seen yet is added.
        self.start = np.where(weight > 0, low, high) * weight
        self.base = self.start.sum()
        self.bounds = np.abs(weight) * (high - low)
        self.terms = np.argsort(self.bounds, kind="stable")
        self.sums = np.cumsum(self.bounds[self.terms])

    def beating(self, lists, begin, end, own, threshold) -> tuple[np.ndarray, np.ndarray]:
        """Places of a stretch that beat the threshold, and their scores; all of them without a threshold."""
        stretch, weight, start = lists[:, begin:end], self.weight, self.start
        places = np.arange(stretch.shape[1])
        if threshold is None:
            part = weight @ stretch
            kept = places + begin != own
            return places[kept] + begin, part[kept]
        free = int(np.searchsorted(self.sums, threshold - self.base, side="right"))
        essential, others = self.terms[free:], self.terms[:free][::-1]
        left = self.sums[free - 1] if free else 0
        part = weight[essential] @ stretch[essential] + start[others].sum()
        if begin <= own < begin + len(places):
            places, part = np.delete(places, own - begin), np.delete(part, own - begin)
        whole = len(places) == stretch.shape[1]
        for at in range(0, len(others) + 1, PROBED):
            alive = part + left > threshold
            if not alive.all():
                places, part, whole = places[alive], part[alive], False
            probed = others[at : at + PROBED]
            if not len(places) or not len(probed):
                break
            impacts = stretch[probed] if whole else stretch[probed[:, None], places]
            part = part + (weight[probed] @ impacts - start[probed].sum())
            left = left - self.bounds[probed].sum()
        beats = part > threshold
        return places[beats] + begin, part[beats]
