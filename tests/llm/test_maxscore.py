"""MaxScore against scores of every pair."""

import numpy as np
import pytest
from blotter.llm import maxscore
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F


def by_hand(ids, vectors, asked, queries, k):
    rows = []
    for query_id, query in zip(asked, queries):
        scores = [(-sum(int(a) * int(b) for a, b in zip(v, query)), int(i)) for i, v in zip(ids, vectors) if i != query_id]
        rows += [(int(query_id), i, -s) for s, i in sorted(scores)[:k]]
    return rows


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(0, 700), st.integers(0, 9), st.sampled_from([1, 3, 20]), st.sampled_from([2, 60, 10**6, 10**8]))
def test_best_of_a_shard(seed, size, width, k, largest):
    dice = np.random.default_rng(seed)
    ids = np.sort(dice.choice(3 * size + 5, size, replace=False))
    vectors = dice.integers(-largest, largest + 1, (size, width))
    if size and width:
        vectors[dice.integers(0, size, size // 3)] = vectors[0]
    asked = np.concatenate([ids[:: max(size // 5, 1)], [10**6]])
    queries = np.concatenate([vectors[:: max(size // 5, 1)], dice.integers(-largest, largest + 1, (1, width))])
    found = maxscore._best(ids, np.ascontiguousarray(vectors.T), asked, queries, k)
    assert list(zip(*(c.tolist() for c in found))) == by_hand(ids, vectors, asked, queries, k)


@pytest.mark.parametrize("size", [1, 20, 21, 511, 512, 513, 1300])
def test_sizes_around_the_stretches(size):
    dice = np.random.default_rng(size)
    vectors = np.floor(dice.normal(size=(size, 16)) * 10).astype(np.int64)
    ids = np.arange(size) * 20
    found = maxscore._best(ids, np.ascontiguousarray(vectors.T), ids[:9], vectors[:9], 20)
    assert list(zip(*(c.tolist() for c in found))) == by_hand(ids, vectors, ids[:9], vectors[:9], 20)


def test_later_stretches_probe_few_vectors():
    """Lists with small bounds are probed for the vectors only that may still win."""
    dice = np.random.default_rng(3)
    vectors = np.floor(dice.normal(size=(4000, 32)) * np.r_[np.full(4, 400), np.full(28, 4)]).astype(np.int64)
    lists = np.ascontiguousarray(vectors.T).astype(np.float64)
    low, high = lists.min(axis=1), lists.max(axis=1)
    threshold = np.sort(vectors @ vectors[0])[-30]
    places, scores = maxscore._Query(low, high, lists[:, 0]).beating(lists, 1000, 4000, -1, threshold)
    exact = vectors[1000:] @ vectors[0]
    assert places.tolist() == (1000 + np.flatnonzero(exact > threshold)).tolist()
    assert scores.tolist() == exact[exact > threshold].tolist()


def test_many_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(maxscore, "SHARD", 150)
    monkeypatch.setattr(maxscore, "BLOCK", 20)
    dice = np.random.default_rng(4)
    vectors = dice.integers(-30, 31, (1200, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, v array<long>")
    rows = maxscore.top_k(df, F.col("vec_id") % 20 == 0, k=20).orderBy("query_id", "rank").collect()
    ids = np.arange(1200)
    wanted = by_hand(ids, vectors, ids[::20], vectors[::20], 20)
    assert [(r["query_id"], r["vec_id"], r["score"]) for r in rows] == wanted
    assert [r["rank"] for r in rows] == [*range(1, 21)] * 60
