from plan import executed_plan, planned
from pyspark.sql import functions as F

from blotter.operators import min_per_key, semi_join, top_k, top_n_per_group


def test_top_n_keeps_ties_and_gaps(spark):
    rows = [("a", n) for n in (9, 9, 7, 7, 5)] + [("b", n) for n in (1, 2)] + [(None, 3)]
    df = top_n_per_group(spark.createDataFrame(rows, "g string, n int"), ["g"], [F.desc("n")], 3)
    got = sorted((str(r.g), r.n, r["rank"]) for r in df.collect())
    assert got == [
        ("None", 3, 1), ("a", 7, 3), ("a", 7, 3), ("a", 9, 1), ("a", 9, 1), ("b", 1, 2), ("b", 2, 1),
    ]


def test_top_n_drops_rows_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 5)
    plan = planned(top_n_per_group(df, ["g"], [F.desc("id")], 3))
    assert plan.count("WindowGroupLimit") == 2


def test_top_k(spark):
    rows = [(1, 5.0), (2, 3.0), (3, 3.0), (4, 9.0)]
    df = spark.createDataFrame(rows, "zip int, income double")
    assert [r.zip for r in top_k(df, "income", 2, ties=["zip"]).collect()] == [2, 3]
    assert [r.zip for r in top_k(df, "income", 2, ascending=False, ties=["zip"]).collect()] == [4, 1]
    assert "TakeOrderedAndProject" in planned(top_k(df, "income", 2))


def test_top_k_takes_nulls_last(spark):
    df = spark.createDataFrame([(1, None), (2, 2.0), (3, 5.0)], "zip int, income double")
    assert [r.zip for r in top_k(df, "income", 2).collect()] == [2, 3]
    assert [r.zip for r in top_k(df, "income", 3, ascending=False).collect()] == [3, 2, 1]


def test_min_per_key(spark):
    rows = [
        (1.0, 2.0, "b"), (1.0, 2.0, "a"), (1.0, 2.0, "a"), (0.0, 2.0, "z"), (-0.0, 2.0, "y"),
        (3.0, 3.0, None), (4.0, 4.0, None), (4.0, 4.0, "c"), (None, 1.0, "n"), (5.0, 5.0, ""),
    ]
    df = min_per_key(
        spark.createDataFrame(rows, "lat double, lon double, z string"), ["lat", "lon"], "z", "m"
    )
    got = {(r.lat, r.lon): r.m for r in df.collect()}
    assert got == {
        (1.0, 2.0): "a", (0.0, 2.0): "y", (3.0, 3.0): None, (4.0, 4.0): "c", (None, 1.0): "n",
        (5.0, 5.0): "",
    }


def test_min_per_key_sorts_only_distinct_pairs(spark):
    df = spark.range(10_000).select((F.col("id") % 3).alias("k"), F.lit("same").alias("v"))
    plan = executed_plan(min_per_key(df, ["k"], "v", "m"))
    scan_side = plan[plan.rindex("SortAggregate") :]
    assert "HashAggregate" in scan_side


def test_semi_join(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    right = spark.createDataFrame([(1,), (1,), (3,), (None,)], "k int")
    assert sorted(r.v for r in semi_join(left, right, "k").collect()) == ["a", "b"]
    assert "LeftSemi" in planned(semi_join(left, right, "k"))
