"""Joins over stored buckets against joins that shuffle."""

import pytest
from plan import executed_plan, planned
from pyspark.sql import functions as F

from blotter import plans, sources
from blotter.operators import copartition, equi_join, pair_join
from blotter.plans.distances import AREA_OF_STATION


def listed(df):
    return sorted((str(tuple(row)) for row in df.collect()))


@pytest.fixture
def sides(spark):
    left = spark.sql("SELECT CAST(IF(id % 9 = 0, NULL, id % 13) AS int) AS `A r.ea`, id AS n, 'left' AS name FROM range(400)")
    right = spark.sql("SELECT id % 17 AS PREC, concat('s', id) AS name, id AS extra FROM range(40) UNION ALL SELECT NULL, 'x', 0")
    return left, right


@pytest.fixture
def many_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_rows_and_columns(spark, sides):
    on = [("A r.ea", "PREC")]
    stored = copartition(*sides, on, 3)
    plain = equi_join(*sides, on)
    assert stored.join().columns == plain.columns and listed(stored.join()) == listed(plain)
    assert listed(stored.pairs()) == listed(pair_join(*sides, on[0]))


def test_nothing_is_shuffled_and_every_bucket_is_a_task(spark, sides, many_partitions):
    stored = copartition(*sides, [("A r.ea", "PREC")], 4)
    for df in (stored.join(), stored.pairs(), stored.join().groupBy("PREC").agg(F.sum("n"))):
        for plan in (planned(df), executed_plan(df)):
            assert "SortMergeJoin" in plan
            below = plan.split("SortMergeJoin")[1]
            assert "Exchange" not in below and "SelectedBucketsCount: 4 out of 4" in below
    assert stored.join().rdd.getNumPartitions() == 4
    assert "n#" not in executed_plan(stored.join().select("extra")).split("ReadSchema")[1]


def test_composite_keys_and_text(spark):
    left = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, None, 3), (2, "a", 4)], "k int, t string, n int")
    right = spark.createDataFrame([(1, "a", 10), (2, "a", 20), (2, "a", 21), (None, "a", 30)], "k long, t string, m int")
    stored = copartition(left, right, ["k", "t"], 2)
    assert listed(stored.join()) == listed(equi_join(left, right, ["k", "t"]))
    assert "Exchange" not in planned(stored.join())


def test_keys_with_fractions(spark):
    left = spark.createDataFrame([(0.0, 1), (-0.0, 2), (float("nan"), 3)], "k double, n int")
    right = spark.createDataFrame([(-0.0, 10), (float("nan"), 20)], "k double, m int")
    assert listed(copartition(left, right, ["k"], 2).join()) == listed(equi_join(left, right, ["k"]))


@pytest.mark.parametrize("spread_by", [None, ["n", "m"]])
def test_hot_keys_are_cut(spark, many_partitions, spread_by):
    left = spark.range(3000).selectExpr("IF(id % 3 = 0, id % 50, 7) AS k", "id AS n")
    right = spark.range(100).selectExpr("id % 50 AS k", "id AS m")
    stored = copartition(left, right, ["k"], 4, hot_rows=100, spread_by=spread_by)
    assert listed(stored.join()) == listed(equi_join(left, right, ["k"]))
    sizes = [r["n"] for r in stored.left.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) > 1 and max(sizes) < 2000 and sum(sizes) == 3000
    assert "Exchange" not in planned(stored.join())


def test_empty_sides(spark, sides):
    left, right = sides
    on = [("A r.ea", "PREC")]
    assert copartition(left.where("false"), right, on, 3).join().collect() == []
    assert copartition(left, right.where("false"), on, 3).join().collect() == []


def test_tables_can_be_dropped(spark, sides):
    sources.drop_scratch(spark)
    copartition(*sides, [("A r.ea", "PREC")], 3)
    assert len([t for t in spark.catalog.listTables() if t.name.startswith("blotter_")]) == 2
    sources.drop_scratch(spark)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("blotter_")]


@pytest.fixture
def areas(spark):
    incidents = spark.range(60).selectExpr("id AS DR_NO", "'01/01/2015' AS `DATE OCC`", "CAST(id % 7 AS int) AS AREA")
    stations = spark.range(5).selectExpr("concat('D', id) AS DIVISION", "id AS PREC")
    return incidents, stations


def test_all_variants_have_the_same_rows(spark, areas):
    report = plans.compare_join_rows(*areas, partitions=3).collect()
    assert {r["variant"] for r in report} == {"broadcast", "repartition", "copartitioned", "bucketed"}
    assert all(r["matches"] for r in report) and len(report) == 4 * 5
    assert sum(r["found_rows"] for r in report) == 4 * equi_join(*areas, AREA_OF_STATION).count()


def test_wrong_rows_are_listed_with_their_key(spark, areas):
    plain = equi_join(*areas, AREA_OF_STATION)
    doubled = plain.unionByName(plain.where("DR_NO = 3"))
    missing = plain.where("DR_NO <> 8")
    swapped = plain.withColumn("DIVISION", F.when(F.col("DR_NO") == 4, "D0").otherwise(F.col("DIVISION")))
    extra = plain.unionByName(plain.where("DR_NO = 2").withColumn("AREA", F.lit(99)))
    gone = plain.where("AREA <> 1")
    cases = {"doubled": doubled, "missing": missing, "swapped": swapped, "extra": extra, "gone": gone, "same": plain}
    report = plans.compare_rows(plain, cases, "AREA").where("NOT matches").collect()
    assert {(r["variant"], r["key"], r["found_rows"] - r["expected_rows"]) for r in report} == {
        ("doubled", 3, 1), ("missing", 1, -1), ("swapped", 4, 0), ("extra", 99, 1), ("gone", 1, -9)
    }
