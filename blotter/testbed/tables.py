"""Adapter from the test tables to incidents, geocode, incomes and stations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DATE_FORMAT = "MM/dd/yyyy hh:mm:ss a"

# The year the test tables are reported on.
TEST_YEAR = 1999

# All descent codes, and one that has no label.
CODES = "HBWOACDFGIJKLPSUVXZ-"

# Start of the newer of the two extracts orders are split into.
NEWER_FROM = "1999-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _position() -> tuple[Column, Column]:
    unknown = F.col("l_partkey") % 50 == 0
    lat = F.lit(33.5) + F.col("l_partkey") % 40 / F.lit(50.0)
    lon = F.lit(-118.8) + F.col("l_suppkey") % 30 / F.lit(50.0)
    zero = F.lit(0.0)
    return F.when(unknown, zero).otherwise(lat), F.when(unknown, zero).otherwise(lon)


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One incident per line item."""
    lat, lon = _position()
    descent = F.substring(F.lit(CODES), (1 + F.col("l_orderkey") % 20).cast("int"), F.lit(1))
    hhmm = (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 131) % 2400
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("DR_NO"),
        F.date_format("l_shipdate", DATE_FORMAT).alias("DATE OCC"),
        hhmm.cast("string").alias("TIME OCC"),
        (F.col("l_suppkey") % 25).cast("int").alias("AREA"),
        F.when(F.col("l_returnflag") == "R", "STREET").otherwise("OTHER").alias("Premis Desc"),
        F.when(F.col("l_linenumber") != 7, descent).alias("Vict Descent"),
        (F.col("l_quantity") * 10).cast("int").alias("Weapon Used Cd"),
        lat.alias("LAT"),
        lon.alias("LON"),
    )


def order_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One incident per order, with its date only."""
    return table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", DATE_FORMAT).alias("DATE OCC")
    )


def order_extracts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as an older and a newer extract; the older one misspells a column name."""
    orders = table(spark, sf_dir, "orders")
    date, start = F.col("o_orderdate"), F.lit(NEWER_FROM).cast("timestamp_ntz")
    old = orders.where(date < start).withColumnRenamed("o_custkey", "o_custkey ")
    new = orders.where((date >= start) | date.isNull())
    return old, new


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text, some numbers spoilt; ``newer`` splits them into two extracts."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    text = {name: F.col(name).cast("string") for name in ("o_orderkey", "o_custkey", "o_totalprice")}
    return orders.select(
        text["o_orderkey"].alias("o_orderkey"),
        F.when(key % 7 == 0, F.concat(F.lit("A"), text["o_custkey"])).otherwise(text["o_custkey"]).alias("o_custkey"),
        F.when(key % 11 == 0, "n/a").when(key % 13 == 0, "").otherwise(text["o_totalprice"]).alias("o_totalprice"),
        F.when(key % 2 == 0, "yes").otherwise("no").alias("newer"),
    )


def order_reports(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as numbered reports in an older and a newer extract. The newer one corrects older
    reports, some twice, and moves some of them to another year."""
    key, date, start = F.col("o_orderkey"), F.col("o_orderdate"), F.lit(NEWER_FROM).cast("timestamp_ntz")
    reports = table(spark, sf_dir, "orders").select(
        key.alias("DR_NO"),
        F.date_format(date, DATE_FORMAT).alias("DATE OCC"),
        F.col("o_custkey").alias("AREA"),
        F.lit(1).alias("version"),
        (date < start).alias("old"),
    )
    older = reports.where("old").drop("old")
    corrected = older.where(F.col("DR_NO") % 50 == 0).withColumns(
        {"AREA": F.col("AREA") + 1, "version": F.lit(3)}
    )
    moved = F.when(F.col("DR_NO") % 100 == 0, F.lit("12/31/1998 12:00:00 AM")).otherwise(F.col("DATE OCC"))
    superseded = corrected.where(F.col("DR_NO") % 150 == 0).withColumns({"AREA": F.lit(-1), "version": F.lit(2)})
    newer = reports.where(~F.col("old")).drop("old").unionByName(corrected.withColumn("DATE OCC", moved))
    return older, newer.unionByName(superseded)


def drifted_orders(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Two extracts of orders: each lacks a column, and a number and a key have other types."""
    orders = table(spark, sf_dir, "orders")
    even = F.col("o_orderkey") % 2 == 0
    return {
        "old": orders.where(even).select(
            F.col("o_orderkey").cast("int").alias("o_orderkey "),
            "o_totalprice",
            F.col("o_custkey").cast("string").alias("o_custkey"),
            "o_orderstatus",
        ),
        "new": orders.where(~even).select(
            "o_orderkey", "o_custkey", F.round("o_totalprice").cast("int").alias("o_totalprice"), "o_orderpriority"
        ),
    }


def texts_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text: numbers, dates, text, and some of each that do not fit."""
    key = F.col("o_orderkey")
    price = F.format_string("%d.25", key * 3)
    date = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf_dir, "orders").select(
        key.cast("string").alias("whole"),
        F.when(key % 11 == 0, "n/a").when(key % 13 == 0, F.lit(None).cast("string")).otherwise(price).alias("price"),
        F.when(key % 2 == 0, price).otherwise(key.cast("string")).alias("mixed"),
        date.alias("date"),
        F.when(key % 3 == 0, date).when(key % 3 == 1, F.col("o_custkey").cast("string")).otherwise("").alias("jumble"),
        F.col("o_orderpriority").alias("text"),
        F.lit(None).cast("string").alias("nothing"),
    )


def broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``line``: orders as CSV lines, some with a field too few or too many or a quote left open;
    ``newer`` splits them into two extracts."""
    key = F.col("o_orderkey")
    start = F.concat_ws(",", key.cast("string"), F.col("o_custkey").cast("string"))
    whole = F.concat(start, F.lit(',"day '), (key % 5).cast("string"), F.lit(', sent"'))
    line = (
        F.when(key % 17 == 0, start)
        .when(key % 19 == 0, F.concat(whole, F.lit(", more ")))
        .when(key % 23 == 0, F.concat(start, F.lit(',"open')))
        .otherwise(whole)
    )
    return table(spark, sf_dir, "orders").select(line.alias("line"), (key % 2 == 0).alias("newer"))


def odd_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names with everything that CSV may lose."""
    key = F.col("p_partkey")
    odd = (
        F.when(key % 8 == 0, F.lit(None).cast("string"))
        .when(key % 8 == 1, "")
        .when(key % 8 == 2, F.concat(F.lit("  "), "p_name", F.lit("\t ")))
        .when(key % 8 == 3, F.concat(F.lit('"'), "p_name", F.lit('", "')))
        .when(key % 8 == 4, F.concat("p_name", F.lit("\nnext\\")))
        .when(key % 8 == 5, F.concat(F.lit("\\\""), "p_name", F.lit("\\")))
        .when(key % 8 == 6, " ")
        .otherwise(F.col("p_name"))
    )
    return table(spark, sf_dir, "part").select("p_partkey", odd.alias("odd"), F.reverse(odd).alias("turned"))


def geocode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points with their ZIPs as written down, several per point."""
    lat, lon = _position()
    spread = F.col("l_partkey") % 40 * 7 + F.col("l_suppkey") % 30 * 3 + F.col("l_orderkey") % 3
    kind = F.col("l_orderkey") % 3
    suffix = F.when(kind == 0, "; 90050").when(kind == 1, "-3018").otherwise("")
    return (
        table(spark, sf_dir, "lineitem")
        .select(
            lat.alias("LAT"),
            lon.alias("LON"),
            F.concat((90000 + spread % 25).cast("string"), suffix).alias("ZIPcode"),
        )
        .distinct()
    )


def incomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ZIP per nation, the average balance of its customers as money text."""
    average = F.round(F.avg("c_acctbal")).cast("bigint")
    return (
        table(spark, sf_dir, "customer")
        .groupBy("c_nationkey")
        .agg(money_text(average).alias("Estimated Median Income"))
        .select((90000 + F.col("c_nationkey")).alias("Zip Code"), "Estimated Median Income")
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One station per nation."""
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        (key + 1).alias("OBJECTID"),
        F.col("n_name").alias("DIVISION"),
        key.alias("PREC"),
        (F.lit(-118.6) + F.lit(0.02) * key).alias("x"),
        (F.lit(33.6) + F.lit(0.03) * key).alias("y"),
    )


def money_text(amount: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(amount, 0))
