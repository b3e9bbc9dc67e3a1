
from __future__ import annotations

import sys
import warnings
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parent
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

from blotter import plans, sources  # noqa: E402
from blotter import functions as fn  # noqa: E402
from blotter.operators import (  # noqa: E402
    copartition,
    equi_join,
    min_per_key,
    pair_join,
    semi_join,
    top_k,
)
from blotter.plans.distances import AREA_OF_STATION  # noqa: E402
from blotter.plans.victims import DESCENTS, clean_incomes  # noqa: E402
from blotter.testbed import oracle, tables  # noqa: E402
from blotter.testbed.tables import TEST_YEAR  # noqa: E402

try:
    import corpus_pipeline
    from blotter.llm.queries import ORACLE as LLM_SQL
    from blotter.llm.queries import QUERIES as LLM_QUERIES

    LLM_QUERIES = {**LLM_QUERIES, "pipeline": corpus_pipeline.run}
    if corpus_pipeline.ORACLE_SQL is not None:
        LLM_SQL = {**LLM_SQL, "pipeline": corpus_pipeline.ORACLE_SQL}
except ModuleNotFoundError as missing:
    # The training-data operators, or modules that only they need, may have been left out of a deployment.
    if missing.name not in ("corpus_pipeline", "blotter.llm", "blotter.llm.queries"):
        warnings.warn(f"no training-data queries: {missing}", stacklevel=1)
    LLM_QUERIES, LLM_SQL = {}, {}

SMOKE_DIR = "/root/testdata/sf0.001"

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """Mean distance and number of incidents per division."""
    return q4_distance_by_division(spark, SMOKE_DIR)


# Sources and sinks


def etl_union_renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = tables.order_extracts(spark, sf_dir)
    return sources.combine(old, new, {"o_custkey ": "o_custkey"})


def etl_csv_to_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two raw CSV extracts in, Parquet and CSV copies out, Parquet read back."""
    old, new = tables.order_extracts(spark, sf_dir)
    old_path, new_path, csv_path, parquet_path = (
        sources.scratch_path(spark, name)
        for name in ("orders-old", "orders-new", "orders-csv", "orders-parquet")
    )
    sources.write_csv(old, old_path)
    sources.write_csv(new, new_path)
    return sources.build_incidents(
        spark,
        old_path,
        new_path,
        csv_path,
        parquet_path,
        types={
            "o_orderkey": "bigint",
            "o_custkey": "bigint",
            "o_totalprice": "double",
            "o_orderdate": "timestamp_ntz",
        },
        renames={"o_custkey ": "o_custkey"},
        date=None,
    )


def etl_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracts with numbers that are none; what did not fit, by row and column."""
    parquet_path = sources.scratch_path(spark, "dirty-parquet")
    raw = tables.dirty_orders(spark, sf_dir)
    paths = [sources.scratch_path(spark, name) for name in ("dirty-old", "dirty-new", "dirty-csv")]
    sources.write_csv(raw.where("newer = 'no'").drop("newer"), paths[0])
    sources.write_csv(raw.where("newer = 'yes'").drop("newer"), paths[1])
    sources.build_incidents(
        spark, *paths, parquet_path,
        types={"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double"}, renames={}, date=None,
    )
    return sources.rejects(spark, parquet_path).select(
        "o_orderkey", "o_custkey", "o_totalprice", "rejected_column", "rejected_text"
    )


def etl_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracts with lines that do not fit their header; the rows, and those lines as they stand."""
    broken = tables.broken_lines(spark, sf_dir).withColumnRenamed("line", "o_orderkey,o_custkey,note")
    paths = [sources.scratch_path(spark, name) for name in ("lines-old", "lines-new", "lines-csv", "lines-parquet")]
    for newer, path in zip((False, True), paths):
        broken.where(F.col("newer") == newer).drop("newer").write.options(**sources.WHOLE_LINES).csv(path)
    set_aside = sources.scratch_path(spark, "lines-malformed")
    rows = sources.build_incidents(
        spark, *paths, types={"o_orderkey": "bigint", "o_custkey": "bigint"}, renames={}, date=None,
        malformed_path=set_aside, verify=True,
    )
    lines = sources.read_parquet(spark, set_aside).select("reason", "line")
    return rows.unionByName(lines, allowMissingColumns=True)


def etl_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both copies of a table that was built from two extracts, read back and compared by year."""
    paths = _incident_extracts(spark, sf_dir)
    sources.build_incidents(spark, *paths, verify=True)
    return sources.compare_copies(spark, *paths[2:])


def etl_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table of two older extracts, and a newer one merged into it."""
    older, newer = tables.order_reports(spark, sf_dir)
    paths = [
        sources.scratch_path(spark, name)
        for name in ("reports-old", "reports-new", "reports-csv", "reports-parquet", "reports-newer")
    ]
    even = F.col("DR_NO") % 2 == 0
    for df, path in ((older.where(even), paths[0]), (older.where(~even), paths[1]), (newer, paths[4])):
        sources.write_csv(df, path)
    types = {"DR_NO": "bigint", "AREA": "int", "version": "int"}
    sources.build_incidents(spark, *paths[:4], types=types)
    return sources.merge_extract(spark, paths[3], paths[4], newest=["version"], types=types)


def etl_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.reconcile(tables.drifted_orders(spark, sf_dir), {"o_orderkey ": "o_orderkey"})


def csv_type_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The types of a CSV table, from the profiles of its two halves."""
    texts = tables.texts_of_orders(spark, sf_dir)
    half = F.col("whole").cast("bigint") % 2 == 0
    parts = (_through_csv(spark, texts.where(part)) for part in (half, ~half))
    return sources.profiled_types(sources.merge_profiles(*map(sources.type_profile, parts)))


def csv_lossless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blanks, empty strings, nulls, quotes, backslashes and line breaks, there and back."""
    odd = tables.odd_texts(spark, sf_dir)
    path = sources.scratch_path(spark, "odd-csv")
    sources.write_csv(odd, path, multiline=True)
    return sources.read_csv(spark, path, schema=odd.schema, multiline=True)


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A directory of CSV parts, read back with the declared schema."""
    orders = etl_union_renamed(spark, sf_dir)
    path = sources.scratch_path(spark, "orders-csv")
    sources.write_csv(orders, path)
    return sources.read_csv(spark, path, schema=orders.schema)


def csv_untyped_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sources.scratch_path(spark, "part-csv")
    sources.write_csv(tables.table(spark, sf_dir, "part"), path)
    return sources.read_csv(spark, path)


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sources.scratch_path(spark, "orders-parquet")
    sources.write_parquet(etl_union_renamed(spark, sf_dir), path)
    return sources.read_parquet(spark, path)


# Column functions


def date_parts_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = F.col("DATE OCC")
    return tables.order_incidents(spark, sf_dir).select(
        date.alias("date_text"),
        fn.text_year(date).alias("year"),
        fn.text_month(date).alias("month"),
    )


def first_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = F.col("ZIPcode")
    return tables.geocode(spark, sf_dir).select(
        written.alias("written"), fn.first_token(written).alias("zip_code")
    )


def parse_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.round("c_acctbal").cast("bigint")
    return (
        tables.table(spark, sf_dir, "customer")
        .select("c_custkey", tables.money_text(amount).alias("written"))
        .withColumn("amount", fn.parse_money(F.col("written")).cast("bigint"))
    )


def decode_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.col("Vict Descent")
    return tables.incidents(spark, sf_dir).select(
        F.col("DR_NO").alias("dr_no"),
        code.alias("code"),
        fn.decode(code, DESCENTS).alias("victim_descent"),
    )


def haversine_km(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = equi_join(
        tables.incidents(spark, sf_dir).select("DR_NO", "AREA", "LAT", "LON"),
        tables.stations(spark, sf_dir).select("PREC", "x", "y"),
        AREA_OF_STATION,
        "broadcast",
    )
    distance = fn.haversine_km(F.col("LAT"), F.col("LON"), F.col("y"), F.col("x"))
    return joined.select(F.col("DR_NO").alias("dr_no"), F.round(distance, 6).alias("distance_km"))


def time_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    time = F.col("TIME OCC")
    return tables.incidents(spark, sf_dir).select(
        time.try_cast("bigint").alias("hhmm"),
        fn.time_segment(time).alias("unbounded"),
        fn.time_segment(time, bounded=True).alias("bounded"),
    )


# Months with the most incidents


def q1_top_months_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.top_months(tables.order_incidents(spark, sf_dir))


def q1_top_months_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.top_months_sql(tables.order_incidents(spark, sf_dir))


def q1_top_months_df_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.top_months(_through_csv(spark, tables.order_incidents(spark, sf_dir)))


def q1_top_months_sql_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.top_months_sql(_through_csv(spark, tables.order_incidents(spark, sf_dir)))


def months_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of an older extract, stored, and of a newer one merged into them."""
    orders = tables.order_incidents(spark, sf_dir)
    newer = F.col("DATE OCC").substr(4, 2) > "20"
    paths = [sources.scratch_path(spark, name) for name in ("months-before", "months-now")]
    plans.maintain(spark, paths[0], plans.month_counts(orders.where(~newer)), plans.merge_counts)
    counts = plans.maintain(
        spark, paths[1], plans.month_counts(orders.where(newer)), plans.merge_counts, before=paths[0]
    )
    return plans.top_months_of(counts)


# Incidents on the street by time of day


def q2_segments_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.street_segments_sql(tables.incidents(spark, sf_dir))


def q2_segments_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.street_segments(tables.incidents(spark, sf_dir))


def q2_segments_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.street_segments(tables.incidents(spark, sf_dir), bounded=True)


def q2_segments_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    incidents = tables.incidents(spark, sf_dir).select("DR_NO", "TIME OCC", "Premis Desc")
    return plans.street_segments(_through_csv(spark, incidents), bounded=True)


def q2_top3_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fewer than there are, so the limit cuts."""
    return plans.busiest_segments(tables.incidents(spark, sf_dir), k=3)


def q2_top5_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.busiest_segments(tables.incidents(spark, sf_dir))


# Victims by descent and income


def lookup_min_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lookup = min_per_key(
        tables.geocode(spark, sf_dir), ["LAT", "LON"], "ZIPcode", "zip_code", clean=fn.first_token
    )
    return lookup.withColumnsRenamed({"LAT": "lat", "LON": "lon"})


def lookup_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup of older points, stored, and of newer ones merged into it."""
    geocode = tables.geocode(spark, sf_dir)
    newer = F.col("ZIPcode").contains("-")
    paths = [sources.scratch_path(spark, name) for name in ("lookup-before", "lookup-now")]
    plans.maintain(spark, paths[0], plans.zip_lookup(geocode.where(~newer)), plans.merge_lookups)
    lookup = plans.maintain(
        spark, paths[1], plans.zip_lookup(geocode.where(newer)), plans.merge_lookups, before=paths[0]
    )
    return lookup.withColumnsRenamed({"LAT": "lat", "LON": "lon"})


def semi_join_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    victims = plans.victims_by_zip(
        tables.incidents(spark, sf_dir), tables.geocode(spark, sf_dir), TEST_YEAR
    )
    return semi_join(clean_incomes(tables.incomes(spark, sf_dir)), victims, "zip")


def topk_low(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(clean_incomes(tables.incomes(spark, sf_dir)), "income", 3, ties=["zip"])


def topk_high(spark: SparkSession, sf_dir: str) -> DataFrame:
    incomes = clean_incomes(tables.incomes(spark, sf_dir))
    return top_k(incomes, "income", 3, ascending=False, ties=["zip"])


def _q3(lowest: bool = True, strategy: str | None = None, prefilter: bool = False) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plans.victims_by_income(
            tables.incidents(spark, sf_dir),
            tables.geocode(spark, sf_dir),
            tables.incomes(spark, sf_dir),
            lowest,
            TEST_YEAR,
            strategy=strategy,
            prefilter=prefilter,
        )

    return query


def _q3_sql(lowest: bool = True, strategy: str | None = None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plans.victims_by_income_sql(
            tables.incidents(spark, sf_dir),
            tables.geocode(spark, sf_dir),
            tables.incomes(spark, sf_dir),
            lowest,
            TEST_YEAR,
            strategy=strategy,
        )

    return query


def q3_lowest_income_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over a table that was built from two raw extracts and is partitioned by year."""
    return plans.victims_by_income(
        sources.build_incidents(spark, *_incident_extracts(spark, sf_dir)),
        tables.geocode(spark, sf_dir),
        tables.incomes(spark, sf_dir),
        year=TEST_YEAR,
    )


def topk_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lowest incomes where every third one cannot be read; those come last."""
    written = F.when(F.col("Zip Code") % 3 == 0, "n/a").otherwise(F.col("Estimated Median Income"))
    incomes = tables.incomes(spark, sf_dir).withColumn("Estimated Median Income", written)
    return top_k(clean_incomes(incomes), "income", 20, ties=["zip"])


# Incidents and the station in charge


def q4_distance_by_division(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.distance_by_division(
        tables.incidents(spark, sf_dir), tables.stations(spark, sf_dir)
    )


def q4_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of incidents in a box, from a table laid out by place."""
    path = sources.scratch_path(spark, "incidents-clustered")
    sources.write_clustered(tables.incidents(spark, sf_dir), path)
    boxed = sources.read_parquet(spark, path).where(
        F.col("LAT").between(33.6, 33.8) & F.col("LON").between(-118.7, -118.55)
    )
    return plans.distance_by_division(boxed, tables.stations(spark, sf_dir))


def q4_join_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return equi_join(
        tables.incidents(spark, sf_dir),
        tables.stations(spark, sf_dir),
        AREA_OF_STATION,
        "broadcast",
    )


def q4_join_repartition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return equi_join(*_narrow(spark, sf_dir), AREA_OF_STATION, "repartition", partitions=8)


def q4_join_copartitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_join(*_narrow(spark, sf_dir), AREA_OF_STATION[0]).select(
        "key",
        F.col("left.`DR_NO`").alias("left_dr_no"),
        F.col("left.`DATE OCC`").alias("left_date"),
        F.col("right.`DIVISION`").alias("right_division"),
        F.col("right.`PREC`").alias("right_prec"),
    )


def q4_join_copartitioned_4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pair join over four partitions a side."""
    return pair_join(*_narrow(spark, sf_dir), AREA_OF_STATION[0], partitions=4).select(
        "key",
        F.col("left.`DR_NO`").alias("left_dr_no"),
        F.col("right.`DIVISION`").alias("right_division"),
    )


def q4_join_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over tables that are stored in four buckets by the key."""
    return copartition(*_narrow(spark, sf_dir), AREA_OF_STATION, partitions=4).join()


def q4_verify_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys for which a join variant has other rows than the plain join: none."""
    return q4_verify_digests(spark, sf_dir).where(~F.col("matches")).drop("matches")


def q4_verify_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.compare_join_rows(*_narrow(spark, sf_dir), partitions=4)


def q4_verify_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.compare_joins(
        tables.incidents(spark, sf_dir), tables.stations(spark, sf_dir), TEST_YEAR
    )


def row_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides have a nationkey and a name; the right ones stay."""
    customers = tables.table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.col("c_nationkey").alias("nationkey"),
        F.col("c_name").alias("name"),
        "c_acctbal",
    )
    nations = tables.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("nationkey"),
        F.col("n_name").alias("name"),
        F.col("n_regionkey").alias("regionkey"),
    )
    return equi_join(customers, nations, ["nationkey"], "broadcast")


def _narrow(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return (
        tables.incidents(spark, sf_dir).select("DR_NO", "DATE OCC", "AREA"),
        tables.stations(spark, sf_dir).select("DIVISION", "PREC"),
    )


def _incident_extracts(spark: SparkSession, sf_dir: str) -> list[str]:
    """Two raw extracts of incidents, and where their copies go."""
    raw = tables.incidents(spark, sf_dir)
    newer = fn.text_year(F.col("DATE OCC")) >= "1999"
    paths = [
        sources.scratch_path(spark, name)
        for name in ("incidents-old", "incidents-new", "incidents-csv", "incidents-parquet")
    ]
    sources.write_csv(raw.where(~newer).withColumnRenamed("AREA", "AREA "), paths[0])
    sources.write_csv(raw.where(newer), paths[1])
    return paths


def _through_csv(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Written as a directory of CSV parts and scanned as text."""
    path = sources.scratch_path(spark, "incidents-csv")
    sources.write_csv(df, path)
    return sources.read_csv(spark, path)


def queries() -> dict[str, Query]:
    return {
        "etl_union_renamed": etl_union_renamed,
        "etl_csv_to_parquet": etl_csv_to_parquet,
        "etl_rejects": etl_rejects,
        "etl_malformed": etl_malformed,
        "etl_verify": etl_verify,
        "etl_incremental": etl_incremental,
        "etl_schema_drift": etl_schema_drift,
        "csv_type_profile": csv_type_profile,
        "csv_lossless": csv_lossless,
        "csv_roundtrip": csv_roundtrip,
        "csv_untyped_scan": csv_untyped_scan,
        "parquet_roundtrip": parquet_roundtrip,
        "date_parts_text": date_parts_text,
        "first_token": first_token,
        "parse_money": parse_money,
        "decode_codes": decode_codes,
        "haversine_km": haversine_km,
        "time_segments": time_segments,
        "q1_top_months_df": q1_top_months_df,
        "q1_top_months_sql": q1_top_months_sql,
        "q1_top_months_df_csv": q1_top_months_df_csv,
        "q1_top_months_sql_csv": q1_top_months_sql_csv,
        "months_incremental": months_incremental,
        "q2_segments_sql": q2_segments_sql,
        "q2_segments_df": q2_segments_df,
        "q2_segments_bounded": q2_segments_bounded,
        "q2_segments_csv": q2_segments_csv,
        "q2_top3_segments": q2_top3_segments,
        "q2_top5_segments": q2_top5_segments,
        "lookup_min_per_key": lookup_min_per_key,
        "lookup_incremental": lookup_incremental,
        "semi_join_zip": semi_join_zip,
        "topk_low": topk_low,
        "topk_high": topk_high,
        "topk_unreadable": topk_unreadable,
        "q3_lowest_income": _q3(),
        "q3_highest_income": _q3(lowest=False),
        "q3_lowest_income_stored": q3_lowest_income_stored,
        "q3_lowest_income_sql": _q3_sql(),
        "q3_highest_income_sql": _q3_sql(lowest=False),
        "q3_sql_hint_broadcast": _q3_sql(strategy="broadcast"),
        "q3_sql_hint_merge": _q3_sql(strategy="merge"),
        "q3_sql_hint_shuffle_hash": _q3_sql(strategy="shuffle_hash"),
        "q3_highest_hint_broadcast": _q3(lowest=False, strategy="broadcast"),
        "q3_highest_hint_merge": _q3(lowest=False, strategy="merge"),
        "q3_highest_hint_shuffle_hash": _q3(lowest=False, strategy="shuffle_hash"),
        "q3_merge_prefiltered": _q3(strategy="merge", prefilter=True),
        "q3_hint_broadcast": _q3(strategy="broadcast"),
        "q3_hint_merge": _q3(strategy="merge"),
        "q3_hint_shuffle_hash": _q3(strategy="shuffle_hash"),
        "q3_hint_replicate_nl": _q3(strategy="shuffle_replicate_nl"),
        "q4_distance_by_division": q4_distance_by_division,
        "q4_clustered": q4_clustered,
        "q4_join_broadcast": q4_join_broadcast,
        "q4_join_repartition": q4_join_repartition,
        "q4_join_copartitioned": q4_join_copartitioned,
        "q4_join_copartitioned_4": q4_join_copartitioned_4,
        "q4_join_bucketed": q4_join_bucketed,
        "q4_verify_counts": q4_verify_counts,
        "q4_verify_rows": q4_verify_rows,
        "q4_verify_digests": q4_verify_digests,
        "row_merge": row_merge,
        **LLM_QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    """The same queries as SQL over the raw tables."""
    return {**oracle.SQL, **LLM_SQL}
