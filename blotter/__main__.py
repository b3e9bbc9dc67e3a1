"""Runs a report on stored tables: ``spark-submit blotter/__main__.py months --incidents PATH``."""

from __future__ import annotations

import sys
from argparse import ArgumentParser, BooleanOptionalAction, Namespace
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from blotter import plans, sources  # noqa: E402
from blotter.plans.victims import YEAR  # noqa: E402
from blotter.sources.layouts import (  # noqa: E402
    GEOCODE_TYPES,
    INCIDENT_TYPES,
    INCOME_TYPES,
    STATION_TYPES,
)

STRATEGIES = ["broadcast", "merge", "shuffle_hash", "repartition", "shuffle_replicate_nl"]

# Rows printed as a preview; the whole result goes to --out.
SHOWN = 20


def arguments() -> ArgumentParser:
    parser = ArgumentParser(prog="blotter")
    commands = parser.add_subparsers(dest="command", required=True)

    combine = commands.add_parser("combine", help="combine two raw CSV extracts")
    for name in ("--old", "--new", "--csv", "--parquet"):
        combine.add_argument(name, required=True)
    combine.add_argument("--malformed", help="where lines go that do not fit their header")
    combine.add_argument("--strict", action="store_true", help="such lines, and text that fits no type, are errors")
    combine.add_argument("--verify", action=BooleanOptionalAction, default=True, help="read both copies back")
    combine.add_argument("--mode", choices=["error", "overwrite", "resume"], default="error")

    months = commands.add_parser("months", help="months with the most incidents per year")
    segments = commands.add_parser("segments", help="street incidents by time of day")
    victims = commands.add_parser("victims", help="victims by descent in poor or rich areas")
    distances = commands.add_parser("distances", help="distance to the station in charge")
    joins = commands.add_parser("joins", help="check that all join variants agree")

    for report in (months, segments, victims, distances, joins):
        report.add_argument("--incidents", required=True, help="Parquet or CSV table")
        report.add_argument("--format", choices=["parquet", "csv"], default="parquet")
        report.add_argument("--out", help="where the whole result is written")
        report.add_argument("--out-format", choices=["parquet", "csv"], default="parquet")
        report.add_argument("--out-mode", choices=["error", "overwrite", "append"], default="error")
    for report in (months, segments, victims):
        report.add_argument("--sql", action="store_true", help="run it as SQL")
    for report in (victims, distances):
        report.add_argument("--strategy", choices=STRATEGIES, help="how to join")
    for report in (distances, joins):
        report.add_argument("--stations", required=True, help="CSV table")
    for report in (victims, joins):
        report.add_argument("--year", type=int, default=YEAR)
    segments.add_argument("--bounded", action="store_true", help="limit Night to valid times")
    victims.add_argument("--geocode", required=True, help="CSV table")
    victims.add_argument("--incomes", required=True, help="CSV table")
    victims.add_argument("--lowest", action=BooleanOptionalAction, default=True)
    return parser


def run(spark: SparkSession, argv: Sequence[str]) -> DataFrame:
    return _report(spark, arguments().parse_args(argv))


def _report(spark: SparkSession, args: Namespace) -> DataFrame:
    if args.command == "combine":
        return sources.build_incidents(
            spark, args.old, args.new, args.csv, args.parquet, strict=args.strict, mode=args.mode,
            malformed_path=args.malformed, verify=args.verify,
        )

    incidents = _incidents(spark, args)
    if args.command == "months":
        return (plans.top_months_sql if args.sql else plans.top_months)(incidents)
    if args.command == "segments":
        segments = plans.street_segments_sql if args.sql else plans.street_segments
        return segments(incidents, args.bounded)
    if args.command == "victims":
        geocode = sources.read_csv(spark, args.geocode, types=GEOCODE_TYPES)
        incomes = sources.read_csv(spark, args.incomes, types=INCOME_TYPES)
        if args.sql:
            return plans.victims_by_income_sql(
                incidents, geocode, incomes, args.lowest, args.year, strategy=args.strategy
            )
        return plans.victims_by_income(
            incidents, geocode, incomes, args.lowest, args.year, strategy=args.strategy
        )

    stations = sources.read_csv(spark, args.stations, types=STATION_TYPES)
    if args.command == "distances":
        return plans.distance_by_division(incidents, stations, args.strategy or "broadcast")
    return plans.compare_joins(incidents, stations, args.year)


def _incidents(spark: SparkSession, args: Namespace) -> DataFrame:
    if args.format == "csv":
        return sources.read_csv(spark, args.incidents, types=INCIDENT_TYPES)
    return sources.read_parquet(spark, args.incidents)


def deliver(spark: SparkSession, args: Namespace, result: DataFrame) -> DataFrame:
    """Write the whole result where ``--out`` says; what is then there to be shown."""
    if getattr(args, "out", None) is None:
        return result
    if args.out_format == "csv":
        sources.write_csv(result, args.out, args.out_mode)
        return sources.read_csv(spark, args.out)
    sources.write_parquet(result, args.out, args.out_mode)
    return sources.read_parquet(spark, args.out)


def main() -> None:
    spark = SparkSession.builder.appName("blotter").getOrCreate()
    args = arguments().parse_args(sys.argv[1:])
    shown = deliver(spark, args, _report(spark, args))
    print(f"First {SHOWN} rows at most" + (f"; all are in {args.out}" if getattr(args, "out", None) else ""))
    shown.show(SHOWN, truncate=False)
    if args.command == "combine":
        print("Values that did not fit their type, by column")
        sources.count_rejects(spark, args.parquet).show(SHOWN, truncate=False)
        print("Lines that did not fit their header, by file")
        lines = sources.read_parquet(spark, args.malformed or f"{args.parquet.rstrip('/')}-malformed")
        lines.groupBy("file", "reason").count().show(SHOWN, truncate=False)
    sources.drop_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
