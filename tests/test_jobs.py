"""From raw extracts to every report, the way the jobs are started."""

import pytest

from plan import formatted

from blotter import sources
from blotter.__main__ import arguments, deliver, run

HEADER = "DR_NO,DATE OCC,TIME OCC,{area},Premis Desc,Vict Descent,Weapon Used Cd,LAT,LON\n"


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("jobs")
    paths = {name: str(base / name) for name in
             ("old", "new", "csv", "parquet", "stations", "geocode", "incomes")}
    old = HEADER.format(area="AREA ") + "".join(
        f"{i},0{1 + i % 4}/02/2015 12:00:00 AM,{i * 37 % 2400:04d},{1 + i % 2},STREET,"
        f"{'HWB'[i % 3]},{90 + i},34.{i % 4},-118.0\n"
        for i in range(100)
    )
    new = HEADER.format(area="AREA") + "900,01/02/2020 12:00:00 AM,1200,1,YARD,,,0,0\n"
    stations = "OBJECTID,DIVISION,LOCATION,PREC,x,y\n1,NORTH,a,1,-118.0,34.0\n2,SOUTH,b,2,-118.1,34.1\n"
    geocode = "LAT,LON,ZIPcode\n" + "".join(f"34.{i},-118.0,9000{i}; 90009\n" for i in range(4))
    incomes = '"Zip Code","Community","Estimated Median Income"\n' + "".join(
        f'9000{i},"A, B","$3{i},000"\n' for i in range(4)
    )
    for name, text in {"old": old, "new": new, "stations": stations, "geocode": geocode,
                       "incomes": incomes}.items():
        (base / name).write_text(text)
    combined = run(
        spark,
        ["combine", "--old", paths["old"], "--new", paths["new"], "--csv", paths["csv"],
         "--parquet", paths["parquet"]],
    )
    assert combined.count() == 101
    return paths


def rows(spark, *argv):
    return [tuple(row) for row in run(spark, argv).collect()]


def both_formats(spark, files, command, *rest):
    parquet = rows(spark, command, "--incidents", files["parquet"], *rest)
    csv = rows(spark, command, "--incidents", files["csv"], "--format", "csv", *rest)
    assert parquet == csv
    return parquet


def test_months(spark, files):
    expected = [("2015", f"0{m}", 25, 1) for m in (1, 2, 3, 4)] + [("2020", "01", 1, 1)]
    assert both_formats(spark, files, "months") == expected
    assert both_formats(spark, files, "months", "--sql") == expected


def test_segments(spark, files):
    times = [i * 37 % 2400 for i in range(100)]
    morning = sum(500 <= t <= 1159 for t in times)
    unbounded = both_formats(spark, files, "segments")
    assert both_formats(spark, files, "segments", "--sql") == unbounded
    bounded = both_formats(spark, files, "segments", "--bounded")
    assert both_formats(spark, files, "segments", "--bounded", "--sql") == bounded
    for got in (unbounded, bounded):
        assert sum(n for n, _ in got) == 100
        assert (morning, "Morning") in got
    assert bounded != unbounded


@pytest.mark.parametrize("direction", ["--lowest", "--no-lowest"])
def test_victims(spark, files, direction):
    tables = ["--geocode", files["geocode"], "--incomes", files["incomes"], direction]
    expected = both_formats(spark, files, "victims", *tables)
    # Points 34.0 to 34.3 have 25 victims each; three of the four ZIPs are picked.
    assert sum(n for _, n in expected) == 75
    assert both_formats(spark, files, "victims", "--sql", *tables) == expected
    for strategy in ("broadcast", "merge", "shuffle_hash"):
        sql = ["--sql", "--strategy", strategy]
        assert both_formats(spark, files, "victims", *sql, *tables) == expected
    with pytest.raises(ValueError, match="no join hint"):
        run(spark, ["victims", "--incidents", files["parquet"], "--sql", "--strategy", "repartition", *tables])
    for strategy in ("broadcast", "merge", "shuffle_hash", "shuffle_replicate_nl"):
        assert both_formats(spark, files, "victims", "--strategy", strategy, *tables) == expected


def test_distances_and_joins(spark, files):
    stations = ["--stations", files["stations"]]
    expected = both_formats(spark, files, "distances", *stations)
    assert sorted((division, n) for division, _, n in expected) == [("NORTH", 45), ("SOUTH", 45)]
    for strategy in ("merge", "repartition"):
        assert both_formats(spark, files, "distances", "--strategy", strategy, *stations) == expected
    counts = both_formats(spark, files, "joins", *stations)
    assert [row[1:] for row in counts] == [("NORTH", 50), ("SOUTH", 50)] * 4


@pytest.mark.parametrize(
    ("argv", "filters", "columns"),
    [
        (
            ["segments"],
            ["EqualTo(`Premis Desc`,STREET)"],
            "TIME OCC:int,Premis Desc:string",
        ),
        (
            ["distances", "--stations"],
            [
                "Not(EqualTo(LAT,0.0))",
                "Not(EqualTo(LON,0.0))",
                "GreaterThanOrEqual(`Weapon Used Cd`,100)",
                "LessThanOrEqual(`Weapon Used Cd`,199)",
                "IsNotNull(AREA)",
            ],
            "AREA:int,Weapon Used Cd:int,LAT:double,LON:double",
        ),
        (
            ["victims", "--geocode", "--incomes"],
            ["IsNotNull(`Vict Descent`)", "IsNotNull(LAT)", "IsNotNull(LON)"],
            "DATE OCC:string,Vict Descent:string,LAT:double,LON:double",
        ),
        (["months"], [], "DATE OCC:string"),
    ],
)
def test_filters_and_columns_reach_the_scan(spark, files, argv, filters, columns):
    command, *options = argv
    tables = [item for option in options for item in (option, files[option.strip("-")])]
    df = run(spark, [command, "--incidents", files["parquet"], *tables])
    plan = formatted(df)
    assert plan.count(f"ReadSchema: struct<{columns}>") == 1
    assert all(item in plan for item in filters), plan


@pytest.mark.parametrize("form", ["parquet", "csv"])
def test_a_result_is_written_whole(spark, tmp_path, form):
    """Far more months than are shown."""
    lines = "".join(
        f"{i},{1 + i % 12:02d}/01/{1000 + i // 12} 12:00:00 AM,1200,1,YARD,,,0,0\n" for i in range(3000)
    )
    for name, text in (("old", ""), ("new", lines)):
        (tmp_path / f"{name}.csv").write_text(HEADER.format(area="AREA") + text)
    paths = [str(tmp_path / name) for name in ("old.csv", "new.csv", "csv", "parquet")]
    sources.build_incidents(spark, *paths, date=None)
    out = str(tmp_path / "out")
    argv = ["months", "--incidents", paths[3], "--out", out, "--out-format", form]
    args = arguments().parse_args(argv)
    assert deliver(spark, args, run(spark, argv)).count() == 3000
    again = sources.read_csv(spark, out) if form == "csv" else sources.read_parquet(spark, out)
    assert again.count() == 3000


def test_one_year_is_one_partition(spark, files):
    tables = [item for name in ("geocode", "incomes") for item in (f"--{name}", files[name])]
    for argv in (["victims", *tables], ["victims", "--sql", *tables]):
        plan = formatted(run(spark, [argv[0], "--incidents", files["parquet"], *argv[1:]]))
        assert "PartitionFilters: [isnotnull(occ_year" in plan and "= 2015)]" in plan
