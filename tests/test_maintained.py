"""Profiles of text columns, and reports kept up to date from stored parts."""

import random

import pytest
from plan import executed_plan, planned

from blotter import plans, sources


def texts(spark, rows):
    return spark.createDataFrame(rows, "a string, `b c.d` string")


ODD = ["1", "-7", "+3", "9223372036854775807", "9223372036854775808", "1.", ".5", "1e3", "1e", "5d", "NaN", "Infinity", "", " 1",
       "2015-02-03", "2015-02-03 04:05:06", "02/20/2015 11:30:00 PM", "02/20/2015", "2015", "x", None]


def profile_of(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "a string")
    (row,) = sources.profiled_types(sources.type_profile(df)).collect()
    return row


@pytest.mark.parametrize(
    ("values", "kind", "likely", "misfits"),
    [
        (["1", "-7", "+3", None], "bigint", "bigint", 0),
        (["1", ".5", "1e3", "2."], "double", "double", 0),
        (["9223372036854775808", "1"], "double", "double", 0),
        (["2015-02-03 04:05:06", "02/20/2015 11:30:00 PM", "2015-02-03"], "timestamp_ntz", "timestamp_ntz", 0),
        (["1", "2", "x"], "string", "bigint", 1),
        (["1", "x"], "string", "string", 0),
        (["5d", "NaN", "Infinity", "1e"], "string", "string", 0),
        ([None, None], "string", "string", 0),
        (["", "1", "2.5"], "string", "double", 1),
        ([" 1"], "string", "string", 0),
    ],
)
def test_types(spark, values, kind, likely, misfits):
    row = profile_of(spark, values)
    assert (row["type"], row["likely"], row["misfits"]) == (kind, likely, misfits)
    assert row["rows"] == len(values) and row["nulls"] == values.count(None)


def test_extremes(spark):
    row = profile_of(spark, ["10", "9", "-2.5", "1e2", "2015-02-03", "2014-12-31 23:00:00", "long text of no kind", ""])
    assert (row["least_long"], row["most_long"], row["least_double"], row["most_double"]) == (9, 10, -2.5, 100.0)
    assert (str(row["first"]), str(row["last"])) == ("2014-12-31 23:00:00", "2015-02-03 00:00:00")
    assert (row["shortest"], row["longest"]) == (0, 20)


@pytest.mark.parametrize("seed", range(3))
def test_profiles_of_parts_add_up(spark, seed):
    dice = random.Random(seed)
    rows = [(dice.choice(ODD), dice.choice(ODD[:4])) for _ in range(60)]
    at = dice.randint(0, 60)
    whole = sources.type_profile(texts(spark, rows))
    parts = sources.merge_profiles(*(sources.type_profile(texts(spark, part)) for part in (rows[:at], rows[at:])))
    assert sorted(map(tuple, parts.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    assert parts.columns == whole.columns


def test_profile_is_one_scan_and_gives_types_to_read_by(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    sources.write_csv(texts(spark, [("1", "x"), (None, "2.5"), ("3", None)]), path)
    profile = sources.type_profile(sources.read_csv(spark, path))
    plan = planned(profile)
    assert plan.count("FileScan") == 1 and "partial_max" in plan and "SortAggregate" not in plan
    types = sources.types_of(profile)
    assert types == {"a": "bigint"}
    assert sources.read_csv(spark, path, types=types).dtypes == [("a", "bigint"), ("b c.d", "string")]
    assert sources.type_profile(texts(spark, [])).collect() == []


def incidents(spark, months):
    return spark.createDataFrame([(f"{m:02d}/01/{y} 12:00:00 AM",) for y, m in months] or [], "`DATE OCC` string")


def stored_incidents(spark, path, months):
    incidents(spark, months).write.parquet(path)
    return spark.read.parquet(path)


def test_months_from_stored_counts(spark, tmp_path):
    dice = random.Random(5)
    extracts = [[(dice.choice([2015, 2016]), dice.randint(1, 12)) for _ in range(n)] for n in (200, 0, 50)]
    before = None
    for k, months in enumerate(extracts):
        part = plans.month_counts(stored_incidents(spark, str(tmp_path / f"extract{k}"), months))
        counts = plans.maintain(spark, str(tmp_path / f"v{k}"), part, plans.merge_counts, before)
        before = str(tmp_path / f"v{k}")
    whole = plans.top_months(incidents(spark, sum(extracts, [])))
    assert plans.top_months_of(counts).collect() == whole.collect()
    assert counts.count() <= 24


def test_history_is_not_read(spark, tmp_path):
    old, new = (stored_incidents(spark, str(tmp_path / n), [(2015, 1), (2015, 2)]) for n in ("old", "new"))
    before = plans.maintain(spark, str(tmp_path / "v0"), plans.month_counts(old), plans.merge_counts)
    plan = executed_plan(plans.merge_counts(before, plans.month_counts(new)))
    assert "/v0" in plan and "/new" in plan and "/old" not in plan


def test_lookup_from_stored_lookups(spark, tmp_path):
    dice = random.Random(6)
    rows = [(dice.randint(0, 4) / 2, 1.0, dice.choice(["90002; 9", "90001-1", None, "90003"])) for _ in range(60)]
    points = lambda part: spark.createDataFrame(part, "LAT double, LON double, ZIPcode string")
    before = None
    for k, part in enumerate((rows[:20], rows[20:])):
        lookup = plans.maintain(spark, str(tmp_path / f"z{k}"), plans.zip_lookup(points(part)), plans.merge_lookups, before)
        before = str(tmp_path / f"z{k}")
    whole = plans.zip_lookup(points(rows))
    assert sorted(map(tuple, lookup.collect())) == sorted(map(tuple, whole.collect()))
