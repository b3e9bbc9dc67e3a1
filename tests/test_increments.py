"""Newer extracts merged into a stored table, and extracts whose columns have drifted apart."""

import random

import pytest
from pyspark.sql import types as T

from blotter import sources
from blotter.sources.drift import wider

TYPES = {"DR_NO": "bigint", "AREA": "int", "version": "int"}
HEADER = "DR_NO,DATE OCC,AREA,version,note\n"


def written(path, rows):
    text = lambda v: "" if v is None else str(v)
    path.write_text(HEADER + "".join(",".join(map(text, row)) + "\n" for row in rows))
    return str(path)


def date(year, day=1):
    return f"01/{day:02d}/{year} 12:00:00 AM"


def build(spark, tmp_path, rows):
    paths = [written(tmp_path / "old.csv", rows), written(tmp_path / "none.csv", []), str(tmp_path / "csv"), str(tmp_path / "table")]
    sources.build_incidents(spark, *paths, types=TYPES)
    return paths[3]


def merge(spark, table, path, **options):
    return sources.merge_extract(spark, table, path, newest=["version"], types=TYPES, **options)


def listed(df):
    return sorted((tuple(r) for r in df.select("DR_NO", "DATE OCC", "AREA", "version", "note").collect()), key=str)


def files(tmp_path):
    found = {}
    for path in (tmp_path / "table").rglob("*.parquet"):
        found.setdefault(path.parent.name, set()).add(path.name)
    return found


OLD = [
    (1, date(2015), 5, 1, "a"),
    (2, date(2015), 5, 1, "b"),
    (2, date(2016), 5, 1, "b again"),
    (3, date(2017), 6, 1, "c"),
    (4, date(2018), 6, 1, "d"),
    (5, "bad", 6, 1, "e"),
    (None, date(2018), 7, 1, "nameless"),
    (6, date(2019), 7, 1, "f"),
    (6, date(2019), 7, 1, "f"),
]


def test_only_touched_years_are_written(spark, tmp_path):
    table = build(spark, tmp_path, OLD)
    before = files(tmp_path)
    new = [(2, date(2020), 9, 2, "B"), (7, date(2018), 1, 1, "g"), (7, date(2018), 1, 2, "G"), (7, date(2018), 1, None, "no")]
    after = merge(spark, table, written(tmp_path / "new.csv", new))
    assert listed(after) == sorted(
        [r for r in OLD if r[0] != 2] + [(2, date(2020), 9, 2, "B"), (7, date(2018), 1, 2, "G")], key=str
    )
    now = files(tmp_path)
    same = {name for name in before if before[name] == now.get(name)}
    assert same == {"occ_year=2017", "occ_year=2019", "occ_year=__HIVE_DEFAULT_PARTITION__"}
    # 2016 had no other row, 2015 and 2018 were written anew, 2020 is new.
    assert set(now) == (set(before) - {"occ_year=2016"}) | {"occ_year=2020"}


def test_merging_again_changes_nothing(spark, tmp_path):
    table = build(spark, tmp_path, OLD)
    new = written(tmp_path / "new.csv", [(1, date(2016), 9, 2, "A"), (None, date(2016), 1, 1, "nameless too"), (5, "bad", 1, 2, "E")])
    once = listed(merge(spark, table, new))
    assert listed(merge(spark, table, new)) == once and len(once) == len(OLD) + 1


def test_a_broken_off_run_is_made_good(spark, tmp_path):
    """The new year was written, the old one not: the row stands in both until the merge is run again."""
    table = build(spark, tmp_path, OLD)
    moved = [(1, date(2016), 9, 2, "A")]
    both = listed(merge(spark, build(spark, tmp_path / "other" if (tmp_path / "other").mkdir() is None else None, OLD), written(tmp_path / "n.csv", moved)))
    year = spark.read.parquet(str(tmp_path / "other/table/occ_year=2016"))
    year.write.mode("overwrite").parquet(table + "/occ_year=2016")
    assert listed(merge(spark, table, str(tmp_path / "n.csv"))) == both


@pytest.mark.parametrize("seed", range(3))
def test_merging_is_like_building_anew(spark, tmp_path, seed):
    dice = random.Random(seed)
    row = lambda k, v: (k, date(dice.randint(2010, 2013), dice.randint(1, 28)), dice.randint(1, 9), v, f"n{dice.random()}")
    old = [row(k, 1) for k in range(40)]
    new = [row(dice.randint(20, 60), v) for v in range(2, 32)]
    after = merge(spark, build(spark, tmp_path, old), written(tmp_path / "new.csv", new))
    best = {}
    for r in old + new:
        best[r[0]] = max(best.get(r[0], r), r, key=lambda r: r[3])
    assert listed(after) == sorted(best.values(), key=str)


def test_rejected_text_and_malformed_lines(spark, tmp_path):
    table = build(spark, tmp_path, OLD)
    path = tmp_path / "new.csv"
    path.write_text(HEADER + f"8,{date(2017)},x,2,h\nbroken\n")
    with pytest.raises(ValueError, match="1 lines"):
        merge(spark, table, str(path))
    with pytest.raises(Exception, match="malformed line|int expected"):
        merge(spark, table, str(path), strict=True)
    aside = str(tmp_path / "aside")
    merge(spark, table, str(path), malformed_path=aside)
    assert [r["line"] for r in sources.read_parquet(spark, aside).collect()] == ["broken"]
    assert [(r["DR_NO"], r["rejected_text"]) for r in sources.rejects(spark, table).collect()] == [(8, "x")]


def test_nothing_new_and_other_columns(spark, tmp_path):
    table = build(spark, tmp_path, OLD)
    before = files(tmp_path)
    assert merge(spark, table, written(tmp_path / "new.csv", [])).count() == len(OLD) and files(tmp_path) == before
    (tmp_path / "new.csv").write_text("DR_NO,DATE OCC,AREA,version\n")
    with pytest.raises(ValueError, match="note"):
        merge(spark, table, str(tmp_path / "new.csv"))


def test_reconciled_extracts(spark):
    old = spark.createDataFrame([(1, 2.5, "x")], "`AREA ` int, v double, only_old string")
    new = spark.createDataFrame([(7, "y", 2**40)], "v int, only_new string, AREA long")
    both = sources.reconcile({"old": old, "new": new}, {"AREA ": "AREA"})
    assert both.dtypes == [
        ("origin", "string"), ("AREA", "bigint"), ("v", "double"), ("only_old", "string"), ("only_new", "string")
    ]
    assert sorted(map(tuple, both.collect())) == [("new", 2**40, 7.0, None, "y"), ("old", 1, 2.5, "x", None)]
    report = sources.drift(spark, {"old": old, "new": new}, {"AREA ": "AREA"})
    assert sorted(map(tuple, report.collect()), key=str) == sorted([
        ("AREA", "old", "int", "bigint"), ("v", "new", "int", "double"),
        ("only_old", "new", None, "string"), ("only_new", "old", None, "string"),
    ], key=str)


def test_common_types_hold_every_value():
    cases = [
        (T.IntegerType(), T.LongType(), T.LongType()),
        (T.ShortType(), T.FloatType(), T.FloatType()),
        (T.IntegerType(), T.FloatType(), T.DoubleType()),
        (T.LongType(), T.DoubleType(), T.StringType()),
        (T.DecimalType(10, 2), T.LongType(), T.DecimalType(21, 2)),
        (T.DecimalType(38, 2), T.DecimalType(38, 30), T.StringType()),
        (T.DecimalType(10, 2), T.DoubleType(), T.StringType()),
        (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()),
        (T.TimestampType(), T.TimestampNTZType(), T.StringType()),
        (T.BooleanType(), T.IntegerType(), T.StringType()),
    ]
    for a, b, both in cases:
        assert wider([a, b]) == wider([b, a]) == both
    with pytest.raises(ValueError, match="no common type"):
        wider([T.ArrayType(T.IntegerType()), T.IntegerType()])


def test_names_that_cannot_be_told_apart(spark):
    df = spark.createDataFrame([(1, 2)], "a int, `a ` int")
    with pytest.raises(ValueError, match="old"):
        sources.reconcile({"old": df}, {"a ": "a"})
