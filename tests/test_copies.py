"""Lines that do not fit, and copies that do not agree."""

import re

import pytest
from pyspark.sql import functions as F

from blotter import sources
from blotter.sources.tables import column

HEADER = "DR_NO,DATE OCC,AREA{},note\n"
OLD = HEADER.format(" ") + (
    "1,02/20/2015 12:00:00 AM,5,plain\n"
    "2,02/21/2015 12:00:00 AM,6\n"
    '3,02/21/2015 12:00:00 AM,7,"a, b", more \n'
    '4,02/21/2015 12:00:00 AM,8,"not\n'
    'closed"\n'
    '5,02/22/2016 12:00:00 AM,x,"say ""so"""\n'
    "  \n"
    "\n"
    "6,02/22/2016 12:00:00 AM,,"
)
NEW = HEADER.format("") + "7,01/08/2020 12:00:00 AM,3,\n7,01/08/2020 12:00:00 AM,3,\nDR_NO,DATE OCC,AREA,note\n,\n"
MALFORMED = {
    ("old.csv", "not 4 fields", "2,02/21/2015 12:00:00 AM,6"),
    ("old.csv", "not 4 fields", '3,02/21/2015 12:00:00 AM,7,"a, b", more '),
    ("old.csv", "odd number of quotes", '4,02/21/2015 12:00:00 AM,8,"not'),
    ("old.csv", "odd number of quotes", 'closed"'),
    ("new.csv", "not 4 fields", ","),
}
TYPES = {"DR_NO": "bigint", "AREA": "int"}


@pytest.fixture
def paths(tmp_path):
    (tmp_path / "old.csv").write_text(OLD)
    (tmp_path / "new.csv").write_text(NEW)
    return [str(tmp_path / name) for name in ("old.csv", "new.csv", "csv", "parquet")]


def build(spark, paths, **options):
    return sources.build_incidents(spark, *paths, types=TYPES, verify=True, **options)


def set_aside(spark, path):
    rows = sources.read_parquet(spark, path).collect()
    return sorted((r["file"].rsplit("/", 1)[1], r["reason"], r["line"]) for r in rows)


def test_no_line_is_lost(spark, paths):
    rows = build(spark, paths).select("DR_NO", "AREA", "note").collect()
    assert sorted(map(tuple, rows), key=str) == sorted(
        [(1, 5, "plain"), (5, None, 'say "so"'), (6, None, None), (7, 3, None), (7, 3, None), (None, None, "note")], key=str
    )
    assert set_aside(spark, paths[3] + "-malformed") == sorted(MALFORMED)
    # Lines with anything on them but the two headers: 8 and 4.
    assert len(rows) + len(MALFORMED) == sum(len(line.strip()) > 0 for line in (OLD + "\n" + NEW).split("\n")) - 2


def test_strict_takes_no_malformed_line(spark, paths):
    with pytest.raises(Exception, match="malformed line, "):
        build(spark, paths, strict=True)


def test_no_malformed_line_is_an_empty_table(spark, paths, tmp_path):
    for name in ("old.csv", "new.csv"):
        (tmp_path / name).write_text("DR_NO,DATE OCC,AREA,note\n1,02/20/2015 12:00:00 AM,5,plain\n")
    assert build(spark, paths, malformed_path=str(tmp_path / "aside")).count() == 2
    assert set_aside(spark, str(tmp_path / "aside")) == []


def test_what_is_missing_is_written_when_resumed(spark, paths):
    build(spark, paths)
    sources.write_parquet(spark.range(1), paths[3] + "-malformed", "overwrite")
    marker = sources.scratch._file_system_call(
        spark, paths[3] + "-malformed/_SUCCESS", lambda fs, at: fs.delete(at, False)
    )
    assert marker
    build(spark, paths, mode="resume")
    assert set_aside(spark, paths[3] + "-malformed") == sorted(MALFORMED)


def test_parts_with_another_header(spark, tmp_path):
    for name, text in (("a.csv", "a,b\n1,2\n"), ("b.csv", "b,a\n1,2\n")):
        (tmp_path / name).write_text(text)
    with pytest.raises(Exception, match="(?i)header"):
        sources.read_lines(spark, str(tmp_path)).collect()


def test_odd_headers(spark, tmp_path):
    cases = {"one": "a\nx\n\"y\"\n", "odd": 'a `b`,c.d,"e,f"\n1,2,3\n4\n', "none": "", "top": "a,b\n"}
    for name, text in cases.items():
        (tmp_path / name).write_text(text)
    read = {name: sources.read_lines(spark, str(tmp_path / name)) for name in cases}
    assert [r["a"] for r in read["one"].collect()] == ["x", "y"]
    assert read["odd"].columns[:3] == ["a `b`", "c.d", "e,f"]
    assert [tuple(r) for r in sources.fitting(read["odd"]).collect()] == [("1", "2", "3")]
    assert [r["line"] for r in sources.malformed(read["odd"]).collect()] == ["4"]
    assert read["none"].collect() == read["top"].collect() == []
    (tmp_path / "taken").write_text("a,_line\n1,2\n")
    with pytest.raises(ValueError, match="_line"):
        sources.read_lines(spark, str(tmp_path / "taken"))


def test_blanks_quotes_and_missing_values_as_the_plain_reader_has_them(spark, tmp_path):
    odd = [" pad ", "", None, 'say "so", then', "back\\", '"', "null", "a,b", "\t"]
    df = spark.createDataFrame([(i, a, b) for i, a in enumerate(odd) for b in odd], "n int, a string, b string")
    path = str(tmp_path / "odd")
    sources.write_csv(df, path)
    order = lambda rows: sorted(map(tuple, rows), key=str)
    lines = sources.read_lines(spark, path)
    assert order(sources.fitting(lines).collect()) == order(sources.read_csv(spark, path).collect())
    assert sources.malformed(lines).isEmpty()


def changed(spark, path, kind, change):
    """Write a copy anew with other rows, at the same place."""
    if kind == "parquet":
        kept = sources.stored(change(sources.read_parquet(spark, path)), "changed")
        sources.write_parquet(kept, path, "overwrite", ["occ_year"])
    else:
        kept = sources.stored(change(sources.read_csv(spark, path)), "changed")
        sources.write_csv(kept, path, "overwrite")


def one_value(df):
    return df.withColumn("note", F.when(column("note") == "plain", "Plain").otherwise(column("note")))


def one_row_doubled(df):
    return df.unionByName(df.where(column("note") == "plain"))


def one_row_missing(df):
    return df.where(column("note").isNull() | (column("note") != "plain"))


def null_for_empty(df):
    return df.withColumn("note", F.coalesce("note", F.lit("")))


@pytest.mark.parametrize("kind", ["parquet", "csv"])
@pytest.mark.parametrize("change", [one_value, one_row_doubled, one_row_missing, null_for_empty])
def test_a_copy_that_differs_is_found(spark, paths, kind, change):
    build(spark, paths)
    sources.verify_copies(spark, *paths[2:], TYPES)
    changed(spark, paths[3] if kind == "parquet" else paths[2], kind, change)
    with pytest.raises(sources.CopyMismatch, match="2015" if change is not null_for_empty else "differ"):
        sources.verify_copies(spark, *paths[2:], TYPES)
    report = {r["occ_year"]: r for r in sources.compare_copies(spark, *paths[2:], TYPES).collect()}
    assert report[2015]["matches"] == (change is null_for_empty)
    with pytest.raises(sources.CopyMismatch):
        build(spark, paths, mode="resume")


def test_copies_that_agree_but_are_not_what_was_written(spark, paths):
    build(spark, paths)
    written = {"rows": 6, "hashes": 0}
    with pytest.raises(sources.CopyMismatch, match="6 rows read back, 6 written"):
        sources.verify_copies(spark, *paths[2:], TYPES, written=written)


def test_copies_with_other_columns(spark, paths):
    build(spark, paths)
    changed(spark, paths[2], "csv", lambda df: df.drop("note"))
    with pytest.raises(sources.CopyMismatch, match=re.escape("'note'")):
        sources.verify_copies(spark, *paths[2:], TYPES)


def test_digests_add_up_and_tell_nulls_apart(spark):
    rows = [("a", None), (None, "a"), ("", "a"), ("a", None)]
    df = spark.createDataFrame(rows, "x string, y string")
    whole = df.agg(*sources.digest([F.col("x"), F.col("y")])).first()
    parts = [spark.createDataFrame(p, df.schema).agg(*sources.digest([F.col("x"), F.col("y")])).first() for p in (rows[:1], rows[1:])]
    assert whole["rows"] == 4 and whole["hashes"] == sum(p["hashes"] for p in parts)
    single = [spark.createDataFrame([r], df.schema).agg(*sources.digest([F.col("x"), F.col("y")])).first()[1] for r in rows[:3]]
    assert len(set(single)) == 3
    nothing = df.where("false").agg(*sources.digest([F.col("x")])).first()
    assert tuple(nothing) == (0, 0)
