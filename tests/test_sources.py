import shutil

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from blotter import sources
from blotter.sources import scratch
from blotter.sources.layouts import GEOCODE_TYPES, INCOME_TYPES, STATION_TYPES

HEADER = "DR_NO,DATE OCC,TIME OCC,{area},Premis Desc,Vict Descent,Weapon Used Cd,LAT,LON\n"
OLD = HEADER.format(area="AREA ") + (
    '1,02/20/2015 12:00:00 AM,0415,5,"STREET",H,102,34.0,-118.25\n'
    '1,02/20/2015 12:00:00 AM,0415,5,"STREET",H,102,34.0,-118.25\n'
    '2,02/21/2015 12:00:00 AM,1200,x,"YARD, FRONT",,,0,0\n'
)
NEW = HEADER.format(area="AREA") + "3,01/08/2020 12:00:00 AM,2230,3,STREET,B,400,34.1,-118.3\n"


@pytest.fixture
def extracts(tmp_path):
    paths = []
    for name, text in (("old.csv", OLD), ("new.csv", NEW)):
        (tmp_path / name).write_text(text)
        paths.append(str(tmp_path / name))
    return paths


def test_build_incidents(spark, tmp_path, extracts):
    csv, parquet = str(tmp_path / "csv"), str(tmp_path / "parquet")
    stored = sources.build_incidents(spark, *extracts, csv, parquet)
    assert dict(stored.dtypes) == {
        "DR_NO": "bigint", "DATE OCC": "string", "TIME OCC": "int", "AREA": "int",
        "Premis Desc": "string", "Vict Descent": "string", "Weapon Used Cd": "int",
        "LAT": "double", "LON": "double", "occ_year": "int",
    }
    assert sorted((r["DR_NO"], r["occ_year"]) for r in stored.collect()) == [
        (1, 2015), (1, 2015), (2, 2015), (3, 2020)
    ]
    stored = stored.drop("occ_year")
    rows = sorted(map(tuple, stored.collect()))
    assert rows == [
        (1, "02/20/2015 12:00:00 AM", 415, 5, "STREET", "H", 102, 34.0, -118.25),
        (1, "02/20/2015 12:00:00 AM", 415, 5, "STREET", "H", 102, 34.0, -118.25),
        (2, "02/21/2015 12:00:00 AM", 1200, None, "YARD, FRONT", None, None, 0.0, 0.0),
        (3, "01/08/2020 12:00:00 AM", 2230, 3, "STREET", "B", 400, 34.1, -118.3),
    ]
    again = sources.read_csv(spark, csv, schema=stored.schema)
    assert again.schema == stored.schema and sorted(map(tuple, again.collect())) == rows


def test_text_that_does_not_fit_is_kept(spark, tmp_path, extracts):
    csv, parquet = str(tmp_path / "csv"), str(tmp_path / "parquet")
    sources.build_incidents(spark, *extracts, csv, parquet)
    found = sources.rejects(spark, parquet).select("DR_NO", "rejected_column", "rejected_text")
    assert [tuple(r) for r in found.collect()] == [(2, "AREA", "x")]
    assert [tuple(r) for r in sources.count_rejects(spark, parquet).collect()] == [("AREA", 1)]
    text = {r["DR_NO"]: r["AREA"] for r in sources.read_csv(spark, csv).collect()}
    assert text == {"1": "5", "2": "x", "3": "3"}
    strict = str(tmp_path / "strict-csv"), str(tmp_path / "strict-parquet")
    with pytest.raises(Exception, match="int expected in AREA, found: x"):
        sources.build_incidents(spark, *extracts, *strict, strict=True)


def test_a_run_that_broke_off_is_resumed(spark, tmp_path, extracts):
    csv, parquet = str(tmp_path / "csv"), str(tmp_path / "parquet")
    sources.build_incidents(spark, *extracts, csv, parquet)
    first = sorted(map(str, (tmp_path / "parquet").rglob("*.parquet")))
    shutil.rmtree(csv)
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        sources.build_incidents(spark, *extracts, csv, parquet)
    again = sources.build_incidents(spark, *extracts, csv, parquet, mode="resume")
    assert sorted(map(str, (tmp_path / "parquet").rglob("*.parquet"))) == first
    assert sources.read_csv(spark, csv).count() == again.count() == 4
    assert sources.build_incidents(spark, *extracts, csv, parquet, mode="overwrite").count() == 4
    assert sorted(map(str, (tmp_path / "parquet").rglob("*.parquet"))) != first
    with pytest.raises(ValueError, match="unknown mode"):
        sources.build_incidents(spark, *extracts, csv, parquet, mode="append")


def test_a_bad_date_is_in_a_partition_of_its_own(spark, tmp_path):
    for name in ("old", "new"):
        date = "02/20/2015 12:00:00 AM" if name == "old" else "bad"
        (tmp_path / f"{name}.csv").write_text(HEADER.format(area="AREA") + f"1,{date},0415,5,STREET,H,102,34.0,-118.25\n")
    paths = [str(tmp_path / name) for name in ("old.csv", "new.csv", "csv", "parquet")]
    stored = sources.build_incidents(spark, *paths)
    assert sorted(((r["DATE OCC"], r["occ_year"]) for r in stored.collect()), key=str) == [
        ("02/20/2015 12:00:00 AM", 2015), ("bad", None)
    ]


ODD = [" pad ", "", None, 'say "so", then', "back\\", '\\"', "two\nlines", "\r", '"', "\\N", "null", "a,b", "\t"]


def test_csv_is_lossless(spark, tmp_path):
    df = spark.createDataFrame([(i, a, b) for i, a in enumerate(ODD) for b in ODD], "n int, a string, b string")
    path = str(tmp_path / "odd")
    sources.write_csv(df, path, multiline=True)
    back = sources.read_csv(spark, path, schema=df.schema, multiline=True)
    key = lambda r: (r[0], str(r))
    assert sorted(map(tuple, back.collect()), key=key) == sorted(map(tuple, df.collect()), key=key)


def test_line_breaks_are_not_written_unnoticed(spark, tmp_path):
    df = spark.createDataFrame([("a",), ("b\nc",)], "v string")
    with pytest.raises(Exception, match="line break in column v"):
        sources.write_csv(df, str(tmp_path / "split"))


def test_schema_must_match_the_header(spark, tmp_path):
    (tmp_path / "t.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        sources.read_csv(spark, str(tmp_path / "t.csv"), schema="a int, b int").collect()
    row = sources.read_csv(spark, str(tmp_path / "t.csv"), schema="b int, a int").first()
    assert (row.a, row.b) == (2, 1)


def test_scratch_tables_can_be_dropped(spark):
    sources.drop_scratch(spark)
    df, total = sources.stored_and_measured(spark.range(10), "numbers", F.sum("id"))
    assert df.count() == 10 and total == 45
    (path,) = scratch._given
    assert scratch.exists(spark, path)
    sources.drop_scratch(spark)
    assert not scratch.exists(spark, path) and not scratch._given


def test_writing_twice_is_an_error(spark, tmp_path, extracts):
    df = sources.read_csv(spark, extracts[1])
    for write in (sources.write_csv, sources.write_parquet):
        path = str(tmp_path / write.__name__)
        write(df, path)
        with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
            write(df, path)
        write(df, path, mode="append")
        assert spark.read.format(write.__name__[6:]).load(path).count() >= 2


def test_header_in_each_part(spark, tmp_path):
    path = str(tmp_path / "parts")
    sources.write_csv(spark.range(0, 100, 1, 4).withColumnRenamed("id", "DR_NO"), path)
    untyped = sources.read_csv(spark, path)
    assert untyped.dtypes == [("DR_NO", "string")]
    assert sorted(int(row.DR_NO) for row in untyped.collect()) == list(range(100))
    assert sources.read_csv(spark, path, types={"DR_NO": "int"}).dtypes == [("DR_NO", "int")]
    assert sources.read_csv(spark, path, infer=True).dtypes == [("DR_NO", "int")]


def test_only_named_columns_are_parsed(spark, extracts):
    df = sources.read_csv(spark, extracts[1], types={"LAT": "double"}).select("LAT")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<LAT:string>" in plan


def test_line_breaks_in_quotes(spark, tmp_path):
    path = tmp_path / "notes.csv"
    path.write_text('id,note\n1,"two\nlines"\n')
    assert sources.read_csv(spark, str(path)).count() == 2
    assert sources.read_csv(spark, str(path), multiline=True).collect()[0].note == "two\nlines"


def test_combine_by_name_and_position(spark):
    old = spark.createDataFrame([(1, "a")], "`AREA ` int, v string")
    new = spark.createDataFrame([("b", 2)], "v string, AREA int")
    named = sources.combine(old, new, {"AREA ": "AREA"})
    assert sorted(map(tuple, named.collect())) == [(1, "a"), (2, "b")]
    placed = sources.combine(old, new.select("AREA", "v"), {"AREA ": "AREA"}, by_position=True)
    assert sorted(map(tuple, placed.collect())) == [(1, "a"), (2, "b")]
    assert placed.columns == ["AREA", "v"]


def test_small_tables(spark, tmp_path):
    files = {
        "incomes": ('"Zip Code","Community","Estimated Median Income"\n'
                    '90001,"South, North","$33,887"\n', INCOME_TYPES),
        "stations": ("OBJECTID,DIVISION,LOCATION,PREC,x,y\n1,PORT, 1 MAIN ST,5,-118.28,33.75\n",
                     STATION_TYPES),
        "geocode": ("LAT,LON,ZIPcode\n34.0,-118.2,90013; 90015\n", GEOCODE_TYPES),
    }
    rows = {}
    for name, (text, types) in files.items():
        (tmp_path / name).write_text(text)
        rows[name] = tuple(sources.read_csv(spark, str(tmp_path / name), types=types).first())
    assert rows == {
        "incomes": (90001, "South, North", "$33,887"),
        "stations": (1, "PORT", " 1 MAIN ST", 5, -118.28, 33.75),
        "geocode": (34.0, -118.2, "90013; 90015"),
    }


class FakeSession:
    def __init__(self, **settings):
        self.conf = {key.replace("_", "."): value for key, value in settings.items()}


def test_scratch_path():
    shared = FakeSession(spark_checkpoint_dir="hdfs://shared/", spark_master="yarn")
    first, second = (sources.scratch_path(shared, "orders") for _ in range(2))
    assert first.startswith("hdfs://shared/orders-") and first != second
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        sources.scratch_path(FakeSession(spark_master="yarn"), "orders")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        sources.scratch_path(FakeSession(spark_master="local-cluster[2,1,1024]"), "orders")
    for master in ("local", "local[2]", "local[*, 3]"):
        assert "orders-" in sources.scratch_path(FakeSession(spark_master=master), "orders")
