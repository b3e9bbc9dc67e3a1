"""Every query against the same query as SQL over the raw tables."""

import math
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

DATA = Path("/root/testdata")
SCALES = ["sf0.001", "sf0.01"]
NAMES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module", params=SCALES)
def scale(request):
    directory = DATA / request.param
    connection = duckdb.connect()
    for name in NAMES:
        connection.sql(f"CREATE VIEW {name} AS FROM '{directory / name}.parquet'")
    yield str(directory), connection
    connection.close()


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-9) or (a != a and b != b)
    return type(a) is type(b) and a == b


def ordered(rows):
    return sorted(rows, key=lambda row: [(value is not None, str(value)) for value in row])


#: Lists what is wrong; test_copartition.py has wrong rows for it.
WITHOUT_ROWS = {"q4_verify_rows"}

#: The training-data queries have tests of their own.
OWN = contract.queries().keys() - contract.LLM_QUERIES.keys()


@pytest.mark.parametrize("key", sorted(OWN))
def test_matches_sql(spark, scale, key):
    directory, connection = scale
    df = contract.queries()[key](spark, directory)
    oracle = connection.sql(contract.oracle_sql()[key])

    columns = sorted(df.columns)
    assert columns == sorted(oracle.columns)
    got = ordered(tuple(row[name] for name in columns) for row in df.collect())
    places = [oracle.columns.index(name) for name in columns]
    expected = ordered(tuple(row[i] for i in places) for row in oracle.fetchall())

    assert expected or key in WITHOUT_ROWS, "a query without rows checks nothing"
    assert len(got) == len(expected)
    for left, right in zip(got, expected):
        assert all(map(same, left, right)), (left, right)


def test_every_query_has_sql():
    assert contract.oracle_sql().keys() - contract.LLM_SQL.keys() == OWN


@pytest.mark.parametrize("missing", ["blotter.llm", "corpus_pipeline", "public_tokenizers", "xxhash"])
def test_other_queries_do_without_the_training_data_operators(missing):
    code = f"""
import sys, warnings
warnings.simplefilter("ignore")
class Without:
    def find_spec(self, name, path=None, target=None):
        if name == {missing!r} or name.startswith({missing + "."!r}):
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Without())
import __spark_entry__ as entry
assert not entry.LLM_QUERIES and len(entry.queries()) == len(entry.oracle_sql()) == {len(OWN)}
"""
    root = Path(contract.__file__).parent
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["DIVISION", "avg_distance_km", "incidents total"]
    assert df.count() > 0
