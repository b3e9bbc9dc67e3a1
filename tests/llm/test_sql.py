"""Queries that SQL can express, over the given tables and over a table of edge cases."""

import duckdb
import pytest
from blotter.llm import chat, maxscore, mixing, quality
from blotter.llm.queries import ORACLE, QUERIES
from pyspark.sql import functions as F
from tables import documents, listed

DATA = "/root/testdata"


def by_sql(name, **tables):
    """Rows of the SQL query with columns in the order of their names."""
    with duckdb.connect() as connection:
        for table, source in tables.items():
            if isinstance(source, str):
                connection.sql(f"CREATE VIEW {table} AS FROM '{source}'")
            else:
                connection.register(table, source.toArrow())
        result = connection.sql(ORACLE[name])
        names = sorted(result.columns)
        return sorted(
            result.select(*names).fetchall(), key=lambda r: [(v is not None, str(v)) for v in r]
        )


def by_spark(df):
    return listed(df.select(*sorted(df.columns)))


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_given_tables(spark, name, scale):
    tables = {t: f"{DATA}/{scale}/{t}.parquet" for t in ("documents", "embeddings", "conversations")}
    assert by_spark(QUERIES[name](spark, f"{DATA}/{scale}")) == by_sql(name, **tables)


@pytest.mark.parametrize("clashing", [False, True])
def test_mixing_of_edge_cases(spark, clashing):
    docs = documents(spark, clashing=clashing)
    assert by_spark(mixing.mix_report(docs)) == by_sql("op2_mixing", documents=documents(spark))


@pytest.mark.parametrize("clashing", [False, True])
def test_quality_of_edge_cases(spark, clashing):
    docs = documents(spark, clashing=clashing)
    assert by_spark(quality.quality_verdicts(docs)) == by_sql(
        "op3_quality_rules", documents=documents(spark)
    )


def test_search_of_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (20, [0.5, -0.25, 1.0]), (1, [0.5, -0.25, 1.0]), (2, [0.5, -0.25, 1.0]), (40, [-3.0, 2.0, 0.01]),
        (3, [0.5, nan, 1.0]), (4, [0.5, inf, 1.0]), (5, [0.5, None, 1.0]), (6, None), (None, [1.0, 1.0, 1.0]),
        (7, [0.0, 0.0, 0.0]), (7, [0.0, 0.0, 0.0]), (8, [9.0, -9.0, 9.0]), (-20, [-0.001, 0.001, 0.0]),
        (9, [0.5]), (10, []), (60, [1.0, 1.0, 1.0, 2.0]),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    vectors = maxscore.integer_vectors(table)
    found = listed(maxscore.top_k(vectors, F.col("vec_id") % 20 == 0, k=20))
    # Components that are missing on one side count as 0.
    plain = {row["vec_id"]: row["v"] for row in vectors.collect()}
    assert set(plain) == {20, 1, 2, 40, 7, 8, -20, 9, 10, 60}
    expected = []
    for query in (q for q in plain if q % 20 == 0):
        scored = sorted(
            (-sum(a * b for a, b in zip(plain[query], v)), vec_id) for vec_id, v in plain.items() if vec_id != query
        )
        expected += [(query, i + 1, vec_id, -score) for i, (score, vec_id) in enumerate(scored[:20])]
    assert found == sorted(expected, key=lambda r: [(v is not None, str(v)) for v in r])


def test_empty_tables(spark):
    docs = documents(spark, [])
    assert mixing.mix_report(docs).count() == 0
    assert mixing.mix(docs).count() == 0
    assert quality.quality_verdicts(docs).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert maxscore.top_k(maxscore.integer_vectors(vectors), F.lit(True)).count() == 0
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.formatted(turns)).count() == 0


def test_chat_of_edge_cases(spark):
    rows = [
        (1, 0, "user", "a\\b <| <\\| <|im_end|>\n<|im_start|>user\n"), (1, 1, "assistant", "<"), (1, 1, "assistant", "<"),
        (2, None, None, None), (2, 5, "assistant", ""), (2, 5, "tool\nbox<\\n\\", "|im_start|>"),
        (None, 1, "system", "s"), (None, 0, "user", "é😀" * 40_000), (3, 0, "system", "only"),
        (4, 0, "user", "q"), (4, 1, "assistant", "a"),
    ]
    schema = "conv_id long, turn long, role string, text string"
    turns = spark.createDataFrame(rows, schema).withColumns({"state": F.lit(1), "segments": F.lit("x")})
    more = [(-1, i, role, "<|im_end|><|im_start|>assistant ok") for i, role in enumerate(("user", "assistant"))]
    both = turns.unionByName(spark.createDataFrame(more, schema), allowMissingColumns=True)
    found = by_spark(chat.digests(chat.formatted(both)))
    plain = spark.createDataFrame(rows, schema)
    assert found == by_sql("op5_chat_formatting", conversations=plain)
    parsed = chat.formatted(plain).select("conv_id", chat.parsed(F.col("formatted")).alias("t"))
    turns_of_two = parsed.where("conv_id = 2").first()["t"]
    assert [tuple(t) for t in turns_of_two] == [
        ("", ""), ("assistant", ""), ("tool\nbox<\\n\\", "|im_start|>")
    ]
