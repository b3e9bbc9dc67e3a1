"""The pipeline against its stages one by one, on the given and on odd tables."""

import corpus_pipeline
import pytest
from blotter.llm import personal, quality, simhash
from tables import documents, rows, sentence


def written(spark, tmp_path, docs):
    path = tmp_path / "documents.parquet"
    docs.coalesce(2).write.parquet(str(path))
    return str(tmp_path)


def test_given_tables(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    verdicts = {r["doc_id"] for r in quality.quality_verdicts(docs).where("kept").collect()}
    left = corpus_pipeline.STAGES[0][1](spark, docs, sf_dir)
    assert {r["doc_id"] for r in left.collect()} == verdicts and left.columns == docs.columns
    unique = corpus_pipeline.STAGES[1][1](spark, left, sf_dir)
    groups = {r["component_id"] for r in simhash.near_duplicates(left).collect()}
    assert sorted(r["doc_id"] for r in unique.collect()) == sorted(groups)
    clean = corpus_pipeline.STAGES[2][1](spark, unique, sf_dir)
    assert {r["doc_id"]: r["text"] for r in clean.collect()} == {
        r["doc_id"]: personal.mask(r["text"]) for r in unique.collect()
    }
    mixed = corpus_pipeline.STAGES[3][1](spark, clean, sf_dir)
    assert mixed.columns == docs.columns
    pieces = corpus_pipeline.run(spark, sf_dir)
    ends = pieces.where("start + length = doc_tokens").count()
    assert ends == mixed.count()


@pytest.mark.parametrize("data", [[], rows() + [(900 + i, sentence(i, 80), "en", "a", 1) for i in range(9)]])
def test_odd_tables(spark, tmp_path, data):
    docs = documents(spark, data, clashing=bool(data))
    sf_dir = written(spark, tmp_path, docs)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs_out = stage(spark, docs, sf_dir)
        assert docs_out.columns == docs.columns
    assert (corpus_pipeline.run(spark, sf_dir).count() > 0) == bool(data)
