"""From raw documents to packed sequences, one stage after another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from blotter.llm import mixing, packing, personal, quality, simhash
from blotter.llm.queries import tokenizer_file
from blotter.sources import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents outside the limits of their language and source go."""
    return quality.keep_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by the name of its kind."""
    return personal.masked(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources meet their target weights; documents are repeated or left out for it."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens; a document the mix repeats comes as often."""
    return packing.packed(docs, tokenizer_file())


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("PII", personal_data),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: SimHash groups are the components of a graph, which SQL on whole tables does not reach.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage is written as Parquet and read again as the documents of the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
