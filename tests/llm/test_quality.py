"""Limits follow the documents: sources that differ get different ones, junk goes, clean documents stay."""

import random

from blotter.llm import quality
from blotter.llm.quality import MARK, RATIOS
from blotter.llm.queries import QUERIES
from pyspark.sql import functions as F
from tables import documents, sentence


def of_source(source, n, length, symbols=0, lines=0, phrase=0):
    """Documents with so many symbols, repeated lines and repeated phrases in up to half of them."""
    found = []
    for i in range(n):
        dice = random.Random(f"{source}{i}")
        words = [w * length for w in sentence((source, i), 150).split()]
        if i % 2:
            words += ["#*$%&|"[j % 6] * 3 for j in range(symbols)]
            words += words[:9] * dice.randint(0, phrase)
        text = " ".join(words) + "\n" + "say it\n" * (lines if i % 2 else 1)
        found.append((text, "en", source, 1))
    return found


def rows(*sources):
    return [(i, *row) for i, row in enumerate(row for source in sources for row in source)]


def limits(spark, data):
    found = quality.limits(quality.sketches(quality.measured(documents(spark, data))))
    return {row["source"]: row.asDict() for row in found.collect()}


def test_every_limit_follows_its_source(spark):
    plain = of_source("plain", 300, 1, symbols=5, lines=2, phrase=2)
    other = of_source("other", 300, 2, symbols=30, lines=8, phrase=4)
    found = limits(spark, rows(plain, other))
    for name in RATIOS:
        ends = {(found[s][f"{MARK}low_{name}"], found[s][f"{MARK}high_{name}"]) for s in found}
        assert len(ends) == 2, name


def test_small_sources_lean_on_their_language(spark):
    """The limits of a source near those of the language, the nearer the fewer its documents."""
    main = of_source("main", 400, 1)
    high = f"{MARK}high_word_length"
    highs = [
        limits(spark, rows(main, of_source("odd", n, 2)))["odd"][high] for n in (2, 30, 150)
    ]
    assert highs == sorted(highs) and highs[0] < highs[2]


def test_junk_sets_no_standard_of_its_own(spark):
    clean, junk = of_source("clean", 400, 1), of_source("junk", 40, 1, symbols=120)
    data = rows(clean, junk)
    kept = {r["doc_id"] for r in quality.quality_verdicts(documents(spark, data)).where("kept").collect()}
    assert kept.issuperset(range(400))
    assert kept.isdisjoint(range(401, 440, 2))


def test_a_single_document_is_its_own_standard(spark):
    found = quality.quality_verdicts(documents(spark, [(1, sentence(1, 60) + " #", "en", "a", 1)]))
    assert [row["kept"] for row in found.collect()] == [True]


def test_one_symbol_in_a_short_text_says_nothing(spark):
    data = rows(of_source("clean", 200, 1)) + [(900, sentence(5, 30) + " & more", "en", "clean", 1)]
    found = quality.quality_verdicts(documents(spark, data)).where("doc_id = 900").first()
    assert found["n_symbols"] == 1 and found["kept"]


def test_labelled_documents(spark):
    """Limits were chosen on sf0.1; these are other rows."""
    sf_dir = "/root/testdata/sf0.01"
    found = QUERIES["op3_quality_rules"](spark, sf_dir).where("NOT base_failed")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    share = dict(found.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int"))).collect())
    assert share[1] >= 0.98 and share[0] <= 0.1
