"""The lattice against all segmentations, and accuracy on held-out documents."""

import math
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from blotter.llm import langid
from blotter.llm.queries import QUERIES
from pyspark.sql import functions as F
from tables import documents

FILE = public_tokenizers.path("piece_bpe_32k.model")


def by_hand(text, probability, unknown, one=1.0):
    """Sum over all segmentations of a word with its mark, written out."""
    longest = max(map(len, probability))
    sums = [one] + [0 * one] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(end - longest, 0), end):
            piece = text[start:end]
            p = probability.get(piece, unknown if end - start == 1 else 0)
            sums[end] += sums[start] * p
    return sums[-1]


def segmentations(text, pieces):
    """All ways to cut a text into pieces, as numbers; a letter without a piece has the last one."""
    if not text:
        yield []
    for size in range(1, len(text) + 1):
        head = text[:size]
        if head in pieces or size == 1:
            number = pieces.index(head) if head in pieces else len(pieces)
            for rest in segmentations(text[size:], pieces):
                yield [number, *rest]


def test_lattice_sums_all_segmentations():
    pieces = sorted({"▁", "▁a", "a", "ab", "b", "▁ab", "bab", "c"})
    dice = np.random.default_rng(0)
    table = dice.dirichlet(np.ones(len(pieces) + 1), size=2).T
    model = langid.Model(["x", "y"], pieces, table)
    words = ["a", "ab", "abab", "babc", "zab", "é", "abcabcabab", "c" * 40]
    scores = langid.word_scores(words, langid.finder(pieces), langid.scaled(model))
    for word, row in zip(words, scores):
        for language in range(2):
            known = dict(zip(pieces, table[:, language]))
            expected = by_hand(langid.START + word, known, table[-1, language])
            assert np.isclose(row[language], np.log(expected), rtol=1e-9)


def test_long_words_are_scored_whole():
    """Against fractions, at and around the ends of stretches; letters without a piece, too."""
    pieces = sorted({"▁", "▁a", "a", "ab", "b", "▁ab", "babab", "c", "abcabcabcab"})
    dice = np.random.default_rng(1)
    table = dice.dirichlet(np.ones(len(pieces) + 1), size=3).T
    table[-1] = 1e-9
    model = langid.Model(["x", "y", "z"], pieces, table)
    sizes = [1, 39, 40, 41, 79, 80, 81, 119, 400, 1001]
    words = ["".join(dice.choice(list("abcé"), n, p=[0.4, 0.4, 0.15, 0.05])) for n in sizes]
    words += ["abc" * 30, "é" * 200, "ab" * 20 + "é" * 3]
    scores = langid.word_scores(words, langid.finder(pieces), langid.scaled(model))
    for word, row in zip(words, scores):
        for language in range(3):
            known = {p: Fraction(v) for p, v in zip(pieces, table[:, language])}
            exact = by_hand(langid.START + word, known, Fraction(table[-1, language]), Fraction(1))
            assert np.isclose(row[language], math.log(exact.numerator) - math.log(exact.denominator), rtol=1e-9)


def test_expectation_against_all_segmentations():
    """Expected counts of pieces, from every segmentation written out."""
    pieces = sorted({"▁", "▁a", "a", "ab", "b", "▁ab", "bab"})
    table = np.random.default_rng(2).dirichlet(np.ones(len(pieces) + 1), size=2).T
    model = langid.Model(["x", "y"], pieces, table)
    words = [("x", "abab", 3), ("x", "bz", 1), ("y", "abab", 2), ("y", "a", 5)]
    names = ["lang", "word", "n"]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*words)], names=names)
    found = np.zeros_like(table)
    for part in langid._expectation(model)([batch]):
        for language, piece, n in zip(*(column.to_pylist() for column in part.columns)):
            found[piece, language] += n
    expected = np.zeros_like(table)
    for lang, word, n in words:
        language = model.languages.index(lang)
        ways = list(segmentations(langid.START + word, pieces))
        weights = [math.prod(table[i, language] for i in way) for way in ways]
        for way, weight in zip(ways, weights):
            for i in way:
                expected[i, language] += n * weight / sum(weights)
    assert np.allclose(found, expected)


def test_ties_go_to_the_first_language():
    model = langid.Model(["aa", "bb"], ["a", "▁"], np.full((3, 2), 1 / 3))
    langs, scores = [], []
    langid.Scorer(model).add([[b"aab", b"a" * 90]], langs, scores)
    assert langs == ["aa"] and scores == [0.5]


def test_backward_agrees_with_forward():
    pieces = sorted({"▁", "▁a", "a", "ab", "b", "▁ab"})
    table = np.full((len(pieces) + 1, 1), 0.1)
    lattice = langid.Lattice(["abab", "b", "aab"], langid.finder(pieces), len(pieces))
    ahead, behind = lattice.forward(table), lattice.backward(table)
    assert np.allclose(ahead[lattice.last], behind[lattice.first])


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = QUERIES["op7_language"](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    right = found.join(docs, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert found.count() == docs.count()
    assert right.first()[0] >= 0.98
    for row in found.select("doc_id", "held_out", "score").take(50):
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2)
        assert 0 <= row["score"] <= 1


@pytest.mark.parametrize("clashing", [False, True])
def test_edge_cases(spark, clashing):
    words = {"en": "the house and the garden of them ", "de": "das haus und der garten von ihnen "}
    data = [(i, words[lang] * 5, lang, "a", 1) for i in range(20) for lang in words]
    more = [
        (100, None, "en", "a", 1), (101, "", "en", "a", 1), (102, "123 !? 😀", "en", "a", 1), (None, "the garden", None, "a", 1),
        (103, "Der Garten!", "en", None, 1), (103, "Der Garten!", "en", None, 1), (104, "garten" * 5000, None, "a", 1),
        (105, "ж中ñ", None, "a", 1),
    ]
    found = langid.identify(documents(spark, data + more, clashing), FILE)
    got = [(r["doc_id"], r["lang_pred"]) for r in found.collect() if r["doc_id"] is None or r["doc_id"] >= 100]
    assert sorted((d, p) for d, p in got if d not in (None, 105)) == [
        (100, "und"), (101, "und"), (102, "und"), (103, "de"), (103, "de"), (104, "de")
    ]
    assert (None, "en") in got and dict(got)[105] in ("de", "en")


def test_nothing_to_learn_from(spark):
    assert langid.identify(documents(spark, []), FILE).count() == 0
    found = langid.identify(documents(spark, [(1, "some text", None, "a", 1)]), FILE).collect()
    assert [(r["lang_pred"], r["score"]) for r in found] == [("und", 0.0)]
