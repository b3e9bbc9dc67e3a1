"""Small tables with everything that may go wrong in them."""

import random

CLASHING = {
    "n": "1", "part": "2", "row": "'x'", "kept": "3", "fp": "4", "size": "5L", "rank": "6", "key": "'k'",
    "target": "7", "ids": "8", "place": "9", "start": "10", "end": "11", "words": "12", "base": "'b'",
    "component_id": "13", "text_hash": "14L", "copy": "'c'", "state": "15", "digest": "16",
}

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

SYLLABLES = "an er in on th re at en ou ea ti or st he nd".split()


def sentence(seed, words):
    dice = random.Random(str(seed))
    return " ".join("".join(dice.choices(SYLLABLES, k=dice.randint(1, 4))) for _ in range(words))


def rows():
    """Nulls in every column, empty, blank and long texts, copies, ties and repeated rows."""
    long_text = sentence("long", 30_000)
    found = [
        (1, sentence(1, 60), "en", "a", 1),
        (2, sentence(1, 60), "en", "a", 1),
        (3, sentence(3, 40), "de", "b", 1),
        (3, sentence(3, 40), "de", "b", 1),
        (4, None, "en", "a", None),
        (5, "", None, None, 0),
        (6, " \t\n\r\x0b\x0c", "fr", "", 6),
        (7, long_text, "en", "c", len(long_text)),
        (8, "x" * 50_000, "en", "c", 50_000),
        (None, sentence(9, 30), "en", "a", 1),
        (9, sentence(9, 30), None, None, None),
        (10, "Écoutez l’été 中文 😀 " * 8, "fr", "é", 1),
        (11, "one two", "en", "a", 7),
        (12, "the same line\n" * 40, "en", "b", 1),
        (13, "### " + sentence(13, 50) + " $$$ %%%", "en", "b", 1),
        (14, "word " * 3000, "en", "b", 1),
    ]
    return found + [(100 + i, sentence(("many", i), 25 + i), "en", "a", 1) for i in range(30)]


def documents(spark, data=None, clashing=False):
    df = spark.createDataFrame(rows() if data is None else data, DOCUMENTS)
    return df.selectExpr("*", *(f"{value} AS {name}" for name, value in CLASHING.items())) if clashing else df


def listed(df):
    return sorted((tuple(row) for row in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])
