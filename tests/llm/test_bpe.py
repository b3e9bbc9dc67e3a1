"""BPE against the tokenizers library, and back to the text."""

import hashlib
import json

import numpy as np
import public_tokenizers
import pytest
from blotter.llm import bpe
from blotter.llm.queries import op13_bpe
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tables import documents, sentence
from tokenizers import Tokenizer

FILE = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY, OWN = Tokenizer.from_file(FILE), bpe.Bpe(FILE)
ODD = ["a", "the", " ", "  ", "\n", "\t", "\x1c", "\x85", "\u3000", "'s", "'", "'LL", "12", "²", "é", "中", "😀", "\ufffd",
       "...", "\u0301", "<|endoftext|>", "<|endof", "\x00"]
texts = st.one_of(st.text(max_size=200), st.lists(st.sampled_from(ODD), max_size=40).map("".join))


def expected(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=500, deadline=None)
@given(texts)
def test_ids_are_those_of_the_library(text):
    ids = expected(text)
    assert OWN.encode(text) == ids
    assert OWN.decode(np.array(ids, np.int32)) == LIBRARY.decode(ids, skip_special_tokens=False) == text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 50_300), max_size=30))
def test_any_ids_decode_as_in_the_library(ids):
    assert OWN.decode(np.array(ids, np.int32)) == LIBRARY.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["x" * 30_000, "ab" * 20_000 + "y", "é" * 9_999, " " * 5_000 + "a", "中文" * 5_000])
def test_long_words(text):
    assert OWN.encode(text) == expected(text)


def test_texts_longer_than_a_stride(monkeypatch):
    monkeypatch.setattr(bpe, "STRIDE", 50)
    for text in (sentence("stride", 3000), "a\n  b  \n" * 400, "no" * 400, "<|endoftext|> a" * 100):
        assert OWN.encode(text) == expected(text)


def test_forgotten_words_are_worked_out_anew(monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN", 3)
    text = sentence("forgotten", 500)
    assert bpe.Bpe(FILE).encode(text) == expected(text)


def test_all_code_points():
    for first in range(0, 0x110000, 64):
        text = "".join(f"a{chr(c)}1" for c in range(first, first + 64) if not 0xD800 <= c < 0xE000)
        assert OWN.encode(text) == expected(text)


def test_other_kinds_of_vocabularies_are_refused(tmp_path):
    said = json.load(open(FILE, encoding="utf-8"))
    said["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "other.json").write_text(json.dumps(said))
    with pytest.raises(ValueError):
        bpe.Bpe(str(tmp_path / "other.json"))
    with pytest.raises(ValueError):
        bpe.Bpe(public_tokenizers.path("word_bpe_49k.json"))


def test_columns_with_everything(spark):
    df = documents(spark, clashing=True).drop("ids")
    ids = df.withColumn("ids", bpe.encode(F.col("text"), FILE))
    rows = ids.withColumn("again", bpe.decode(F.col("ids"), FILE)).collect()
    assert len(rows) == df.count()
    for row in rows:
        assert row["ids"] == expected(row["text"] or "")
        assert row["again"] == (row["text"] or "")


def test_null_ids_and_no_utf8(spark):
    rows = spark.sql("SELECT CAST(NULL AS array<int>) AS ids UNION ALL SELECT array() UNION ALL SELECT array(447, null, 999999)")
    assert [r[0] for r in rows.select(bpe.decode(F.col("ids"), FILE)).collect()] == [None, "", "\ufffd"]
    odd = spark.sql("SELECT CAST(X'61FF62' AS string) AS text").select(bpe.encode(F.col("text"), FILE).alias("ids"))
    assert odd.first()["ids"] == expected("a\ufffdb")


def test_query(spark, tmp_path):
    path = str(tmp_path / "sf")
    documents(spark, clashing=True).write.parquet(f"{path}/documents.parquet")
    found = op13_bpe(spark, path).collect()
    source = {(r["doc_id"], r["text"]) for r in documents(spark).collect()}
    wanted = set()
    for doc_id, text in source:
        ids = expected(text or "")
        digests = (hashlib.sha256(s.encode()).hexdigest() for s in (",".join(map(str, ids)), text or ""))
        wanted.add((doc_id, len(ids), *digests))
    assert {tuple(r) for r in found} == wanted and len(found) == documents(spark).count()
    documents(spark, []).write.parquet(f"{path}/none/documents.parquet")
    assert op13_bpe(spark, f"{path}/none").collect() == []
