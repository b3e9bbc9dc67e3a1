"""Repeated passages against windows of words compared by brute force."""

import random

import numpy as np
import pytest
from blotter.llm import chunks
from hypothesis import given, settings
from hypothesis import strategies as st
from tables import documents, listed, sentence


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=400), st.integers(1, 40))
def test_chunks_cover_the_text(text, times):
    data = (text * times).encode()
    digests, ends, words = chunks.chunks(data)
    assert len(digests) == len(ends) == len(words)
    if data:
        assert (np.diff(ends) > 0).all() and ends[-1] == len(text * times)
        assert words[-1] == len(data.split())


def test_hash_depends_on_sixteen_bytes():
    dice = np.random.default_rng(1)
    data = dice.integers(0, 256, 300, dtype=np.uint8)
    whole, late = chunks.gear_hashes(data), chunks.gear_hashes(data[100:])
    assert (whole[116:] == late[16:]).all()
    by_hand = 0
    for byte in data[:200].tolist():
        by_hand = (2 * by_hand + int(chunks.GEAR[byte])) % (1 << 16)
    assert by_hand == whole[199]


def test_insertions_move_no_other_cut():
    text = sentence("cuts", 2000).encode()
    changed = text[:3000] + b" inserted words " + text[3000:]
    before, after = set(chunks.cuts(np.frombuffer(text, np.uint8))), set(chunks.cuts(np.frombuffer(changed, np.uint8)))
    assert {c for c in before if c < 2900} == {c for c in after if c < 2900}
    assert {c + 16 for c in before if c > 3100} == {c for c in after if c > 3116}


def planted():
    """Passages of 51 to 120 words in two or more documents each, at any place; clean documents."""
    dice = random.Random(3)
    data, shared = [], set()
    for i in range(120):
        words = sentence(("own", i), dice.randint(30, 400)).split()
        if i < 60:
            passage = sentence(("passage", i // 2), 51 + i // 2).split()
            at = dice.randint(0, len(words))
            words[at:at] = passage
            shared.add(i)
        data.append((i, " ".join(words), "en", "a", 1))
    for i, word in ((200, "thhe"), (201, "thhe")):
        data.append((i, f"{sentence(i, 20 + i % 2)} " + f"{word} " * 120, "en", "a", 1))
        shared.add(i)
    return data, shared


def test_planted_passages_are_found(spark):
    data, shared = planted()
    rows = chunks.repeated_spans(documents(spark, data, clashing=True)).collect()
    assert {r["doc_id"] for r in rows} == shared
    text = {d: t for d, t, *_ in data}
    for r in rows:
        own = text[r["doc_id"]][r["start"] : r["end"]]
        assert r["kept"] == (r["doc_id"] == r["first_doc_id"])
        if not r["kept"]:
            assert own in text[r["first_doc_id"]]


def test_given_documents(spark):
    """Every document with a passage of over 50 words that another one has; no document without
    a shared passage of ten words."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    flagged = {r["doc_id"] for r in chunks.repeated_spans(docs).select("doc_id").collect()}
    texts = [(r["doc_id"], r["text"].split()) for r in docs.select("doc_id", "text").collect()]

    def sharing(size):
        of, found = {}, set()
        for doc_id, words in texts:
            for window in {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}:
                if of.setdefault(window, doc_id) != doc_id:
                    found |= {of[window], doc_id}
        return found

    assert sharing(51) <= flagged <= sharing(10)


@pytest.mark.parametrize("clashing", [False, True])
def test_edge_cases(spark, clashing):
    passage = sentence("p", 60)
    long_text = sentence("l", 40_000)
    data = [
        (1, passage, "en", "a", 1), (2, f"x {passage}", "en", "a", 1), (3, None, None, None, None), (4, "", "en", "a", 1),
        (5, sentence("r", 60), "en", "a", 1), (5, sentence("r", 60), "en", "a", 1), (6, long_text, "en", "a", 1),
        (7, "é😀 " + long_text, "en", "a", 1), (None, sentence("n", 60), "en", "a", 1), (8, "  \n", "en", "a", 1),
    ]
    docs = documents(spark, data, clashing)
    assert {r["doc_id"] for r in chunks.repeated_spans(docs).collect()} == {1, 2, 6, 7}
    left = chunks.deduplicated(docs)
    assert left.columns == docs.columns and left.count() == len(data)
    texts = {r["doc_id"]: r["text"] for r in left.collect()}
    assert texts[1] == passage and texts[6] == long_text and texts[3] is None
    assert len(texts[2]) < 100 and texts[7].startswith("é😀") and len(texts[7]) < 200


def test_every_repeated_chunk_keeps_one_copy(spark):
    """Copies that also hold a passage of an earlier document, and overlaps of different extent."""
    shared, own, other = sentence("shared", 80), sentence("own", 150), sentence("other", 90)
    copy = f"{own} {shared} {other}"
    data = [(3, f"{sentence(3, 50)} {shared}", "en", "a", 1), (100, copy, "en", "a", 1), (101, copy, "en", "a", 1)]
    data += [(102, f"{other} {sentence(102, 40)}", "en", "a", 1), (None, copy, "en", "a", 1)]
    # A few words of the copies recur in an earlier document by chance.
    data += [(2, f"{sentence(2, 30)} {' '.join(own.split()[60:75])} {sentence(22, 30)}", "en", "a", 1)]
    docs = documents(spark, data, clashing=True)
    texts = {d: t for d, t, *_ in data}
    gone = {}
    for r in chunks.repeated_spans(docs).where("NOT kept").collect():
        assert texts[r["doc_id"]][r["start"] : r["end"]] in texts[r["first_doc_id"]]
        gone.setdefault(r["doc_id"], []).append(r)
    left_somewhere, every = set(), set()
    for doc_id, text in texts.items():
        digests, ends, _ = chunks.chunks(text.encode())
        for digest, start, end in zip(digests.tolist(), [0, *ends.tolist()], ends.tolist()):
            every.add(digest)
            if not any(r["start"] < end and start < r["end"] for r in gone.get(doc_id, [])):
                left_somewhere.add(digest)
    assert left_somewhere == every
    left = {r["doc_id"]: r["text"] for r in chunks.deduplicated(docs).collect()}
    assert own in left[100] and shared in left[3] and other[50:] in left[100]
    assert len(left[101]) < 100 and len(left[None]) < 100 and len(left[102]) < len(texts[102]) - 400


def test_empty_table(spark):
    assert listed(chunks.repeated_spans(documents(spark, []))) == []
    assert listed(chunks.deduplicated(documents(spark, []))) == []
