"""Packed pieces against the tokenizer applied to whole texts."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from blotter.llm import mixing, packing
from blotter.llm.queries import tokenizer_file
from blotter.llm.words import word_count
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tables import documents, listed, rows, sentence
from tokenizers import Tokenizer

WINDOW = 2048


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_file())


def check(pieces, texts, tokenizer):
    """All tokens once, sequences without gaps and full but for the last."""
    wanted = Counter()
    for doc_id, text in texts:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        wanted[doc_id, len(ids), zlib.crc32(ids.tobytes())] += 1
    sequences = defaultdict(list)
    for piece in pieces:
        sequences[piece["sequence_id"]].append((piece["offset"], piece["length"]))
        assert piece["length"] > 0
    for number, parts in sequences.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == WINDOW or (number == max(sequences) and at < WINDOW)
    assert sorted(sequences) == list(range(len(sequences)))
    assert sum(p["length"] for p in pieces) == sum(n * count for (_, n, _), count in wanted.items())
    return wanted


def test_edge_cases(spark, tokenizer):
    pieces = packing.packed(documents(spark, clashing=True), tokenizer_file()).collect()
    check(pieces, [(r[0], r[1]) for r in rows()], tokenizer)
    # Pieces hold the ids they say they hold; of repeated rows the first fits as well.
    ids = {}
    for doc_id, text, *_ in rows():
        ids.setdefault(doc_id, set()).add(tuple(tokenizer.encode(text or "", add_special_tokens=False).ids + [1]))
    covered = defaultdict(Counter)
    for p in pieces:
        own = [np.array(x, dtype="<u4") for x in ids[p["doc_id"]] if len(x) == p["doc_tokens"]]
        end = p["start"] + p["length"]
        assert any(zlib.crc32(x[p["start"] : end].tobytes()) == p["ids_crc32"] for x in own)
        covered[p["doc_id"], p["doc_tokens"]].update(range(p["start"], end))
    copies = Counter((r[0], len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + 1) for r in rows())
    for key, places in covered.items():
        assert set(places.values()) == {copies[key]} and len(places) == key[1]


def test_windows_follow_the_shares(spark, tokenizer):
    """Each source is within one serving of its share wherever the stream is cut."""
    sizes = {"a": 300, "b": 90, "c": 30, None: 60}
    data = [
        (i, sentence((source, i), 400), "en", source, 1)
        for source, count in sizes.items()
        for i in range(1000 * ord((source or "z")[0]), 1000 * ord((source or "z")[0]) + count)
    ]
    pieces = packing.packed(documents(spark, data).repartition(5), tokenizer_file()).collect()
    check(pieces, [(r[0], r[1]) for r in data], tokenizer)
    source_of = {r[0]: r[3] for r in data}
    total = sum(p["length"] for p in pieces)
    share = Counter()
    for p in pieces:
        share[source_of[p["doc_id"]]] += p["length"] / total
    served, so_far = Counter(), 0
    tail = len(sizes) * packing.QUANTUM
    windows = defaultdict(list)
    for p in pieces:
        windows[p["sequence_id"]].append(p)
    for number in sorted(windows):
        for p in windows[number]:
            served[source_of[p["doc_id"]]] += p["length"]
            so_far += p["length"]
        if so_far < total - tail:
            for source in sizes:
                assert abs(served[source] - share[source] * so_far) <= 2 * packing.QUANTUM


@pytest.mark.parametrize("targets", [None, {f"s{i}": 1 + i % 3 for i in range(20)}])
def test_every_window_has_the_target_proportions(spark, tokenizer, targets):
    """Twenty sources, each of them in every window; queues that run out leave the others their proportions."""
    data = [(i, sentence(("mix", i), 300), "en", f"s{i % 20}", 1) for i in range(400)]
    data += [(1000 + i, sentence(("mix", i), 9), "en", f"tiny{i}", 1) for i in range(0 if targets else 3)]
    pieces = packing.packed(documents(spark, data).repartition(4), tokenizer_file(), targets).collect()
    check(pieces, [(r[0], r[1]) for r in data], tokenizer)
    source_of = {r[0]: r[3] for r in data}
    windows, left = defaultdict(Counter), Counter()
    for p in pieces:
        windows[p["sequence_id"]][source_of[p["doc_id"]]] += p["length"]
        left[source_of[p["doc_id"]]] += p["length"]
    weights = targets or dict(left)
    for number in range(max(windows)):
        lasting = {source: weights[source] for source in weights if left[source] > windows[number][source]}
        spent = sum(windows[number][source] for source in weights if source not in lasting)
        for source, weight in lasting.items():
            due = (WINDOW - spent) * weight / sum(lasting.values())
            # One token for rounding and one for the deficits of the others, where no queue ends.
            slack = 2 if not spent else WINDOW
            assert abs(windows[number][source] - due) <= slack
        left.subtract(windows[number])
    assert sum(len(w) >= 20 for w in windows.values()) > len(windows) / 3
    if targets:
        with pytest.raises(ValueError):
            packing.packed(documents(spark, data), tokenizer_file(), {"s0": 1})


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9000), st.floats(0.01, 100)), min_size=1, max_size=40), st.booleans())
def test_windows_cut_every_queue_once(queues, own):
    sizes = np.array([size for size, _ in queues])
    weights = sizes.astype(float) if own else np.array([weight for _, weight in queues])
    found = packing.Windows(sizes, weights)
    begins = found.begins(np.arange(found.last + 2))
    assert (np.diff(begins, axis=0) >= 0).all() and (begins[0] == 0).all() and (begins[-1] == sizes).all()
    assert (np.diff(begins.sum(axis=1))[:-1] == WINDOW).all()
    for place, size in enumerate(sizes.tolist()):
        positions = np.arange(size)
        first, last = found.around(np.full(size, place), positions)
        window = np.searchsorted(begins[:, place], positions, side="right") - 1
        assert (first <= window).all() and (window <= last).all()


def test_empty_table(spark):
    assert packing.packed(documents(spark, []), tokenizer_file()).count() == 0


TOKENIZER = Tokenizer.from_file(tokenizer_file())
PIECES = st.sampled_from(
    ["The", "été", "É", "STRAßE", "ﬁ", "İ", "Σς", "e\u0301", "'s", "'S", "'", ".", ",", "!?", "...", " ", "\n", "\xa0", "\x1c",
     "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "12", "²", "ª", "µ", "ŉ", "中文", "😀", "_", "-", "x", "THE", "\u0300"]
)


@settings(max_examples=3000, deadline=None)
@given(st.lists(PIECES, max_size=10).map("".join) | st.text(st.characters(exclude_categories=["Cs"]), max_size=30))
def test_ids_of_words_add_up_to_those_of_texts(text):
    whole = TOKENIZER.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.WordIds(TOKENIZER).of_text(text.encode()), "<u2").tolist() == whole


def test_full_tables_start_anew(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_WORDS", 3)
    text = sentence("words", 200)
    whole = TOKENIZER.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.WordIds(TOKENIZER).of_text(text.encode()), "<u2").tolist() == whole


def test_mix_gives_the_words_it_promises(spark):
    docs = documents(spark, clashing=True)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    words = F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    by_source = lambda df, n: {r[0]: r[1] for r in df.groupBy("source").agg(F.sum(n)).collect() if r[1]}
    plan = mixing.mixed(docs, word_count(F.col("text")), mixing.order_key())
    assert by_source(mixed, words) == by_source(plan, F.col("__mix_taken"))
    assert mixed.where("n_chars <> length(text)").count() == 0
    originals = {(r[0], r[1]) for r in docs.select("doc_id", "text").collect()}
    for row in mixed.select("doc_id", "text").collect():
        assert any(row[0] == d and t is not None and t.startswith(row[1]) for d, t in originals)


def test_ids_do_not_crowd_a_range(spark):
    """Documents without an id, or with one and the same, lie in as many ranges as others."""
    data = [(None if i % 2 else 7, sentence(("crowd", i), 3), "en", "a", 1) for i in range(3 * mixing.RANGE)]
    docs = documents(spark, data)
    result = mixing.mixed(docs, word_count(F.col("text")), mixing.order_key())
    sizes = [r["count"] for r in result.groupBy("__mix_range").count().collect()]
    assert sum(sizes) == len(data) and len(sizes) == 16 and max(sizes) < mixing.RANGE


def test_mix_is_the_same_again(spark):
    docs = documents(spark)
    again = docs.repartition(7, "text")
    assert listed(mixing.mix_report(docs)) == listed(mixing.mix_report(again))
    assert listed(mixing.mix(docs)) == listed(mixing.mix(again))
