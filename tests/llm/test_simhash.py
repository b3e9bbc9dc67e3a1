"""Fingerprints and components against comparing everything with everything."""

import random

import pytest
import xxhash
from blotter.llm import simhash
from blotter.llm.components import components
from pyspark.sql import functions as F
from tables import documents, listed, rows, sentence


def by_hand(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def grouped(prints):
    """Smallest doc_id reachable over links of at most three bits."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(prints):
        for j, (_, b) in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(prints):
        r = find(i)
        least[r] = min((x for x in (least.get(r), doc_id) if x is not None), default=None)
    return [least[find(i)] for i in range(len(prints))]


@pytest.mark.parametrize("clashing", [False, True])
def test_documents(spark, clashing):
    found = simhash.near_duplicates(documents(spark, clashing=clashing))
    prints = [(doc_id, by_hand(text)) for doc_id, text, *_ in rows()]
    signed = lambda fp: fp - (1 << 64) if fp >> 63 else fp
    expected = [(d, signed(fp), c) for (d, fp), c in zip(prints, grouped(prints))]
    assert listed(found.select("doc_id", "fp", "component_id")) == listed(
        spark.createDataFrame(expected, "d long, fp long, c long")
    )


@pytest.mark.parametrize("block", [2048, 7])
def test_fingerprints_in_dense_clusters(spark, block, monkeypatch):
    """Clusters around random centres, chains of single flips, and all bits at the edges of halves."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    dice = random.Random(block)
    prints = {0, (1 << 64) - 1}
    for _ in range(12):
        centre = dice.getrandbits(64)
        for _ in range(60):
            prints.add(centre ^ sum(1 << bit for bit in dice.sample(range(64), dice.randint(0, 4))))
    chain = dice.getrandbits(64)
    for bit in dice.sample(range(64), 40):
        prints.add(chain)
        chain ^= sum(1 << b for b in {bit, (bit + 31) % 64, (bit + 32) % 64})
    ordered = sorted(prints)
    signed = [fp - (1 << 64) if fp >> 63 else fp for fp in ordered]
    table = spark.createDataFrame([(fp,) for fp in signed], "fp long")
    found = dict((r["node"], r["root"]) for r in components(simhash.links(table)).collect())
    groups = grouped(list(zip(signed, ordered)))
    assert [found.get(fp, fp) for fp in signed] == groups


def test_all_links_meet_at_an_anchor(spark):
    """Every pattern of up to three flips, around words that are codewords in either half or not."""
    dice = random.Random(5)
    pairs = []
    for _ in range(400):
        x = dice.getrandbits(64)
        pairs.append((x, x ^ sum(1 << bit for bit in dice.sample(range(64), 3))))
    signed = [tuple(v - (1 << 64) if v >> 63 else v for v in pair) for pair in pairs]
    table = spark.createDataFrame([(i, *pair) for i, pair in enumerate(signed)], "i long, x long, y long")
    home = table.select("i", F.col("x").alias("fp")).select("i", F.explode(F.array(*simhash._homes())).alias("a"))
    copy = table.select("i", F.col("y").alias("fp")).select("i", F.explode(F.concat(*simhash._reached())).alias("a"))
    assert home.join(copy, ["i", "a"]).select("i").distinct().count() == len(pairs)


def test_one_of_each_stays(spark):
    kept = simhash.keep_one(documents(spark, clashing=True))
    assert kept.columns == documents(spark, clashing=True).columns
    components_of = dict(
        ((r["doc_id"], r["text_hash"]), r["component_id"])
        for r in simhash.near_duplicates(documents(spark)).collect()
    )
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert sorted(ids) == sorted(set(components_of.values()))


def test_ids_do_not_join_different_texts(spark):
    """Null ids, and an id that stands for different texts: one row of each text stays."""
    texts = [sentence(("ids", i), 60) for i in range(6)]
    data = [(None, texts[0]), (None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (8, texts[3])]
    data += [(None, texts[4]), (9, texts[4]), (7, texts[5]), (7, texts[5])]
    docs = documents(spark, [(d, t, "en", "a", 1) for d, t in data], clashing=True)
    kept = [(r["doc_id"], r["text"]) for r in simhash.keep_one(docs).select("doc_id", "text").collect()]
    expected = [(None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (9, texts[4]), (7, texts[5])]
    assert sorted(kept, key=str) == sorted(expected, key=str)
    roots = {(r["text_hash"], r["root"]) for r in simhash.near_duplicates(docs).collect()}
    assert len(roots) == len({root for _, root in roots}) == len(texts)


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1001 + i) for i in range(100)] + [(5000, 5000)]
    found = dict((r["node"], r["root"]) for r in components(spark.createDataFrame(links, "a long, b long")).collect())
    assert found == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(101)}}


def test_empty_table(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    assert simhash.keep_one(documents(spark, [])).count() == 0
