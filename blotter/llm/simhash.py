"""Near-duplicate documents by SimHash and anchor points.

Two fingerprints link if they differ in at most ``DISTANCE`` = 3 of 64 bits, so in the lower or
the upper half they differ in at most 1. Each half has its own anchors: the codewords of
the [31, 26] Hamming code over 31 of its 32 bits. That code covers every word within
radius 1. A fingerprint is at home at the one anchor within the covering radius, and is
copied to every anchor within covering radius plus the threshold of the half, 1 + 1 = 2: one
anchor if it is a codeword, else 16. If x and y link, then in some half y lies within 2 of
the home of x, so they meet there. There are 2**26 anchors a half, so the 32 copies
are the price for comparing next to nothing by chance.

At each anchor the fingerprints at home are compared with all that are copied to it. Only
a spanning part of the links found at an anchor is passed on, never all pairs of a group. The
fingerprints at home at a crowded anchor are dealt into blocks of about ``BLOCK``; each block
sees all copies, a batch at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from blotter.llm.components import components
from blotter.sources import stored

DISTANCE = 3
SHINGLE = 3
SEED = 42
BLOCK = 2048
#: Words of a text that are hashed at a time.
STRIDE = 1 << 16
#: Pairs of a small group that are compared in one go with other groups.
SMALL = 256


def fingerprint(text: Column) -> Column:
    """The 64 bits as a long. Null and texts without a word give 0."""
    return _fingerprint(text.cast("binary"))


@F.pandas_udf(LongType())
def _fingerprint(texts: pd.Series) -> pd.Series:
    return pd.Series([simhash(t) for t in texts], dtype="int64")


def simhash(text: bytes | None) -> int:
    """bytes.lower and bytes.split touch A-Z and the six ASCII spaces only, as asked for."""
    words = text.lower().split() if text else []
    total = max(len(words) - SHINGLE + 1, min(len(words), 1))
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, total, STRIDE):
        part = words[start : start + STRIDE + SHINGLE - 1]
        if len(part) < SHINGLE:
            shingles = [b" ".join(part)]
        else:
            shingles = map(b" ".join, zip(part, part[1:], part[2:]))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits((2 * ones > total).astype(np.uint8), bitorder="little")
    return int(packed.view("<i8")[0])


def links(prints: DataFrame) -> DataFrame:
    """a, b: links between the distinct values of ``fp`` that connect all that link."""
    distinct = stored(prints.select("fp").where(F.col("fp").isNotNull()).distinct(), "prints")
    home = distinct.select("fp", F.explode(F.array(*_homes())).alias("anchor"))
    crowded = (
        home.groupBy("anchor")
        .agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        .where(F.col("blocks") > 1)
    )
    crowded = stored(crowded, "crowded")
    copies = distinct.select("fp", F.explode(F.concat(*_reached())).alias("anchor"))
    blocks = F.coalesce(F.col("blocks"), F.lit(1))
    home = home.join(crowded, "anchor", "left").select(
        "anchor", "fp", F.lit(0).alias("role"), F.pmod(F.xxhash64("fp"), blocks).cast("int").alias("block")
    )
    copies = copies.join(crowded, "anchor", "left").select(
        "anchor", "fp", F.lit(1).alias("role"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block")
    )
    rows = home.unionByName(copies).repartition("anchor", "block")
    rows = rows.sortWithinPartitions("anchor", "block", "role")
    return rows.select("anchor", "block", "fp", "role").mapInArrow(_compared, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, fp, component_id, root for every row of ``docs``.

    ``component_id`` is the smallest doc_id that can be reached over links, null if none of
    them has one. Components may share it, if ids are missing or used twice; ``root``, the smallest
    fingerprint of the component, tells them apart. Null text is as empty text: fingerprint 0, linked like any other. Rows
    that are repeated come back as often; other columns are not looked at.
    """
    prints = stored(
        docs.select(
            "doc_id", F.xxhash64("text").alias("text_hash"), fingerprint(F.col("text")).alias("fp")
        ),
        "fingerprints",
    )
    found = components(links(prints)).withColumnRenamed("node", "fp")
    # One row per fingerprint before anything is joined; copies travel only once, at the end.
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = least.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    names = rooted.join(named, "root").select("fp", "component_id", "root")
    return prints.join(names, "fp")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, the one with the smallest doc_id, with all its columns.

    Missing or repeated doc_ids make no component of texts that do not link.
    Of rows with the same doc_id the one with the smallest text hash stays, of rows that
    are the same in both any one.
    """
    same = F.struct("doc_id", "text_hash")
    kept = (
        near_duplicates(docs)
        .groupBy("root")
        .agg(F.min(F.when(F.col("doc_id").eqNullSafe(F.col("component_id")), same)).alias("k"))
        .select(F.col("k.doc_id").alias("__id"), F.col("k.text_hash").alias("__hash"))
    )
    hashed = docs.withColumns({"__id": F.col("doc_id"), "__hash": F.xxhash64("text")})
    joined = hashed.join(
        kept.withColumnsRenamed({"__id": "__kept_id", "__hash": "__kept_hash"}),
        F.col("__id").eqNullSafe(F.col("__kept_id")) & (F.col("__hash") == F.col("__kept_hash")),
        "left_semi",
    )
    return joined.dropDuplicates(["__id", "__hash"]).select(*docs.columns)


def _half(upper: bool) -> Column:
    """31 bits of a half."""
    half = F.shiftrightunsigned("fp", 32) if upper else F.col("fp")
    return half.bitwiseAND(F.lit(0x7FFFFFFF).cast("long"))


def _syndrome(half: Column) -> Column:
    """0 for a codeword, else the place (1 to 31) of the bit whose flip gives one."""
    total = F.lit(0)
    for k in range(5):
        mask = sum(1 << (place - 1) for place in range(1, 32) if place >> k & 1)
        total = total + F.bit_count(half.bitwiseAND(F.lit(mask).cast("long"))).bitwiseAND(F.lit(1)) * (1 << k)
    return total


def _flip(place: Column) -> Column:
    """The word with one bit at ``place``; none for 0."""
    one = F.call_function("shiftleft", F.lit(1).cast("long"), place - 1)
    return F.when(place > 0, one).otherwise(F.lit(0).cast("long"))


def _named(code: Column, upper: bool) -> Column:
    """Anchors of both halves as different numbers."""
    return code + F.lit((1 << 32) if upper else 0).cast("long")


def _homes() -> list[Column]:
    return [
        _named(_half(upper).bitwiseXOR(_flip(_syndrome(_half(upper)))), upper)
        for upper in (False, True)
    ]


def _reached() -> list[Column]:
    return [_within_two(upper) for upper in (False, True)]


def _within_two(upper: bool) -> Column:
    """The anchors within 2 of a half: home, and for each pair of places with place XOR
    other = syndrome the word with both flipped."""
    half = _half(upper)

    def pair(row: Column, place: Column) -> Column:
        other = place.bitwiseXOR(row["s"])
        return _named(row["h"].bitwiseXOR(_flip(place)).bitwiseXOR(_flip(other)), upper)

    def anchors(row: Column) -> Column:
        places = F.filter(
            F.sequence(F.lit(1), F.lit(31)),
            lambda i: (row["s"] > 0) & (i < i.bitwiseXOR(row["s"])) & (i != row["s"]),
        )
        home = _named(row["h"].bitwiseXOR(_flip(row["s"])), upper)
        return F.concat(F.array(home), F.transform(places, lambda i: pair(row, i)))

    # As fields of an array element, half and syndrome are worked out once a row.
    row = F.struct(half.alias("h"), _syndrome(half).alias("s"))
    return F.flatten(F.transform(F.array(row), anchors))


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group, those at home first. A group may run over many batches."""
    homes, last = _Homes(), None
    for batch in batches:
        anchor, block, fp, role = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        fp = fp.view(np.uint64)
        starts = np.flatnonzero(
            np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (block[1:] != block[:-1])))
        )
        ends = np.append(starts[1:], len(fp))
        at_home = np.add.reduceat(1 - role.astype(np.int64), starts)
        copied = ends - starts - at_home
        found = []
        # Groups that lie in this batch and are small are compared together.
        inner = np.ones(len(starts), dtype=bool)
        inner[0] = inner[-1] = False
        small = inner & (at_home > 0) & (at_home * copied <= SMALL)
        found += _pairs(fp, starts[small], at_home[small], copied[small])
        for g in np.flatnonzero((~inner | (at_home * copied > SMALL)) & ((at_home > 0) | ~inner)):
            key = (anchor[starts[g]], block[starts[g]])
            if key != last:
                homes, last = _Homes(), key
            middle = starts[g] + at_home[g]
            homes.add(fp[starts[g] : middle])
            found += homes.linked(fp[middle : ends[g]])
        if found:
            a = np.concatenate([x for x, _ in found]).view(np.int64)
            b = np.concatenate([y for _, y in found]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _pairs(fp, starts, at_home, copied) -> list[tuple[np.ndarray, np.ndarray]]:
    size = at_home * copied
    if not size.sum():
        return []
    group = np.repeat(np.arange(len(size)), size)
    within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    x = fp[starts[group] + within // copied[group]]
    y = fp[(starts + at_home)[group] + within % copied[group]]
    near = (x != y) & (np.bitwise_count(x ^ y) <= DISTANCE)
    return [(x[near], y[near])]


class _Homes:
    """The fingerprints at home at one anchor, and which of them are known to be connected."""

    def __init__(self) -> None:
        self.prints = np.empty(0, dtype=np.uint64)
        self.root = np.empty(0, dtype=np.int64)

    def add(self, prints: np.ndarray) -> None:
        count = len(self.prints)
        self.prints = np.concatenate([self.prints, prints])
        self.root = np.concatenate([self.root, np.arange(count, count + len(prints))])

    def linked(self, copies: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """A link from each copy to one fingerprint at home, and links that join those it touches."""
        found = []
        if not len(self.prints):
            return found
        for start in range(0, len(copies), 4096):
            part = copies[start : start + 4096]
            gap = self.prints[None, :] ^ part[:, None]
            near = (np.bitwise_count(gap) <= DISTANCE) & (gap != 0)
            rows = np.flatnonzero(near.any(axis=1))
            if not len(rows):
                continue
            first = near[rows].argmax(axis=1)
            found.append((part[rows], self.prints[first]))
            for row in rows:
                met = np.flatnonzero(near[row])
                roots = np.unique(self.root[met])
                if len(roots) > 1:
                    of = [met[np.argmax(self.root[met] == r)] for r in roots]
                    ends = self.prints[of]
                    found.append((np.full(len(of) - 1, ends[0]), ends[1:]))
                    self.root[np.isin(self.root, roots)] = roots[0]
        return found
