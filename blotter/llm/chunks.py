"""Passages that repeat across documents, by content-defined chunks.

A gear hash rolls over the bytes of a text: h = 2h + gear[byte] in 16 bits, so it depends on the
last 16 bytes. A chunk ends where the hash is the smallest within ``REACH`` bytes on either side
(the first of equal ones). Such cuts depend on nothing but the bytes around them, so an
insertion moves no cut that is farther away, and copies of a passage are cut alike wherever they
stand. Chunks have more than ``REACH`` bytes and twice as many on average; where bytes repeat so that no
smallest exists, a chunk ends after ``LONGEST`` bytes. Cuts fall between characters.

Chunks are deduplicated by digest: those that occur in more than one document are found
by a grouping that is added up in the map tasks, so a passage that a third of all documents share
sends one row per task. Neighbouring repeated chunks make up a run, and those of a run that stay in
the same document a span. Single chunks hold a
few words that may recur by chance, so a run counts from ``MIN_WORDS`` words on; of a
passage of over 50 words only its ends, cut by the text around it, are missing. For the same reason 64
bits of digest are enough: a wrong span takes several collisions in a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from blotter.sources import stored

REACH = 16
LONGEST = 96
MIN_WORDS = 16

#: Two random bytes for each byte value.
GEAR = np.array(
    [int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=2).digest(), "little") for b in range(256)],
    dtype=np.uint16,
)
SPACES = np.isin(np.arange(256), list(b" \t\n\v\f\r"))


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte, by doubling the number of bytes it covers."""
    h = GEAR[data]
    for step in (1, 2, 4, 8):
        longer = h.copy()
        longer[step:] += h[:-step] << step
        h = longer
    return h


def cuts(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks of ``data`` (bytes); the last one is its length."""
    if not len(data):
        return np.zeros(0, dtype=np.int64)
    h = gear_hashes(data)
    edge = np.full(REACH, np.iinfo(np.uint16).max, dtype=np.uint16)
    low = np.concatenate([edge, h, edge])
    step = 1
    while step < REACH:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    n = len(h)
    # low[i] is the least of h[i - REACH : i]
    smallest = (h < low[:n]) & (h <= low[REACH + 1 : REACH + 1 + n])
    ends = np.append(np.flatnonzero(smallest) + 1, n)
    gaps = np.diff(ends, prepend=0)
    if gaps.max() > LONGEST:
        more = []
        for end, gap in zip(ends[gaps > LONGEST].tolist(), gaps[gaps > LONGEST].tolist()):
            at = end - gap
            while end - at > LONGEST:
                at += REACH + 1 + int(h[at + REACH : at + LONGEST].argmin())
                more.append(at)
        ends = np.append(ends, more)
    inside = (data & 0xC0) == 0x80
    while True:  # a cut inside a character moves to its end
        moved = (ends < n) & inside[np.minimum(ends, n - 1)]
        if not moved.any():
            return np.unique(ends)
        ends = ends + moved


def chunks(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per chunk: digest, end in code points, and words that begin before its end."""
    data = np.frombuffer(text, dtype=np.uint8)
    ends = cuts(data)
    begins = np.concatenate([[0], ends[:-1]])
    digests = np.array(
        [xxhash.xxh3_64_intdigest(text[a:b]) for a, b in zip(begins.tolist(), ends.tolist())], dtype=np.uint64
    )
    points = np.cumsum((data & 0xC0) != 0x80)
    word = ~SPACES[data]
    word[1:] &= SPACES[data[:-1]]
    words = np.cumsum(word)
    return digests.view(np.int64), points[ends - 1], words[ends - 1]


#: Stands for a missing doc_id while chunks are grouped, above all others.
NAMELESS = (1 << 63) - 1

CHUNKS = "digest long, doc_id long, text_hash long, place int, start int, end int, words int"


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts: list[list[np.ndarray]] = []
        sizes, held = [], 0
        for text in batch.column(2):
            digests, points, words = chunks(text.as_py() or b"")
            parts.append(
                [
                    digests,
                    np.arange(len(digests)),
                    np.concatenate([[0], points[:-1]]) if len(points) else points,
                    points,
                    np.diff(words, prepend=0),
                ]
            )
            sizes.append(len(digests))
            held += sizes[-1]
        if not held:
            continue
        digest, place, start, end, words = (np.concatenate(column) for column in zip(*parts))
        of = pa.array(np.repeat(np.arange(len(sizes)), sizes))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(digest, pa.int64()),
                batch.column(0).take(of),
                batch.column(1).take(of),
                pa.array(place, pa.int32()),
                pa.array(start, pa.int32()),
                pa.array(end, pa.int32()),
                pa.array(words, pa.int32()),
            ],
            names=["digest", "doc_id", "text_hash", "place", "start", "end", "words"],
        )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash (tells rows of one doc_id apart), start, end, n_words, first_doc_id, kept: one row per repeated span.

    Offsets count code points, the end is exclusive. Each repeated chunk stays in the smallest
    document that has it, so no text is lost, whatever stands beside it. A run of repeated chunks
    counts from ``MIN_WORDS`` words on and is split where that document changes; ``first_doc_id``
    names it, ``kept`` says that it is this one. Chunks that another document has first stay, too, and
    belong to the kept span, where fewer than ``MIN_WORDS`` words of them stand in a row beside own
    ones: cutting a few words that recur by chance would leave holes in the one copy. A document whose text shares nothing with others has no row, nor has null or empty
    text. Rows that share a doc_id are one document, so repeated rows are no repeats; rows
    without one are a document together. Other columns are not looked at.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.col("text").cast("binary").alias("text"),
    )
    every = rows.mapInArrow(_chunked, CHUNKS)
    named = F.coalesce("doc_id", F.lit(NAMELESS))
    repeated = (
        every.select("digest", named.alias("named"))
        .groupBy("digest")
        .agg(F.min("named").alias("first"), F.max("named").alias("last"))
        .where(F.col("first") != F.col("last"))
        .select("digest", "first")
    )
    found = every.join(repeated, "digest").drop("digest").distinct()
    row = ("doc_id", "text_hash")
    same = Window.partitionBy(*row, "first").orderBy("place")
    pieces = (
        found.withColumn("piece", F.col("place") - F.row_number().over(same))
        .groupBy(*row, "first", "piece")
        .agg(
            F.min("place").alias("place"),
            F.count("*").alias("n"),
            F.min("start").cast("long").alias("start"),
            F.max("end").cast("long").alias("end"),
            F.sum("words").alias("words"),
        )
        .withColumn("own", F.coalesce(F.col("doc_id") == F.col("first"), F.lit(False)))
        .withColumn("island", _run(*row))
        .withColumn("stretch", _run(*row, "own"))
        .withColumn("island_words", F.sum("words").over(Window.partitionBy(*row, "island")))
        .withColumn("stretch_words", F.sum("words").over(Window.partitionBy(*row, "own", "stretch")))
        .where(F.col("island_words") >= MIN_WORDS)
        .withColumn("kept", F.col("own") | (F.col("stretch_words") < MIN_WORDS))
        .withColumn("first_doc_id", F.when(F.col("kept"), F.col("doc_id")).otherwise(F.col("first")))
    )
    return (
        pieces.withColumn("span", _run(*row, "first_doc_id"))
        .groupBy(*row, "first_doc_id", "span")
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.sum("words").alias("n_words"),
            F.first("kept").alias("kept"),
        )
        .select(*row, "start", "end", "n_words", "first_doc_id", "kept")
    )


def _run(*keys: str) -> Column:
    """The same number for pieces that follow each other without a gap and agree in ``keys``."""
    ahead = Window.partitionBy(*keys).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return F.col("place") - F.coalesce(F.sum("n").over(ahead), F.lit(0))


@F.pandas_udf(StringType())
def _without(texts: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([without(text, listed) for text, listed in zip(texts, spans)], dtype="object")


def without(text: str | None, spans) -> str | None:
    """``text`` without the listed (start, end) spans."""
    if text is None or spans is None or not len(spans):
        return text
    out, at = [], 0
    for span in sorted(spans, key=lambda s: s["start"]):
        out.append(text[at : span["start"]])
        at = max(at, span["end"])
    return "".join([*out, text[at:]])


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with all repeated spans but the kept ones cut out of ``text``; ``n_chars`` follows."""
    spans = repeated_spans(docs).where(~F.col("kept"))
    spans = spans.groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).agg(
        F.collect_list(F.struct("start", "end")).alias("__spans")
    )
    spans = stored(spans, "repeated-spans")
    joined = docs.join(
        spans,
        docs["doc_id"].cast("long").eqNullSafe(spans["__id"]) & (F.xxhash64(docs["text"]) == spans["__hash"]),
        "left",
    ).withColumn("__text", _without("text", "__spans"))
    replaced = {"text": F.col("__text"), "n_chars": F.length("__text").cast("long")}
    return joined.select(
        *(replaced[name].alias(name) if name in replaced else F.col(name) for name in docs.columns)
    )
