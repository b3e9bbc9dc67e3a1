r"""Personal data: four fixed kinds, and identifiers found by the words before them.

The fixed kinds (email, ip, card, phone) are the seeds. Each seed says which words stand before
an identifier: the last one, and the last two. Such a context is a pattern. Patterns
and instances (identifier-like tokens: at least ``MIN_LENGTH`` characters with
``MIN_DIGITS`` digits) form a graph that Spark scores in rounds:

* pattern: the share of all its occurrences in the corpus that are followed by a known
  instance, weighed with the instance's score. It needs ``MIN_SUPPORT`` different known
  instances and a share of ``MIN_CONFIDENCE``;
* instance: 1 for a seed, else 1 - product(1 - share) over its accepted patterns.

A token whose score reaches ``MIN_SCORE`` and that stands behind an accepted pattern becomes a
span of the kind most known instances of that pattern have. Occurrences of a context are
counted over all texts, also where no identifier follows, so words such as "the" never
pass. The texts are read for seeds and tokens, then to count the contexts that seeds have suggested,
and again in each round in which newly found instances suggest contexts not yet counted: a context may
become a pattern that no seed ever follows. Its kind comes with the instances. What a pass may
count is told to the tasks as a bitmap of fixed size; a context that only shares a bit is
dropped by the join that follows.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from blotter.sources import stored

# The kinds in the order in which spans at the same place are listed.
KINDS = ("email", "ip", "card", "phone")

MIN_LENGTH = 6
MIN_DIGITS = 4
MIN_SUPPORT = 5
MIN_CONFIDENCE = 0.5
MIN_SCORE = 0.5
#: Rounds at least; they go on while they find anything new.
ROUNDS = 3
#: Size of the bitmap of suggested contexts: 2**BITMAP_BITS bits, 4 MB.
BITMAP_BITS = 25
#: Contexts that one bitmap row stands for when the bitmap is put together.
BITMAP_ROW = 1 << 12

# The patterns of the four kinds.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# The lookbehind and the possessive digits change no match: a start inside a group of digits fails
# wherever the start of the group has failed. They keep long runs of digits linear.
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = "\"'`.,;:!?()[]{}<>|#$%&*"
EDGE_BYTES = EDGE.encode()
#: Odd numbers that spread the hashes of two words over 63 bits.
MIX_LAST, MIX_BEFORE, MASK = 0xC2B2AE3D27D4EB4F, 0x9E3779B97F4A7C15, (1 << 64) - 1
#: Words whose hashes a task keeps.
KNOWN_WORDS = 200_000

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of the four kinds, sorted; kinds are numbered as in ``KINDS``."""
    found: list[Span] = []
    at, free = text.find("@"), 0
    while at >= 0:
        # The leftmost match before an @ begins with the run of characters that touches it.
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            found.append((start, 0, match.end()))
            free = match.end()
        at = text.find("@", max(at + 1, free))
    if not any(digit in text for digit in "0123456789"):
        return found
    for m in IP.finditer(text):
        parts = [part.lstrip("0") or "0" for part in m[0].split(".")]
        if all(len(part) <= 3 and int(part) <= 255 for part in parts):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and _luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _word_hash(word: bytes) -> int:
    """The same for a word with and without punctuation around it, in either case (A-Z)."""
    return zlib.crc32(word.strip(EDGE_BYTES).lower())


class _Hashes(dict):
    """Hashes of the words met so far; starts anew at ``KNOWN_WORDS``."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > KNOWN_WORDS:
            self.clear()
        self[word] = found = _word_hash(word)
        return found


def _contexts(second: int | None, first: int | None) -> list[int]:
    """Keys of the last word, and of the last two, before a place."""
    if first is None:
        return []
    last = (first * MIX_LAST & MASK) >> 1
    return [last] if second is None else [last, ((second + 1) * MIX_BEFORE + first * MIX_LAST & MASK) >> 1]


def scanned(text: str) -> tuple[list[Span], list[tuple]]:
    """The base spans; and (start, end, kind, instance, contexts) of seeds and other tokens."""
    base = base_spans(text)
    if not base and not any(digit in text for digit in "0123456789"):
        return base, []
    places = [(start, end, kind) for start, kind, end in base]
    tokens = [(m.start(), m.end()) for m in TOKEN.finditer(text)]
    taken = iter(sorted((start, end) for start, end, _ in places))
    current = next(taken, None)
    for start, end in tokens:
        word = text[start:end]
        digits = sum(word.count(d) for d in "0123456789")
        if digits < MIN_DIGITS:
            continue
        while start < end and text[start] in EDGE:
            start += 1
        while end > start and text[end - 1] in EDGE:
            end -= 1
        while current and current[1] <= start:
            current = next(taken, None)
        if end - start >= MIN_LENGTH and not (current and current[0] < end):
            places.append((start, end, None))
    starts = np.array([s for s, _ in tokens])
    seen = []
    for start, end, kind in places:
        # The token that holds the place, and the two before it.
        own = int(np.searchsorted(starts, start, side="right")) - 1
        before = [_word_hash(text[slice(*tokens[i])].encode(errors="replace")) for i in (own - 2, own - 1) if i >= 0]
        second, first = [None] * (2 - len(before)) + before
        instance = int.from_bytes(
            hashlib.blake2b(text[start:end].encode(errors="replace"), digest_size=8).digest(), "little", signed=True
        )
        seen.append((start, end, kind, instance, _contexts(second, first)))
    return base, seen


SCANNED = (
    "doc_id long, text_hash long, part int, row long, counts array<long>, base string, base_sha256 string, "
    "seen array<struct<start: long, end: long, kind: int, instance: long, contexts: array<long>>>"
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, row = TaskContext.get().partitionId(), 0
    seen_type = pa.list_(
        pa.struct(
            [
                ("start", pa.int64()),
                ("end", pa.int64()),
                ("kind", pa.int32()),
                ("instance", pa.int64()),
                ("contexts", pa.list_(pa.int64())),
            ]
        )
    )
    for batch in batches:
        counts, bases, digests, seen = [], [], [], []
        for text in batch.column(2):
            base, places = scanned((text.as_py() or b"").decode(errors="replace"))
            kinds = Counter(kind for _, kind, _ in base)
            listed = ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in base)
            counts.append([kinds[k] for k in range(len(KINDS))])
            bases.append(listed)
            digests.append(hashlib.sha256(listed.encode()).hexdigest())
            seen.append([dict(zip(("start", "end", "kind", "instance", "contexts"), p)) for p in places])
        size = len(bases)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array([part] * size, pa.int32()),
                pa.array(range(row, row + size), pa.int64()),
                pa.array(counts, pa.list_(pa.int64())),
                pa.array(bases, pa.string()),
                pa.array(digests, pa.string()),
                pa.array(seen, seen_type),
            ],
            names=["doc_id", "text_hash", "part", "row", "counts", "base", "base_sha256", "seen"],
        )
        row += size


def found_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The scanned documents, one row each, and the spans that patterns add to them.

    The second table has part, row (which name a row of the first), start, end, kind.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.col("text").cast("binary").alias("text"),
    )
    scan = stored(rows.mapInArrow(_scan, SCANNED), "pii-scan")
    places = scan.select("part", "row", F.explode("seen").alias("at")).select("part", "row", "at.*")
    edges = stored(
        places.select("instance", "kind", F.explode("contexts").alias("context"))
        .groupBy("context", "instance", "kind")
        .agg(F.count("*").alias("n")),
        "pii-graph",
    )
    patterns = _patterns(docs, edges)
    new = places.where("kind IS NULL").withColumn("context", F.explode("contexts"))
    spans = (
        new.drop("kind")
        .join(patterns, "context")
        .groupBy("part", "row", "start", "end")
        .agg(
            (1 - F.exp(F.sum(F.log1p(-F.least("share", F.lit(0.999999)))))).alias("score"),
            F.max(F.struct("share", "kind")).alias("best"),
        )
        .where(F.col("score") >= MIN_SCORE)
        .select("part", "row", "start", "end", F.col("best.kind").alias("kind"))
    )
    return scan, spans


def _known(found: DataFrame) -> DataFrame:
    """instance, score, kind: each instance once, with its best score and the kind that goes with it."""
    best = found.groupBy("instance").agg(F.max(F.struct("score", "kind")).alias("best"))
    return stored(best.select("instance", "best.score", "best.kind"), "pii-known")


def _suggested(edges: DataFrame, known: DataFrame) -> DataFrame:
    """Contexts with enough different known instances behind them."""
    return (
        edges.join(known.select("instance"), "instance")
        .groupBy("context")
        .agg(F.count_distinct("instance").alias("support"))
        .where(F.col("support") >= MIN_SUPPORT)
        .select("context")
    )


def _context_totals(docs: DataFrame, contexts: DataFrame) -> DataFrame:
    """context, total: how often each of ``contexts`` occurs in all texts."""
    bits = 1 << BITMAP_BITS
    suggested = stored(
        contexts.select("context", F.pmod("context", F.lit(bits)).alias("bit")), "pii-suggested"
    )
    # 2**BITMAP_BITS bits at most, however many contexts there are.
    marks = suggested.groupBy(F.floor(F.col("bit") / BITMAP_ROW).alias("of")).agg(
        F.collect_set((F.col("bit") % BITMAP_ROW).cast("int")).alias("bits")
    )
    bitmap = np.zeros(bits // 8, dtype=np.uint8)
    for mark in marks.collect():
        places = mark["of"] * BITMAP_ROW + np.array(mark["bits"], dtype=np.int64)
        np.bitwise_or.at(bitmap, places >> 3, (1 << (places & 7)).astype(np.uint8))
    sent = docs.sparkSession.sparkContext.broadcast(bitmap)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, hashes = sent.value, _Hashes()
        for batch in batches:
            found = []
            for text in batch.column(0):
                words = (text.as_py() or b"").split()
                if not words:
                    continue
                first = np.fromiter(map(hashes.__getitem__, words), dtype=np.int64, count=len(words))
                last = first.astype(np.uint64) * np.uint64(MIX_LAST)
                before = (first[:-1].astype(np.uint64) + np.uint64(1)) * np.uint64(MIX_BEFORE)
                for keys in (last, last[1:] + before):
                    keys = (keys >> np.uint64(1)).astype(np.int64)
                    bit = keys % bits
                    found.append(keys[(wanted[bit >> 3] >> (bit & 7)) & 1 == 1])
            if found:
                keys, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["context", "n"])

    texts = docs.select(F.col("text").cast("binary").alias("text"))
    counted = texts.mapInArrow(count, "context long, n long")
    counted = counted.groupBy("context").agg(F.sum("n").alias("total"))
    return stored(counted.join(suggested.select("context"), "context"), "pii-totals")


def _patterns(docs: DataFrame, edges: DataFrame) -> DataFrame:
    """context, share, kind of the accepted patterns.

    Each round, contexts that the instances known by then suggest for the first time are
    counted in all texts. Rounds end when, after ``ROUNDS`` of them, one has brought no new context,
    pattern or instance, or earlier if no pattern passes.
    """
    seeds = edges.where("kind IS NOT NULL").select("instance", F.lit(1.0).alias("score"), "kind").distinct()
    known, totals, before = _known(seeds), None, None
    for number in itertools.count(1):
        fresh = _suggested(edges, known)
        if totals is not None:
            fresh = fresh.join(totals, "context", "left_anti")
        fresh = stored(fresh, "pii-fresh")
        news = not fresh.isEmpty()
        if totals is None:
            totals = _context_totals(docs, fresh)
        elif news:
            totals = totals.unionByName(_context_totals(docs, fresh))
        scored = edges.join(known.withColumnRenamed("kind", "known_kind"), "instance")
        patterns = (
            scored.groupBy("context")
            .agg(
                F.sum(F.col("n") * F.col("score")).alias("hits"),
                F.count_distinct("instance").alias("support"),
                F.mode(F.coalesce("kind", "known_kind"), deterministic=True).alias("kind"),
            )
            .where(F.col("support") >= MIN_SUPPORT)
            .join(totals, "context")
            .select("context", F.least(F.col("hits") / F.col("total"), F.lit(1.0)).alias("share"), "kind")
            .where((F.col("share") >= MIN_CONFIDENCE) & F.col("kind").isNotNull())
        )
        patterns = stored(patterns, "pii-patterns")
        passed = patterns.count()
        if not passed:
            break
        reached = (
            edges.drop("kind")
            .join(patterns, "context")
            .groupBy("instance")
            .agg(
                (1 - F.exp(F.sum(F.log1p(-F.least("share", F.lit(0.999999)))))).alias("score"),
                F.max(F.struct("share", "kind")).alias("best"),
            )
            .where(F.col("score") >= MIN_SCORE)
            .select("instance", "score", F.col("best.kind").alias("kind"))
        )
        known = _known(seeds.unionByName(reached))
        after = (passed, known.count())
        if number >= ROUNDS and not news and after == before:
            break
        before = after
    return patterns


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found per row.

    Null text is as empty text: no spans. Repeated rows come back as often. ``spans`` lists
    base and found spans as kind:start:end; found spans never touch a base span.
    """
    scan, found = found_spans(docs)
    kind = F.array(*map(F.lit, KINDS))
    part = F.struct("start", "kind", "end")
    added = found.groupBy("part", "row").agg(F.collect_list(part).alias("added"))
    joined = scan.select("doc_id", "text_hash", "part", "row", "counts", "base", "base_sha256", "seen").join(
        added, ["part", "row"], "left"
    )
    base = F.transform(
        F.filter("seen", lambda s: s["kind"].isNotNull()),
        lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")),
    )
    whole = F.transform(
        F.sort_array(F.concat(base, F.col("added"))),
        lambda s: F.concat_ws(":", F.get(kind, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
    )
    return joined.select(
        "doc_id",
        "text_hash",
        *(F.col("counts")[i].alias(f"n_{name}") for i, name in enumerate(KINDS)),
        "base_sha256",
        F.when(F.col("added").isNull(), F.col("base")).otherwise(F.array_join(whole, ",")).alias("spans"),
        F.coalesce(F.size("added"), F.lit(0)).cast("long").alias("n_found"),
    )


@F.pandas_udf(StringType())
def _masked(texts: pd.Series, added: pd.Series) -> pd.Series:
    return pd.Series([mask(text, more) for text, more in zip(texts, added)], dtype="object")


def mask(text: str | None, added: str | None = None) -> str | None:
    """``text`` with each span replaced by its kind, as in ``<email>``.

    Spans are those of the fixed kinds and those listed in ``added``. Of spans that overlap, the
    name of the first stands for all.
    """
    if text is None:
        return None
    spans = base_spans(text)
    if added:
        more = (item.split(":") for item in added.split(","))
        spans = sorted(spans + [(int(start), KINDS.index(kind), int(end)) for kind, start, end in more])
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind]}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by the name of its kind; ``n_chars`` follows.

    Only spans that patterns have added are joined, once for each pair of doc_id and text; the
    fixed kinds are found again where the text is. The table of added spans is stored, so
    Spark knows its size and decides by it how to join.
    """
    added = (
        personal_data(docs)
        .where("n_found > 0")
        .groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
        .agg(F.max("spans").alias("__spans"))
    )
    added = stored(added, "pii-added")
    joined = docs.join(
        added,
        docs["doc_id"].cast("long").eqNullSafe(added["__id"]) & (F.xxhash64(docs["text"]) == added["__hash"]),
        "left",
    ).withColumn("__text", _masked("text", "__spans"))
    replaced = {"text": F.col("__text"), "n_chars": F.length("__text").cast("long")}
    return joined.select(
        *(replaced[name].alias(name) if name in replaced else F.col(name) for name in docs.columns)
    )
