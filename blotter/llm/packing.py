"""Mixture-controlled packing: deficit round-robin over the queues of the sources, token by token.

The tokens of a source form a queue, and every source has a target weight: its own tokens, if none
is given. The next token is always that of the source that is furthest behind its target: token j
of a source with weight p is due at (j + 1/2) / p, and the stream is in the order of the due times.
Window w holds tokens ``WINDOW`` * w up to ``WINDOW`` * (w + 1) of it, gathered by source.
So each window meets the target proportions as far as whole tokens go, and what a
window could not give is the deficit that the next ones make up for. A queue that has run out drops
out, and the others go on in proportion to their weights.

All this needs no walk over the windows. Up to time y a source has given floor(p * y + 1/2) tokens, or all
it has; the time at which this adds up to a window's first token is found by bisection, for any
window on its own, from the sizes of the queues alone. Queue positions are prefix sums per task
of the tokenizing job and source. Nothing is sorted, and token ids never go through a
shuffle: they are stored once and cut where they lie. The sizes of the queues, a number per source,
are collected and sent to all tasks.

Windows are full but for the very last one.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blotter.sources import stored

WINDOW = 2048
#: Tokens of a serving.
QUANTUM = 1
END_ID = 1
#: Windows times sources whose cuts are worked out together, about.
CUTS = 1 << 20
#: Halvings until no number lies between the ends.
HALVINGS = 64
#: Words whose ids a task keeps; at that number it starts anew.
KNOWN_WORDS = 500_000

#: Marks that may follow the letters of a word.
MARKS = b".,!?;:#$%&*|"

#: The alphabet of byte-level merges: printable bytes are themselves, the others, in order, the
#: characters from U+0100 on. Only bytes above 127 are looked up here.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in PRINTABLE)}

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def packed(
    docs: DataFrame, tokenizer_file: str, targets: Mapping[str | None, float] | None = None
) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``targets`` has a positive weight for every source (None: as many as it has tokens, so all queues
    last until the end). Null text is as empty text: one piece with the end id. Repeated rows are
    packed each, a null source is a source, other columns are not looked at. An empty table
    gives no piece.
    """
    tokens = stored(tokenized(docs, tokenizer_file), "pack-tokens")
    sums = stored(tokens.groupBy("part", "source").agg(F.sum("n").alias("n")), "pack-sums")
    totals = {r["source"]: r["n"] for r in sums.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    names = sorted(totals, key=lambda name: (name is None, name or ""))
    sizes = np.array([totals[name] for name in names], dtype=np.int64)
    starts = stored(_starts(sums), "pack-starts")
    located = tokens.join(
        starts, (F.col("part") == F.col("s_part")) & F.col("source").eqNullSafe(F.col("s_source"))
    ).select("doc_id", "ids", "n", (F.col("start") + F.col("before")).alias("at"), "place")
    return located.mapInArrow(_cutter(Windows(sizes, _weights(names, sizes, targets))), PIECES)


def _weights(names: list[str | None], sizes: np.ndarray, targets: Mapping[str | None, float] | None) -> np.ndarray:
    if targets is None:
        return sizes.astype(np.float64)
    missing = [name for name in names if not targets.get(name, 0) > 0]
    if missing:
        raise ValueError(f"no positive target for {missing}")
    return np.array([targets[name] for name in names], dtype=np.float64)


class Windows:
    """Which part of each queue every window holds."""

    def __init__(self, sizes: np.ndarray, weights: np.ndarray) -> None:
        self.sizes, self.weights, self.total = sizes, weights, int(sizes.sum())
        self.last = max(-(-self.total // WINDOW) - 1, 0)

    def given(self, time: np.ndarray) -> np.ndarray:
        """Tokens of each source (columns) that are due by each time (rows)."""
        due = np.floor(time[:, None] * self.weights + 0.5)
        return np.minimum(due, self.sizes).astype(np.int64)

    def begins(self, windows: np.ndarray) -> np.ndarray:
        """Queue positions of each source (columns) at which the windows (rows) begin.

        All windows halve the same interval equally often, so the ends they arrive at are the same or
        apart, and positions never fall from one window to the next. Tokens that are due at the
        same time follow in the order of the sources.
        """
        rank = np.minimum(windows * WINDOW, self.total)
        low = np.zeros(len(rank))
        high = np.full(len(rank), (self.sizes / self.weights).max())
        for _ in range(HALVINGS):
            middle = (low + high) / 2
            early = self.given(middle).sum(axis=1) <= rank
            low, high = np.where(early, middle, low), np.where(early, high, middle)
        at_low = self.given(low)
        room = self.given(high) - at_low
        ahead = np.cumsum(room, axis=1) - room
        missing = rank - at_low.sum(axis=1)
        return at_low + np.clip(missing[:, None] - ahead, 0, room)

    def around(self, places: np.ndarray, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first and the last window in which the tokens at these queue positions may be."""
        rank = self.given((positions + 0.5) / self.weights[places]).sum(axis=1)
        slack = len(self.sizes) + 2
        first, last = (rank - slack) // WINDOW, (rank + slack) // WINDOW
        return np.clip(first, 0, self.last), np.clip(last, 0, self.last)


def tokenized(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """doc_id, source, part, before, n, ids: n ids of two bytes each, the end id included;
    ``before`` counts the tokens of the same source that lie earlier in the same part."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("text").cast("binary").alias("text"),
    )
    schema = "doc_id long, source string, part int, before long, n long, ids binary"
    return rows.mapInArrow(_tokenizer(tokenizer_file), schema)


class WordIds:
    """Ids of texts, two bytes each, as the tokenizer gives them, worked out once a word.

    Its rules cut a text at white space and between letters and other characters before they
    merge anything, so the ids of a word of letters and marks after them are the ids of both.
    Letters go straight to the merges, in the alphabet these work on; all else is encoded
    as it stands. The tables start anew when they are full.
    """

    def __init__(self, tokenizer) -> None:
        self.tokenizer, self.merges = tokenizer, tokenizer.model.tokenize
        self.words: dict[bytes, bytes] = {}
        self.cores: dict[bytes, bytes] = {b"": b""}
        self.marks: dict[bytes, bytes] = {b"": b""}
        self.bytes_of = [i.to_bytes(2, "little") for i in range(1 << 16)]

    def of_text(self, text: bytes) -> bytes:
        # Case of A-Z makes no difference but in the names of special tokens.
        words = (text if b"<|" in text else text.lower()).split()
        if len(self.words) > KNOWN_WORDS:
            self.words.clear()
        new = set(words).difference(self.words)
        if new:
            self._meet(new)
        return b"".join(map(self.words.__getitem__, words))

    def _meet(self, new: set[bytes]) -> None:
        if len(self.cores) > KNOWN_WORDS:
            self.cores = {b"": b""}
        words, cores, marks, merges, bytes_of = self.words, self.cores, self.marks, self.merges, self.bytes_of
        for word in new:
            core = word.rstrip(MARKS)
            tail = word[len(core) :]
            ids = cores.get(core)
            if ids is None:
                plain = core.decode().lower() if core.isalpha() else _merged(core)
                if plain is None:
                    words[word] = self.encoded(word)
                    continue
                cores[core] = ids = b"".join([bytes_of[token.id] for token in merges(plain)])
            if tail:
                if tail not in marks:
                    marks[tail] = self.encoded(tail)
                ids += marks[tail]
            words[word] = ids

    def encoded(self, word: bytes) -> bytes:
        found = self.tokenizer.encode(word.decode(errors="replace"), add_special_tokens=False)
        return b"".join([self.bytes_of[i] for i in found.ids])


def _merged(core: bytes) -> str | None:
    """What the merges see of letters below U+0100, whose lower case and normal form are settled
    letter by letter; None if there is anything else."""
    try:
        text = core.decode()
    except UnicodeDecodeError:
        return None
    if not text.isalpha() or max(text) >= "\u0100":
        return None
    return text.lower().encode().decode("latin-1").translate(BYTE_LETTERS)


def _tokenizer(file: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(file)
        if tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of more than two bytes")
        known = WordIds(tokenizer)
        end = END_ID.to_bytes(2, "little")
        part = TaskContext.get().partitionId()
        ahead: dict[str | None, int] = defaultdict(int)
        for batch in batches:
            sources = batch.column(1).to_pylist()
            ids, before, counts = [], [], []
            for text, source in zip(batch.column(2), sources):
                ids.append(known.of_text(text.as_py() or b"") + end)
                before.append(ahead[source])
                counts.append(len(ids[-1]) // 2)
                ahead[source] += counts[-1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sources, pa.string()),
                    pa.array([part] * len(ids), pa.int32()),
                    pa.array(before, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                names=["doc_id", "source", "part", "before", "n", "ids"],
            )

    return run


def _starts(sums: DataFrame) -> DataFrame:
    """Where the tokens of each part and source begin in the queue of the source, and the place of
    the source (code-point order)."""
    ahead = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    order = Window.orderBy(F.col("source").asc_nulls_last())
    places = sums.select("source").distinct().withColumn("place", F.row_number().over(order) - 1)
    starts = sums.withColumn("start", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    starts = starts.select(F.col("part").alias("s_part"), F.col("source").alias("s_source"), "start")
    return starts.join(places, F.col("s_source").eqNullSafe(F.col("source"))).select(
        "s_part", "s_source", "start", "place"
    )


def _cutter(windows: Windows) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A piece for each window that a document reaches into."""
    names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            doc_ids, ids = batch.column(0).to_pylist(), batch.column(1)
            n, at, place = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 4))
            # A part at a time: documents times sources, then windows times sources.
            step = max(CUTS // len(windows.sizes), 1)
            for begin in range(0, len(n), step):
                part = slice(begin, begin + step)
                first = windows.around(place[part], at[part])[0]
                last = windows.around(place[part], at[part] + n[part] - 1)[1]
                ahead = np.cumsum(last - first + 2) * len(windows.sizes) // CUTS
                for group in np.split(np.arange(len(first)), np.flatnonzero(np.diff(ahead)) + 1):
                    rows: list[list] = [[] for _ in names]
                    wanted = np.unique(np.concatenate([np.arange(first[i], last[i] + 2) for i in group]))
                    begins = windows.begins(wanted)
                    before = np.cumsum(begins, axis=1) - begins
                    for i in group:
                        row = begin + i
                        size, source, position = int(n[row]), place[row], int(at[row])
                        words = np.frombuffer(ids[row].as_py(), dtype="<u2").astype("<u4")
                        near = slice(*np.searchsorted(wanted, (first[i], last[i] + 2)))
                        cuts, shift = begins[near, source].tolist(), before[near, source].tolist()
                        start, k = 0, 0
                        while start < size:
                            while cuts[k + 1] <= position + start:
                                k += 1
                            length = min(cuts[k + 1] - position - start, size - start)
                            crc = zlib.crc32(words[start : start + length].tobytes())
                            offset = shift[k + 1] - shift[k] + position + start - cuts[k]
                            piece = (doc_ids[row], start, length, crc, size, int(first[i]) + k, offset)
                            for column, value in zip(rows, piece):
                                column.append(value)
                            start += length
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(column, pa.int64()) for column in rows], names=list(names)
                    )

    return run
