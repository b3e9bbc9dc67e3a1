"""Periodic runs of words, found with suffix trees.

A run is a stretch of words with smallest period q that is at least max(``SHORTEST``, 2 * q) long and
that no neighbouring word extends. Every run holds the Lyndon word of its period for one of the
two orders of the words, so the longest Lyndon word from each place on, for either order, is a candidate
for the root of a run: it reaches to the next place whose suffix is smaller. A candidate is extended
to the right and to the left as far as words its length apart are the same. These extensions
are longest common extensions (LCE): on the suffix tree of the words to the right, on the tree of
the words reversed to the left. Trees are built by Ukkonen's algorithm; the LCE of two places is the
string depth of the lowest common ancestor of their leaves, the least depth on the Euler tour between
them, answered in constant time from a sparse table over blocks of the tour. All candidates are
answered at once, as arrays.

Trees are grown only where a run can be: words q apart are the same for at least half of ``SHORTEST``
words on end, so a run is covered by phrases of that many words that come twice within it. What
such phrases cover is cut out, again and again until nothing more falls away; a run lies in one piece
whole, and what would extend it lies there, too.

Documents are independent rows, so nothing is shuffled; a document's memory grows with its longest
piece. Null text has no words. Repeated rows give the same result each, an empty table none; other
columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

#: Words of the shortest run.
SHORTEST = 12
#: Places of an Euler tour per block.
BLOCK = 32

RUN = StructType([StructField(name, LongType()) for name in ("start", "length", "period")])
FOUND = StructType(
    [
        StructField("n_words", LongType()),
        StructField("runs", ArrayType(RUN)),
        StructField("collapsed", StringType()),
    ]
)


def runs(text: Column) -> Column:
    """n_words, runs and collapsed of a text.

    ``runs`` are by start, then period, in numbers of words; ``collapsed`` joins the words by blanks
    without those that a run repeats: all of a run after its first period goes.
    """
    return _runs(text.cast("binary"))


@F.arrow_udf(FOUND)
def _runs(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    kinds = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for batch in texts:
        counts, ends, collapsed = [], [0], []
        parts = [np.empty((0, 3), dtype=np.int64)]
        for text in batch:
            # bytes.split knows the six ASCII spaces only, as asked for.
            words = (text.as_py() or b"").split()
            found = runs_of(words)
            counts.append(len(words))
            ends.append(ends[-1] + len(found))
            parts.append(found)
            collapsed.append(b" ".join(_kept(words, found)).decode(errors="replace"))
        columns = [pa.array(column) for column in np.concatenate(parts).T.copy()]
        rows = pa.StructArray.from_arrays(columns, fields=list(kinds))
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)
        yield pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), lists, pa.array(collapsed, pa.string())],
            names=["n_words", "runs", "collapsed"],
        )


def runs_of(words: list) -> np.ndarray:
    """start, length and period of every run, by start, then period."""
    found = [np.empty((0, 3), dtype=np.int64)]
    for start, end in _pieces(words, 0, len(words)):
        known: dict = {}
        numbers = [known.setdefault(word, len(known)) for word in words[start:end]]
        part = _all_runs(numbers)
        part[:, 0] += start
        found.append(part[part[:, 1] >= SHORTEST])
    rows = np.concatenate(found)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _kept(words: list[bytes], found: np.ndarray) -> list[bytes]:
    if not len(found):
        return words
    # Stretches that go, as steps up at their begin and down at their end.
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(steps, found[:, 0] + found[:, 2], 1)
    np.add.at(steps, found[:, 0] + found[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0)]


def _pieces(words: list, start: int, end: int) -> Iterator[tuple[int, int]]:
    """Stretches covered by phrases of SHORTEST / 2 words that come twice within the stretch."""
    size = SHORTEST // 2
    waiting = [(start, end)]
    while waiting:
        start, end = waiting.pop()
        if end - start < SHORTEST:
            continue
        part = words[start:end] if end - start < len(words) else words
        phrases = list(zip(*(part[i:] for i in range(size))))
        if len(set(phrases)) == len(phrases):
            continue
        times = Counter(phrases)
        again = np.fromiter((times[p] > 1 for p in phrases), dtype=bool, count=len(phrases))
        steps = np.zeros(len(part) + 1, dtype=np.int64)
        steps[: len(again)] += again
        steps[size : size + len(again)] -= again
        edges = np.flatnonzero(np.diff(np.cumsum(steps) > 0, prepend=False, append=False))
        cut = [(start + a, start + b) for a, b in edges.reshape(-1, 2).tolist()]
        if cut == [(start, end)]:
            yield start, end
        else:
            waiting += cut


def _all_runs(words: list[int]) -> np.ndarray:
    """Every run of at least two periods, in no order."""
    size = len(words)
    ahead = SuffixTree(words)
    back = SuffixTree(words[::-1])
    places = np.arange(size)
    rising, falling = (_next_smaller(ahead.ranks(f)) for f in (False, True))
    other = rising != falling
    i, j = np.concatenate([places, places[other]]), np.concatenate([rising, falling[other]])
    # The last place can have no word beside it; its suffix is only the end itself.
    right = np.zeros(len(i), dtype=np.int64)
    inside = j < size
    right[inside] = ahead.lce(i[inside], j[inside])
    left = np.zeros(len(i), dtype=np.int64)
    led = i > 0
    left[led] = back.lce(size - i[led], size - j[led])
    start, end, period = i - left, j + right, j - i
    rows = np.stack([start, end - start, period], axis=1)
    return np.unique(rows[rows[:, 1] >= 2 * period], axis=0)


def _next_smaller(ranks: np.ndarray) -> np.ndarray:
    """For each place the next one with a smaller rank, or the end."""
    size, ranks = len(ranks), ranks.tolist()
    found, open_places = [size] * size, []
    for place, rank in enumerate(ranks):
        while open_places and ranks[open_places[-1]] > rank:
            found[open_places.pop()] = place
        open_places.append(place)
    return np.array(found, dtype=np.int64)


class SuffixTree:
    """The suffix tree of a sequence of numbers from 0 on, closed by a mark of its own.

    The mark, -1, is smaller than all of them in either order.
    """

    def __init__(self, words: list[int]) -> None:
        self.words = [*words, -1]
        self._grow()
        self._tour()

    def _grow(self) -> None:
        """Ukkonen: one word after the other, at most one new leaf per open suffix."""
        words, size = self.words, len(self.words)
        # Node 0 is the root; the edge into a node has the words from begin to end. Leaves have
        # nothing below. There are at most twice as many nodes as words.
        begin, end, link = [0] * (2 * size), [size] * (2 * size), [0] * (2 * size)
        below: list[dict | None] = [None] * (2 * size)
        end[0], below[0], nodes = 0, {}, 1
        node, edge, length, missing = 0, 0, 0, 0
        for place, word in enumerate(words):
            missing += 1
            last = 0  # an inner node of this step that waits for its suffix link
            while missing:
                if not length:
                    edge = place
                child = below[node].get(words[edge])
                if child is None:
                    below[node][words[edge]] = nodes
                    begin[nodes] = place
                    nodes += 1
                    if last:
                        link[last] = node
                        last = 0
                else:
                    span = min(end[child], place + 1) - begin[child]
                    if length >= span:
                        node, edge, length = child, edge + span, length - span
                        continue
                    if words[begin[child] + length] == word:
                        length += 1
                        if last:
                            link[last] = node
                        break
                    # Split the edge, and hang a new leaf on the new node.
                    middle = below[node][words[edge]] = nodes
                    begin[middle], end[middle] = begin[child], begin[child] + length
                    begin[child] += length
                    below[middle] = {words[begin[child]]: child, word: middle + 1}
                    begin[middle + 1] = place
                    nodes += 2
                    if last:
                        link[last] = middle
                    last = middle
                missing -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = place - missing + 1
        self.begin, self.end, self.below = begin, end, below

    def _tour(self) -> None:
        """The Euler tour as string depths, and where each suffix stands on it."""
        size, begin, end, below = len(self.words), self.begin, self.end, self.below
        tour, seen = [0], [0] * size
        # The inner nodes on the way down: the children yet to be visited, and the depth.
        way = [(_in_order(below[0], False), 0)]
        while way:
            rest, depth = way[-1]
            for child in rest:
                deeper = depth + end[child] - begin[child]
                if below[child] is None:
                    seen[size - deeper] = len(tour)
                    tour += (deeper, depth)
                else:
                    tour.append(deeper)
                    way.append((_in_order(below[child], False), deeper))
                    break
            else:
                way.pop()
                if way:
                    tour.append(way[-1][1])
        self.seen = np.array(seen, dtype=np.int64)
        self._index(np.array(tour, dtype=np.int32))

    def _index(self, tour: np.ndarray) -> None:
        """Least values of a block from its begin, to its end, and of 2**k blocks on end."""
        blocks = -(-len(tour) // BLOCK)
        full = np.full(blocks * BLOCK, np.iinfo(np.int32).max, dtype=np.int32)
        full[: len(tour)] = tour
        table = full.reshape(blocks, BLOCK)
        self.tour = full
        self.upto = np.minimum.accumulate(table, axis=1).reshape(-1)
        self.onward = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        self.sparse = [table.min(axis=1)]
        while 2 << (len(self.sparse) - 1) <= blocks:
            row, step = self.sparse[-1], 1 << (len(self.sparse) - 1)
            self.sparse.append(np.minimum(row[:-step], row[step:]))

    def lce(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words on end are the same from places a and from places b on; a and b differ."""
        first, last = np.minimum(self.seen[a], self.seen[b]), np.maximum(self.seen[a], self.seen[b])
        least = np.minimum(self.onward[first], self.upto[last])
        begin, end = first // BLOCK + 1, last // BLOCK
        level = np.zeros(len(first), dtype=np.int64)
        level[end > begin] = np.log2((end - begin)[end > begin]).astype(np.int64)
        for k in np.unique(level[end > begin]):
            at = np.flatnonzero((level == k) & (end > begin))
            row = self.sparse[k]
            both = np.minimum(row[begin[at]], row[end[at] - (1 << k)])
            least[at] = np.minimum(least[at], both)
        near = np.flatnonzero(begin > end)  # both in one block
        if len(near):
            here = np.full(len(near), np.iinfo(np.int32).max, dtype=np.int32)
            for step in range(BLOCK):
                place = first[near] + step
                within = place <= last[near]
                here[within] = np.minimum(here[within], self.tour[place[within]])
            least[near] = here
        return least.astype(np.int64)

    def ranks(self, falling: bool) -> np.ndarray:
        """Numbers that order the suffixes but the mark; words compare the other way round if ``falling``."""
        if not falling:
            return self.seen[:-1]  # the tour visits them in this order
        begin, end, below = self.begin, self.end, self.below
        size = len(self.words)
        places = []
        way = [(_in_order(below[0], True), 0)]
        while way:
            rest, depth = way[-1]
            for child in rest:
                deeper = depth + end[child] - begin[child]
                if below[child] is not None:
                    way.append((_in_order(below[child], True), deeper))
                    break
                places.append(size - deeper)
            else:
                way.pop()
        ranks = np.empty(size, dtype=np.int64)
        ranks[places] = np.arange(size)
        return ranks[:-1]


def _in_order(children: dict, falling: bool) -> Iterator:
    """The mark first, then the words in their order."""
    order = sorted(children, reverse=falling)
    if falling and order[-1] < 0:
        order.insert(0, order.pop())
    return map(children.__getitem__, order)
