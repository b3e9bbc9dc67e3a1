"""Language of a text by unigram pieces, summed over all segmentations.

Each language gives every piece of a fixed public vocabulary a probability. The likelihood of a
word is the sum, over all ways to cut it into pieces, of the product of their probabilities; a
forward pass over the lattice of pieces adds them up. A text scores the sum of the logarithms over
its words, for each language; the score is the posterior under equal priors.

Probabilities are learned by expectation maximisation from the words of at most ``SAMPLE``
labelled documents a language (those with the smallest hashes): each round runs the
forward and the backward pass over all distinct words in tasks, and adds up expected piece counts.
What comes to the driver is one number per piece and language.

Words are lower-cased and reduced to their letters. A task runs the lattice once for each word
it does not know yet, many words at a time in NumPy. Words of any length are scored whole: beyond
``STRETCH`` letters the pass goes on stretch by stretch from the sums of the last nodes, which are
brought back to 1 each time, so no sum vanishes and memory does not grow with the word. Only
learning takes the words of its sample in parts, of ``PART`` letters.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.sources import stored

SAMPLE = 1000
ROUNDS = 3
#: Added to every expected count.
SMOOTHING = 0.05
#: Letters that are summed up before sums are brought back to 1. With those of the longest piece (16) a
#: letter may cost 1e-8, scaled, before a float no longer holds the sum.
STRETCH = 20
#: Letters of a word that are learned from together.
PART = 40
#: A letter costs about this factor; probabilities are scaled by it so that sums stay near 1.
LETTER = 9.0
#: Words whose scores a task keeps; at that number it starts anew.
KNOWN_WORDS = 300_000
#: Bytes of text that are scored together.
TOGETHER = 1 << 20

START, STOP = "▁", "\n"
UNDETERMINED = "und"
HELD_OUT = 2


@dataclass
class Model:
    languages: list[str]
    pieces: list[str]
    #: One row per piece, and a last one for letters without a piece; a column per language.
    probabilities: np.ndarray


def vocabulary(model_file: str) -> list[str]:
    """Pieces of letters in lower case, with or without the mark of a word's start."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    bare = lambda piece: piece.removeprefix(START)
    return sorted({p for p in pieces if p == START or (bare(p).isalpha() and p == p.lower())})


def held_out(doc_id: Column) -> Column:
    """A fixed quarter of the documents, by their id; no id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == HELD_OUT


def letters(word: bytes) -> str:
    text = word.decode(errors="replace").lower()
    return text if text.isalpha() else "".join(filter(str.isalpha, text))


def parts(word: str) -> list[str]:
    return [word[i : i + PART] for i in range(0, len(word), PART)]


class Lattice:
    """Arcs from letter to letter, one for each piece found in each of many words.

    The words lie one after another in a string; node p is the place before its character p.
    """

    def __init__(self, words: list[str], finder: ahocorasick.Automaton, unknown: int) -> None:
        string = "".join([START + word + STOP for word in words])
        sizes = np.array([len(word) + 2 for word in words], dtype=np.int64)
        self.first = np.cumsum(sizes) - sizes
        self.last = self.first + sizes - 1
        self.letters = sizes - 2
        self.nodes = len(string)
        hits = np.fromiter(chain.from_iterable(finder.iter(string)), dtype=np.int64).reshape(-1, 2)
        end, length, piece = hits[:, 0] + 1, hits[:, 1] & 255, hits[:, 1] >> 8
        # A letter that is no piece is an arc of its own.
        bare = np.ones(self.nodes, dtype=bool)
        bare[end[length == 1] - 1] = False
        bare[self.last] = False
        alone = np.flatnonzero(bare)
        self.to = np.concatenate([end, alone + 1])
        self.of = np.concatenate([end - length, alone])
        self.piece = np.concatenate([piece, np.full(len(alone), unknown)])
        self.depth = np.arange(self.nodes) - np.repeat(self.first, sizes)

    def forward(self, probabilities: np.ndarray) -> np.ndarray:
        """Per node the scaled sum over all ways from the start of its word."""
        return self._sums(self.of, self.to, self.first, self.depth[self.to], probabilities)

    def backward(self, probabilities: np.ndarray) -> np.ndarray:
        """Per node the scaled sum over all ways to the end of its word."""
        return self._sums(self.to, self.of, self.last, -self.depth[self.of], probabilities)

    def _sums(self, source, target, begin, step, probabilities) -> np.ndarray:
        sums = np.zeros((self.nodes, probabilities.shape[1]))
        sums[begin] = 1.0
        add_up(sums, source, target, step, self.piece, probabilities)
        return sums


def add_up(sums, source, target, step, piece, probabilities) -> None:
    """Follows the arcs in order of their steps; arcs to the same node have the same step."""
    order = np.lexsort((target, step))
    step, target, source, piece = step[order], target[order], source[order], piece[order]
    bounds = np.append(np.flatnonzero(np.diff(step, prepend=step[:1] - 1)), len(step))
    for a, b in zip(bounds[:-1], bounds[1:]):
        nodes = target[a:b]
        runs = np.flatnonzero(np.diff(nodes, prepend=-1))
        sums[nodes[runs]] = np.add.reduceat(sums[source[a:b]] * probabilities[piece[a:b]], runs, axis=0)


def finder(pieces: list[str]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for i, piece in enumerate(pieces):
        found.add_word(piece, i << 8 | len(piece))
    found.make_automaton()
    return found


def scaled(model: Model) -> np.ndarray:
    lengths = np.array([len(p) - p.startswith(START) for p in model.pieces] + [1])
    return model.probabilities * (LETTER**lengths)[:, None]


def word_scores(words: list[str], automaton: ahocorasick.Automaton, probabilities: np.ndarray) -> np.ndarray:
    """Log-likelihood of each word under each language, from scaled probabilities."""
    sizes = np.array([len(word) for word in words], dtype=np.int64)
    scores = np.empty((len(words), probabilities.shape[1]))
    short = np.flatnonzero(sizes <= STRETCH)
    if len(short):
        lattice = Lattice([words[i] for i in short], automaton, len(probabilities) - 1)
        scores[short] = np.log(np.maximum(lattice.forward(probabilities)[lattice.last], 1e-300))
    long = np.flatnonzero(sizes > STRETCH)
    if len(long):
        scores[long] = _long_sums([words[i] for i in long], automaton, probabilities)
    return scores - sizes[:, None] * np.log(LETTER)


def _long_sums(words: list[str], automaton: ahocorasick.Automaton, probabilities: np.ndarray) -> np.ndarray:
    """Logarithm of the scaled sum over all ways through each word.

    A row holds ``wide`` letters that were passed and the next stretch of a word; wide is the length of the
    longest piece, so no arc into the stretch begins before the row. Node p of a row is the place
    before its letter p. What lies outside the word is filled with a character of no piece.
    """
    unknown = len(probabilities) - 1
    wide = max((len(piece) for piece in automaton.keys()), default=1)
    width = wide + STRETCH
    marked = [START + word for word in words]
    logs = np.zeros((len(words), probabilities.shape[1]))
    alive = np.arange(len(words))
    passed = np.zeros((len(words), wide, probabilities.shape[1]))
    passed[:, -1] = 1.0
    at = 0
    while len(alive):
        before = STOP * max(wide - at, 0)
        rows = [(before + marked[i][max(at - wide, 0) : at + STRETCH]).ljust(width, STOP) for i in alive]
        string = "".join(rows)
        hits = np.fromiter(chain.from_iterable(automaton.iter(string)), dtype=np.int64).reshape(-1, 2)
        row, end = hits[:, 0] // width, hits[:, 0] % width + 1
        length, piece = hits[:, 1] & 255, hits[:, 1] >> 8
        new = (end > wide) & (length < end)
        row, end, length, piece = row[new], end[new], length[new], piece[new]
        # A letter that is no piece is an arc of its own.
        bare = np.frombuffer(string.encode("utf-32-le"), dtype="<u4").reshape(-1, width) != ord(STOP)
        bare[:, :wide] = False
        bare[row[length == 1], end[length == 1] - 1] = False
        lone_row, lone = np.nonzero(bare)
        row = np.concatenate([row, lone_row])
        end = np.concatenate([end, lone + 1])
        length = np.concatenate([length, np.ones(len(lone), dtype=np.int64)])
        piece = np.concatenate([piece, np.full(len(lone), unknown)])
        sums = np.zeros((len(alive), width + 1, probabilities.shape[1]))
        sums[:, 1 : wide + 1] = passed
        to = row * (width + 1) + end
        add_up(sums.reshape(-1, probabilities.shape[1]), to - length, to, end, piece, probabilities)
        last = np.array([len(marked[i]) for i in alive]) - at + wide
        done = last <= width
        logs[alive[done]] += np.log(np.maximum(sums[np.flatnonzero(done), last[done]], 1e-300))
        alive, passed = alive[~done], sums[~done, width - wide + 1 :]
        most = passed.max(axis=1, initial=1e-300)
        logs[alive] += np.log(most)
        passed = passed / most[:, None]
        at += STRETCH
    return logs


def learn(labelled: DataFrame, pieces: list[str]) -> Model:
    """A model from rows of text and lang, neither null."""
    texts = _sample(labelled).select("lang", F.col("text").cast("binary").alias("text"))
    counted = texts.mapInArrow(_counted, "lang string, word string, n long")
    words = stored(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "language-words")
    languages = sorted(row["lang"] for row in words.select("lang").distinct().toLocalIterator())
    model = Model(languages, pieces, np.full((len(pieces) + 1, len(languages)), 1.0 / (len(pieces) + 1)))
    for _ in range(ROUNDS if languages else 0):
        expected = words.mapInArrow(_expectation(model), "language int, piece int, n double")
        sums = expected.groupBy("language", "piece").agg(F.sum("n").alias("n"))
        counts = np.full_like(model.probabilities, SMOOTHING)
        # One row per piece and language at most.
        for row in sums.toLocalIterator():
            counts[row["piece"], row["language"]] += row["n"]
        model = Model(languages, pieces, counts / counts.sum(axis=0))
    return model


def _sample(labelled: DataFrame) -> DataFrame:
    """The documents of each language whose hashes are among the ``SAMPLE`` smallest.

    Hashes are ranked without their texts, and only each language's last one goes back to the
    documents. Rows that are repeated count once.
    """
    keyed = labelled.withColumn("__key", F.xxhash64("__key", "text"))
    order = F.row_number().over(Window.partitionBy("lang").orderBy("__key"))
    ranked = keyed.select("lang", "__key").distinct().withColumn("rank", order).where(F.col("rank") <= SAMPLE)
    last = ranked.groupBy(F.col("lang").alias("__lang")).agg(F.max("__key").alias("__last"))
    last = stored(last, "language-sample")
    chosen = keyed.join(last, (F.col("lang") == F.col("__lang")) & (F.col("__key") <= F.col("__last")))
    return chosen.dropDuplicates(["lang", "__key"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter[tuple[str, str]] = Counter()
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for word, n in Counter(text.as_py().split()).items():
                for part in parts(letters(word)):
                    counts[lang, part] += n
        columns = [
            pa.array([lang for lang, _ in counts], pa.string()),
            pa.array([word for _, word in counts], pa.string()),
            pa.array(counts.values(), pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "word", "n"])


def _expectation(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, probabilities = finder(model.pieces), scaled(model)
        place = {lang: i for i, lang in enumerate(model.languages)}
        for batch in batches:
            langs = np.array([place[lang] for lang in batch.column(0).to_pylist()], dtype=np.int64)
            words, n = batch.column(1).to_pylist(), batch.column(2).to_numpy()
            for language in np.unique(langs):
                rows = np.flatnonzero(langs == language)
                own = probabilities[:, [language]]
                lattice = Lattice([words[i] for i in rows], automaton, len(own) - 1)
                ahead, behind = lattice.forward(own)[:, 0], lattice.backward(own)[:, 0]
                whole = np.repeat(ahead[lattice.last], lattice.letters + 2)
                weight = np.repeat(n[rows], lattice.letters + 2)
                share = ahead[lattice.of] * own[lattice.piece, 0] * behind[lattice.to]
                share *= weight[lattice.of] / np.maximum(whole[lattice.of], 1e-300)
                sums = np.bincount(lattice.piece, share, minlength=len(own))
                used = np.flatnonzero(sums)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([language] * len(used), pa.int32()), pa.array(used, pa.int32()), pa.array(sums[used])],
                    names=["language", "piece", "n"],
                )

    return run


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score for every row."""
    # Bounded by vocabulary and number of languages. Plain values: tasks may lack this package.
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.pieces, model.probabilities))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Model(*sent.value))
        for batch in batches:
            langs: list[str] = []
            scores: list[float] = []
            waiting: list[list[bytes]] = []
            size = 0
            for text in batch.column(1):
                plain = text.as_py() or b""
                waiting.append(plain.split())
                size += len(plain)
                if size > TOGETHER:
                    scorer.add(waiting, langs, scores)
                    waiting, size = [], 0
            scorer.add(waiting, langs, scores)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


class Scorer:
    """Scores texts, given as lists of words, and keeps the scores of words."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.automaton, self.probabilities = finder(model.pieces), scaled(model)
        self._forget()

    def _forget(self) -> None:
        """Row 0 is for words without a letter."""
        self.known: dict[bytes, int] = {}
        self.forms: dict[str, int] = {"": 0}
        self.used = 1
        self.rows = np.zeros((1 << 16, len(self.model.languages)))

    def _meet(self, words: list[bytes]) -> None:
        new = [word for word in dict.fromkeys(words) if word not in self.known]
        if len(self.known) + len(new) > KNOWN_WORDS and self.known:
            self._forget()
            new = list(dict.fromkeys(words))
        plain = [letters(word) for word in new]
        forms = [form for form in dict.fromkeys(plain) if form not in self.forms]
        if forms:
            scores = word_scores(forms, self.automaton, self.probabilities)
            while self.used + len(forms) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[self.used : self.used + len(forms)] = scores
            self.forms.update(zip(forms, range(self.used, self.used + len(forms))))
            self.used += len(forms)
        self.known.update((word, self.forms[form]) for word, form in zip(new, plain))

    def add(self, texts: list[list[bytes]], langs: list[str], scores: list[float]) -> None:
        self._meet([word for words in texts for word in words])
        for words in texts:
            rows = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))
            if not rows.any() or not self.model.languages:
                langs.append(UNDETERMINED)
                scores.append(0.0)
                continue
            sums = self.rows[rows].sum(axis=0)
            best = int(sums.argmax())
            langs.append(self.model.languages[best])
            scores.append(float(1.0 / np.exp(sums - sums[best]).sum()))


def identify(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``.

    Learned from text and non-null lang of the documents that are not held out; predictions
    see the text alone. A text that is null or has no letter is ``und`` with score 0, and so is
    every text if there is nothing to learn from. Equally likely languages: the first by name.
    Repeated rows come back as often; other columns are not looked at.
    """
    labelled = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    labelled = labelled.select("text", F.col("lang").cast("string").alias("lang"), F.xxhash64("doc_id").alias("__key"))
    model = learn(labelled, vocabulary(model_file))
    found = predicted(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
