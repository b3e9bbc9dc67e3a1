"""Quality rules whose limits follow the documents of a language and source.

Four ratios of each document (symbols, repeated lines, repeated words, mean word length)
go into quantile sketches, one per language, source and ratio. A sketch is a histogram
whose buckets keep the leading ``SKETCH_BITS`` bits of the value, so a quantile is off by
at most 1 / 2**(SKETCH_BITS - 1) of itself; two sketches merge by adding their counts, in any
order, with the same result. The limits of a group come from its sketch alone:

    [median - REACH * (median - q(1 - tail)), median + REACH * (q(tail) - median)]

where ``tail`` is 90% for ratios that junk sets apart in kind and 99% for those whose high values
are rare among clean documents as well. There is no least spread: where nine tenths of a language
have no symbols, none are accepted. Limits of a source are averaged with those of its language,
which weigh as much as ``PRIOR`` documents, so they change steadily with the number of documents;
and no source may raise a limit to more than ``LOOSER`` times that of its language, so a
source made of junk does not set its own standard.

Everything is DataFrame expressions. Sketches are added up in the map tasks, so a source
with a third of all rows sends no more than another one.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm.words import SPACE, words, worded_lines
from blotter.sources import stored

SYMBOLS = r"[#*$%&|<>]+"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

SKETCH_BITS = 6
#: Documents that the limits of the language count for beside those of a source.
PRIOR = 100
REACH = 4
LOOSER = 3

#: Each ratio with the quantile, per mille, that its spread reaches to. Values are per mille, too,
#: the word length in hundredths.
RATIOS: Mapping[str, int] = {
    "symbols": 900,
    "dup_lines": 990,
    "repeat_words": 990,
    "word_length": 900,
}

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MARK = "__quality_"


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the base measures, in columns named ``MARK`` + measure.

    Repeated words are found without leaving the row: eight word hashes are folded into
    one by doubling (1, 2, 4, 8), equal neighbours in the sorted window hashes mark the
    repeated windows, and the words covered by their positions are counted. Only texts
    with a repeated window pay for the sorting.
    """
    m = lambda name: F.col(MARK + name)
    text = F.col("text")
    n = F.size(m("w"))
    windows = F.greatest(n - (WINDOW - 1), F.lit(0))
    df = docs.withColumn(MARK + "w", words(text))
    df = df.withColumns(
        {
            MARK + "n_words": n.cast("long"),
            MARK + "word_chars": F.length(F.array_join(m("w"), "")).cast("long"),
            MARK + "n_symbols": F.coalesce(
                F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, "")), F.lit(0)
            ).cast("long"),
            MARK + "lines": worded_lines(text),
            MARK + "h": F.transform(m("w"), lambda w: F.xxhash64(w)),
        }
    )
    df = df.withColumn(
        MARK + "n_dup_lines",
        (F.size(m("lines")) - F.size(F.array_distinct(m("lines")))).cast("long"),
    )
    step = 1
    while step < WINDOW:
        size = F.greatest(F.size(m("h")) - step, F.lit(0))
        df = df.withColumn(
            MARK + "h",
            F.zip_with(
                F.slice(m("h"), F.lit(1), size),
                F.slice(m("h"), F.lit(1 + step), size),
                lambda a, b: F.xxhash64(a, b),
            ),
        )
        step *= 2
    repeated = F.size(F.array_distinct(m("h"))) < F.size(m("h"))
    df = df.withColumn(
        MARK + "s",
        F.when(
            repeated,
            F.sort_array(
                F.zip_with(
                    m("h"),
                    F.sequence(F.lit(1), F.greatest(windows, F.lit(1))),
                    lambda h, i: F.struct(h.alias("h"), i.alias("i")),
                )
            ),
        ),
    )
    rest = F.size(m("s")) - 1
    df = df.withColumn(
        MARK + "e",
        F.zip_with(
            F.slice(m("s"), F.lit(1), rest),
            F.slice(m("s"), F.lit(2), rest),
            lambda a, b: a["h"] == b["h"],
        ),
    )
    no = F.array(F.lit(False))
    either = F.zip_with(F.concat(no, m("e")), F.concat(m("e"), no), lambda a, b: a | b)
    df = df.withColumn(
        MARK + "p",
        F.sort_array(
            F.filter(
                F.zip_with(m("s"), either, lambda s, dup: F.when(dup, s["i"])),
                lambda i: i.isNotNull(),
            )
        ),
    )
    more = F.size(m("p")) - 1
    gaps = F.zip_with(
        F.slice(m("p"), F.lit(1), more),
        F.slice(m("p"), F.lit(2), more),
        lambda a, b: F.least(b - a, F.lit(WINDOW)),
    )
    covered = F.aggregate(gaps, F.lit(WINDOW), lambda total, gap: total + gap)
    df = df.withColumn(
        MARK + "n_repeat_words", F.coalesce(F.when(more >= 0, covered), F.lit(0)).cast("long")
    )
    # A generator keeps the measures apart from what is built on them. Without it a filter on the
    # verdict is moved below the steps above, each of which would be written out where it is used.
    measures = F.inline(F.array(F.struct(*(m(name) for name in MEASURES))))
    return df.select(*docs.columns, measures)


def base_failed() -> Column:
    n, repeat = F.col(MARK + "n_words"), F.col(MARK + "n_repeat_words")
    return (n < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n)


def sketches(df: DataFrame) -> DataFrame:
    """lang, source, ratio, bucket, n: a quantile sketch per language, source and ratio."""
    values = F.array(
        *(F.struct(F.lit(name).alias("ratio"), _ratio(name).alias("value")) for name in RATIOS)
    )
    return (
        df.where(~base_failed())
        .select("lang", "source", F.explode(values).alias("at"))
        .groupBy("lang", "source", "at.ratio", _bucket(F.col("at.value")).alias("bucket"))
        .agg(F.count("*").alias("n"))
    )


def merged(sketch: DataFrame, *keys: str) -> DataFrame:
    return sketch.groupBy(*keys, "ratio", "bucket").agg(F.sum("n").alias("n"))


def limits(sketch: DataFrame) -> DataFrame:
    """lang, source and the lowest and highest accepted value of each ratio."""
    own = _fences(sketch, "lang", "source").alias("own")
    whole = _fences(merged(sketch, "lang"), "lang").alias("whole")
    joined = own.join(
        whole,
        F.col("own.lang").eqNullSafe(F.col("whole.lang"))
        & (F.col("own.ratio") == F.col("whole.ratio")),
    )
    n = F.col("own.n")
    blended = lambda end: F.floor(
        (n * F.col(f"own.{end}") + PRIOR * F.col(f"whole.{end}")) / (n + PRIOR)
    )
    low, high = blended("low"), F.least(blended("high"), LOOSER * F.col("whole.high"))
    chosen = joined.select("own.lang", "own.source", "own.ratio", low.alias("low"), high.alias("high"))
    of = lambda name, end: F.max(F.when(F.col("ratio") == name, F.col(end)))
    return chosen.groupBy("lang", "source").agg(
        *(of(name, end).alias(f"{MARK}{end}_{name}") for name in RATIOS for end in ("low", "high"))
    )


def judged(df: DataFrame, bounds: DataFrame) -> DataFrame:
    """Measured rows with ``base_failed`` and ``kept``, named with ``MARK``.

    ``bounds`` has a row per language and source. It is read from a table, so Spark knows
    its size and broadcasts it only below its own limit.
    """
    bounds = bounds.withColumnsRenamed({"lang": MARK + "lang", "source": MARK + "source"})
    joined = df.join(
        bounds,
        df["lang"].eqNullSafe(bounds[MARK + "lang"])
        & df["source"].eqNullSafe(bounds[MARK + "source"]),
        "left",
    )
    within = reduce(
        lambda a, b: a & b,
        (
            _bucket(_ratio(name)).between(F.col(f"{MARK}low_{name}"), F.col(f"{MARK}high_{name}"))
            for name in RATIOS
        ),
    )
    return joined.withColumns(
        {
            MARK + "base_failed": base_failed(),
            MARK + "kept": ~base_failed() & F.coalesce(within, F.lit(False)),
        }
    ).drop(*bounds.columns)


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the measures, ``base_failed`` and ``kept``.

    Null text has no words and fails the base rule. A null language or source is a group
    of its own. Repeated rows are judged each; other columns are not looked at. Texts are
    read once: the measures are stored, then sketched, then joined with the limits.
    """
    narrow = measured(docs.select("doc_id", "text", "lang", "source")).drop("text")
    narrow = stored(narrow, "quality-measures")
    bounds = stored(limits(sketches(narrow)), "quality-limits")
    names = [*MEASURES, "base_failed", "kept"]
    return judged(narrow, bounds).select(
        "doc_id", *(F.col(MARK + name).alias(name) for name in names)
    )


def keep_quality(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`quality_verdicts` keeps, with all their columns.

    The texts are measured twice, once for the limits and once against them, which costs
    less than carrying them through a shuffle.
    """
    narrow = measured(docs.select("text", "lang", "source")).drop("text")
    bounds = stored(limits(sketches(narrow)), "quality-limits")
    return judged(measured(docs), bounds).where(F.col(MARK + "kept")).select(*docs.columns)


def _ratio(name: str) -> Column:
    """A whole number; 0 where the divisor is 0.

    Of symbols only as many count as their number is sure to be above, two standard errors
    down, so that one or a few in a short text say nothing.
    """
    m = {measure: F.col(MARK + measure) for measure in MEASURES}
    sure = F.floor(F.greatest(m["n_symbols"] - 2 * F.sqrt(m["n_symbols"]), F.lit(0.0)))
    top, bottom = {
        "symbols": (1000 * sure, m["word_chars"]),
        "dup_lines": (1000 * m["n_dup_lines"], m["n_words"]),
        "repeat_words": (1000 * m["n_repeat_words"], m["n_words"]),
        "word_length": (100 * m["word_chars"], m["n_words"]),
    }[name]
    return F.floor(top / F.greatest(bottom, F.lit(1)))


def _bucket(value: Column) -> Column:
    """The least value of the same bucket. Documents are judged by it, as limits are buckets."""
    shift = F.greatest(F.length(F.bin(value)) - SKETCH_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def _fences(sketch: DataFrame, *keys: str) -> DataFrame:
    """Per group and ratio: n, low and high, from the median and both tails of the sketch."""
    group = Window.partitionBy(*keys, "ratio")
    below = F.sum("n").over(
        group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    tail = F.coalesce(*(F.when(F.col("ratio") == name, F.lit(t)) for name, t in RATIOS.items()))
    ranked = sketch.withColumns({"below": below, "total": F.sum("n").over(group), "tail": tail})
    quantile = lambda p: F.min(
        F.when(1000 * F.col("below") >= p * F.col("total"), F.col("bucket"))
    )
    found = ranked.groupBy(*keys, "ratio").agg(
        F.sum("n").alias("n"),
        quantile(F.lit(500)).alias("middle"),
        quantile(1000 - F.col("tail")).alias("bottom"),
        quantile(F.col("tail")).alias("top"),
    )
    middle = F.col("middle")
    return found.select(
        *keys,
        "ratio",
        "n",
        (middle - REACH * (middle - F.col("bottom"))).alias("low"),
        (middle + REACH * (F.col("top") - middle)).alias("high"),
    )
