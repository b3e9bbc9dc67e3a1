"""Mixing sources to target weights, exact to the word.

Sources in code-point order (null last) have the weights 5, 2, 1, 5, 2, 1, ... and share as
many words as all documents have. A target stops at ``EPOCHS`` times the words of its
source; what is over is shared again by weight until no target is above. Documents of a
source are put in order of a hash of their doc_id and text. A source whose target is e times its words
plus a rest gives every document e times and then its documents in order up to the rest; the
document at the cut gives its first words only, so the budget is met to the word.

The order is kept distributed: the leading hex digits of the hash cut a source into ranges
of about ``RANGE`` rows, the words of each range are summed, and prefix sums over the ranges say
where each range begins. Only rows of one range are ever sorted together, so a source
with a third of all rows is many small tasks, also where its documents share one doc_id or have none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm.words import WORD, word_count
from blotter.sources import stored

# The weights of the sources, repeated.
WEIGHTS = (5, 2, 1)
EPOCHS = 3
#: Rows of a source that are sorted together, about.
RANGE = 2000

SPACED_WORD = r"[\x20\x09-\x0D]*" + WORD

MARK = "__mix_"


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target for a table of source and source_size.

    Filling up by weight: sources reach their limit in order of limit / weight. After the
    first k have, the others share the rest; the right k is the first whose shares keep all
    others within their limits. One row per source goes through this.
    """
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("place", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    limit = EPOCHS * F.col("source_size")
    ranked = ranked.withColumns({"weight": weight.cast("long"), "limit": limit})
    filling = Window.orderBy(F.col("limit") / F.col("weight"), "place")
    so_far = filling.rowsBetween(Window.unboundedPreceding, -1)
    from_here = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(so_far), F.lit(0))
    level = rest / F.sum("weight").over(from_here)
    levelled = ranked.withColumn("level", level)
    # The first source, in filling order, that does not reach its limit sets the level.
    free = F.col("level") * F.col("weight") <= F.col("limit")
    filled = levelled.withColumn(
        "common", F.min(F.when(free, F.struct(F.col("limit") / F.col("weight"), "place", "level"))).over(everything)
    )
    capped = F.col("limit") / F.col("weight") < F.col("common.col1")
    target = F.when(capped, F.col("limit").cast("double")).otherwise(
        F.least(F.col("common.level") * F.col("weight"), F.col("limit").cast("double"))
    )
    return filled.select("source", "source_size", target.alias("target"))


def order_key() -> Column:
    """Of doc_id and text, so that rows without an id, or with the same one, are spread, too."""
    digest = F.coalesce(F.md5("text"), F.lit(""))
    return F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), digest))


def mixed(docs: DataFrame, size: Column, key: Column) -> DataFrame:
    """``docs`` with size, source_size, target, epochs, last and taken, named with ``MARK``.

    ``size`` is the number of words of a row, ``key`` its ``order_key``. Rows alike in doc_id and text may change
    places, which changes no count; only they share a key. Every row is there, also those the mix takes nothing of.
    """
    m = lambda name: F.col(MARK + name)
    keyed = docs.withColumns({MARK + "key": key, MARK + "size": size})
    per_source = stored(
        keyed.groupBy("source").agg(F.sum(m("size")).alias("source_size"), F.count("*").alias("rows")),
        "mix-sources",
    )
    # So many hex digits that 16**digits ranges of a source hold about RANGE rows each.
    ranges = F.greatest(F.col("rows") / RANGE, F.lit(1.0))
    digits = per_source.select(
        F.col("source").alias("of"), F.ceil(F.log(16.0, ranges)).cast("int").alias(MARK + "digits")
    )
    plan = targets(per_source.select("source", "source_size"))
    plan = plan.join(digits, F.col("source").eqNullSafe(F.col("of"))).select(
        F.col("source").alias(MARK + "source"),
        F.col("source_size").alias(MARK + "source_size"),
        F.col("target").alias(MARK + "target"),
        MARK + "digits",
    )
    plan = stored(plan, "mix-plan")
    known = keyed.join(plan, keyed["source"].eqNullSafe(plan[MARK + "source"])).withColumn(
        MARK + "range", F.expr(f"substring({MARK}key, 1, {MARK}digits)")
    )

    group = [m("source"), m("range")]
    ahead = Window.partitionBy(m("source")).orderBy(m("range")).rowsBetween(Window.unboundedPreceding, -1)
    sums = known.groupBy(*group).agg(F.sum(m("size")).alias("words"))
    starts = stored(
        sums.select(
            m("source").alias(MARK + "s"),
            m("range").alias(MARK + "r"),
            F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias(MARK + "start"),
        ),
        "mix-ranges",
    )
    inside = (
        Window.partitionBy(*group)
        .orderBy(m("key"), "doc_id", m("size"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = known.withColumn(MARK + "inside", F.coalesce(F.sum(m("size")).over(inside), F.lit(0)))
    placed = placed.join(starts, m("source").eqNullSafe(m("s")) & (m("range") == m("r")))

    budget = F.floor(m("target"))
    whole = F.when(m("source_size") > 0, F.floor(budget / m("source_size"))).otherwise(F.lit(0))
    rest = budget - whole * m("source_size")
    last = F.least(F.greatest(rest - m("start") - m("inside"), F.lit(0)), m("size"))
    return placed.withColumns(
        {
            MARK + "epochs": whole.cast("int"),
            MARK + "last": last.cast("long"),
            MARK + "taken": (whole * m("size") + last).cast("long"),
        }
    )


def mix_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row.

    Null or empty text has size 0 and the mix takes nothing of it. A null source is a
    source. Other columns are not looked at, and only numbers are shuffled.
    """
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("n"), order_key().alias("k"))
    result = mixed(stored(sized, "mix-sizes"), F.col("n"), F.col("k"))
    names = ("size", "source_size", "target", "taken")
    return result.select("doc_id", *(F.col(MARK + name).alias(name) for name in names))


def mix(docs: DataFrame) -> DataFrame:
    """The rows of the mix with the columns of ``docs``.

    A document is there once for each time it is taken whole; the one at the cut of its
    source ends after its last word taken. ``n_chars``, if there is such a column, follows.
    """
    m = lambda name: F.col(MARK + name)
    result = mixed(docs, word_count(F.col("text")), order_key())
    pieces = F.regexp_extract_all("text", F.lit(SPACED_WORD), F.lit(0))
    cut = F.when(m("last") == m("size"), F.col("text")).otherwise(
        F.array_join(F.slice(pieces, F.lit(1), m("last").cast("int")), "")
    )
    copies = F.concat(
        F.array_repeat(F.col("text"), m("epochs")),
        F.when(m("last") > 0, F.array(cut)).otherwise(F.array().cast("array<string>")),
    )
    taken = result.where(m("taken") > 0).withColumn(MARK + "copy", F.explode(copies))
    replaced = {"text": m("copy"), "n_chars": F.length(m("copy")).cast("long")}
    return taken.select(
        *(replaced[name].alias(name) if name in replaced else F.col(name) for name in docs.columns)
    )
