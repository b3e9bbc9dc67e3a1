"""Chat formatting by a declarative template, with a loss flag for each piece of text.

A template names the control strings, the roles whose texts are learned, and the turns that
may follow each other as transitions of a finite-state machine. A conversation is folded over
its turns by that machine, and becomes a list of segments (text, loss): control strings and
headers without loss, texts with the flag of their role. All of it is DataFrame expressions.

Control strings inside a text are made harmless and can be restored: a backslash is doubled and
``<|`` becomes ``<\\|``. An escaped text has ``<``, one backslash and ``|`` in a row only where a
control string was, so :func:`restored` can undo the two steps in turn. In a role a line break
becomes ``<\\n`` by the same reasoning.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    begin: str = "<|im_start|>"
    end: str = "<|im_end|>"
    #: Roles whose texts are under the loss mask.
    learned: frozenset[str] = frozenset({"assistant"})
    #: (state, role) -> state. A turn without a transition makes the order invalid for good.
    moves: Mapping[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "system",
            ("start", "user"): "user",
            ("system", "user"): "user",
            ("user", "assistant"): "assistant",
            ("assistant", "user"): "user",
        }
    )
    start: str = "start"
    #: States in which a conversation may end.
    final: frozenset[str] = frozenset({"user", "assistant"})


CHATML = Template()
INVALID = "invalid"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def restored(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("<\\n"))


def restored_role(role: Column) -> Column:
    return restored(F.replace(role, F.lit("<\\n"), F.lit("\n")))


def formatted(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """conv_id, state, valid_order, segments, formatted: one row per conversation.

    Turns are ordered by turn (null first), then role, then text; repeated rows are turns of
    their own. Null role or text is as empty text. Rows without a conv_id are one conversation.
    A conversation whose order is invalid is formatted all the same and marked. An empty table
    gives no row. A conversation is one row of the result, so its texts meet in one task; other
    conversations do not.
    """
    plain = turns.select(
        "conv_id",
        F.struct(
            F.col("turn").alias("turn"),
            F.coalesce(F.col("role"), F.lit("")).alias("role"),
            F.coalesce(F.col("text"), F.lit("")).alias("text"),
        ).alias("at"),
    )
    whole = plain.groupBy("conv_id").agg(F.sort_array(F.collect_list("at")).alias("turns"))
    moves = F.create_map(
        *(F.lit(x) for (state, role), to in template.moves.items() for x in (f"{state}\n{role}", to))
    )
    state = F.aggregate(
        "turns",
        F.lit(template.start),
        lambda now, t: F.coalesce(F.try_element_at(moves, F.concat_ws("\n", now, t["role"])), F.lit(INVALID)),
    )
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    no = F.lit(False)
    segments = F.flatten(
        F.transform(
            "turns",
            lambda t: F.array(
                piece(F.concat(F.lit(template.begin), escaped_role(t["role"]), F.lit("\n")), no),
                piece(escaped(t["text"]), t["role"].isin(*template.learned)),
                piece(F.lit(template.end + "\n"), no),
            ),
        )
    )
    result = whole.select("conv_id", state.alias("state"), segments.alias("segments"))
    return result.select(
        "conv_id",
        "state",
        F.col("state").isin(*template.final).alias("valid_order"),
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
    )


def parsed(text: Column, template: Template = CHATML) -> Column:
    """The turns (role, text) of a formatted conversation."""
    parts = F.split(text, re.escape(template.begin).replace("\\<", "<"))
    closing = len(template.end) + 1

    def turn(part: Column) -> Column:
        head = F.instr(part, "\n")
        body = F.substring(part, head + 1, F.length(part) - head - closing)
        return F.struct(
            restored_role(F.substring(part, F.lit(1), head - 1)).alias("role"), restored(body).alias("text")
        )

    return F.transform(F.slice(parts, F.lit(2), F.size(parts)), turn)


def learned_text(segments: Column) -> Column:
    """All text under the loss mask, as it was written."""
    under = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(under, lambda s: restored(s["text"])), "")


def digests(conversations: DataFrame, template: Template = CHATML) -> DataFrame:
    """Counts and digests of what can be read back from :func:`formatted`."""
    read = conversations.select(
        "conv_id",
        "valid_order",
        "formatted",
        parsed(F.col("formatted"), template).alias("turns"),
        learned_text(F.col("segments")).alias("learned"),
    )
    listed = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(listed, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid_order",
    )
