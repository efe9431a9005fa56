"""Multi-party perspective rotation: every participant's view of a dialogue, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Roles that give instructions and take no part in the dialogue; they keep their own role in every view.
INSTRUCTING = ("system",)

#: Format marks; inside a text they are broken up, so that a text cannot end its own turn.
MARKS = r"<\|(im_start|im_end)\|>"


def rotate_perspectives(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    speaker: str = "role",
    text: str = "text",
    instructing: tuple[str, ...] = INSTRUCTING,
) -> DataFrame:
    """One row per conversation, participant and turn: the turn as it stands in that participant's view.

    The participants of a conversation are its distinct speakers other than the ``instructing`` ones. In
    the view of a participant, its own turns have the role ``assistant`` and are trained on, the turns of
    other participants have the role ``user`` with the speaker's name, and instructing turns keep their role.

    Result columns: ``conv_id``, ``perspective``, ``turn``, ``speaker`` (null for instructing turns),
    ``chat_role``, ``segment`` (header, text and end mark), ``n_chars`` (characters of the segment),
    ``mask_start`` and ``mask_end`` (characters of the segment that count for the loss, half open; equal if
    none), ``in_loss``. The view of a participant is its segments in the order of ``turn``; a segment has all
    that concatenation needs, so no conversation is ever gathered into one row or one task.

    The work is one distinct over (conversation, speaker), with map-side combine, and one equi-join on the
    conversation. A hot conversation is a large partition of a plain join, which adaptive execution splits;
    the rows made are turns times participants, which is the size of the result itself.

    Format marks inside a text or a speaker's name are broken up (``<| im_end |>``), and line breaks in a name become blanks.
    Turns with one number, or without any (these come first), stand in the order of ``speaker`` (instructing turns first) and ``segment``.

    Defined cases: a null conversation is a conversation of its own; a null speaker is the participant named
    ``unknown``; a null text is an empty turn with an empty mask; a null turn number is kept (it sorts first);
    repeated rows give repeated rows; a conversation of instructing turns only has no participant and gives no
    rows; an empty table gives an empty result. Other columns of the input are left out, so none can clash.
    """
    told = F.coalesce(F.col(speaker), F.lit("unknown"))
    rows = turns.select(
        F.col(conversation).alias("conv_id"),
        F.col(turn).alias("turn"),
        told.alias("speaker"),
        F.regexp_replace(F.coalesce(F.col(text), F.lit("")), MARKS, "<| $1 |>").alias("text"),
    )
    instructs = F.col("speaker").isin(*instructing) if instructing else F.lit(False)
    views = rows.where(~instructs).select(F.col("conv_id").alias("view_of"), F.col("speaker").alias("perspective"))
    joined = rows.join(views.distinct(), F.col("conv_id").eqNullSafe(F.col("view_of")))

    own = F.col("speaker") == F.col("perspective")
    role = F.when(instructs, F.col("speaker")).when(own, F.lit("assistant")).otherwise(F.lit("user"))
    # A name cannot end its header either: marks are broken up, and line breaks become blanks.
    plain = F.regexp_replace(F.regexp_replace("speaker", MARKS, "<| $1 |>"), r"[\r\n]", " ")
    name = F.when(instructs | own, F.lit("")).otherwise(F.concat(F.lit(" name="), plain))
    head: Column = F.concat(F.lit("<|im_start|>"), F.col("chat_role"), name, F.lit("\n"))
    # The answer and its end mark are learned, the header is given.
    tail: Column = F.concat(F.col("text"), F.lit("<|im_end|>\n"))
    in_loss = own & ~instructs & (F.length("text") > 0)
    return (
        joined.withColumn("chat_role", role)
        .withColumns({"head": head, "tail": tail, "in_loss": in_loss})
        .select(
            "conv_id",
            "perspective",
            "turn",
            F.when(~instructs, F.col("speaker")).alias("speaker"),
            "chat_role",
            F.concat("head", "tail").alias("segment"),
            (F.length("head") + F.length("tail")).cast("long").alias("n_chars"),
            F.length("head").cast("long").alias("mask_start"),
            F.when(F.col("in_loss"), F.length("head") + F.length("text") + F.length(F.lit("<|im_end|>")))
            .otherwise(F.length("head"))
            .cast("long")
            .alias("mask_end"),
            "in_loss",
        )
    )
