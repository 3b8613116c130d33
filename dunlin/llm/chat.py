"""Chat formatting: a finite-state machine over roles and a declarative template.

Every turn becomes segments of text with a loss flag. A conversation may hold any number
of rows: turns are formatted one by one, the machine looks at neighbours only, and digests
run over a sorted stream.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """What stands around a turn, whose text is trained on, and which role may follow which."""

    start: str = "<|im_start|>"
    end: str = "<|im_end|>"
    after_role: str = "\n"
    after_turn: str = "\n"
    trained: tuple[str, ...] = ("assistant",)
    # Role before ("" at the start) -> roles allowed.
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    last: tuple[str, ...] = ("assistant",)  # states a conversation may end in


CHATML = Template()


def escape(text):
    """Put a backslash into every ``<|``, also where backslashes stand between already.

    No control string is left in the result, and ``unescape`` undoes it for any text.
    Works on a column.
    """
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def escape_role(role):
    """As ``escape``; line ends and backslashes are written out too, so a role stays in its line."""
    written = F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return escape(written)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def unescape_role(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(text))


def format_chat(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """Segments ``conv_id, place, part, kind, text, loss, turn_ok`` of rows ``conv_id, turn, role, text``.

    The segments of a conversation in order of ``place, part`` spell its formatted text:
    a head (kind ``head``), the escaped text (kind ``text``) and an end (kind ``end``).
    ``loss`` is true for texts of trained roles. ``turn_ok`` tells whether the machine
    accepts the role after the one before; ``ends_ok`` on the last turn whether it may end there.

    Rows are ordered by turn (null first), role, text; equal rows are separate turns.
    Null text or role counts as empty; a null ``conv_id`` is a conversation of its own.
    Conversations with a turn out of order are formatted all the same and flagged. Other
    columns are ignored; an empty table gives no rows.
    """
    none = F.lit("")
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), none).alias("role"),
        F.coalesce(F.col("text").cast("string"), none).alias("text"),
    )
    # The window streams rows in order and keeps neighbours only.
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumns(
        {"place": F.row_number().over(order).cast("long"), "before": F.lag("role").over(order), "next": F.lead("role").over(order)}
    )
    state = F.coalesce("before", none)
    allowed = F.lit(False)
    for role, after in template.follows.items():
        fits = F.col("before").isNull() if role == "" else F.col("before").isNotNull() & (state == role)
        allowed |= fits & F.col("role").isin(*after)
    ends = F.col("next").isNotNull() | F.col("role").isin(*template.last)
    trained = F.col("role").isin(*template.trained)
    head = F.concat(F.lit(template.start), escape_role(F.col("role")), F.lit(template.after_role))
    parts = F.array(
        F.struct(F.lit(0).alias("part"), F.lit("head").alias("kind"), head.alias("text"), F.lit(False).alias("loss")),
        F.struct(F.lit(1).alias("part"), F.lit("text").alias("kind"), escape(F.col("text")).alias("text"), trained.alias("loss")),
        F.struct(
            F.lit(2).alias("part"),
            F.lit("end").alias("kind"),
            F.lit(template.end + template.after_turn).alias("text"),
            F.lit(False).alias("loss"),
        ),
    )
    return rows.select("conv_id", "place", (allowed & ends).alias("turn_ok"), F.explode(parts).alias("s")).select(
        "conv_id", "place", "s.part", "s.kind", "s.text", "s.loss", "turn_ok"
    )


def read_chat(segments: DataFrame, template: Template = CHATML) -> DataFrame:
    """Read formatted conversations back, one row per conversation.

    ``n_turns``, ``turns_sha256`` (role, line end, text, line end of each turn, unescaped),
    ``loss_chars`` and ``loss_sha256`` (all text under the loss mask, unescaped),
    ``formatted_chars`` and ``valid``. Segments are streamed in order: a task holds one
    batch and the digests of one conversation, however long it is.
    """
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]
    kinds = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"
    start, after = len(template.start), len(template.after_role)

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, open_, n, lost, chars, valid = None, False, 0, 0, 0, True
        turns = loss = None

        def row():
            return [None if key != key else key, n, turns.hexdigest(), lost, loss.hexdigest(), chars, valid]

        for frame in frames:
            done = []
            ids = [None if pd.isna(i) else int(i) for i in frame["conv_id"]]
            for conv, kind, text, is_loss, ok in zip(ids, frame["kind"], frame["text"], frame["loss"], frame["turn_ok"]):
                if not open_ or conv != key:
                    if open_:
                        done.append(row())
                    key, open_, n, lost, chars, valid = conv, True, 0, 0, 0, True
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                chars += len(text)
                valid = valid and bool(ok)
                if kind == "head":
                    n += 1
                    turns.update(unescape_role(text[start : len(text) - after]).encode() + b"\n")
                elif kind == "text":
                    plain = unescape(text)
                    turns.update(plain.encode() + b"\n")
                    if is_loss:
                        lost += len(plain)
                        loss.update(plain.encode())
            if done:
                yield _frame(done)
        if open_:
            yield _frame([row()])

    def _frame(rows):
        out = pd.DataFrame(rows, columns=columns)
        return out.astype({"conv_id": "Int64"})

    return segments.repartition("conv_id").sortWithinPartitions("conv_id", "place", "part").mapInPandas(read, kinds)
