"""Chat formatting: a finite-state machine over roles and a declarative template.

Everything is DataFrame functions. The template (``Template``) says how a turn is
opened and closed, which roles may follow which, and which roles carry loss. Each
turn becomes three text segments (opening with the role, the text, the closing
mark), each with a loss flag; a conversation's formatted text is the segments in
order.

Control strings inside a text are escaped reversibly: every ``<``, run of
backslashes, ``|`` gets one more backslash, so an escaped text holds no ``<|``; the
reverse takes one backslash away. Role names are percent-escaped for ``%``, line
feed and ``<``.

Defined results: a null text or role counts as empty; turns are ordered by (turn,
role, text), nulls first, so ties and repeated rows have one order; repeated rows
are kept as turns of their own; rows with a null conv_id form one conversation;
an order of roles that the machine doesn't accept is still formatted, with
``valid`` false and ``first_bad_turn`` the 0-based position of the first such
turn; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """``transitions``: state -> {role: next state}; a role not listed leads to
    the state "bad", which no role leaves. ``accept``: states a conversation may
    end in. ``loss_roles``: roles whose text is under the loss mask."""
    start: str = "<|im_start|>"
    end: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    transitions: dict[str, dict[str, str]] = field(default_factory=lambda: {
        "begin": {"system": "system", "user": "user"},
        "system": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user"},
    })
    accept: tuple[str, ...] = ("assistant",)


CHATML = Template()


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def escape_role(role: Column) -> Column:
    out = F.replace(role, F.lit("%"), F.lit("%25"))
    return F.replace(F.replace(out, F.lit("\n"), F.lit("%0A")), F.lit("<"), F.lit("%3C"))


def unescape_role(role: Column) -> Column:
    out = F.replace(F.replace(role, F.lit("%3C"), F.lit("<")), F.lit("%0A"), F.lit("\n"))
    return F.replace(out, F.lit("%25"), F.lit("%"))


def _next_state(template: Template, state: Column, role: Column) -> Column:
    out = F.lit("bad")
    for s, edges in template.transitions.items():
        for r, to in edges.items():
            out = F.when((state == s) & (role == r), F.lit(to)).otherwise(out)
    return out


def format_conversations(rows: DataFrame, template: Template = CHATML) -> DataFrame:
    """One row per conversation: conv_id, segments (array of text, loss, in order),
    formatted, valid, first_bad_turn. Turns of one conversation meet in one row, as
    its formatted text does."""
    turns = rows.select(
        F.col("conv_id"), F.col("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    conv = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))

    def segments(t: Column) -> Column:
        return F.array(
            F.struct(F.concat(F.lit(template.start), escape_role(t["role"]), F.lit("\n")).alias("text"),
                     F.lit(False).alias("loss")),
            F.struct(escape_text(t["text"]).alias("text"), t["role"].isin(*template.loss_roles).alias("loss")),
            F.struct(F.lit(template.end).alias("text"), F.lit(False).alias("loss")))

    def walk(acc: Column, t: Column) -> Column:
        to = _next_state(template, acc["state"], t["role"])
        bad = F.when(acc["bad"].isNull() & (to == "bad"), acc["n"]).otherwise(acc["bad"])
        return F.struct(to.alias("state"), (acc["n"] + 1).alias("n"), bad.alias("bad"))

    begin = F.struct(F.lit("begin").alias("state"), F.lit(0).alias("n"), F.lit(None).cast("int").alias("bad"))
    return (conv.select("conv_id", F.flatten(F.transform("turns", segments)).alias("segments"),
                        F.aggregate("turns", begin, walk).alias("fsm"))
                .select("conv_id", "segments",
                        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
                        F.col("fsm")["state"].isin(*template.accept).alias("valid"),
                        F.col("fsm")["bad"].alias("first_bad_turn")))


def parse_formatted(formatted: Column, template: Template = CHATML) -> Column:
    """The turns (array of role, text) that a formatted conversation holds."""
    def turn(part: Column) -> Column:
        cut = F.instr(part, "\n")
        body = F.substr(part, cut + 1, F.length(part) - cut - F.lit(len(template.end)))
        return F.struct(unescape_role(F.substr(part, F.lit(1), cut - 1)).alias("role"),
                        unescape_text(body).alias("text"))

    parts = F.split(formatted, template.start.replace("|", r"\|"))
    return F.transform(F.slice(parts, F.lit(2), F.size(parts)), turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    masked = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(masked, lambda s: unescape_text(s["text"])), "")


def conversation_digest(formatted: DataFrame, template: Template = CHATML) -> DataFrame:
    """Sizes and digests read back from ``format_conversations``' output."""
    read = formatted.select("conv_id", "formatted", "valid", "first_bad_turn",
                            parse_formatted(F.col("formatted"), template).alias("turns"),
                            loss_text(F.col("segments")).alias("loss"))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(flat, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid", "first_bad_turn")


def turn_segments(rows: DataFrame, template: Template = CHATML) -> DataFrame:
    """The segments as rows: conv_id, segment (from 0), text, loss, valid."""
    out = format_conversations(rows, template)
    return out.select("conv_id", "valid", F.posexplode("segments").alias("segment", "s")) \
              .select("conv_id", "segment", F.col("s.text").alias("text"), F.col("s.loss").alias("loss"), "valid")
