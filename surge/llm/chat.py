"""Chat formatting: a finite-state machine over roles and a declarative template.

A template names, for each role, the state it leads to from each state, the
text before and after its message and whether the message is trained on.  A
conversation is folded turn by turn through the machine; every turn emits three
segments (head, message, tail) with a loss flag each.  Control strings inside
messages are escaped reversibly, so the formatted text parses back to the turns.
Only DataFrame functions run; a conversation is one row, as its output is one text.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """``next_state[state][role]``: the machine; roles it lacks and missing moves lead to ``error``, which is final."""

    head: str = "<|im_start|>{role}\n"
    tail: str = "<|im_end|>\n"
    trained: tuple[str, ...] = ("assistant",)
    start: str = "start"
    accept: tuple[str, ...] = ("assistant",)
    next_state: dict[str, dict[str, str]] = field(default_factory=lambda: {
        "start": {"system": "system", "user": "user"},
        "system": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user"},
    })


CHATML = Template()
ERROR = "error"

# Escaping: every control string opens with "<|"; in a message one backslash more stands between the two signs.
_OPEN, _OPEN_ESCAPED = r"<(\\*)\|", r"<\\(\\*)\|"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _OPEN, r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _OPEN_ESCAPED, r"<$1|")


def escaped_role(role: Column) -> Column:
    out = role
    for sign, code in (("%", "%25"), ("\n", "%0A"), ("<", "%3C")):
        out = F.replace(out, F.lit(sign), F.lit(code))
    return out


def unescaped_role(role: Column) -> Column:
    out = role
    for sign, code in (("<", "%3C"), ("\n", "%0A"), ("%", "%25")):
        out = F.replace(out, F.lit(code), F.lit(sign))
    return out


def _segment(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def format_chats(turns: DataFrame, template: Template = CHATML, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: (conv_id, n_turns, valid, final_state, bad_turn, segments, formatted).

    ``segments`` is an array of (text, loss); ``formatted`` is their concatenation.
    ``valid``: the machine accepts the turn order; ``bad_turn`` is the first turn it has
    no move for (1-based, null if none).  Invalid conversations are formatted too.
    Null texts and roles count as empty (an empty role has no move); turns are ordered by
    (turn, role, text), null turns first, repeated rows are turns of their own.  Rows with a
    null conversation form one conversation.  An empty table gives an empty result; other
    columns are not read.
    """
    rows = turns.select(F.col(f"`{conv_col}`").alias("conv_id"), F.struct(
        F.col(f"`{turn_col}`").alias("turn"), F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")).alias("t"))
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    moves = {f"{state}\n{role}": to for state, by in template.next_state.items() for role, to in by.items()}
    table = F.create_map(*[F.lit(x) for kv in moves.items() for x in kv])

    def step(state: Column, turn: Column) -> Column:
        to = F.coalesce(F.element_at(table, F.concat(state["at"], F.lit("\n"), turn["role"])), F.lit(ERROR))
        seen = state["seen"] + F.lit(1)
        bad = F.when(state["bad"].isNull() & (to == ERROR), seen).otherwise(state["bad"])
        return F.struct(to.alias("at"), seen.alias("seen"), bad.alias("bad"))

    begin = F.struct(F.lit(template.start).alias("at"), F.lit(0).alias("seen"), F.lit(None).cast("int").alias("bad"))
    before, after = template.head.split("{role}")
    segments = F.flatten(F.transform("turns", lambda t: F.array(
        _segment(F.concat(F.lit(before), escaped_role(t["role"]), F.lit(after)), F.lit(False)),
        _segment(escaped(t["text"]), t["role"].isin(list(template.trained))),
        _segment(F.lit(template.tail), F.lit(False)))))
    run = chats.select("conv_id", "turns", F.aggregate("turns", begin, step).alias("end"), segments.alias("segments"))
    return run.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.col("end.at").isin(list(template.accept)).alias("valid"),
        F.col("end.at").alias("final_state"), F.col("end.bad").alias("bad_turn"), "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))


def parse_chat(formatted: Column, template: Template = CHATML) -> Column:
    """The turns of a formatted text: array of (role, text), unescaped."""
    before, after = template.head.split("{role}")
    parts = F.split(formatted, r"\Q" + template.tail + r"\E")
    whole = F.slice(parts, F.lit(1), F.size(parts) - 1)  # what follows the last tail is empty

    def turn(part: Column) -> Column:
        body = F.substring(part, F.lit(len(before) + 1), F.length(part))
        cut = F.instr(body, after)
        return F.struct(unescaped_role(F.substring(body, F.lit(1), cut - 1)).alias("role"),
                        unescaped(F.substring(body, cut + len(after), F.length(body))).alias("text"))

    return F.transform(whole, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")
