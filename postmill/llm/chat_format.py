"""Chat formatting with a grammar round trip, in DataFrame functions only.

Grammar of a rendered conversation (a conversation is its turns, one after the other):

    user turn       [INST]  mark body [/INST]
    assistant turn  <s>     mark body </s>
    other roles     [ROLE:name] mark body [/ROLE]

``mark`` is a space (body as it is) or ``~`` (escaped body). The parser takes an opening, its mark,
and everything up to the next control string of any kind. A turn is first rendered as it is and
parsed again; if that does not give back the same single turn, its content conflicts with the
grammar and it is escaped and checked again. Escaping maps ``\\`` to ``\\0``, ``<`` to ``\\1``,
``[`` to ``\\2`` and ``]`` to ``\\3``, so an escaped body holds no control string and every turn
recovers. ``recover`` parses the finished text and ``format_conversations`` compares the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN = r"\[INST\]|<s>|\[ROLE:[^\]]*\]"
CONTROL = r"\[INST\]|\[/INST\]|<s>|</s>|\[ROLE:|\[/ROLE\]"
TURN = rf"(?s)({OPEN})([ ~])(.*?)({CONTROL})"
ESCAPES = (("\\", "\\0"), ("<", "\\1"), ("[", "\\2"), ("]", "\\3"))
ASSISTANT = "assistant"


def _lit_replace(c: Column, a: str, b: str) -> Column:
    return F.replace(c, F.lit(a), F.lit(b))


def escape(c: Column) -> Column:
    for a, b in ESCAPES:
        c = _lit_replace(c, a, b)
    return c


def unescape(c: Column) -> Column:
    for a, b in reversed(ESCAPES):
        c = _lit_replace(c, b, a)
    return c


def render(role: Column, body: Column, mark: str) -> Column:
    """One turn as text; ``body`` must already be escaped when ``mark`` is ``~``."""
    opening = (F.when(role == "user", "[INST]").when(role == ASSISTANT, "<s>")
               .otherwise(F.concat(F.lit("[ROLE:"), escape(role), F.lit("]"))))
    closing = F.when(role == "user", "[/INST]").when(role == ASSISTANT, "</s>").otherwise("[/ROLE]")
    return F.concat(opening, F.lit(mark), body, closing)


def recover(formatted: Column) -> Column:
    """Deterministic parser: array of (role, text, closing) read from rendered text."""
    groups = [F.regexp_extract_all(formatted, F.lit(TURN), F.lit(k)) for k in (1, 2, 3, 4)]
    z = F.arrays_zip(*[g.alias(n) for g, n in zip(groups, ("o", "m", "b", "c"))])

    def turn(t: Column) -> Column:
        name = (F.when(t["o"] == "[INST]", "user").when(t["o"] == "<s>", ASSISTANT)
                .otherwise(unescape(F.regexp_extract(t["o"], r"(?s)^\[ROLE:(.*)\]$", 1))))
        text = F.when(t["m"] == "~", unescape(t["b"])).otherwise(t["b"])
        return F.struct(name.alias("role"), text.alias("text"), t["c"].alias("closing"))

    return F.transform(z, turn)


def _same(rendered: Column, role: Column, text: Column) -> Column:
    """Parsing ``rendered`` gives exactly this one turn, closed as its role closes, and nothing else."""
    got = recover(rendered)
    closing = F.when(role == "user", "[/INST]").when(role == ASSISTANT, "</s>").otherwise("[/ROLE]")
    one = F.element_at(got, 1)
    return ((F.size(got) == 1) & (one["role"] == role) & (one["text"] == text) & (one["closing"] == closing)
            & (F.length(rendered) == F.length(render(role, text, " "))))


def format_conversations(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: (conv_id, formatted, turns, identical).

    ``turns`` is what the parser reads back from ``formatted``; ``identical`` says that it equals
    the source. Turns are ordered by (turn, role, text), nulls first, so ties and repeated rows
    have a fixed order. Null role or text counts as empty; a null conversation id is one
    conversation of its own; an empty table gives no rows. Rendering and the turn's own round trip
    run per row; only finished turns are gathered per conversation, whose text is one value.
    """
    t = conversations.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                             F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                             F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    role, text = F.col("role"), F.col("text")
    t = t.withColumn("plain", render(role, text, " "))
    t = t.withColumn("rendered", F.when(_same(F.col("plain"), role, text), F.col("plain"))
                     .otherwise(render(role, escape(text), "~")))
    turn = F.struct("turn", "role", "text", "rendered")
    c = t.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    c = c.select("conv_id", F.array_join(F.transform("t", lambda x: x["rendered"]), "").alias("formatted"),
                 F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("source"))
    c = c.withColumn("turns", F.transform(recover(F.col("formatted")),
                                          lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))))
    return c.select("conv_id", "formatted", "turns", (F.col("turns") == F.col("source")).alias("identical"))


def loss_spans(turns: Column) -> Column:
    """Texts under the loss mask: the assistant turns, in order."""
    return F.transform(F.filter(turns, lambda x: x["role"] == ASSISTANT), lambda x: x["text"])
