"""Chat formatting: a state machine over roles and a declarative template, as columns.

DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.words import filled

START, INVALID = "start", "invalid"


@dataclass(frozen=True)
class ChatTemplate:
    """How a turn is written, which of it bears loss, and which roles may follow which.

    A turn is ``opening``, role, ``middle``, text, ``closing``. Every control string begins
    with ``lead``. Inside roles and texts a backslash is doubled and ``lead`` is broken by
    one, so no control string can be told there and the way back is unique; ``middle``
    inside a role becomes the control string ``role_break``.
    """

    opening: str = "<|im_start|>"
    middle: str = "\n"
    closing: str = "<|im_end|>\n"
    role_break: str = "<|br|>"
    lead: str = "<|"
    loss_roles: tuple[str, ...] = ("assistant",)
    loss_on_closing: bool = False
    #: state -> roles that may come next; a role's name is the state after it.
    order: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            START: ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    final: tuple[str, ...] = ("assistant",)

    def escape(self, text: Column) -> Column:
        doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
        return F.replace(doubled, F.lit(self.lead), F.lit(f"{self.lead[0]}\\{self.lead[1:]}"))

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, r"(?s)\\(.)", "$1")

    def escape_role(self, role: Column) -> Column:
        return F.replace(self.escape(role), F.lit(self.middle), F.lit(self.role_break))

    def unescape_role(self, role: Column) -> Column:
        return self.unescape(F.replace(role, F.lit(self.role_break), F.lit(self.middle)))


def _moves(template: ChatTemplate) -> Column:
    """Transition table as a map from 'state>role' to the next state."""
    entries = [
        F.lit(x) for state, roles in template.order.items() for role in roles for x in (f"{state}>{role}", role)
    ]
    return F.create_map(*entries)


def conversations_of(turns: DataFrame, *, id_col: str = "conv_id") -> DataFrame:
    """(id, turns): each conversation's turns in order, ties by role, then text; nulls are empty."""
    one = F.struct(
        F.col("turn"), filled(F.col("role")).alias("role"), filled(F.col("text")).alias("text")
    )
    return turns.groupBy(id_col).agg(F.sort_array(F.collect_list(one)).alias("turns"))


def format_chats(turns: DataFrame, template: ChatTemplate | None = None, *, id_col: str = "conv_id") -> DataFrame:
    """(id, valid, first_bad, segments, formatted) per conversation of (id, turn, role, text).

    ``segments`` are the parts of the output in order, each with its loss flag, and
    ``formatted`` is all of them joined. The state machine reads the roles in order;
    ``first_bad`` is the 0-based place of the first role that may not stand where it does
    (the number of turns if only the end is wrong), null in a valid conversation. Invalid
    conversations are formatted as well: nothing is dropped. Null roles and texts are
    empty, turns with equal numbers stand by role and text, null turns first, repeated
    rows are turns like any other, and rows with a null id are one conversation.
    """
    t = template or ChatTemplate()
    moves = _moves(t)
    begin = F.struct(F.lit(START).alias("state"), F.lit(None).cast("int").alias("bad"), F.lit(0).alias("at"))

    def step(acc: Column, turn: Column) -> Column:
        state = F.coalesce(F.try_element_at(moves, F.concat(acc["state"], F.lit(">"), turn["role"])), F.lit(INVALID))
        bad = F.coalesce(acc["bad"], F.when(state == INVALID, acc["at"]))
        return F.struct(state.alias("state"), bad.alias("bad"), (acc["at"] + 1).alias("at"))

    def parts(turn: Column) -> Column:
        loss = turn["role"].isin(*t.loss_roles)
        return F.array(
            _segment(F.concat(F.lit(t.opening), t.escape_role(turn["role"]), F.lit(t.middle)), F.lit(False)),
            _segment(t.escape(turn["text"]), loss),
            _segment(F.lit(t.closing), loss & F.lit(t.loss_on_closing)),
        )

    grouped = conversations_of(turns, id_col=id_col)
    read = grouped.select(
        id_col,
        F.aggregate("turns", begin, step).alias("_end"),
        F.flatten(F.transform("turns", parts)).alias("segments"),
    )
    first_bad = F.coalesce(F.col("_end.bad"), F.when(~F.col("_end.state").isin(*t.final), F.col("_end.at")))
    return read.select(
        id_col,
        first_bad.isNull().alias("valid"),
        first_bad.alias("first_bad"),
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
    )


def _segment(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), F.coalesce(loss, F.lit(False)).alias("loss"))


def parse_chats(formatted: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """Add ``turns`` (array of role and text), read back from the column ``formatted`` alone."""
    t = template or ChatTemplate()
    cut = formatted.withColumn("_pieces", F.split("formatted", _literal(t.opening)))
    bodies = F.slice("_pieces", 2, F.greatest(F.size("_pieces") - 1, F.lit(0)))

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, t.middle, 1)
        after = F.length(role) + len(t.middle)
        text = F.substring(piece, after + 1, F.length(piece) - after - len(t.closing))
        return F.struct(t.unescape_role(role).alias("role"), t.unescape(text).alias("text"))

    return cut.withColumn("turns", F.transform(bodies, turn)).drop("_pieces")


def _literal(text: str) -> str:
    return "\\Q" + text + "\\E"


def loss_text(segments: Column, template: ChatTemplate | None = None) -> Column:
    """All text under the loss mask, unescaped, in order."""
    t = template or ChatTemplate()
    kept = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(kept, lambda s: t.unescape(s["text"])), "")
