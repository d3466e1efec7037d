"""Chat formatting: a finite-state machine over roles and a declarative template, in SQL functions.

A conversation's turns are put in order of (turn, role, text), nulls first, and walked by the machine
``Template.transitions``; text segments with loss flags are emitted from the template and joined to the
formatted text.  Texts and roles are escaped so that no control string can come from them: the escape
character precedes every escape character and every bar, and in each control string another character
stands before the first bar.  Beside the formatted text stands its loss mask, the lengths of its segments
with a flag each; reading back uses those two alone.

Defined results: a null text is the empty text, a null role the empty role; repeated rows and ties are
turns of their own; rows with a null conv_id are one conversation; an order of roles that the machine
does not allow is formatted all the same, with ``valid`` false and ``first_error`` the index of the
first offending turn; a conversation is one output value, so its turns meet in one row by nature.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """``<|role>|\\n text <|end|>\\n``; loss_roles: whose texts count; transitions: state -> allowed roles."""

    open_mark: str = "<|"
    close_mark: str = ">|\n"
    end_mark: str = "<|end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    transitions: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "start": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )

    def __post_init__(self) -> None:
        for mark in (self.open_mark, self.close_mark, self.end_mark):
            if mark.find("|") < 1 or mark[mark.find("|") - 1] == "\\":
                raise ValueError(f"a control string needs a character that isn't the escape before its first bar: {mark!r}")


DEFAULT = Template()


def escape(c: Column) -> Column:
    """Puts a backslash before each backslash and each bar."""
    return F.regexp_replace(c, r"([\\|])", r"\\$1")


def unescape(c: Column) -> Column:
    """The inverse of ``escape``."""
    return F.regexp_replace(c, r"\\([\\|])", "$1")


def _walk(turns: Column, template: Template) -> Column:
    """The index of the first turn that the machine refuses, or -1."""
    allowed = F.create_map(*[F.lit(x) for state, roles in template.transitions.items() for r in roles for x in (f"{state}>{r}", r)])
    state = F.struct(F.lit("start").alias("at"), F.lit(0).alias("i"), F.lit(-1).alias("bad"))

    def step(acc: Column, turn: Column) -> Column:
        ok = F.try_element_at(allowed, F.concat(acc["at"], F.lit(">"), turn["role"])).isNotNull()
        return F.struct(
            turn["role"].alias("at"),
            (acc["i"] + 1).alias("i"),
            F.when((acc["bad"] < 0) & ~ok, acc["i"]).otherwise(acc["bad"]).alias("bad"),
        )

    return F.aggregate(turns, state, step, lambda acc: acc["bad"])


def format_chats(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """conv_id, segments (array of text, loss), formatted, mask (array of chars, loss), valid, first_error for each conversation."""
    row = F.struct("turn", F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    convs = turns.select("conv_id", row.alias("turn_row")).groupBy("conv_id").agg(F.sort_array(F.collect_list("turn_row")).alias("turns"))
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    segments = F.flatten(
        F.transform(
            "turns",
            lambda t: F.array(
                segment(F.concat(F.lit(template.open_mark), escape(t["role"]), F.lit(template.close_mark)), F.lit(False)),
                segment(escape(t["text"]), t["role"].isin(*template.loss_roles)),
                segment(F.lit(template.end_mark), F.lit(False)),
            ),
        )
    )
    bad = _walk(F.col("turns"), template)
    return (
        convs.select("conv_id", segments.alias("segments"), bad.alias("first_error"))
        .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
        .withColumn("mask", F.transform("segments", lambda s: F.struct(F.length(s["text"]).alias("chars"), s["loss"].alias("loss"))))
        .withColumn("valid", F.col("first_error") < 0)
    )


def parse_chats(formatted: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Adds ``parsed`` (array of role, text, loss), read back from ``formatted`` and ``mask`` alone.

    A turn is three segments of the mask; if their lengths aren't those of the formatted turn, the read fails.
    """
    pieces = F.split("formatted", rf"\Q{template.end_mark}\E", -1)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    head = len(template.close_mark) - 1

    def parse(piece: Column, i: Column) -> Column:
        close = F.instr(piece, template.close_mark)
        role = F.substring(piece, F.lit(len(template.open_mark) + 1), close - 1 - len(template.open_mark))
        text = F.substring(piece, close + len(template.close_mark), F.length(piece))
        turn = [F.get(F.col("mask"), i * 3 + k) for k in range(3)]
        fits = (turn[0]["chars"] == close + head) & (turn[1]["chars"] == F.length(text)) & ~turn[0]["loss"] & ~turn[2]["loss"]
        loss = F.when(fits, turn[1]["loss"]).otherwise(F.raise_error(F.lit("the loss mask doesn't fit the formatted text")).cast("boolean"))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"), loss.alias("loss"))

    return formatted.withColumn("parsed", F.transform(pieces, parse))


def chat_digests(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Per conversation: what reading the formatted text and the loss mask back gives, as digests."""
    back = parse_chats(format_chats(turns, template).drop("segments"), template)
    said = F.array_join(F.transform("parsed", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("parsed", lambda t: t["loss"]), lambda t: t["text"]), "")
    return back.select(
        "conv_id",
        F.size("parsed").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
        "first_error",
    )
