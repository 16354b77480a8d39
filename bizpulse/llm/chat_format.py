"""Conversations as training text: a declarative template, a state machine over roles, segments with loss flags.

Everything is built in: rows of a conversation are gathered into an array in order of turns, the machine walks its roles,
and every turn becomes a header, its text and a footer. Control strings inside texts are broken up by a backslash, so the
markers of the template occur nowhere else, and reading back is a split on them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Names of roles in headers, what is trained on, which role may follow which, and the marks around a turn.

    `follows` maps a role, or "" for the beginning, to the roles that may come next; a conversation may end after the roles
    of `ends`. A header is `opening`, the name of the role, `closing`; roles without a name are written as `other` and their
    bytes in hexadecimal digits.
    """

    names: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    trained: tuple[str, ...] = ("assistant",)
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    )
    ends: tuple[str, ...] = ("assistant",)
    opening: str = "### "
    closing: str = ":\n"
    footer: str = "</turn>\n"
    other: str = "role-"

    def __post_init__(self):
        marks = {self.opening.strip(), self.footer.strip()}
        if any(len(m) < 2 or "\\" in m for m in marks) or not self.closing or "\\" in self.closing:
            raise ValueError("marks need two characters or more besides blanks, and no backslash")
        if len(set(self.names.values())) < len(self.names) or any(
            n.startswith(self.other) or self.closing in n or m in n for n in self.names.values() for m in marks
        ):
            raise ValueError("names of roles must differ, and hold neither marks nor the prefix of other roles")


DEFAULT = Template()


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in pairs.items() for x in pair))


def escaped(text: Column, template: Template = DEFAULT) -> Column:
    """`text` with backslashes doubled and a backslash after the first character of each mark, so that no mark is left."""
    marks = sorted({template.opening.strip(), template.footer.strip()}, key=len, reverse=True)
    found = "|".join(f"{re.escape(m[0])}(?={re.escape(m[1:])})" for m in marks)
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), f"({found})", r"$1\\")


def unescaped(text: Column) -> Column:
    """The text that `escaped` was given: every backslash gives way to the character after it."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _header(role: Column, template: Template) -> Column:
    own = F.concat(F.lit(template.other), F.hex(F.encode(role, "UTF-8")))
    return F.concat(F.lit(template.opening), F.coalesce(F.try_element_at(_map(template.names), role), own), F.lit(template.closing))


def _role(header: Column, template: Template) -> Column:
    """The role that a header's name stands for."""
    hexed = F.decode(F.unhex(F.substr(header, F.lit(len(template.other) + 1))), "UTF-8")
    return F.coalesce(F.try_element_at(_map({n: r for r, n in template.names.items()}), header), hexed)


def _walk(roles: Column, template: Template) -> Column:
    """Number of the first turn that may not follow the one before it; the number of turns if the end is the fault; else null."""
    step = _map({f"{a} {b}": b for a, following in template.follows.items() for b in following})
    start = F.struct(F.lit("").alias("at"), F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("bad"))

    def move(state: Column, role: Column) -> Column:
        to = F.try_element_at(step, F.concat(state["at"], F.lit(" "), role))
        bad = F.when(state["bad"].isNull() & to.isNull(), state["seen"]).otherwise(state["bad"])
        return F.struct(F.coalesce(to, F.lit("")).alias("at"), (state["seen"] + 1).alias("seen"), bad.alias("bad"))

    def finish(state: Column) -> Column:
        return F.when(state["bad"].isNotNull(), state["bad"]).when(~state["at"].isin(*template.ends), state["seen"])

    return F.aggregate(roles, start, move, finish)


def format_chats(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", template: Template = DEFAULT
) -> DataFrame:
    """One row per conversation: `conv_id`, `n_turns`, `valid`, `bad_turn`, `segments`, `formatted`.

    Rows of a conversation are taken by turn; rows of equal turn by role, then text; a null turn comes first. Repeated rows
    are turns each. Null texts and roles count as empty; a null id is a conversation of its own. `segments` is an array of
    (text, loss): per turn a header, the escaped text and a footer, where only texts of trained roles have loss; `formatted`
    is their texts joined. `bad_turn` is the number, from 0, of the first turn that may not stand there, or the number of
    turns if the conversation may not end so; `valid` says that there is none. Conversations that break the order are
    formatted like the others. Other columns of `turns` are not read.

    A conversation becomes one value, so one task holds its text; different conversations spread by their ids.
    """
    told = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    gathered = told.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("told"))

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def parts(t: Column) -> Column:
        return F.array(
            segment(_header(t["role"], template), F.lit(False)),
            segment(escaped(t["text"], template), t["role"].isin(*template.trained)),
            segment(F.lit(template.footer), F.lit(False)),
        )

    bad = _walk(F.transform("told", lambda t: t["role"]), template)
    made = gathered.select(
        "conv_id", F.size("told").cast("long").alias("n_turns"), bad.alias("bad_turn"), F.flatten(F.transform("told", parts)).alias("segments")
    )
    return made.select(
        "conv_id", "n_turns", F.col("bad_turn").isNull().alias("valid"), "bad_turn", "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
    )


def read_chats(formatted: Column, template: Template = DEFAULT) -> Column:
    """The turns of a formatted conversation, an array of (role, text); null and empty text have none."""
    pieces = F.split(formatted, re.escape(template.footer), -1)
    opening, closing = F.lit(template.opening), F.lit(template.closing)

    def turn(piece: Column) -> Column:
        header = F.substring_index(piece, template.closing, 1)
        name = F.substr(header, F.length(opening) + 1)
        text = F.substr(piece, F.length(header) + F.length(closing) + 1)
        return F.struct(_role(name, template).alias("role"), unescaped(text).alias("text"))

    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def loss_text(segments: Column) -> Column:
    """What is trained on: the texts of segments with loss, unescaped, joined without anything between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")
