"""Conversations as training text with a loss mask.

A declarative template says how a turn is written and which roles carry loss; a
finite-state machine over the roles says which orders of turns are valid. A
conversation becomes a list of segments (text, loss), whose concatenation is the
formatted text. Control strings inside texts are escaped, so that the turns can
be read back from the formatted text alone.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """``head`` + role + ``colon`` + text + ``end`` is a turn; ``transitions`` are (state, role, state)."""

    head: str = "### "
    colon: str = ": "
    end: str = "</turn>"
    names: dict[str, str] = field(
        default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"}
    )
    loss: tuple[str, ...] = ("assistant",)
    start: str = "begin"
    accept: tuple[str, ...] = ("answered",)
    transitions: tuple[tuple[str, str, str], ...] = (
        ("begin", "system", "briefed"),
        ("begin", "user", "asked"),
        ("briefed", "user", "asked"),
        ("asked", "assistant", "answered"),
        ("answered", "user", "asked"),
    )


TEMPLATE = Template()


def escape(text: Column, template: Template = TEMPLATE) -> Column:
    """A backslash before each backslash, and inside each control string.

    Afterwards neither the start nor the end of a turn occurs in the text.
    """
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit(template.end), F.lit(template.end[0] + "\\" + template.end[1:]))
    mark = template.head[0]
    return F.replace(out, F.lit(mark), F.lit("\\" + mark))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\s\S])", "$1")


def _literal_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def _final_state(roles: Column, template: Template) -> Column:
    """State after all roles; ``error`` once no transition fits, and from then on."""
    moves = _literal_map({f"{s} {r}": t for s, r, t in template.transitions})
    return F.aggregate(
        roles,
        F.lit(template.start),
        lambda state, role: F.coalesce(F.try_element_at(moves, F.concat_ws(" ", state, role)), F.lit("error")),
    )


def format_chats(conversations: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, valid, segments, formatted``.

    ``segments`` is an array of (text, loss, role); the markers of a turn and its
    text are segments of their own. Turns are ordered by ``turn`` (nulls first),
    then role and text; repeated rows are turns of their own. A null text or role
    is empty; a role that the template doesn't name keeps its own name, escaped,
    and makes the conversation invalid. Rows with a null ``conv_id`` form one
    conversation. Invalid conversations are formatted too, with ``valid`` false.
    Other columns are ignored; an empty table gives no rows.
    """
    role = F.coalesce(F.col("role"), F.lit(""))
    rows = conversations.select(
        "conv_id", F.struct("turn", role.alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t")
    )
    chats = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    names = _literal_map(template.names)

    def segments(t: Column) -> Column:
        shown = F.coalesce(F.try_element_at(names, t["role"]), _own_name(t["role"], template))
        loss = t["role"].isin(*template.loss)
        return F.array(
            _segment(F.concat(F.lit(template.head), shown, F.lit(template.colon)), F.lit(False), t["role"]),
            _segment(escape(t["text"], template), loss, t["role"]),
            _segment(F.lit(template.end + "\n"), F.lit(False), t["role"]),
        )

    out = chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        _final_state(F.transform("turns", lambda t: t["role"]), template).isin(*template.accept).alias("valid"),
        F.flatten(F.transform("turns", segments)).alias("segments"),
    )
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def _own_name(role: Column, template: Template) -> Column:
    """An unnamed role, escaped so that it reads back as itself and not as a named one."""
    shown = F.replace(escape(role, template), F.lit(template.colon), F.lit(template.colon[0] + "\\" + template.colon[1:]))
    return F.when(shown.isin(*template.names.values()), F.concat(F.lit("\\"), shown)).otherwise(shown)


def _segment(text: Column, loss: Column, role: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"), role.alias("role"))


def parse_chats(formatted: Column, template: Template = TEMPLATE) -> Column:
    """Array of (role, text), read back from formatted text alone."""
    roles = _literal_map({shown: role for role, shown in template.names.items()})
    ends = F.split(formatted, r"\Q" + template.end + "\n" + r"\E")

    def turn(piece: Column) -> Column:
        body = F.substring(piece, F.lit(len(template.head) + 1), F.length(piece))
        shown = F.substring_index(body, template.colon, 1)
        text = F.substring(body, F.length(shown) + F.lit(len(template.colon) + 1), F.length(body))
        return F.struct(
            F.coalesce(F.try_element_at(roles, shown), unescape(shown)).alias("role"), unescape(text).alias("text")
        )

    return F.transform(F.slice(ends, F.lit(1), F.size(ends) - 1), turn)


def digest(chats: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Digests of what :func:`format_chats` returns, read back from its segments and formatted text."""
    read = chats.withColumn("read", parse_chats(F.col("formatted"), template))
    masked = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    read = read.withColumn("masked", F.array_join(masked, ""))
    turns = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("read").cast("long").alias("n_turns"),
        F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.length("masked").cast("long").alias("loss_chars"),
        F.sha2(F.col("masked").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )
