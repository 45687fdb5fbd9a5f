"""Chat formatting (8): a finite-state machine over roles and a declarative template, in DataFrame functions only.

A conversation's turns become text segments, each with a loss flag; their
concatenation is the formatted text.  The machine of the template (state, role
-> state) runs over the turn order and names the state it ends in.  Inside
texts and role names every control character of the template is written as a
backslash pair, so no text can imitate a marker and ``parse`` returns the exact
turns from the formatted text alone.

Defined cases: turns go in order of turn (null first), role, text, so repeated
rows and ties have one order; a null role or text counts as empty; rows with a
null ``conv_id`` are one conversation; roles unknown to the template are
formatted without loss and make the conversation invalid; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, REJECT = "start", "reject"


@dataclass(frozen=True)
class Template:
    """Markers, loss roles and the turn grammar; ``{role}`` in ``prefix`` stands for the escaped role name."""

    prefix: str = "### {role}: "
    suffix: str = "</turn>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    transitions: tuple[tuple[str, str, str], ...] = (
        (START, "system", "system"), (START, "user", "user"), ("system", "user", "user"),
        ("user", "assistant", "assistant"), ("assistant", "user", "user"),
    )
    final: tuple[str, ...] = ("assistant",)
    #: control character -> letter after the backslash; the backslash itself must come first
    escapes: dict[str, str] = field(default_factory=lambda: {"\\": "s", "#": "h", "<": "l", ":": "c"})


DEFAULT = Template()


def escape(text: Column, template: Template = DEFAULT) -> Column:
    for char, letter in template.escapes.items():
        text = F.replace(text, F.lit(char), F.lit("\\" + letter))
    return text


def unescape(text: Column, template: Template = DEFAULT) -> Column:
    for char, letter in reversed(template.escapes.items()):
        text = F.replace(text, F.lit("\\" + letter), F.lit(char))
    return text


def end_state(roles: Column, template: Template = DEFAULT) -> Column:
    """State of the machine after the roles, ``reject`` once no transition fits."""
    def step(state: Column, role: Column) -> Column:
        out = F.lit(REJECT)
        for before, on, after in template.transitions:
            out = F.when((state == before) & (role == on), F.lit(after)).otherwise(out)
        return out

    return F.aggregate(roles, F.lit(START), step)


def format_chat(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """One row per conversation: ``conv_id``, ``state``, ``valid``, ``segments`` (text, loss), ``formatted``."""
    rows = turns.select("conv_id", F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).alias("t"))
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    before, _, after = template.prefix.partition("{role}")
    off = F.lit(False)

    def segments(t: Column) -> Column:
        loss = t["role"].isin(*template.loss_roles) if template.loss_roles else off
        marker = F.concat(F.lit(before), escape(t["role"], template), F.lit(after))
        return F.array(F.struct(marker.alias("text"), off.alias("loss")),
                       F.struct(escape(t["text"], template).alias("text"), loss.alias("loss")),
                       F.struct(F.lit(template.suffix).alias("text"), off.alias("loss")))

    state = end_state(F.transform("turns", lambda t: t["role"]), template)
    out = convs.select("conv_id", state.alias("state"), F.flatten(F.transform("turns", segments)).alias("segments"))
    return out.select("conv_id", "state", F.col("state").isin(*template.final).alias("valid"), "segments",
                      F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))


def parse(formatted: Column, template: Template = DEFAULT) -> Column:
    """The turns (role, text) read back from formatted text."""
    before, _, after = template.prefix.partition("{role}")
    pieces = F.split(formatted, F.lit("\\Q" + template.suffix + "\\E"))
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        body = F.substring(piece, F.lit(len(before) + 1), F.length(piece))
        cut = F.locate(after, body)
        return F.struct(unescape(F.substring(body, F.lit(1), cut - 1), template).alias("role"),
                        unescape(F.substring(body, cut + len(after), F.length(body)), template).alias("text"))

    return F.transform(pieces, turn)


def loss_text(segments: Column, template: Template = DEFAULT) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]),
                                    lambda s: unescape(s["text"], template)), "")


def digest(chats: DataFrame, template: Template = DEFAULT) -> DataFrame:
    read = chats.select("conv_id", "state", "valid", "formatted", parse(F.col("formatted"), template).alias("turns"),
                        loss_text(F.col("segments"), template).alias("loss"))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(flat, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "state", "valid")
