"""Chat formatting from a declarative template; DataFrame operations only.

A template names, for every role, the marks before and after a turn, whether its text bears
loss, and the roles that may follow.  A finite-state machine, a fold, walks the roles of a
conversation and writes its path, one state a turn; marks and loss flags of the segments are those of
the states.  The result tells whether the order is valid and which turn first breaks it.
Conversations in an invalid order are formatted like others.

Marks begin with ``[`` or ``<``.  In texts ``&``, ``[`` and ``<`` become ``&amp;``,
``&lsqb;`` and ``&lt;``, so no control string can stand in a text and a formatted
conversation can be cut back into its turns without loss.  A role that the template doesn't
name is marked with its escaped name and bears no loss.

Turns are ordered by turn (null first), then role and text; repeated rows stay.  Null texts
and roles count as empty, a null conversation id is a conversation.  One conversation is one
row of the result, so its turns are gathered; that is the feature, not a grouping.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Role:
    """Marks around a turn, whether its text bears loss, and who may speak next."""

    before: str
    after: str
    loss: bool = False
    then: tuple[str, ...] = ()


@dataclass(frozen=True)
class Template:
    """Roles by name; ``first``: who may speak first; ``last``: who may speak last."""

    roles: dict[str, Role] = field(default_factory=lambda: {
        "system": Role("<<SYS>>", "<</SYS>>", then=("user",)),
        "user": Role("[INST] ", " [/INST]", then=("assistant",)),
        "assistant": Role("<s>", "</s>", loss=True, then=("user",)),
    })
    first: tuple[str, ...] = ("system", "user")
    last: tuple[str, ...] = ("assistant", "user")
    #: Around the name of any other role, and after its text.
    other: tuple[str, str, str] = ("[ROLE ", "]", "[/ROLE]")


LLAMA = Template()
#: Characters that begin a mark or an escape, and what stands for them.
ESCAPES = (("&", "&amp;"), ("[", "&lsqb;"), ("<", "&lt;"), ("]", "&rsqb;"))


def escape(text: Column) -> Column:
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


#: State of a turn whose role the template doesn't name.
_OTHER = "-"


def _states(template: Template) -> dict[str, str]:
    """One character for each role."""
    return {name: chr(ord("a") + i) for i, name in enumerate(template.roles)}


def _mark(template: Template, state: Column, role: Column, end: bool) -> Column:
    a, b, c = template.other
    out = F.lit(c) if end else F.concat(F.lit(a), escape(role), F.lit(b))
    for name, code in _states(template).items():
        r = template.roles[name]
        out = F.when(state == code, F.lit(r.after if end else r.before)).otherwise(out)
    return out


def _bears_loss(template: Template, state: Column) -> Column:
    return state.isin([code for name, code in _states(template).items() if template.roles[name].loss])


def _walk(template: Template, roles: Column) -> Column:
    """Struct (state, path, broken): the last state, all states in order, and the first turn
    (from 0) whose role the machine doesn't allow, null if none."""
    codes = _states(template)

    def step(s: Column, role: Column) -> Column:
        to = F.lit(_OTHER)
        for name, code in codes.items():
            to = F.when(role == name, F.lit(code)).otherwise(to)
        allowed = F.when(s["state"].isNull(), role.isin(list(template.first))).otherwise(F.lit(False))
        for name, code in codes.items():
            allowed = F.when(s["state"] == code, role.isin(list(template.roles[name].then))).otherwise(allowed)
        broken = F.coalesce(s["broken"], F.when(~F.coalesce(allowed, F.lit(False)), F.length(s["path"])))
        return F.struct(to.alias("state"), F.concat(s["path"], to).alias("path"), broken.alias("broken"))

    start = F.struct(F.lit(None).cast("string").alias("state"), F.lit("").alias("path"), F.lit(None).cast("int").alias("broken"))
    return F.aggregate(roles, start, step)


def format_chats(turns: DataFrame, *, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 template: Template = LLAMA) -> DataFrame:
    """One row per conversation: ``id``, valid, broken_at, segments (array of (text, loss)
    in order) and formatted, the segments' texts joined."""
    c = lambda name: F.col(f"`{name}`")
    said = F.struct(c(turn).alias("turn"), F.coalesce(c(role).cast("string"), F.lit("")).alias("role"),
                    F.coalesce(c(text).cast("string"), F.lit("")).alias("text"))
    rows = turns.select(c(id).alias("_id"), said.alias("_said")).groupBy("_id").agg(F.sort_array(F.collect_list("_said")).alias("_turns"))
    roles = F.transform("_turns", lambda t: t["role"])
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    def emitted(t: Column, i: Column) -> Column:
        state = F.substr(F.col("_fsm.path"), i + 1, F.lit(1))
        return F.array(segment(_mark(template, state, t["role"], False), F.lit(False)),
                       segment(escape(t["text"]), _bears_loss(template, state)),
                       segment(_mark(template, state, t["role"], True), F.lit(False)))

    done = rows.withColumn("_fsm", _walk(template, roles)).withColumn("segments", F.flatten(F.transform("_turns", emitted)))
    valid = F.col("_fsm.broken").isNull() & F.col("_fsm.state").isin([_states(template)[name] for name in template.last])
    return done.select(F.col("_id").alias(id), F.coalesce(valid, F.lit(False)).alias("valid"), F.col("_fsm.broken").alias("broken_at"),
                       "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))


def parse_chat(formatted: Column, template: Template = LLAMA) -> Column:
    """Array of (role, text) read back from a formatted conversation.

    Text holds no ``[``, ``]`` or ``<``, so a lookbehind for the closing marks cuts the
    turns apart, and a turn's text is what its own marks leave.
    """
    quote = lambda s: "\\Q" + s + "\\E"
    a, b, c = template.other
    closing = [r.after for r in template.roles.values()] + [c]
    turns = F.filter(F.split(formatted, "(?<=" + "|".join(map(quote, closing)) + ")"), lambda t: t != "")

    def read(t: Column) -> Column:
        name = unescape(F.substring_index(F.substr(t, F.lit(len(a) + 1)), b, 1))
        inner = F.substr(t, F.locate(b, t) + len(b), F.length(t) - F.locate(b, t) - len(b) + 1 - len(c))
        out = F.struct(name.alias("role"), unescape(inner).alias("text"))
        for role, r in template.roles.items():
            body = F.substr(t, F.lit(len(r.before) + 1), F.length(t) - len(r.before) - len(r.after))
            out = F.when(t.startswith(r.before), F.struct(F.lit(role).alias("role"), unescape(body).alias("text"))).otherwise(out)
        return out

    return F.transform(turns, read)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
