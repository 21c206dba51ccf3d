"""Chat formatting: a template turns conversations into segments with loss flags, and back.

The role automaton checks the order of turns; the formatted text of a conversation is its segments
end to end. Control strings inside a text or a role are escaped, so the markers of a turn stand
nowhere else and the output can be read back exactly. DataFrame functions only.

Defined cases: a null text or role is the empty string; turns are ordered by turn, role and text with
nulls first, so ties and repeated rows (each a turn of its own) have one order; rows with a null
conversation id are one conversation; an empty table gives no rows; other columns are left out.
A conversation is one output row, so a single conversation has to fit into a row.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """`opening` role `after_role` text `closing` for each turn. `transitions` are the automaton's:
    from the last role ("" at the start) to the roles that may follow; `final` are the roles it may end on."""

    opening: str = "<|im_start|>"
    after_role: str = "\n"
    closing: str = "<|im_end|>\n"
    controls: tuple[str, ...] = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]")
    escape: str = "\\"
    loss_roles: tuple[str, ...] = ("assistant",)
    transitions: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    final: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        for c in self.controls:
            if len(c) < 2 or c[0] in c[1:] or self.escape in c:
                raise ValueError(f"control string {c!r}: its first character may stand only at its start, the escape nowhere")
        if self.opening not in self.controls or not any(self.closing.startswith(c) for c in self.controls):
            raise ValueError("a turn has to open and close with control strings")

    def escaped(self, text: Column) -> Column:
        """Reversible; the result holds no control string and no `after_role` of one line break."""
        text = F.replace(text, F.lit(self.escape), F.lit(self.escape + "0"))
        for c in self.controls:
            text = F.replace(text, F.lit(c), F.lit(c[0] + self.escape + "1" + c[1:]))
        return text

    def unescaped(self, text: Column) -> Column:
        for code, plain in (("1", ""), ("2", self.after_role), ("0", self.escape)):
            text = F.replace(text, F.lit(self.escape + code), F.lit(plain))
        return text

    def escaped_role(self, role: Column) -> Column:
        return F.replace(self.escaped(role), F.lit(self.after_role), F.lit(self.escape + "2"))


def valid(roles: Column, template: Template) -> Column:
    """Whether the automaton accepts the sequence of roles; its state is the last role, null once it failed."""
    def step(state: Column, role: Column) -> Column:
        out = F.lit(None).cast("string")
        for last, then in template.transitions.items():
            out = F.when((state == last) & role.isin(*then), role).otherwise(out)
        return out

    return F.aggregate(roles, F.lit(""), step, lambda state: F.coalesce(state.isin(*template.final), F.lit(False)))


def format_conversations(turns: DataFrame, template: Template = Template(), conv_id: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: conv_id, valid, segments (text, loss) in order, formatted."""
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    grouped = turns.groupBy(F.col(conv_id).alias("conv_id")).agg(F.sort_array(F.collect_list(one)).alias("turns"))

    def emitted(t: Column) -> Column:
        mark = F.concat(F.lit(template.opening), template.escaped_role(t["role"]), F.lit(template.after_role))
        return F.array(
            F.struct(mark.alias("text"), F.lit(False).alias("loss")),
            F.struct(template.escaped(t["text"]).alias("text"), t["role"].isin(*template.loss_roles).alias("loss")),
            F.struct(F.lit(template.closing).alias("text"), F.lit(False).alias("loss")))

    return (grouped.select("conv_id", valid(F.transform("turns", lambda t: t["role"]), template).alias("valid"),
                           F.flatten(F.transform("turns", emitted)).alias("segments"))
            .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), "")))


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """The turns (role, text) that a formatted conversation says."""
    def turn(body: Column) -> Column:
        at = F.instr(body, template.after_role)
        end = F.length(body) - len(template.closing)
        return F.struct(template.unescaped(F.substring(body, F.lit(1), at - 1)).alias("role"),
                        template.unescaped(F.substring(body, at + len(template.after_role), end - at + 1 - len(template.after_role))).alias("text"))

    bodies = F.split(formatted, re.escape(template.opening))
    return F.transform(F.slice(bodies, F.lit(2), F.greatest(F.size(bodies) - 1, F.lit(0))), turn)


def loss_text(segments: Column, template: Template = Template()) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: template.unescaped(s["text"])), "")
