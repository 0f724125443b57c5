"""Chat formatting by DataFrame functions only: turn order, marked turns, loss flags, and reading back."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START = "start"


@dataclass(frozen=True)
class Template:
    """How turns are marked, which roles may follow which, and which roles' texts count for the loss.

    Each mark holds no line break and starts with < or [. A role without marks of its own gets the
    marks of `other`, with the role's name, URL-encoded, on the first line of the turn.
    """

    marks: dict[str, tuple[str, str]] = field(
        default_factory=lambda: {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
    )
    other: tuple[str, str] = ("[ROLE]", "[/ROLE]")
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    )
    loss: tuple[str, ...] = ("assistant",)

    def control_pattern(self) -> str:
        every = [m for pair in (*self.marks.values(), self.other) for m in pair]
        return "|".join("".join("\\" + c if not c.isalnum() else c for c in m) for m in sorted(every, key=len, reverse=True))


LLAMA = Template()


def escaped(text: Column, template: Template) -> Column:
    """A backslash before every control string, whatever backslashes stand there already."""
    return F.regexp_replace(text, f"(\\\\*(?:{template.control_pattern()}))", r"\\$1")


def unescaped(text: Column, template: Template) -> Column:
    return F.regexp_replace(text, f"\\\\(\\\\*(?:{template.control_pattern()}))", "$1")


def _mark(role: Column, template: Template, side: int) -> Column:
    out = F.lit(template.other[side])
    for name, pair in template.marks.items():
        out = F.when(role == name, F.lit(pair[side])).otherwise(out)
    return out


def turn_segments(conversations: DataFrame, template: Template = LLAMA) -> DataFrame:
    """conv_id, turn, role, in_order, body, is_loss, start, body_start: one row for each turn.

    The finite-state machine's state is the role of the turn before: in_order says whether the
    template lets this role follow it. `body` is the escaped text; the turn's string is the opening
    mark, body and closing mark on lines of their own. start and body_start count characters of the
    conversation's string from 0. Turns are taken in order of turn, then role, then text; null turns
    first. Null roles and texts count as empty; null conv_ids form one conversation.
    """
    rows = conversations.select(
        F.col("conv_id").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    known = F.col("role").isin(*template.marks)
    head = F.when(known, F.lit("")).otherwise(F.concat(F.url_encode("role"), F.lit("\n")))
    rows = rows.withColumn("body", escaped(F.col("text"), template)).withColumn("opening", F.concat(_mark(F.col("role"), template, 0), F.lit("\n"), head))
    rows = rows.withColumn("closing", F.concat(F.lit("\n"), _mark(F.col("role"), template, 1), F.lit("\n")))
    rows = rows.withColumn("size", F.length("opening") + F.length("body") + F.length("closing"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    before = F.lag("role", 1, START).over(order)
    allowed = F.lit(False)
    for state, roles in template.follows.items():
        allowed = allowed | ((before == state) & F.col("role").isin(*roles))
    end = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        rows.withColumn("in_order", allowed)
        .withColumn("position", F.row_number().over(order))
        .withColumn("start", end - F.col("size"))
        .withColumn("body_start", F.col("start") + F.length("opening"))
        .withColumn("is_loss", F.col("role").isin(*template.loss))
        .drop("text", "size")
    )


def format_conversations(conversations: DataFrame, template: Template = LLAMA) -> DataFrame:
    """conv_id, formatted, loss_spans (array of start, length in characters), valid: one row a conversation.

    valid: every turn is one that the template allows after the turn before it. A conversation is
    one value, as a document is; the turns by themselves are in turn_segments.
    """
    turn = F.struct("position", F.concat("opening", "body", "closing").alias("said"), "is_loss", F.col("body_start").alias("start"), F.length("body").alias("length"))
    turns = turn_segments(conversations, template).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(turn)).alias("turns"), F.min("in_order").alias("valid")
    )
    spans = F.transform(F.filter("turns", lambda t: t["is_loss"]), lambda t: F.struct(t["start"], t["length"]))
    return turns.select("conv_id", F.array_join("turns.said", "").alias("formatted"), spans.alias("loss_spans"), "valid")


def read_turns(formatted: Column, template: Template = LLAMA) -> Column:
    """array of (role, text) that a formatted string holds, marks found again and texts unescaped."""
    marks = {name: [F.lit(m) for m in pair] for name, pair in template.marks.items()}
    # a turn ends with a closing mark on a line of its own; inside a text a backslash stands before it
    closings = [pair[1] for pair in (*template.marks.values(), template.other)]
    quoted = "|".join("".join("\\" + c if not c.isalnum() else c for c in m) for m in closings)
    # a line break before a mark belongs to the mark, so a cut leaves opening mark and body
    turns = F.filter(F.split(formatted, f"\n(?:{quoted})\n"), lambda t: t != "")

    def read(turn: Column) -> Column:
        opening = F.substring_index(turn, "\n", 1)
        rest = turn.substr(F.length(opening) + 2, F.length(turn))
        role, body = F.url_decode(F.substring_index(rest, "\n", 1)), rest.substr(F.length(F.substring_index(rest, "\n", 1)) + 2, F.length(rest))
        for name, pair in marks.items():
            role, body = F.when(opening == pair[0], F.lit(name)).otherwise(role), F.when(opening == pair[0], rest).otherwise(body)
        return F.struct(role.alias("role"), unescaped(body, template).alias("text"))

    return F.transform(turns, read)


def read_loss_text(formatted: Column, spans: Column, template: Template = LLAMA) -> Column:
    """All text under the loss mask, unescaped, one text after the other."""
    return F.array_join(F.transform(spans, lambda s: unescaped(formatted.substr((s["start"] + 1).cast("int"), s["length"].cast("int")), template)), "")


def chat_digest(conversations: DataFrame, template: Template = LLAMA) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid, read back from the output."""
    done = format_conversations(conversations, template)
    done = done.withColumn("turns", read_turns(F.col("formatted"), template)).withColumn(
        "loss", read_loss_text(F.col("formatted"), F.col("loss_spans"), template)
    )
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )
