"""Chat formatting by prefix-target expansion, in DataFrame functions only.

A turn is written as ``<s>[INST] role [/INST]text</s>``. A control string inside a role
or text gets a backslash after its first character, and one that already has
backslashes there gets one more, so the mark can be taken off again.

Every assistant turn is an example: all turns before it are its context and only its
reply is trainable. Contexts of one conversation are prefixes of one another, so the
output holds each turn once, with its place in the conversation's text; an example
is its target's row and everything before ``loss_start``. ``example_texts`` writes
them out in full, which grows with the square of a conversation's turns.

Turns are ordered by turn (nulls first), then role, then text, so repeated
turn numbers have a defined order and repeated rows stay. Null role or text is empty.
Rows of a null conv_id are one conversation. Running sums go over groups
of 64 turns first, so a long conversation is not summed in one piece.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_GROUP = 64
_CONTROL = r"([<\[])(\\*)(/?s>|/?INST\])"
_ESCAPED = r"([<\[])\\(\\*)(/?s>|/?INST\])"
_TURN = r"(?s)^<s>\[INST\] (.*?) \[/INST\](.*)</s>$"


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), _CONTROL, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def _running(df: DataFrame, sums: dict[str, str]) -> DataFrame:
    """Running sums of columns before each row, per conversation in turn order."""
    order = ["turn", "role", "text"]
    inner = Window.partitionBy("conv_id", "group").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("conv_id").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy("conv_id", "group").agg(*[F.sum(c).alias(f"all_{c}") for c in sums])
    before = totals.select(F.col("conv_id").alias("_conv"), F.col("group").alias("_group"),
                           *[F.coalesce(F.sum(f"all_{c}").over(outer), F.lit(0)).alias(f"before_{c}") for c in sums])
    within = df.select("*", *[F.coalesce(F.sum(c).over(inner), F.lit(0)).alias(f"within_{c}") for c in sums])
    on = F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("group").eqNullSafe(F.col("_group"))
    return within.join(before, on).select(
        *df.columns, *[(F.col(f"within_{c}") + F.col(f"before_{c}")).alias(name) for c, name in sums.items()])


def format_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn_no, start, segment, example_no, loss_start, loss_end).

    ``start`` is where the segment begins in the conversation's text. example_no and the
    loss span, in characters of that text, are null but for assistant turns.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    head = F.concat(F.lit("<s>[INST] "), escaped(F.col("role")), F.lit(" [/INST]"))
    shaped = turns.select(
        "*", F.floor(F.col("turn") / _GROUP).alias("group"), F.concat(head, escaped(F.col("text")), F.lit("</s>")).alias("segment"),
        F.length(head).alias("head"), F.length(escaped(F.col("text"))).alias("reply"),
        (F.col("role") == "assistant").cast("int").alias("target"), F.lit(1).alias("one"))
    shaped = shaped.withColumn("size", F.length("segment"))
    placed = _running(shaped, {"size": "start", "one": "turn_no", "target": "example_no"})
    loss = F.when(F.col("target") == 1, F.col("start") + F.col("head"))
    return placed.select("conv_id", "turn_no", "start", "segment",
                         F.when(F.col("target") == 1, F.col("example_no")).alias("example_no"),
                         loss.alias("loss_start"), (loss + F.col("reply")).alias("loss_end"))


def parse_turns(formatted: DataFrame) -> DataFrame:
    """(conv_id, turn_no, role, text, reply): the turns again, and the text under the loss mask."""
    masked = F.expr("substring(segment, cast(loss_start - start + 1 as int), cast(loss_end - loss_start as int))")
    return formatted.select(
        "conv_id", "turn_no", unescaped(F.regexp_extract("segment", _TURN, 1)).alias("role"),
        unescaped(F.regexp_extract("segment", _TURN, 2)).alias("text"), unescaped(masked).alias("reply"),
        F.length("segment").alias("chars"))


def example_texts(formatted: DataFrame) -> DataFrame:
    """(conv_id, example_no, text, loss_start, loss_end): every example in full, up to the end of its target."""
    target = formatted.where(F.col("example_no").isNotNull()).select(
        F.col("conv_id").alias("_conv"), F.col("turn_no").alias("_last"), F.col("example_no").alias("_example"),
        F.col("loss_start").alias("_from"), F.col("loss_end").alias("_to"))
    on = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("turn_no") <= F.col("_last"))
    parts = F.array_sort(F.collect_list(F.struct("turn_no", "segment")))
    return formatted.join(target, on).groupBy("_conv", "_example", "_from", "_to").agg(
        F.array_join(F.transform(parts, lambda p: p["segment"]), "").alias("text")).select(
        F.col("_conv").alias("conv_id"), F.col("_example").alias("example_no"), "text",
        F.col("_from").alias("loss_start"), F.col("_to").alias("loss_end"))


def trained_texts(examples: DataFrame) -> DataFrame:
    """(conv_id, example_no, reply): what each example's loss mask covers, unescaped."""
    masked = F.expr("substring(text, cast(loss_start + 1 as int), cast(loss_end - loss_start as int))")
    return examples.select("conv_id", "example_no", unescaped(masked).alias("reply"))


def joined_in_order(df: DataFrame, key: str, order: str, texts: dict[str, str]) -> DataFrame:
    """Per key the texts in order, back to back; groups of 64 are joined before the shuffle on the key."""
    def one(at: str, c: str) -> Column:
        parts = F.array_sort(F.collect_list(F.struct(at, c)))
        return F.array_join(F.transform(parts, lambda p: p[c]), "").alias(c)

    def join(at: str) -> list[Column]:
        return [one(at, c) for c in texts]

    parts = df.select(key, order, F.floor(F.col(order) / _GROUP).alias("_group"),
                      *[F.coalesce(F.expr(e), F.lit("")).alias(c) for c, e in texts.items()])
    return parts.groupBy(key, "_group").agg(*join(order)).groupBy(key).agg(*join("_group"))
