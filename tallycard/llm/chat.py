"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the context, and only its text is
trainable. A turn is written as

    <s>[role] text</s>

Control strings inside roles and texts are escaped so that none of `<`, `[`, `]` is left in them: a backslash
becomes two, and these become backslash l, b, e. `unescaped` undoes it exactly.

Defined results
* Turns are ordered by (turn, role, text), nulls first; repeated rows are turns of their own.
* A null text or role is empty. Rows with a null id form one conversation.
* Turns after the last assistant turn, and conversations without one, would be in no example: the whole
  conversation then comes once more with an empty mask.
* An empty table gives no examples.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

# What `unescaped` turns back; the backslash itself is doubled.
_ESCAPES = (("<", "\\l"), ("[", "\\b"), ("]", "\\e"))


def escaped(text):
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for plain, code in _ESCAPES:
        out = F.replace(out, F.lit(plain), F.lit(code))
    return out


def unescaped(text):
    """Backslashes come in pairs but for the one of an escape, so cutting at pairs leaves only escapes."""

    def back(part):
        for plain, code in _ESCAPES:
            part = F.replace(part, F.lit(code), F.lit(plain))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\"), back), "\\")


def examples(conversations):
    """Rows conv_id, example (from 0), formatted, mask_start, mask_end.

    `mask_start` and `mask_end` are code points from the start of `formatted`: the trainable text lies between them.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    written = turns.select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.concat(F.lit("<s>["), escaped(F.col("role")), F.lit("] ")).alias("head"),
        escaped(F.col("text")).alias("body"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    segment = F.concat("head", "body", F.lit("</s>"))
    is_target = F.col("role") == "assistant"
    seen = written.select(
        "conv_id",
        "head",
        "body",
        is_target.alias("is_target"),
        F.lead(F.lit(True)).over(order).isNull().alias("is_last"),
        F.sum(is_target.cast("int")).over(before).alias("example"),
        F.collect_list(segment).over(before).alias("context"),
    )
    # The context is put together only where an example ends.
    ends = seen.where(F.col("is_target") | F.col("is_last")).select(
        "conv_id",
        F.coalesce("example", F.lit(0)).cast("int").alias("example"),
        "is_target",
        F.concat(F.array_join("context", ""), F.col("head")).alias("prompt"),
        "body",
    )
    start = F.char_length("prompt")
    return ends.select(
        "conv_id",
        "example",
        F.concat("prompt", "body", F.lit("</s>")).alias("formatted"),
        start.cast("long").alias("mask_start"),
        F.when(F.col("is_target"), start + F.char_length("body")).otherwise(start).cast("long").alias("mask_end"),
    )


def turns_of(formatted):
    """Array of (role, text) read back from a formatted example."""
    written = F.filter(F.split(formatted, "</s>"), lambda turn: turn != "")

    def turn(segment):
        close = F.instr(segment, "]")
        return F.struct(
            unescaped(F.substring(segment, F.lit(5), close - 5)).alias("role"),
            unescaped(F.substring(segment, close + 2, F.char_length(segment))).alias("text"),
        )

    return F.transform(written, turn)


def masked(formatted, start, end):
    """The trainable text of an example."""
    return unescaped(F.substring(formatted, start.cast("int") + 1, (end - start).cast("int")))


def digest(expanded):
    """One row per conversation, read back from its examples."""
    rows = expanded.select(
        "conv_id",
        "example",
        "formatted",
        F.char_length("formatted").cast("long").alias("chars"),
        masked(F.col("formatted"), F.col("mask_start"), F.col("mask_end")).alias("loss"),
    )
    # The last example is the whole conversation.
    per = rows.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("whole"),
        F.sum("chars").alias("formatted_chars"),
        F.array_sort(F.collect_list(F.struct("example", "loss"))).alias("losses"),
    )
    turns = turns_of(F.col("whole"))
    said = F.transform(
        F.col("turns"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    loss = F.array_join(F.col("losses.loss"), "")
    return (
        per.select("conv_id", turns.alias("turns"), loss.alias("loss"), "formatted_chars")
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
            F.char_length("loss").cast("long").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )
