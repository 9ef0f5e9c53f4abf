"""Chat formatting by prefix-target expansion: every assistant turn becomes an example of its own.

An example holds all turns before the reply as context, then the reply, and only the reply's text
is trainable. Control strings inside roles and texts are escaped reversibly: a backslash goes in
after the first character of anything that reads like a control string, backslashes included, so
that one more backslash never collides with one that was there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ranklake.llm.common import present

#: The template: ``TURN role TEXT text END``. Fixed values.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: What texts must not forge: the template's own marks and those of common templates, after their first character.
_REST = r"(\|turn\|>|\|text\|>|\|end\|>|\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\])"
_RAW, _ESCAPED = r"([<\[])(\\*)" + _REST, r"([<\[])\\(\\*)" + _REST


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _RAW, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def expand(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", target: str = "assistant") -> DataFrame:
    """One example per ``target`` turn: ``conv_id, example, turns, formatted, loss_start, loss_end``.

    ``formatted`` is the whole prefix with the reply at its end; characters from ``loss_start`` up to
    ``loss_end`` are trainable. A conversation that does not end with a reply has one more example
    that holds every turn and trains nothing (``loss_start = loss_end``), so that no turn is lost.

    Rows are ordered by turn, null first, then by role and text, so repeated rows stay, side by side. Null
    role and text are empty; null conversation ids are one conversation. Empty tables give no rows; other
    columns are ignored. An example is a prefix of its conversation, so the examples of a
    conversation grow with the square of its length: they are made when read, and what
    is shuffled is each turn once.
    """
    shaped = turns.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("_turn"),
        present(role).alias("_role"), present(text).alias("_plain"),
    )
    body = escape(F.col("_plain"))
    shaped = shaped.withColumn("_body", body).withColumn(
        "_part", F.concat(F.lit(TURN), escape(F.col("_role")), F.lit(TEXT), F.col("_body"), F.lit(END))
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("_turn").asc_nulls_first(), "_role", "_plain")
    placed = shaped.select(
        "conv_id", "_part",
        F.row_number().over(order).alias("_seq"),
        F.sum(F.length("_part")).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("_end"),
        F.length("_body").alias("_size"),
        (F.col("_role") == target).alias("_target"),
        F.lead(F.lit(True), 1, False).over(order).alias("_more"),
    )
    stop = F.col("_end") - len(END)
    start = F.when(F.col("_target"), stop - F.col("_size")).otherwise(stop)
    cut = F.when(
        F.col("_target") | ~F.col("_more"),
        F.struct(F.col("_seq").alias("turns"), F.col("_end").alias("end"), start.alias("start"), stop.alias("stop")),
    )
    whole = placed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("_seq", "_part"))).alias("_parts"),
        F.array_sort(F.collect_list(cut)).alias("_cuts"),
    )
    joined = F.array_join(F.transform("_parts", lambda x: x["_part"]), "")
    each = whole.select("conv_id", joined.alias("_whole"), F.posexplode("_cuts").alias("example", "_cut"))
    return each.select(
        "conv_id", "example", F.col("_cut.turns").cast("long").alias("turns"),
        F.substring(F.col("_whole"), F.lit(1), F.col("_cut.end").cast("int")).alias("formatted"),
        F.col("_cut.start").alias("loss_start"), F.col("_cut.stop").alias("loss_end"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, as an array of ``role`` and ``text``."""
    parts = F.split(formatted, r"<\|end\|>")
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def turn(part: Column) -> Column:
        halves = F.split(F.substring(part, F.lit(len(TURN) + 1), F.length(part)), r"<\|text\|>")
        return F.struct(unescape(halves[0]).alias("role"), unescape(halves[1]).alias("text"))

    return F.transform(parts, turn)


def read_loss(formatted: Column, start: Column, end: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return unescape(F.substring(formatted, (start + 1).cast("int"), (end - start).cast("int")))


def digests(examples: DataFrame) -> DataFrame:
    """What the examples of each conversation say, read back from their formatted text."""
    last = F.col("example") == F.max("example").over(Window.partitionBy("conv_id"))
    told = F.transform(
        read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    read = examples.select(
        "conv_id", "example", F.length("formatted").cast("long").alias("_chars"),
        read_loss(F.col("formatted"), F.col("loss_start"), F.col("loss_end")).alias("_loss"),
        F.when(last, told).alias("_told"),
    )
    told = F.max("_told")
    loss = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("example", "_loss"))), lambda x: x["_loss"]), "")
    done = read.groupBy("conv_id").agg(told.alias("_told"), loss.alias("_loss"), F.sum("_chars").alias("formatted_chars"))
    return done.select(
        "conv_id",
        F.size("_told").cast("long").alias("n_turns"),
        F.sha2(F.array_join("_told", "").cast("binary"), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
