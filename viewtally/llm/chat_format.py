"""Chat formatting by prefix-target expansion.

Each assistant turn becomes an example of its own: the template text of all
turns up to and including it, of which only its reply is trainable.  Because
the template only ever appends, an example is a prefix of its conversation's
formatted text; that text is built once and cut.  Turns after the last reply,
and conversations without a reply, come as one example without a target.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
TRAIN_ROLE = "assistant"

#: (character or mark, what it is written as); undone in reverse order
ESCAPES = (("&", "&amp;"), ("<|", "&lt;|"))
ROLE_ESCAPES = (*ESCAPES, ("\n", "&#10;"))


def escape(text: Column, marks=ESCAPES) -> Column:
    for raw, safe in marks:
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescape(text: Column, marks=ESCAPES) -> Column:
    for raw, safe in reversed(marks):
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def format_chats(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) -> one row per example: conv_id,
    example (from 1), formatted, loss_start (code points before the reply),
    loss_length (code points of the reply as written; 0: no target).

    Null role and text are empty.  Turns go by (turn, role, text), nulls
    first, so ties and repeated rows have a fixed order and all count; null conv_ids
    are one conversation.  An empty table gives no rows; other columns are not
    looked at.  A conversation is the unit: it must fit in a task.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    parts = turns.select("conv_id", "turn", role.alias("role"), text.alias("text")).select(
        "conv_id", "turn", "role", "text",
        F.concat(F.lit(START), escape(F.col("role"), ROLE_ESCAPES), F.lit("\n")).alias("head"),
        escape(F.col("text")).alias("body"))
    by_turn = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    size = F.length("head") + F.length("body") + F.lit(len(END))
    placed = (parts.withColumn("k", F.row_number().over(by_turn))
              .withColumn("stop", F.sum(size.cast("bigint")).over(
                  by_turn.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    turn = F.struct("k", F.concat("head", "body", F.lit(END)).alias("seg"), "stop",
                    (F.col("role") == TRAIN_ROLE).alias("reply"),
                    (F.col("stop") - F.length("body") - len(END)).alias("start"),
                    F.length("body").alias("size"))
    whole = (placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
             .withColumn("text", F.array_join(F.transform("t", lambda x: x["seg"]), "")))
    targets = F.filter("t", lambda x: x["reply"])
    last = F.element_at("t", -1)
    ends = F.concat(F.transform(targets, lambda x: F.struct(x["stop"].alias("stop"), x["start"].alias("start"),
                                                            x["size"].alias("size"))),
                    F.when(~last["reply"], F.array(F.struct(last["stop"].alias("stop"), last["stop"].alias("start"),
                                                            F.lit(0).alias("size"))))
                    .otherwise(F.expr("array()")))
    return (whole.select("conv_id", "text", F.posexplode(ends).alias("i", "e"))
            .select("conv_id", (F.col("i") + 1).alias("example"),
                    F.substring(F.col("text"), F.lit(1), F.col("e.stop").cast("int")).alias("formatted"),
                    F.col("e.start").alias("loss_start"), F.col("e.size").alias("loss_length")))


def read_back(examples: DataFrame) -> DataFrame:
    """What the formatted examples hold, parsed from them alone: conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    reply = unescape(F.substring(F.col("formatted"), (F.col("loss_start") + 1).cast("int"), F.col("loss_length")))
    told = examples.select("conv_id", "example", "formatted", reply.alias("reply"))
    per = told.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("all"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "reply"))),
                                 lambda x: x["reply"]), "").alias("loss"),
        F.sum(F.length("formatted").cast("bigint")).alias("formatted_chars"))
    segs = F.filter(F.split("all", r"<\|im_end\|>\n"), lambda x: x != "")
    line = lambda x: F.concat(
        unescape(F.regexp_extract(x, r"^<\|im_start\|>([^\n]*)\n", 1), ROLE_ESCAPES), F.lit("\n"),
        unescape(F.regexp_extract(x, r"(?s)^<\|im_start\|>[^\n]*\n(.*)$", 1)), F.lit("\n"))
    return per.select("conv_id", F.size(segs).cast("bigint").alias("n_turns"),
                      F.sha2(F.array_join(F.transform(segs, line), ""), 256).alias("turns_sha256"),
                      F.length("loss").cast("bigint").alias("loss_chars"),
                      F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
