"""Chat formatting by prefix-target expansion, built-in expressions only.

Every assistant turn becomes one example: all turns before it as context, the
turn itself as the target, and only the target's text under the loss mask.
A turn is ``<turn ROLE>\\nTEXT</turn>\\n``. Inside a text ``\\`` is written as
``\\b`` and ``<`` as ``\\l`` (in a role ``>`` as ``\\g`` too), so no text holds
a marker and the format reads back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TARGET_ROLE = "assistant"
END = "</turn>\n"


def _swap(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def escape(text: Column) -> Column:
    return _swap(text, [("\\", "\\b"), ("<", "\\l"), (">", "\\g")])


def unescape(text: Column) -> Column:
    return _swap(text, [("\\g", ">"), ("\\l", "<"), ("\\b", "\\")])


def _escape_text(text: Column) -> Column:
    return _swap(text, [("\\", "\\b"), ("<", "\\l")])


def examples(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
             role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, example, text, loss_start, loss_chars): one row per assistant
    turn, ``example`` counted from 0 in each conversation; loss_start (0-based)
    and loss_chars give the masked-in range of ``text`` in code points.

    Turns that no reply follows, and conversations without a reply, come as one
    more row with a null ``example`` and an empty range, so nothing is lost.
    Null role or text: empty. Rows with the same turn number go by role, then
    text; null turn numbers come first; repeated rows stay. Null conv_id is one
    conversation. Other columns are ignored; an empty table gives no rows.
    A conversation must fit one row; its examples repeat the context.
    """
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    head = F.concat(F.lit("<turn "), escape(role), F.lit(">\n"))
    body = _escape_text(text)
    own = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.struct(F.col(turn_col).alias("turn"), role.alias("role"), text.alias("raw"),
                 F.concat(head, body, F.lit(END)).alias("text"), F.length(head).alias("head"),
                 F.length(body).alias("body")).alias("t"))
    convs = (own.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
             .select("conv_id", F.transform("t", lambda x: x["text"]).alias("texts"), F.size("t").alias("n"),
                     F.filter(F.transform("t", lambda x, i: F.struct(
                         i.alias("i"), (x["role"] == TARGET_ROLE).alias("reply"), x["head"].alias("head"),
                         x["body"].alias("body"))), lambda x: x["reply"]).alias("replies")))
    last = F.coalesce(F.try_element_at("replies", F.lit(-1))["i"], F.lit(-1))
    tail = F.when(last < F.col("n") - 1, F.array(F.struct(
        (F.col("n") - 1).alias("i"), F.lit(False).alias("reply"), F.lit(0).alias("head"),
        F.lit(0).alias("body")))).otherwise(F.array().cast("array<struct<i:int,reply:boolean,head:int,body:int>>"))
    rows = convs.select("conv_id", "texts", F.posexplode(F.concat("replies", tail)).alias("k", "r"))
    context = F.array_join(F.slice("texts", F.lit(1), F.col("r.i")), "")
    rows = rows.select("conv_id", "k", "r", context.alias("context"), F.get("texts", F.col("r.i")).alias("own"))
    return rows.select(
        "conv_id", F.when(F.col("r.reply"), F.col("k")).alias("example"),
        F.concat("context", "own").alias("text"),
        F.when(F.col("r.reply"), F.length("context") + F.col("r.head")).otherwise(
            F.length("context") + F.length("own")).cast("long").alias("loss_start"),
        F.col("r.body").cast("long").alias("loss_chars"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the examples alone: n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars (of all rows together)."""
    masked = unescape(F.expr("substring(text, cast(loss_start AS int) + 1, cast(loss_chars AS int))"))
    rows = formatted.select("conv_id", F.length("text").alias("chars"), "text",
                            F.when(F.col("example").isNotNull(), F.struct("example", masked.alias("loss"))).alias("l"))
    convs = rows.groupBy("conv_id").agg(
        F.max_by("text", "chars").alias("whole"), F.sum("chars").alias("formatted_chars"),
        F.sort_array(F.collect_list("l")).alias("l"))
    loss = F.array_join(F.transform("l", lambda x: x["loss"]), "")
    turns = F.filter(F.split("whole", END), lambda x: x != "")
    plain = F.transform(turns, lambda x: F.concat(
        unescape(F.substring_index(F.substring(x, 7, 1 << 30), ">\n", 1)), F.lit("\n"),
        unescape(F.substring(x, F.instr(x, ">\n") + 2, F.length(x))), F.lit("\n")))
    return convs.withColumn("loss", loss).select(
        "conv_id", F.size(turns).cast("long").alias("n_turns"),
        F.sha2(F.array_join(plain, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"))
