"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the context, and only
that reply is trainable.  Turns after the last reply, or all turns of a conversation without one,
make a last example that trains nothing, so that the output holds every turn.

The template of a turn is ``<|turn|>role<|text|>text<|end|>``.  Inside roles and texts a backslash
is doubled and ``|`` becomes ``\\p``; so no control string can occur there, and the escape is
reversible.  The loss mask of an example is the span of its target text, after escaping.

Defined results: a null text or role is empty; null turns come first, and ties go by role and text.
Rows without a conversation id are one conversation, with a null id.  Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
ASSISTANT = "assistant"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\p"))


def unescape(c: Column) -> Column:
    """A doubled backslash is set apart first: between two of them only whole escapes are left."""
    parts = F.split(c, r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda x: F.replace(x, F.lit("\\p"), F.lit("|"))), "\\")


def examples(turns: DataFrame) -> DataFrame:
    """conv_id, example (from 0), context, target, tail, trainable; the formatted example is the three texts together."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    row = F.struct(F.col("turn"), empty("role").alias("role"), empty("text").alias("text"))
    groups = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("turns"))
    shown = groups.select(
        "conv_id",
        F.transform("turns", lambda t: F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT))).alias("heads"),
        F.transform("turns", lambda t: escape(t["text"])).alias("texts"),
        F.transform("turns", lambda t: t["role"] == ASSISTANT).alias("replies"),
    )
    last = F.size("replies")
    at = F.filter(F.sequence(F.lit(1), last), lambda i: F.element_at("replies", i) | (i == last))
    spread = shown.select("*", F.posexplode(at).alias("example", "at"))
    whole = F.transform(F.sequence(F.lit(1), last), lambda i: F.concat(F.element_at("heads", i), F.element_at("texts", i), F.lit(END)))
    before = F.concat(F.array_join(F.slice(whole, F.lit(1), F.col("at") - 1), ""), F.element_at("heads", F.col("at")))
    return spread.select(
        "conv_id",
        "example",
        before.alias("context"),
        F.element_at("texts", F.col("at")).alias("target"),
        F.lit(END).alias("tail"),
        F.element_at("replies", F.col("at")).alias("trainable"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Digest of each conversation, from its examples alone."""
    text = F.concat("context", "target", "tail")
    groups = formatted.groupBy("conv_id").agg(
        F.max(F.struct("example", text.alias("text")))["text"].alias("last"),
        F.sum(F.length(text)).alias("formatted_chars"),
        F.sort_array(F.collect_list(F.when(F.col("trainable"), F.struct("example", unescape(F.col("target")).alias("text"))))).alias("targets"),
    )
    pieces = F.split(F.regexp_replace("last", r"<\|end\|>$", ""), r"<\|end\|>", -1)
    turn = F.transform(pieces, lambda p: F.split(F.substring(p, len(TURN) + 1, 2**31 - 1), r"<\|text\|>", 2))
    plain = F.transform(turn, lambda t: F.concat(unescape(t[0]), F.lit("\n"), unescape(t[1]), F.lit("\n")))
    loss = F.array_join(F.transform("targets", lambda t: t["text"]), "")
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return groups.select(
        "conv_id",
        F.size(turn).cast("long").alias("n_turns"),
        digest(F.array_join(plain, "")).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        digest(loss).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )
