"""Chat logs: collapse cumulative snapshots, then render.

A logged conversation is often saved again after every turn. Each conversation gets a chain of hashes,
one for each of its prefixes; the hash of a whole conversation names what a longer one would have to
begin with. Anti-joins on that hash drop conversations that are the beginning of a longer one, and all
but the smallest conv_id of equal ones. What is left is rendered.

Only DataFrame functions are used. Hashes are 256 bits, so that equal hashes mean equal turns.

Defined results: turns come by turn number, nulls first, and by role and text where numbers repeat;
fully repeated turns count once; a null role or text is rendered as empty, but is no equal of an
empty one; a null conv_id is a conversation like any other, and the smallest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from changefold.llm.common import scan, staged

BEGIN, END = "<|im_start|>", "<|im_end|>"


def _said(role: Column, text: Column) -> Column:
    """One turn as text from which role and text can be told apart again."""
    mark = lambda c: F.coalesce(F.concat(F.char_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.concat(mark(role), F.lit("|"), mark(text))


def turns_of(rows: DataFrame) -> DataFrame:
    """conv_id and turns (turn, role, text in order) of every conversation."""
    told = rows.select("conv_id", "turn", "role", "text").distinct()
    turn = F.struct("turn", "role", "text")
    return told.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn), _before).alias("turns"))


def _before(a: Column, b: Column) -> Column:
    order = F.lit(0)
    for field in ("text", "role", "turn"):
        x, y = a[field], b[field]
        here = F.when(x.isNull() & y.isNull(), 0).when(x.isNull(), -1).when(y.isNull(), 1).when(x < y, -1).when(x > y, 1).otherwise(0)
        order = F.when(here != 0, here).otherwise(order)
    return order


def prefix_hashes(turns: str | Column) -> Column:
    """For each turn the hash of the conversation up to it: of the hash before and the turn."""
    link = lambda last, said: F.sha2(F.concat(last, said).cast("binary"), 256)
    return scan(F.transform(turns, lambda t: _said(t["role"], t["text"])), F.lit(""), link, "string")


def maximal(rows: DataFrame) -> DataFrame:
    """conv_id, turns and whole (hash) of conversations that are not the beginning of another."""
    hashed = turns_of(rows).withColumn("prefixes", prefix_hashes("turns"))
    hashed = staged(hashed.withColumn("whole", F.element_at("prefixes", -1)), "chat-hashed")
    inner = hashed.select(F.explode(F.slice("prefixes", F.lit(1), F.size("prefixes") - 1)).alias("whole")).distinct()
    longest = hashed.join(inner, "whole", "left_anti")
    first = longest.groupBy("whole").agg(F.min(F.struct(F.col("conv_id").isNotNull().alias("known"), "conv_id")).alias("keep"))
    kept = first.select("whole", F.col("keep.conv_id").alias("conv_id"))
    same = longest["whole"].eqNullSafe(kept["whole"]) & longest["conv_id"].eqNullSafe(kept["conv_id"])
    return longest.join(kept, same, "left_semi").select("conv_id", "turns", "whole")


def rendered(turns: str | Column) -> Column:
    """The turns as one text."""
    one = lambda t: F.concat(F.lit(BEGIN), F.coalesce(t["role"], F.lit("")), F.lit("\n"), F.coalesce(t["text"], F.lit("")), F.lit(END + "\n"))
    return F.array_join(F.transform(turns, one), "")


def format_chats(rows: DataFrame) -> DataFrame:
    """conv_id, n_turns and rendered of the conversations that stay."""
    return maximal(rows).select("conv_id", F.size("turns").cast("long").alias("n_turns"), rendered("turns").alias("rendered"))
