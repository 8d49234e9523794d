"""Conversations: nesting (H5), system seeding (W3), history trimming
and context fitting (W1).

W1 and W2 work on the flat turns table with windows over blocks of turns,
so no conversation is ever gathered into one array, or one task, to be
trimmed; W3 works on the nested form, which is the record shape the
chat formats read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.bytelevel import byte_token_count
from ..functions.chat import template_piece


# H5 -----------------------------------------------------------------------
def nest_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(conv_id, turn, role, content) rows -> (conv_id, messages) with the
    messages in turn order."""
    ordered = F.sort_array(F.collect_list(F.struct(F.col(turn).alias("t"), "role", "content")))
    return (turns.groupBy(conv)
            .agg(ordered.alias("__m"))
            .select(conv, F.transform("__m", lambda m: F.struct(m["role"].alias("role"),
                                                                m["content"].alias("content")))
                    .alias("messages")))


# W3 -----------------------------------------------------------------------
def seed_system(messages_df: DataFrame, prompt: str = C.DEFAULT_SYSTEM_PROMPT,
                column: str = "messages") -> DataFrame:
    """Prepend a system message when the conversation does not start with
    one (an empty conversation becomes just the system message)."""
    m = F.col(column)
    sys_msg = F.array(F.struct(F.lit("system").alias("role"), F.lit(prompt).alias("content")))
    starts_with_system = F.coalesce(F.try_element_at(m, F.lit(1))["role"] == "system", F.lit(False))
    empty = F.array().cast("array<struct<role:string,content:string>>")
    return messages_df.withColumn(column, F.when(starts_with_system, m)
                                  .otherwise(F.concat(sys_msg, F.coalesce(m, empty))))


# Positions and running sums of a conversation of any length -----------------
BLOCK = 4096             # turn numbers to a block; rows of one block are ordered in one task


def _placed(turns: DataFrame, conv: str, turn: str, cost: str | None = None) -> DataFrame:
    """Adds ``__rn`` (position from 1) and ``__n`` (turns of the conversation),
    with ``cost`` also ``__first`` (cost of the first turn) and ``__suffix``
    (cost from this turn on).

    Two levels: blocks of turn numbers are summed (map-side first), their
    totals are added up per conversation, and rows are ordered within their
    block only, so a conversation's rows spread over as many tasks as it has
    blocks. Null turns are a block of their own, before the others."""
    block = F.coalesce(F.floor(F.col(turn) / BLOCK), F.lit(-(2 ** 62)))
    rows = turns.withColumn("__block", block)
    value = F.col(cost) if cost else F.lit(0)
    sums = rows.groupBy(conv, "__block").agg(F.count(F.lit(1)).alias("__rows"), F.sum(value).alias("__cost"),
                                             F.min(F.struct(F.col(turn).alias("t"), value.alias("c"))).alias("__head"))
    whole = Window.partitionBy(conv)
    order = whole.orderBy("__block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(1, Window.unboundedFollowing)
    sums = sums.select(F.col(conv).alias("__conv"), F.col("__block").alias("__b"),
                       F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"),
                       F.sum("__rows").over(whole).alias("__n"),
                       F.coalesce(F.sum("__cost").over(after), F.lit(0)).alias("__after"),
                       F.first("__head.c").over(order).alias("__first"))
    rows = rows.join(sums, F.col(conv).eqNullSafe(F.col("__conv")) & (F.col("__block") == F.col("__b")))
    here = Window.partitionBy(conv, "__block")
    out = rows.withColumn("__rn", F.col("__before") + F.row_number().over(here.orderBy(turn)))
    if cost:
        rest = here.orderBy(F.desc(turn)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = out.withColumn("__suffix", F.col("__after") + F.sum(cost).over(rest))
    return out.drop("__conv", "__b", "__block", "__before", "__after")


# W2 -----------------------------------------------------------------------
def trim_history(turns: DataFrame, keep_last: int = C.HISTORY_KEEP_LAST,
                 conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """When a conversation has more than ``keep_last + 1`` messages keep the
    first and the last ``keep_last``; shorter ones are kept whole."""
    return (_placed(turns, conv, turn)
            .where((F.col("__n") <= keep_last + 1) | (F.col("__rn") == 1)
                   | (F.col("__rn") > F.col("__n") - keep_last))
            .drop("__rn", "__n", "__first"))


# W1 -----------------------------------------------------------------------
def message_cost(role=None, content=None):
    """Tokens of one chat-template message (byte variant). Messages are
    delimited by special tokens, so prompt cost is the sum of these plus
    the assistant header."""
    role = F.col("role") if role is None else role
    content = F.col("content") if content is None else content
    return byte_token_count(template_piece(role, content))


HEADER_COST_TEXT = C.ASSISTANT_HEADER


def fit_context(turns: DataFrame, max_tokens: int, cost: str = "cost",
                conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """While the prompt is longer than ``max_tokens`` and has more than two
    messages, drop the oldest message after the first.

    Equivalent closed form: keep the first and the last message, and every
    message whose suffix cost plus the first message's cost plus the header
    fits. ``cost`` must be a per-message token count column."""
    header = byte_token_count(F.lit(HEADER_COST_TEXT))
    return (_placed(turns, conv, turn, cost)
            .where((F.col("__rn") == 1) | (F.col("__rn") == F.col("__n"))
                   | (F.col("__first") + F.col("__suffix") + header <= max_tokens))
            .drop("__rn", "__n", "__first", "__suffix"))
