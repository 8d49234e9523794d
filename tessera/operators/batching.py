"""Batch assembly and padding accounting.

A batch is a set of rows sharing ``batch_id``. Per-batch maxima come from a
window partitioned by ``batch_id`` -- partitions are one batch (2-16 rows),
so the window never holds more than a batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import arrays as A


# R4 -----------------------------------------------------------------------
def pad_right_dynamic(df: DataFrame, ids: str = "input_ids", batch: str = "batch_id",
                      pad_id: int = C.PAD_ID) -> DataFrame:
    """Right-pad every row to the longest row of its batch, with a mask."""
    longest = F.max(F.size(ids)).over(Window.partitionBy(batch))
    return (df.withColumn("__L", longest)
            .withColumn("attention_mask", A.mask_right(F.col(ids), F.col("__L")))
            .withColumn(ids, A.pad_right(F.col(ids), F.col("__L"), pad_id))
            .drop("__L"))


# R5 -----------------------------------------------------------------------
def pad_left_dynamic(df: DataFrame, ids: str = "input_ids", batch: str = "batch_id",
                     max_length: int | None = C.MODEL_MAX_LEN, pad_id: int = C.PAD_ID) -> DataFrame:
    """Left padding to ``min(longest in batch, max_length)``; rows longer
    than ``max_length`` keep their last ``max_length`` ids (None: every row
    keeps all its ids)."""
    longest = F.max(F.size(ids)).over(Window.partitionBy(batch))
    cut = F.col(ids)
    if max_length is not None:
        longest = F.least(longest, F.lit(max_length))
        cut = A.truncate_tail(cut, max_length)
    return (df.withColumn("__L", longest)
            .withColumn(ids, cut)
            .withColumn("attention_mask", A.mask_left(F.col(ids), F.col("__L")))
            .withColumn(ids, A.pad_left(F.col(ids), F.col("__L"), pad_id))
            .drop("__L"))


# narrow batch plans ---------------------------------------------------------
def batch_lengths(assign: DataFrame, length: str = "length", batch: str = "batch_id",
                  max_length: int | None = None) -> DataFrame:
    """On a narrow (key, batch, length) frame: add ``pad_to``, the longest
    row of the batch (capped at ``max_length``). Padding the wide rows then
    needs no window: join this back by key and pad row by row, so the token
    arrays are shuffled once (for the join) instead of once per window."""
    longest = F.max(length).over(Window.partitionBy(batch))
    if max_length is not None:
        longest = F.least(longest, F.lit(max_length))
    return assign.withColumn("pad_to", longest.cast("int"))


def pad_rows_left(df: DataFrame, ids: str = "input_ids", pad_to: str = "pad_to",
                  max_length: int = C.MODEL_MAX_LEN, pad_id: int = C.PAD_ID) -> DataFrame:
    cut = A.truncate_tail(F.col(ids), max_length)
    return (df.withColumn(ids, cut)
            .withColumn("attention_mask", A.mask_left(F.col(ids), F.col(pad_to)))
            .withColumn(ids, A.pad_left(F.col(ids), F.col(pad_to), pad_id)))


def pad_rows_right(df: DataFrame, ids: str = "input_ids", pad_to: str = "pad_to",
                   pad_id: int = C.PAD_ID) -> DataFrame:
    return (df.withColumn("attention_mask", A.mask_right(F.col(ids), F.col(pad_to)))
            .withColumn(ids, A.pad_right(F.col(ids), F.col(pad_to), pad_id)))


# A11 ----------------------------------------------------------------------
def padding_waste(df: DataFrame, length: str = "length", batch: str = "batch_id",
                  fixed_length: int = C.MODEL_MAX_LEN) -> DataFrame:
    """Fixed-length padding vs padding to the longest row of each batch:
    tokens processed, real tokens, waste percentages and the speed-up.
    Two aggregation levels (per batch, then total), both map-side combined."""
    per_batch = df.groupBy(batch).agg(F.count(F.lit(1)).alias("rows"),
                                      F.max(length).alias("longest"),
                                      F.sum(length).alias("real"))
    t = per_batch.agg(F.sum("rows").alias("n_rows"),
                      F.sum("real").alias("real_tokens"),
                      F.sum(F.col("rows") * F.col("longest")).alias("dynamic_tokens"))
    fixed = F.col("n_rows") * F.lit(fixed_length)
    return t.select(
        "n_rows", "real_tokens",
        fixed.cast("long").alias("fixed_tokens"),
        F.col("dynamic_tokens").cast("long").alias("dynamic_tokens"),
        F.round((1 - F.col("real_tokens") / fixed) * 100, 3).alias("fixed_waste_pct"),
        F.round((1 - F.col("real_tokens") / F.col("dynamic_tokens")) * 100, 3).alias("dynamic_waste_pct"),
        F.round(fixed / F.col("dynamic_tokens"), 3).alias("speedup"))


# A12 ----------------------------------------------------------------------
def step_budget(split_counts: DataFrame, batch_size: int, grad_accum: int, epochs: int,
                seconds_per_step: float | None = None) -> DataFrame:
    """``effective = batch * accumulation``; ``steps = n_train // effective
    * epochs``; ``minutes = steps * seconds / 60`` (from split sizes)."""
    eff = batch_size * grad_accum
    n_train = F.sum(F.when(F.col("split") == "train", F.col("n_rows")).otherwise(0))
    out = split_counts.agg(n_train.cast("long").alias("n_train"))
    out = out.select("n_train", F.lit(eff).alias("effective_batch"),
                     (F.floor(F.col("n_train") / eff) * epochs).cast("long").alias("total_steps"))
    if seconds_per_step is not None:
        out = out.withColumn("minutes", F.round(F.col("total_steps") * seconds_per_step / 60, 3))
    return out
