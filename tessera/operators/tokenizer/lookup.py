"""Tokens to ids and back (T9), as joins with the vocabulary table (id, token, ...).

The vocabulary has one row a token; Spark broadcasts it while it is small. The
looked-up column is aggregated first by whoever calls, or not at all: either
way the join adds at most one row to a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ... import constants as C


def tokens_to_ids(rows: DataFrame, vocab: DataFrame, token: str = "token", unknown: int = C.UNK_ID) -> DataFrame:
    """Adds ``id``, that of ``unknown`` for other tokens and null for null, and ``known``."""
    v = vocab.select(F.col("token").alias("__token"), F.col("id").alias("__id"))
    found = F.when(F.col(token).isNotNull(), F.coalesce("__id", F.lit(unknown)))
    return rows.join(v, F.col(token) == F.col("__token"), "left").withColumn("id", found) \
        .withColumn("known", F.col("__id").isNotNull()).drop("__token", "__id")


def ids_to_tokens(rows: DataFrame, vocab: DataFrame, id: str = "id") -> DataFrame:
    """Adds ``token``, null for an id outside the vocabulary."""
    v = vocab.select(F.col("id").alias("__id"), F.col("token").alias("__token"))
    return rows.join(v, F.col(id) == F.col("__id"), "left").withColumn("token", F.col("__token")).drop("__token", "__id")
