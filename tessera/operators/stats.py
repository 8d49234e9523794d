"""Corpus statistics (A4-A6, S9). Each is one aggregation with map-side
partial aggregation; nothing is collected but the one-row result."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import constants as C
from .order import shuffle_hash


# A4 -----------------------------------------------------------------------
def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter to a stage; the count is filled in by whatever
    action runs the plan (no extra job)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


# A5 -----------------------------------------------------------------------
def length_summary(df: DataFrame, length: str = "length", max_length: int = C.MODEL_MAX_LEN,
                   over_1: int = C.LEN_OVER_1, over_2: int = C.LEN_OVER_2) -> DataFrame:
    """min, max, mean length; rows longer than 4096 and 6144; rows at the
    maximum length."""
    L = F.col(length)
    return df.agg(F.min(L).alias("min_length"), F.max(L).alias("max_length"),
                  F.round(F.avg(L), 6).alias("mean_length"),
                  F.count_if(L > over_1).alias("n_over_1"), F.count_if(L > over_2).alias("n_over_2"),
                  F.count_if(L == max_length).alias("n_at_max"))


# A6 -----------------------------------------------------------------------
def head_rows(df: DataFrame, key: str, n: int = C.HEAD_ROWS, salt: str = f"split-{C.SEED}") -> DataFrame:
    """The first ``n`` rows of a saved split in its stored order -- the
    order the split step produced (the split hash). A TakeOrdered of n
    rows; never a full sort."""
    return df.withColumn("__h", shuffle_hash(F.col(key), salt)).orderBy("__h", key).limit(n).drop("__h")


def head_length_summary(head: DataFrame, ids: str = "input_ids", short: int = C.SHORT_LEN) -> DataFrame:
    L = F.size(ids)
    return head.agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.avg(L), 6).alias("mean_length"),
                    F.max(L).alias("max_length"), F.min(L).alias("min_length"),
                    F.count_if(L < short).alias("n_short"))


# S9 -----------------------------------------------------------------------
def corpus_manifest(split_df: DataFrame, source: str, seq_len: int, batch_size: int,
                    grad_accum: int) -> DataFrame:
    """Data fields of a corpus manifest: rows per split, sequence length,
    effective batch and source name."""
    return split_df.agg(F.count_if(F.col("split") == "train").alias("n_train"),
                        F.count_if(F.col("split") == "test").alias("n_test")) \
        .select(F.lit(source).alias("source"), "n_train", "n_test",
                F.lit(seq_len).alias("seq_len"), F.lit(batch_size * grad_accum).alias("effective_batch"))


def phase_manifests(saved: dict[str, DataFrame], phases: dict = C.PHASES) -> DataFrame:
    """One row a phase: ``saved`` maps a phase to its corpus read back from its
    split folders. Only the split column is asked for, which is a folder name,
    so the counts come from the files' footers."""
    one = []
    for phase, corpus in saved.items():
        source, _, seq_len, _, batch, accum, _, _ = phases[phase]
        one.append(corpus_manifest(corpus.select("split"), source, seq_len, batch, accum)
                   .select(F.lit(phase).alias("phase"), "*"))
    return reduce(DataFrame.unionByName, one)
