"""A training corpus from raw documents, in five stages.

Each stage is one operator of ``tessera.llm``, takes (spark, docs, sf_dir) and
works on all that the stage before it kept. All but the last return the
columns of ``documents``; the last gives each text's piece ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import cut_lineage, table
from tessera.llm.mixing import mixed_documents
from tessera.llm.ngram_join import one_of_each
from tessera.llm.pieces import round_trip
from tessera.llm.quality_pu import keep_good
from tessera.llm.toxicity import drop_toxic


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: rejected documents go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: rejected documents go."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join, on shingles of five words from a similarity of 0.8:
    the smallest id of each group stays."""
    return one_of_each(docs, n=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights: the words the mix takes, repeats as rows."""
    return mixed_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece encoding, checked by decoding: doc_id, ids, n_ids, lossless."""
    return round_trip(docs)


STAGES = [
    ("quality classifier", quality),
    ("toxicity", toxicity),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources", mixing),
    ("SentencePiece encoding", encoding),
]

#: Fitted models, permutations and sampled segmentations have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is staged before the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
