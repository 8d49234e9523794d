"""Connected components of a link table, as Spark jobs.

Alternates the two star operations of Kiveris et al. (2014) until nothing
changes: every node's larger neighbours, then its smaller ones, are tied to
the smallest neighbour. Minima are aggregated before their shuffle and joined
back, so a node with very many links is never gathered in one task. Each
round is cut from its lineage in the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(r)


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(e: DataFrame) -> DataFrame:
    # every edge runs from its larger to its smaller end
    low = e.groupBy("a").agg(F.min("b").alias("m"))
    tied = e.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.unionByName(low.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """From ``links`` (a, b: long) one row per linked node: id, component
    (the smallest id reachable). Null ends and self-links are ignored;
    repeated links count once; no links: no rows."""
    e = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = cut_lineage(e)
    seen = _state(e)
    while True:
        e = cut_lineage(_small_star(_large_star(e).distinct()).distinct())
        now = _state(e)
        if now == seen:
            break
        seen = now
    # every edge now points at its component's smallest node
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
