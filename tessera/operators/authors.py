"""Author audit (A1-A3, G7) and author exclusion."""

from __future__ import annotations

import uuid

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..session import checkpoint_dir
from .gates import audit_skip, pattern_flag


def flag_chapters(stories: DataFrame, patterns: Sequence[str],
                  blocked_tags: Sequence[str] = C.EXCLUDE_GENRES,
                  blocked_warnings: Sequence[str] = C.EXCLUDE_WARNINGS,
                  min_views: float = C.MIN_VIEWS) -> DataFrame:
    """Per chapter: ``skip`` (P1) and ``flagged`` (P3, only when not skipped)."""
    skip = audit_skip(blocked_tags=blocked_tags, blocked_warnings=blocked_warnings,
                      min_views=min_views)
    return (stories.withColumn("skip", skip)
            .withColumn("flagged", F.coalesce(pattern_flag(F.col("text"), patterns, F.col("skip")),
                                              F.lit(False))))


# A1 -----------------------------------------------------------------------
def author_stats(flagged: DataFrame) -> DataFrame:
    """``total`` (not skipped), ``bad`` (not skipped and flagged) and
    ``skipped`` per author. Rows without an author are left out (they have
    no name to report). One hash aggregation with a map-side partial step,
    so a prolific author costs one partial row per task, not a hot shuffle
    key."""
    return (flagged.where(F.col("author").isNotNull())
            .groupBy("author")
            .agg(F.count_if(~F.col("skip")).alias("total"),
                 F.count_if(~F.col("skip") & F.col("flagged")).alias("bad"),
                 F.count_if(F.col("skip")).alias("skipped")))


# A2 -----------------------------------------------------------------------
def flag_rule(total=None, bad=None):
    """``total < 3 or bad >= 2 or bad / total > 0.1``; the ratio clause is
    only reached with ``total >= 3``."""
    total = F.col("total") if total is None else total
    bad = F.col("bad") if bad is None else bad
    return ((total < C.FLAG_MIN_TOTAL) | (bad >= C.FLAG_MIN_BAD)
            | (bad / total > C.FLAG_MAX_RATIO))


def flagged_authors(stats: DataFrame) -> DataFrame:
    return stats.where(flag_rule())


# A3 -----------------------------------------------------------------------
def infraction_histogram(stats: DataFrame, bins: int = C.HISTOGRAM_BINS) -> DataFrame:
    """Histogram of ``bad / total`` for authors with ``total >= 3``: ``bins``
    equal-width bins over [min, max], the last bin closed; when all ratios
    are equal the range is widened by 0.5 on each side. Every bin is
    reported, empty ones with 0.

    Bin edges are ``lo + i * (hi - lo) / bins``; a value exactly on an edge
    belongs to the upper bin. The range is one small aggregate whose two
    numbers become literals of the counting job. The authors' ratios are
    checkpointed in between, so the corpus is scanned once."""
    checkpoint_dir(stats.sparkSession)
    ratios = stats.where(F.col("total") >= C.FLAG_MIN_TOTAL) \
        .select((F.col("bad") / F.col("total")).alias("r")).checkpoint()
    row = ratios.agg(F.min("r").alias("mn"), F.max("r").alias("mx")).first()
    spark = stats.sparkSession
    if row is None or row["mn"] is None:
        return spark.createDataFrame([], "bin int, bin_lo double, bin_hi double, n_authors long")
    lo, hi = float(row["mn"]), float(row["mx"])
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    step = (hi - lo) / bins
    r = F.col("r")
    g = F.least(F.greatest(F.floor((r - F.lit(lo)) / F.lit(hi - lo) * bins), F.lit(0)), F.lit(bins - 1))
    idx = (F.when(r < F.lit(lo) + g * F.lit(step), g - 1)
           .when((g < bins - 1) & (r >= F.lit(lo) + (g + 1) * F.lit(step)), g + 1)
           .otherwise(g))
    counts = ratios.groupBy((idx + 1).cast("int").alias("bin")).agg(F.count("*").alias("n_authors"))
    b = F.col("bin")
    all_bins = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return (all_bins.join(counts, "bin", "left")
            .select("bin",
                    F.round(F.lit(lo) + (b - 1) * F.lit(step), 9).alias("bin_lo"),
                    F.round(F.when(b == bins, F.lit(hi)).otherwise(F.lit(lo) + b * F.lit(step)), 9)
                    .alias("bin_hi"),
                    F.coalesce("n_authors", F.lit(0)).cast("long").alias("n_authors")))


# G7 -----------------------------------------------------------------------
def percent_1(num, den):
    """``f"{num/den:.1%}"`` with round-half-even on the tenth of a percent,
    computed in integers (no binary/decimal formatting drift)."""
    scaled = num * 1000
    q = F.floor(scaled / den).cast("long")
    rem = scaled - q * den
    r = (F.when(rem * 2 > den, q + 1)
         .when((rem * 2 == den) & (q % 2 == 1), q + 1).otherwise(q))
    return F.format_string("%d.%d%%", F.floor(r / 10).cast("long"), (r % 10).cast("long"))


def top_flagged(stats: DataFrame, k: int = C.TOP_FLAGGED) -> DataFrame:
    """Authors with ``bad > 0`` ordered by ``bad`` desc, author asc; the top
    ``k`` (a TakeOrdered, no global sort) with the ratio as ``12.3%``."""
    top = stats.where(F.col("bad") > 0).orderBy(F.desc("bad"), F.asc("author")).limit(k)
    return top.select(
        "author", "bad", "total",
        percent_1(F.col("bad"), F.col("total")).alias("ratio_pct"))


# J1 -----------------------------------------------------------------------
def exclude_authors(df: DataFrame, excluded: DataFrame, column: str = "author") -> DataFrame:
    """Left anti-join on the author name; rows without author are kept.

    The exclusion list is an aggregate over the corpus, so it is written
    once to the shared folder and read back: the audit behind it runs once,
    and the planner knows the list's size. A small list is broadcast and the
    chapters never move; beyond ``spark.sql.autoBroadcastJoinThreshold`` the
    join shuffles, and AQE splits a hot author's partition."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/excluded-{uuid.uuid4().hex}"
    excluded.select(F.col(column).alias("__excluded")).where(F.col("__excluded").isNotNull()) \
        .distinct().write.parquet(path)
    ex = spark.read.parquet(path)
    return df.join(ex, F.col(column) == F.col("__excluded"), "left_anti")


def exclusion_list(flagged: DataFrame) -> DataFrame:
    """Exclusion lines as the prepare step reads them: stripped, non-blank,
    distinct."""
    from .gates import py_strip
    return (flagged.select(py_strip(F.col("author")).alias("author"))
            .where(F.col("author") != "").distinct())
