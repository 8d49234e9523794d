"""Views of the record shapes over the driver's tables.

The input tables are ``documents``, ``labels`` and ``conversations``; these
views give them the shapes the data-preparation steps read (story chapters,
corpus documents with a config, nested conversations).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from .tables import read_table

# Fixture parameters (scaled to the driver's tables)
BLOCKED_TAGS = ["grimdark", "harem"]
BLOCKED_WARNINGS = ["toxic"]
VIEWS_THRESHOLD = 1000
FLAG_PATTERN = r"(?i)\b(license|token)\b"
MIN_TOKENS = C.MIN_TOKENS
MAX_TOKENS = C.MAX_TOKENS
TRIM_KEEP_LAST = 3
CONTEXT_MAX = 1500

STORY_COLUMNS = """
  d.doc_id, d.text,
  CASE WHEN d.doc_id % 53 = 0 THEN NULL
       WHEN d.doc_id % 10 = 0 THEN concat('minor', d.doc_id - d.doc_id % 25)
       ELSE concat(d.source, '-', d.doc_id - d.doc_id % 200) END AS author,
  CASE WHEN d.doc_id % 7 = 0 THEN NULL WHEN d.doc_id % 11 = 0 THEN ''
       ELSE concat('  Part ', d.doc_id, ' ') END AS chapter_title,
  CAST(d.n_chars AS DOUBLE) AS average_views,
  CASE WHEN d.lang = 'fr' THEN array('grimdark', 'fr') ELSE array(d.lang) END AS tags,
  CASE WHEN l.toxic = 1 THEN array('toxic') WHEN l.quality = 0 THEN array('low_quality')
       WHEN l.doc_id IS NULL THEN NULL ELSE array('none') END AS warnings,
  CASE WHEN d.doc_id % 3 = 0 THEN 'story' ELSE 'textbook' END AS format
"""


def stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Story chapters: (doc_id, text, author, chapter_title, average_views,
    tags, warnings, format). Labels are joined on doc_id; Spark picks the
    join strategy from the table sizes."""
    d = read_table(spark, sf_dir, "documents").alias("d")
    lab = read_table(spark, sf_dir, "labels").alias("l")
    joined = d.join(lab, F.col("d.doc_id") == F.col("l.doc_id"), "left")
    return joined.selectExpr(*[c.strip() for c in _split_columns(STORY_COLUMNS)])


def corpus(spark: SparkSession, sf_dir: str, with_token_length: bool = True,
           only: str | None = None) -> DataFrame:
    """Corpus documents: (doc_id, text, format, config[, token_length]).

    ``config`` is the document language; ``token_length`` the byte-variant
    token count of the text. ``only`` keeps one format's rows, before the
    count (Spark moves no filter below it, as ``reflect`` is no deterministic
    expression to it).
    """
    from ..functions.bytelevel import byte_token_count
    d = read_table(spark, sf_dir, "documents")
    out = d.select(
        "doc_id", "text",
        F.expr("CASE WHEN doc_id % 3 = 0 THEN 'story' ELSE 'textbook' END").alias("format"),
        F.col("lang").alias("config"))
    if only is not None:
        out = out.where(F.col("format") == only)
    if with_token_length:
        out = out.withColumn("token_length", byte_token_count(F.col("text")).cast("int"))
    return out


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat conversation turns: (conv_id, turn, role, content)."""
    c = read_table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", "role", F.col("text").alias("content"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested conversations: (conv_id, messages ARRAY<STRUCT<role, content>>)."""
    from ..operators.context import nest_turns
    return nest_turns(turns(spark, sf_dir))


def _split_columns(sql: str) -> list[str]:
    """Split a select list on top-level commas."""
    out, depth, cur = [], 0, []
    for ch in sql:
        if ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        if ch == "," and depth == 0:
            out.append("".join(cur))
            cur = []
        else:
            cur.append(ch)
    out.append("".join(cur))
    return [s for s in (x.strip() for x in out) if s]
