"""Input tables and corpus sources / sinks."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import check_columns


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


# S1 -------------------------------------------------------------------------
def read_corpus(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Load a corpus split. With a schema, the files' own columns are checked
    first (a missing column, or one of another type, is an error) and the
    scan reads only the schema's columns."""
    df = spark.read.parquet(path)
    if schema is None:
        return df
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return check_columns(df, wanted).select(*wanted.fieldNames())


# S2 -------------------------------------------------------------------------
def read_config(df_or_path, config: str, spark: SparkSession | None = None,
                column: str = "config") -> DataFrame:
    """Select one named config. On a ``config=`` partitioned folder the
    equality filter prunes whole directories; on a plain table it is pushed
    into the Parquet scan."""
    df = spark.read.parquet(df_or_path) if isinstance(df_or_path, str) else df_or_path
    return df.where(F.col(column) == F.lit(config))


# S3 -------------------------------------------------------------------------
def read_limited(df: DataFrame, limit: int | None) -> DataFrame:
    """Lazy read with a row limit (the first ``limit`` rows in scan order)."""
    return df if limit is None else df.limit(int(limit))


def read_first(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The first ``n`` rows of saved Parquet files, in order of file and row.

    Rows per file come from the files' footers (a scan of no column); the file
    where the n-th row lies is found on their stream, and the rows are then
    filtered where they are read. Nothing passes through one task, and a rerun
    gives the same rows."""
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).count().orderBy("file")
    rows, left = spark.read.parquet(path), n
    file = F.col("_metadata.file_path")
    for f in files.toLocalIterator():
        if f["count"] >= left:
            return rows.where((file < f["file"]) | ((file == f["file"]) & (F.col("_metadata.row_index") < left)))
        left -= f["count"]
    return rows


# S4 / S5 ------------------------------------------------------------------
def write_splits(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Save a split dataset: one folder per split (``split=train``/``test``)."""
    df.write.mode(mode).partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if split is None else df.where(F.col("split") == split)


# S6 / S7 ------------------------------------------------------------------
def write_exclusions(authors: DataFrame, path: str, column: str = "author") -> None:
    """One author per line, UTF-8 text."""
    authors.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def read_exclusions(spark: SparkSession, path: str) -> DataFrame:
    """Exclusion list: lines stripped, blanks dropped, distinct. An absent
    path gives an empty list."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "author string")
    from ..operators.gates import py_strip
    lines = spark.read.text(path)
    return (lines.select(py_strip(F.col("value")).alias("author"))
            .where(F.col("author") != "")
            .distinct())


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath)


# S8 -------------------------------------------------------------------------
def write_tokenizer(vocab: DataFrame, merges: DataFrame, stats: dict, path: str) -> None:
    """Tokenizer artefacts: ``vocab`` and ``merges`` tables plus a one-row
    stats JSON written next to them."""
    vocab.write.mode("overwrite").parquet(os.path.join(path, "vocab"))
    merges.write.mode("overwrite").parquet(os.path.join(path, "merges"))
    spark = vocab.sparkSession
    spark.createDataFrame([(json.dumps(stats, ensure_ascii=False),)], "value string") \
        .coalesce(1).write.mode("overwrite").text(os.path.join(path, "tokenizer_stats"))


# S9 -------------------------------------------------------------------------
MANIFEST = "phase string, source string, n_train long, n_test long, seq_len int, effective_batch int"


def write_manifest(manifest: DataFrame, path: str) -> None:
    manifest.coalesce(1).write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).json(path)
