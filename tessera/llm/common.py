"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, ship_package

#: Java regular expression of one separator run; a word is any run of other characters.
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text; null text: empty array."""
    return F.coalesce(F.array_remove(F.split(text, GAP), ""), F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    """Number of words of a text as long; null text: 0."""
    return F.size(words_of(text)).cast("long")


def bind(value: Column, body) -> Column:
    """``body(x)`` with ``x`` bound to ``value``, which is evaluated once per
    row however often ``body`` uses it (also inside lambdas)."""
    return F.transform(F.array(value), body)[0]


def cut_lineage(df: DataFrame) -> DataFrame:
    """The frame, written once as a Parquet table in the shared folder of
    ``spark.checkpoint.dir`` and read back. Unlike a checkpoint it is
    compressed, later reads take only the columns they need, and its size is
    known to the planner (checkpoints keep the estimates of the plan they
    cut, which multiply beyond bounds in loops of joins)."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._staged_path = path
    if (scope := _SCOPE.get()) is not None:
        scope.append(path)
    return staged


#: Folders staged in the innermost open ``scratch``.
_SCOPE: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


class _Scratch:
    def __init__(self, spark: SparkSession, paths: list[str]):
        self.spark, self.paths, self.kept = spark, paths, []

    def keep(self, *frames: DataFrame) -> None:
        """Leave these staged tables when the scope ends (to the scope around it, if any)."""
        self.kept += [f._staged_path for f in frames]

    def free(self, *frames: DataFrame | None) -> None:
        """Delete these staged tables now: nothing that is still to run reads them."""
        for f in frames:
            path = getattr(f, "_staged_path", None)
            if path in self.paths:
                self.paths.remove(path)
                drop_folder(self.spark, path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[_Scratch]:
    """Tables that ``cut_lineage`` writes within are deleted at the end, but
    for the kept ones. What is returned must read none but these."""
    paths: list[str] = []
    token = _SCOPE.set(paths)
    scope = _Scratch(spark, paths)
    try:
        yield scope
    finally:
        _SCOPE.reset(token)
        for path in paths:
            if path not in scope.kept:
                drop_folder(spark, path)
        if (outer := _SCOPE.get()) is not None:
            outer += [p for p in paths if p in scope.kept]


def row_id(rows: DataFrame, columns: list[str]) -> Column:
    """A 64-bit hash of the columns that stands for a row's values in them.
    No two different rows of the frame share it: that is checked against a
    second hash, and the seed is raised until it holds."""
    for seed in range(100):
        key = F.xxhash64(F.lit(seed), *columns)
        both = rows.select(key.alias("a"), F.xxhash64(F.lit(f"check {seed}"), *columns).alias("b"))
        if not both.groupBy("a").agg(F.min("b").alias("low"), F.max("b").alias("high")).where("low <> high").limit(1).count():
            return key
    raise ValueError("no seed tells the rows apart")


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def python_ready(spark: SparkSession) -> None:
    """Make this package importable in Python workers."""
    ship_package(spark)


def narrow(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """The named columns only, cast to the types the operator computes with
    (so that extra columns, whatever their names, can't clash). A column the
    table lacks is an error."""
    return df.select(*[df[c].cast(t).alias(c) for c, t in types.items()])


def hash_sample(rows: DataFrame, key: str, bound: int, salt: str, total: int | None = None) -> DataFrame:
    """About ``bound`` distinct rows, at most that many, chosen by a hash of ``key``.
    Large tables are first thinned to twice the bound, so that the final
    ordering sees a bounded number of rows."""
    total = rows.count() if total is None else total
    place = F.xxhash64(key, F.lit(salt))
    if total > 2 * bound:
        # the share is taken of the hash's lower bits, the order of the whole hash
        rows = rows.where(F.pmod(place, F.lit(1 << 40)) < int((1 << 40) * 2 * bound / total))
    return rows.distinct().orderBy(place, key).limit(bound)
