"""Plan-shape checks: the scale properties the design relies on."""

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from conftest import SF001
import __spark_entry__ as E
from tessera.operators import order as O
from tessera.operators.tokenizer import encode as TE
from tessera.operators.tokenizer import train as TT


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_config_read_prunes_partitions(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        df = E.queries()["read_config"](spark, SF001)
        p = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [isnotnull(config" in p and "(config" in p and "= en)" in p


def test_exclusion_is_a_broadcast_anti_join_when_small(spark):
    p = plan(E.queries()["quality_gate"](spark, SF001))
    assert "BroadcastHashJoin LeftAnti" in p


def test_author_stats_partial_then_final_aggregation(spark):
    p = plan(E.queries()["author_stats"](spark, SF001))
    assert p.count("HashAggregate (") >= 2 and "partial_count" in p


def test_take_n_and_split_do_not_shuffle_rows(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    taken = O.train_test_split(O.first_n(docs, "doc_id", 100), "doc_id")
    p = plan(taken)
    assert "Exchange" not in p and "Window" not in p


def test_encoding_is_map_side(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    enc = docs.select("doc_id", TE.encoder(TT.byte_model())(F.col("text")).alias("ids"))
    p = plan(enc)
    assert "Exchange" not in p and "ArrowEvalPython" in p


def test_scan_reads_only_needed_columns(spark):
    p = plan(E.queries()["take_n"](spark, SF001))
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in p
