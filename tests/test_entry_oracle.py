"""Driver contract and a DuckDB differential check of the SQL-checkable
queries on the smallest scale (the driver runs the full set at sf0.01)."""

import math

import duckdb
import pytest

from conftest import SF001

import __spark_entry__ as E

FAST = ["audit_gate", "pattern_flag", "author_stats", "flagged_authors", "infraction_histogram",
        "top_flagged", "exclude_authors", "quality_gate", "title_prefix", "seeded_shuffle", "take_n",
        "train_test_split", "split_sizes", "assign_batches", "sample_k", "chatml_train", "chatml_template",
        "trim_history", "seed_system", "fit_context", "special_token_counts", "tokenizer_efficiency",
        "truncate_head", "pad_left_dynamic", "labels_masked", "padding_waste", "clean_stories",
        "length_summary", "sft_batches", "decode_column"]

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def test_contract(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", FAST)
def test_oracle(spark, con, key):
    df = E.queries()[key](spark, SF001)
    rows, cols = df.collect(), df.columns
    rel = con.sql(E.oracle_sql()[key])
    ocols, orows = rel.columns, rel.fetchall()
    assert sorted(cols) == sorted(ocols)
    a = sorted((tuple(_norm(r[c]) for c in sorted(cols)) for r in rows), key=repr)
    idx = [ocols.index(c) for c in sorted(cols)]
    b = sorted((tuple(_norm(r[i]) for i in idx) for r in orows), key=repr)
    assert a == b
    assert not any(isinstance(x, float) and math.isnan(x) for r in a for x in r)
