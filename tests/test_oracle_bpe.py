"""The Spark trainer and encoder against the DuckDB ones, which make one merge a step."""

import duckdb

from conftest import SF001
from tessera.operators.tokenizer.encode import encoder
from tessera.operators.tokenizer.train import train_bpe
from tessera.plans import oracle_bpe as OB
from tessera.plans.registry import _training_texts
from tessera.sources.tables import read_table

SIZE = 130


def test_training_and_encoding_equal_one_merge_a_step(spark):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    model = train_bpe(_training_texts(spark, SF001), vocab_size=SIZE)
    ctes = OB.trainer_ctes(SIZE)
    steps = con.sql(f"WITH RECURSIVE {ctes} SELECT vocab[l + 1], vocab[r + 1] FROM learned ORDER BY step").fetchall()
    assert steps == model.merges and len(model.vocab) == SIZE
    assert len(set(model.vocab)) == SIZE
    sql = f"WITH RECURSIVE {ctes}, {OB.DOC_TEXTS}, {OB.encoded_ctes('texts')}, {OB.ENCODED} SELECT key, ids FROM encoded"
    want = dict(con.sql(sql).fetchall())
    docs = read_table(spark, SF001, "documents")
    got = {r[0]: r[1] for r in docs.select("doc_id", encoder(model)(docs["text"]).alias("ids")).collect()}
    assert {k: v for k, v in got.items() if v} == want
