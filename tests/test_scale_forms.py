"""Forms that keep one key, file or conversation out of one task, against plain ones."""

import random

from pyspark.sql import functions as F

from conftest import SF001
from test_plans import plan
from test_tokenizer import py_byte_ids
from tessera.functions import bytelevel as B
from tessera.operators import context as CX
from tessera.operators import stats as ST
from tessera.operators.tokenizer import lookup as LU
from tessera.operators.tokenizer.train import byte_model
from tessera.sources import artefacts as AF
from tessera.sources import tables as TB


def _turns(spark):
    """A conversation of 9,000 turns with gaps, short ones, one without an id."""
    rnd = random.Random(3)
    rows = [(1, t, rnd.randint(1, 9)) for t in rnd.sample(range(-5000, 40_000), 9000)]
    rows += [(c, t, rnd.randint(1, 9)) for c in (2, 3, None) for t in range(6)] + [(4, 7, 5), (5, None, 3), (5, 2, 4)]
    return rows, spark.createDataFrame(rows, "conv_id long, turn long, cost int")


def _by_conversation(rows):
    out = {}
    for c, t, cost in rows:
        out.setdefault(c, []).append((t, cost))
    return {c: sorted(ts, key=lambda x: (x[0] is not None, x[0] or 0)) for c, ts in out.items()}


def test_trim_and_fit_by_blocks(spark):
    rows, turns = _turns(spark)
    header = 11
    kept, fits = set(), set()
    for c, ts in _by_conversation(rows).items():
        for i, (t, _) in enumerate(ts):
            if len(ts) <= 4 or i == 0 or i >= len(ts) - 3:
                kept.add((c, t))
            suffix = sum(x for _, x in ts[i:])
            if i in (0, len(ts) - 1) or ts[0][1] + suffix + header <= 30_000:
                fits.add((c, t))
    assert {(r[0], r[1]) for r in CX.trim_history(turns, 3).select("conv_id", "turn").collect()} == kept
    got = CX.fit_context(turns, 30_000).select("conv_id", "turn").collect()
    assert {(r[0], r[1]) for r in got} == fits and len(got) == len(fits)
    assert CX.trim_history(turns, 3).columns == turns.columns == CX.fit_context(turns, 9).columns
    assert len({r[0] for r in CX._placed(turns, "conv_id", "turn").where("conv_id = 1")
                .select(F.floor(F.col("turn") / CX.BLOCK)).collect()}) > 5


def test_first_rows_are_filtered_where_they_are_read(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(1000).repartition(7).write.parquet(path)
    every = [r[0] for r in spark.read.parquet(path).select("id", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"))
             .orderBy("f", "i").collect()]
    for n in (0, 1, 142, 143, 500, 1000, 5000):
        first = TB.read_first(spark, path, n)
        assert sorted(r[0] for r in first.collect()) == sorted(every[:n])
        assert "Exchange" not in plan(first) and "SinglePartition" not in plan(first)


def test_lookup_both_ways(spark):
    vocab = AF.vocab_table(spark, byte_model())
    rows = spark.createDataFrame([("<bos>",), ("a",), ("zz",), ("",), (None,), ("a",)], "token string")
    got = {(r.token, r.id, r.known) for r in LU.tokens_to_ids(rows, vocab).collect()}
    ids = byte_model().token_to_id()
    assert got == {("<bos>", 2, True), ("a", ids["a"], True), ("zz", 5, False), ("", 5, False), (None, None, False)}
    back = LU.ids_to_tokens(spark.createDataFrame([(2,), (ids["a"],), (9999,), (None,)], "id int"), vocab)
    assert {(r.id, r.token) for r in back.collect()} == {(2, "<bos>"), (ids["a"], "a"), (9999, None), (None, None)}


def test_manifest_counts_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "c")
    docs = spark.read.parquet(f"{SF001}/documents.parquet").withColumn(
        "split", F.when(F.col("doc_id") % 10 == 0, "test").otherwise("train"))
    TB.write_splits(docs, path)
    m = ST.phase_manifests({"phase5": TB.read_split(spark, path)})
    assert "ReadSchema: struct<>" in plan(m)
    TB.write_manifest(m, str(tmp_path / "m"))
    r = TB.read_manifest(spark, str(tmp_path / "m")).first()
    n = docs.where("split = 'test'").count()
    assert (r.phase, r.n_test, r.n_train, r.seq_len, r.effective_batch) == ("phase5", n, docs.count() - n, 2048, 256)


def test_byte_ids_of_a_batch_at_once(spark):
    rnd = random.Random(5)
    bits = ["<|im_start|>", "<bos>", "==", "=", "=>", "->", "//", "*", "7", "a", " ", "é", "é", "̸", "́", "가",
            "KK", "\n", "\u0000", "Ā", "ē", "😀", "<|", "bos>"]
    texts = ["".join(rnd.choices(bits, k=rnd.randint(0, 40))) for _ in range(400)] + [None, "", None, "==", "1̸2"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string").repartition(3)
    got = df.select("k", B.byte_ids(F.col("t")).alias("ids"), B.byte_token_count(F.col("t")).alias("n"))
    for r in got.collect():
        want = None if texts[r.k] is None else py_byte_ids(texts[r.k])
        assert r.ids == want and r.n == (None if want is None else len(want))
    assert "ascii(" not in plan(got)            # no JVM expression per byte
    for r in df.select("k", B.byte_ids(F.col("t"), 7).alias("ids")).collect():
        assert r.ids == (None if texts[r.k] is None else py_byte_ids(texts[r.k])[:7])
    none = spark.createDataFrame([(None,), ("",)], "t string").coalesce(1)
    assert [r[0] for r in none.select(B.byte_ids(F.col("t"))).collect()] == [None, []]


def test_only_stories_are_counted(spark):
    from tessera.operators import gates as G
    from tessera.sources import fixtures as FX
    every, stories = (G.long_story(FX.corpus(spark, SF001, only=f)).select("doc_id", "token_length") for f in (None, "story"))
    assert sorted(every.collect()) == sorted(stories.collect()) != []
    assert plan(stories).count("Filter (") == plan(every).count("Filter (") + 1
