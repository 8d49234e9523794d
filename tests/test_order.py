"""Deterministic order, take, split, batches, sample."""

import hashlib
import math

from pyspark.sql import functions as F

from conftest import SF01
from tessera.operators import order as O


def py_order(ids, salt):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{i}|{salt}".encode()).hexdigest(), i))


def test_global_index_matches_python_and_partitioning(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id")
    ids = [r[0] for r in docs.collect()]
    want = {d: i for i, d in enumerate(py_order(ids, "42"))}
    for parts in (1, 4, 32):
        got = {r["doc_id"]: r["shuffle_idx"] for r in O.seeded_shuffle(docs.repartition(parts), "doc_id").collect()}
        assert got == want


def test_take_and_split(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id")
    ids = [r[0] for r in docs.collect()]
    taken = {r[0] for r in O.first_n(docs, "doc_id", 600).collect()}
    assert taken == set(py_order(ids, "42")[:600])
    assert O.first_n(docs, "doc_id", 10**9).count() == len(ids)
    split = O.train_test_split(docs.repartition(7), "doc_id", 0.01).collect()
    test = {r["doc_id"] for r in split if r["split"] == "test"}
    train = {r["doc_id"] for r in split if r["split"] == "train"}
    assert not (test & train) and (test | train) == set(ids)
    assert len(test) == math.ceil(0.01 * len(ids))
    assert test == set(py_order(ids, "split-42")[:len(test)])


def test_split_size_reference_numbers():
    # 159,771 samples, 1% test -> 1,598 test / 158,173 train (the logged run)
    assert O.n_test_rows(159_771, 0.01) == 1_598
    assert 159_771 - O.n_test_rows(159_771, 0.01) == 158_173


def test_batches_and_length_groups(spark):
    df = spark.range(0, 230).select(F.col("id").alias("idx"), (F.col("id") * 7 % 23).alias("length"))
    b = O.assign_batches(df, "idx", 16).collect()
    assert all(r["batch_id"] == r["idx"] // 16 and r["row_in_batch"] == r["idx"] % 16 for r in b)
    g = O.length_grouped_batches(df, "idx", "length", 4, mega_factor=5).collect()
    by_mega = {}
    for r in g:
        by_mega.setdefault(r["megabatch"], []).append(r)
    for mb, rows in by_mega.items():
        rows.sort(key=lambda r: (r["batch_id"], r["row_in_batch"]))
        lens = [r["length"] for r in rows]
        assert lens == sorted(lens, reverse=True)
        assert all(r["idx"] // 20 == mb for r in rows)


def test_sample_k(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id")
    ids = [r[0] for r in docs.collect()]
    got = [r[0] for r in O.sample_k(docs, "doc_id", 64).collect()]
    assert sorted(got) == sorted(py_order(ids, "sample")[:64])


def test_results_do_not_depend_on_partitioning(spark):
    from pyspark.sql import functions as F

    from conftest import SF001
    from tessera.functions import bytelevel as B
    from tessera.operators import authors as AU
    from tessera.plans import corpus as X
    from tessera.sources import fixtures as FX
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    stories = FX.stories(spark, SF001)
    excluded = AU.exclusion_list(X.author_audit(stories, [FX.FLAG_PATTERN], FX.BLOCKED_TAGS,
                                                FX.BLOCKED_WARNINGS, FX.VIEWS_THRESHOLD))
    seen = []
    for parts in (1, 4, 32):
        ids = sorted((r[0], tuple(r[1])) for r in
                     docs.repartition(parts).select("doc_id", B.byte_ids(F.col("text"))).collect())
        clean = sorted((r["doc_id"], r["split"], r["length"]) for r in X.clean_stories(
            stories.repartition(parts), excluded, min_tokens=FX.MIN_TOKENS, max_tokens=FX.MAX_TOKENS,
            blocked_tags=FX.BLOCKED_TAGS, blocked_warnings=FX.BLOCKED_WARNINGS,
            min_views=FX.VIEWS_THRESHOLD).collect())
        seen.append((ids, clean))
    assert seen[0] == seen[1] == seen[2]
