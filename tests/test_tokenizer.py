"""Byte-level functions, the byte variant and BPE training /
encoding, against independent Python implementations. The ``tokenizers``
library serves as a test oracle only."""

import json
import random
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tessera import constants as C
from tessera.functions import bytelevel as B
from tessera.functions import chat as CH
from tessera.operators.tokenizer import encode as TE
from tessera.operators.tokenizer import train as TT
from tessera.sources import fixtures as FX

EDGE = ["", " ", "\n", "\t", "    ", "<|endoftext|>", "[MASK]", "<unk>",
        "Year 2025 → 3.14 * 2 = 6.28", "x!=y", "<|im_start|>user\nHello<|im_end|>",
        "a\u00a0!", "a \u00a0b", "x\u3000\u3000y", "hi\u00a0\u00a0there", "\u2028\u2028", "\u0085\u0085", "foo \u2003bar",
        "a=>=b ===", "if x == 42:\n    print('Found the answer!')", "ü ò ² café", "é ≠"]


def py_byte_ids(text):
    """Independent rendering: leftmost special match on the raw text, NFC of
    the runs between, then one id per UTF-8 byte."""
    sym_id = {s: i for i, s in B.byte_variant_vocab()}
    b2s = B.byte_to_symbol()
    out, i, run = [], 0, []
    specials = sorted(C.SPECIAL_TOKENS, key=len, reverse=True)

    def flush():
        if run:
            for b in unicodedata.normalize("NFC", "".join(run)).encode("utf-8"):
                out.append(sym_id[b2s[b]])
            run.clear()
    while i < len(text):
        for s in specials:
            if text.startswith(s, i):
                flush()
                out.append(C.SPECIAL_IDS[s])
                i += len(s)
                break
        else:
            run.append(text[i])
            i += 1
    flush()
    return out


def test_byte_variant_ids(spark):
    df = spark.createDataFrame([(t,) for t in EDGE], "t string")
    got = [r[0] for r in df.select(B.byte_ids(F.col("t"))).collect()]
    assert got == [py_byte_ids(t) for t in EDGE]
    counts = [r[0] for r in df.select(B.byte_token_count(F.col("t"))).collect()]
    assert counts == [len(py_byte_ids(t)) for t in EDGE]
    assert B.BYTE_VOCAB_SIZE == 274


def test_byte_decode_roundtrip_and_skip(spark):
    df = spark.createDataFrame([(t,) for t in EDGE], "t string")
    m = TT.byte_model()
    dec, dec_skip = TE.decoder(m), TE.decoder(m, skip_special=True)
    rows = df.select("t", dec(B.byte_ids(F.col("t"))).alias("d"),
                     dec_skip(B.byte_ids(F.col("t"))).alias("s")).collect()
    for r in rows:
        assert r["d"] == unicodedata.normalize("NFC", r["t"])
    x = spark.createDataFrame([("x == 42",)], "t string").select(dec_skip(B.byte_ids(F.col("t")))).first()[0]
    assert x == "x  "      # digits and operators are special, so skipping drops them


def test_special_extraction_leftmost(spark):
    df = spark.createDataFrame([("a=>=b ===",), ("*==//=",)], "t string")
    got = [r[0] for r in df.select(B.special_token_counts(F.col("t"))).collect()]
    assert got == [["=>", "=="], ["*=", "//"]]


@pytest.fixture(scope="module")
def trained(spark):
    texts = FX.messages(spark, SF001).select(CH.chatml_train(F.col("messages")).alias("text"))
    rows = [r[0] for r in texts.collect()]
    return texts, rows, TT.train_bpe(texts, vocab_size=200)


def hf_tokenizer(rows, vocab):
    tokenizers = pytest.importorskip("tokenizers")
    from tokenizers import decoders, models, normalizers, pre_tokenizers, trainers
    tok = tokenizers.Tokenizer(models.BPE(unk_token="<unk>"))
    tok.normalizer = normalizers.Sequence([normalizers.NFC()])
    tok.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.ByteLevel(add_prefix_space=False),
                                                 pre_tokenizers.Digits(individual_digits=True)])
    tok.decoder = decoders.ByteLevel()
    tok.train_from_iterator(rows, trainers.BpeTrainer(vocab_size=vocab, min_frequency=2, initial_alphabet=C.DIGITS,
                                                      special_tokens=C.SPECIAL_TOKENS, show_progress=False))
    return tok


def test_bpe_training_equals_reference_library(spark, trained):
    texts, rows, model = trained
    tok = hf_tokenizer(rows, 200)
    want = [t for t, _ in sorted(tok.get_vocab().items(), key=lambda x: x[1])]
    assert model.vocab == want
    enc, dec = TE.encoder(model), TE.decoder(model)
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("text")
    edge = spark.createDataFrame([(t,) for t in EDGE], "text string")
    out = docs.unionByName(edge).select("text", enc(F.col("text")).alias("ids")) \
        .withColumn("back", dec(F.col("ids"))).collect()
    for r in out:
        ids = tok.encode(r["text"]).ids
        assert list(r["ids"]) == ids
        assert r["back"] == tok.decode(ids, skip_special_tokens=False)


def test_self_checks(spark, trained):
    """The original script's three asserts, on our model."""
    _, _, model = trained
    enc, dec = TE.encoder(model), TE.decoder(model)
    df = spark.createDataFrame([("Year 2025 → 3.14 * 2 = 6.28",), ("x!=y",),
                                ("<|im_start|>user\nHello<|im_end|>",)], "t string")
    rows = df.select("t", enc(F.col("t")).alias("ids"), dec(enc(F.col("t"))).alias("back")).collect()
    digits_ok = all(not (model.vocab[i].isdigit() and len(model.vocab[i]) > 1) for i in rows[0]["ids"])
    assert digits_ok
    assert model.vocab[rows[1]["ids"][1]] == "!="
    assert rows[2]["back"] == rows[2]["t"]


def one_merge_at_a_time(words, vocab, size, min_frequency=2):
    """The plain trainer: count all pairs, merge the best, again."""
    vocab, merges = list(vocab), []
    words = {tuple(w): n for w, n in words.items()}
    while len(vocab) < size:
        count = Counter()
        for w, n in words.items():
            for pair in zip(w, w[1:]):
                count[pair] += n
        if not count:
            break
        (a, b), c = min(count.items(), key=lambda x: (-x[1], vocab.index(x[0][0]), vocab.index(x[0][1])))
        if c < min_frequency:
            break
        merges.append((a, b))
        if a + b not in vocab:
            vocab.append(a + b)
        changed = Counter()
        for w, n in words.items():
            out, i = [], 0
            while i < len(w):
                if w[i:i + 2] == (a, b):
                    out.append(a + b)
                    i += 2
                else:
                    out.append(w[i])
                    i += 1
            changed[tuple(out)] += n
        words = changed
    return vocab, merges


@pytest.mark.parametrize("seed,hot,symbols", [(1, 1, 1), (2, 3, 12), (3, 8, 60), (4, 500, 200_000)])
def test_rounds_equal_one_merge_at_a_time(spark, seed, hot, symbols):
    """Runs of one symbol, ties and tokens spelt twice, however little a round may take."""
    rnd = random.Random(seed)
    texts = [" ".join("".join(rnd.choices("aaab" if i % 3 else "abcd", k=rnd.randint(1, 9)))
                      for _ in range(rnd.randint(0, 6))) for i in range(40)] + ["", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    words = {r["word"]: r["n"] for r in TT.word_counts(df).collect()}
    first = TT.train_bpe(df, vocab_size=0).vocab
    want = one_merge_at_a_time(words, first, len(first) + 25)
    model = TT.train_bpe(df, vocab_size=len(first) + 25, hot_pairs=hot, max_symbols=symbols)
    assert (model.vocab, model.merges) == want


def test_real_vocabulary_size_equals_library(spark):
    """16,384 tokens asked for, until no pair is left twice: the library's vocabulary and merges."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("text")
    chats = FX.messages(spark, SF001).select(CH.chatml_train(F.col("messages")).alias("text"))
    texts = docs.unionByName(chats)
    tok = hf_tokenizer([r[0] for r in texts.collect()], C.VOCAB_SIZE)
    model = TT.train_bpe(texts, vocab_size=C.VOCAB_SIZE, max_symbols=20_000)
    assert model.vocab == [t for t, _ in sorted(tok.get_vocab().items(), key=lambda x: x[1])]
    assert [list(m) for m in model.merges] == [list(m) for m in json.loads(tok.to_str())["model"]["merges"]]
    assert len(model.merges) >= 2_000
    rounds = TT.LAST_TRAIN_STATS["per_round"]
    assert len(rounds) > 2 and max(r["symbols"] for r in rounds) <= 20_000
    enc, dec = TE.encoder(model), TE.decoder(model)
    edge = spark.createDataFrame([(t,) for t in EDGE], "text string")
    for r in texts.unionByName(edge).select("text", enc(F.col("text")).alias("ids")) \
            .withColumn("back", dec(F.col("ids"))).collect():
        ids = tok.encode(r["text"]).ids
        assert r["ids"] == ids and r["back"] == tok.decode(ids, skip_special_tokens=False)


def test_training_on_nothing(spark):
    model = TT.train_bpe(spark.createDataFrame([], "text string"), vocab_size=100)
    assert model.merges == [] and set(model.vocab) == set(C.SPECIAL_TOKENS) | set(C.DIGITS)


def test_nfc_fallback_matches_icu(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("text")
    extra = spark.createDataFrame([("é ≠ Å",), (None,)], "text string")
    df = docs.unionByName(extra)
    icu = [r[0] for r in df.select(B.nfc(F.col("text"))).collect()]
    saved = B._HAS_ICU
    try:
        B._HAS_ICU = False
        py = [r[0] for r in df.select(B.nfc(F.col("text"))).collect()]
    finally:
        B._HAS_ICU = saved
    assert icu == py
    assert icu[-2] == unicodedata.normalize("NFC", "é ≠ Å")


def test_one_pass_comparisons(spark):
    from tessera.operators.tokenizer import checks as TC
    byte = TT.byte_model()
    toks = {"a": (TE.encoder(byte), byte.vocab_size), "b": (TE.encoder(byte), byte.vocab_size)}
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("text", "lang")
    want_tokens = docs.select(B.byte_token_count(F.col("text")).alias("n")).agg(F.sum("n")).first()[0]
    want_chars = docs.select(F.sum(F.length("text"))).first()[0]
    eff = {r["tokenizer"]: r for r in TC.efficiency(docs, "text", toks).collect()}
    assert set(eff) == {"a", "b"}
    assert all(r["total_tokens"] == want_tokens and r["total_chars"] == want_chars for r in eff.values())
    ranked = TC.ranking(TC.efficiency(docs, "text", toks)).collect()
    assert sorted(r["rank"] for r in ranked) == [1, 2] and all(r["best"] for r in ranked)
    by_cls = TC.token_counts_by_class(docs, "text", "lang", toks).collect()
    assert sum(r["tokens"] for r in by_cls if r["tokenizer"] == "a") == want_tokens
    terms = spark.createDataFrame([("a",), ("ab",), ("==",)], "term string")
    cov = {r["tokenizer"]: r for r in TC.single_token_coverage(terms, "term", toks).collect()}
    assert cov["a"]["single"] == 2 and cov["a"]["terms"] == 3


def test_word_counts_equal_library_pretokenizer(spark):
    tokenizers = pytest.importorskip("tokenizers")
    from collections import Counter

    from tokenizers import normalizers, pre_tokenizers
    texts = FX.messages(spark, SF001).select(CH.chatml_train(F.col("messages")).alias("text"))
    texts = texts.unionByName(spark.createDataFrame([(t,) for t in EDGE], "text string"))
    rows = [r[0] for r in texts.collect()]
    norm = normalizers.NFC()
    pre = pre_tokenizers.Sequence([pre_tokenizers.ByteLevel(add_prefix_space=False),
                                   pre_tokenizers.Digits(individual_digits=True)])
    want = Counter()
    for t in rows:
        for piece, _ in pre.pre_tokenize_str(norm.normalize_str(t)):
            want[piece] += 1
    got = {r["word"]: r["n"] for r in TT.word_counts(texts).collect()}
    assert got == dict(want)
    assert tokenizers is not None


def _one_by_one(words, model):
    """The encoder's ids, each word by itself through the scalar merge."""
    ranks = {p: i for i, p in enumerate(model.merges)}
    ids = {t: i for i, t in enumerate(model.vocab)}
    unk = ids[C.UNK]
    return [None if row is None else [i for w in row for i in (
        [ids[w]] if w in model.vocab[:model.n_specials] else
        [i for p in TE._pieces(w) for i in TE._merge(p, ranks, ids, unk)])] for row in words]


def _odd_model():
    base = TT.byte_model()
    merges = [("b", "c"), ("a", "b"), ("a", "bc"), ("abc", "ab"), ("ab", "c"), ("a", "a"), ("aa", "aa"), ("Ã", "©"), ("²", "a")]
    return TT.BPEModel(base.vocab + ["bc", "ab", "abc", "abcab", "aa", "aaaa", "Ã©"], merges, base.n_specials)


def test_words_of_a_batch_merge_as_one_by_one(monkeypatch):
    import pyarrow as pa
    rng = random.Random(3)
    rows = [["".join(rng.choice("abcé²1 ") for _ in range(rng.randint(1, 12))) for _ in range(rng.randint(0, 9))] for _ in range(200)]
    rows += [None, [], ["==", "<pad>", "1", "abc" * 60, "é" * 40, "a" * 200]]
    model = _odd_model()
    table = TE._Table(model.vocab, model.merges, set(model.vocab[:model.n_specials]))
    batch, want = pa.array(rows, pa.list_(pa.string())), _one_by_one(rows, model)
    assert TE._encode_batch(batch, table).to_pylist() == want
    monkeypatch.setattr(TE, "STEP", 5)
    monkeypatch.setattr(TE, "MERGED", 40)
    assert TE._encode_batch(batch.slice(20), table).to_pylist() == want[20:]


def test_encoding_memory_is_bounded_by_step():
    """A batch of many occurrences needs little beside its words and ids."""
    import tracemalloc

    import pyarrow as pa
    model = _odd_model()
    table = TE._Table(model.vocab, model.merges, set(model.vocab[:model.n_specials]))
    rows = pa.array([["abc", "é", " a"] * 1000] * 2000, pa.list_(pa.string()))
    tracemalloc.start()
    out = TE._encode_batch(rows, table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    n_words, n_ids = len(rows.flatten()), len(out.flatten())
    assert peak < 4 * n_ids + 8 * n_words + 60 * TE.STEP


def test_totals_encode_each_distinct_word_once(spark):
    from tessera.operators.tokenizer import checks as TC
    rows = [("x", t) for t in EDGE] + [("x", "same words again " * 50), ("x", None), (None, "aa bb"), ("none", None), ("empty", "")]
    df = spark.createDataFrame(rows, "cls string, text string")
    byte = TT.byte_model()
    seen = spark.sparkContext.accumulator(0)

    @F.udf("array<int>")
    def counted(t):
        seen.add(1)
        return None if t is None else [0]

    got = {r["cls"]: (r["n_texts"], r["chars"], r["tokens"]) for r in TC.token_counts_by_class(
        df, "text", "cls", {"bpe": (TE.encoder(byte), 274), "udf": (counted, 274)}).collect() if r["tokenizer"] == "bpe"}
    want = {}
    for cls, t in rows:
        n, chars, tokens = want.get(cls, (0, None, None))
        if t is not None:
            chars, tokens = (chars or 0) + len(t), (tokens or 0) + len(py_byte_ids(t))
        want[cls] = (n + 1, chars, tokens)
    assert got == want
    words = df.select("cls", F.explode(B.raw_pretokens(F.col("text")))).distinct().count()
    assert seen.value <= words + len(want)          # one call a distinct word, not one a text's word
    total = TC.efficiency(df.select("text"), "text", {"bpe": (TE.encoder(byte), 274)}).first()
    assert (total["total_chars"], total["total_tokens"]) == (sum(v[1] or 0 for v in want.values()), sum(v[2] or 0 for v in want.values()))
