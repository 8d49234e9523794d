"""Tokenizer artefacts (S8): a versioned folder that a later job starts from.

``vocab`` (id, token, is_special) and ``merges`` (rank, left, right) are
Parquet tables; ``tokenizer_config`` and ``tokenizer_stats`` are JSON lines.
The config names the format's version, the special tokens, the length limit,
the padding side, the chat format and the fingerprint of vocabulary and merges.
"""

from __future__ import annotations

import json
import os
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession

from .. import constants as C
from ..operators.tokenizer.train import BPEModel
from .tables import write_tokenizer

VERSION = 1


def fingerprint(model: BPEModel) -> str:
    """SHA-256 of the vocabulary and the merges in order."""
    text = json.dumps([model.vocab, model.merges, model.n_specials], ensure_ascii=False)
    return sha256(text.encode()).hexdigest()


def vocab_table(spark: SparkSession, model: BPEModel) -> DataFrame:
    """(id, token, is_special); bounded by the vocabulary size."""
    return spark.createDataFrame([(i, t, i < model.n_specials) for i, t in enumerate(model.vocab)],
                                 "id int, token string, is_special boolean")


def wrapper_config(model: BPEModel, max_length: int = C.MODEL_MAX_LEN, padding_side: str = "right") -> dict:
    """What a loader needs beside the vocabulary and the merges."""
    return {"version": VERSION, "tokenizer_type": C.TOKENIZER_TYPE, "vocab_size": model.vocab_size,
            "model_max_length": max_length, "padding_side": padding_side, "bos_token": C.BOS, "eos_token": C.EOS,
            "pad_token": C.PAD, "unk_token": C.UNK, "special_tokens": model.vocab[:model.n_specials],
            "chat_format": [C.IM_START, C.IM_END], "fingerprint": fingerprint(model)}


def save_tokenizer(spark: SparkSession, model: BPEModel, path: str, stats: dict | None = None, **config) -> None:
    """Write the model with its wrapper config and statistics; an older model there is replaced."""
    merges = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(model.merges)], "rank int, left string, right string")
    write_tokenizer(vocab_table(spark, model), merges, {"samples": int(model.samples)} | (stats or {}), path)
    text = json.dumps(wrapper_config(model, **config), ensure_ascii=False)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(os.path.join(path, "tokenizer_config"))


def load_tokenizer(spark: SparkSession, path: str) -> tuple[BPEModel, dict]:
    """(model, config) of a saved folder. A folder that is not whole or doesn't
    fit together is an error: unknown version, ids with gaps or repeats, a merge
    whose parts or result are no tokens, another fingerprint."""
    def line(name: str) -> dict:
        return json.loads(spark.read.text(os.path.join(path, name)).first()["value"])

    config, stats = line("tokenizer_config"), line("tokenizer_stats")
    if config.get("version") != VERSION:
        raise ValueError(f"tokenizer folder of version {config.get('version')}, expected {VERSION}")
    rows = spark.read.parquet(os.path.join(path, "vocab")).orderBy("id").collect()
    if [r["id"] for r in rows] != list(range(len(rows))) or len({r["token"] for r in rows}) != len(rows):
        raise ValueError("the vocabulary's ids or tokens have gaps or repeats")
    pairs = spark.read.parquet(os.path.join(path, "merges")).orderBy("rank").collect()
    model = BPEModel([r["token"] for r in rows], [(r["left"], r["right"]) for r in pairs],
                     sum(r["is_special"] for r in rows), int(stats.get("samples", 0)))
    known = set(model.vocab)
    wrong = [p for p in model.merges if not {p[0], p[1], p[0] + p[1]} <= known]
    if wrong:
        raise ValueError(f"merge of unknown tokens: {wrong[0]}")
    if config["special_tokens"] != model.vocab[:model.n_specials] or config["fingerprint"] != fingerprint(model):
        raise ValueError("the vocabulary and merges are not those the config was written for")
    return model, config
