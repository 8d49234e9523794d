"""A saved tokenizer reads back as the model that was written, and a broken folder is refused."""

import pytest
from pyspark.sql import functions as F

from tessera import constants as C
from tessera.operators.tokenizer.encode import encoder
from tessera.operators.tokenizer.train import BPEModel, byte_model
from tessera.sources.artefacts import load_tokenizer, save_tokenizer, vocab_table


def test_round_trip_and_checks(spark, tmp_path):
    base = byte_model()
    model = BPEModel(base.vocab + ["th", "the"], [("t", "h"), ("th", "e")], base.n_specials, 12)
    path = f"{tmp_path}/tokenizer"
    save_tokenizer(spark, model, path, {"dataset": "x"}, padding_side="left")
    loaded, config = load_tokenizer(spark, path)
    assert loaded == model and config["padding_side"] == "left" and config["model_max_length"] == C.MODEL_MAX_LEN
    texts = spark.createDataFrame([("the other <pad> thé 12",), ("",), (None,)], "text string")
    ids = [[r[0] for r in texts.select(encoder(m)(F.col("text"))).collect()] for m in (model, loaded)]
    assert ids[0] == ids[1] and model.vocab.index("the") in ids[0][0]

    vocab_table(spark, BPEModel(model.vocab[:-1] + ["thx"], model.merges, model.n_specials)).write.mode("overwrite").parquet(f"{path}/vocab")
    with pytest.raises(ValueError, match="merge of unknown tokens"):
        load_tokenizer(spark, path)
    vocab_table(spark, BPEModel([*model.vocab, "more"], model.merges, model.n_specials)).write.mode("overwrite").parquet(f"{path}/vocab")
    with pytest.raises(ValueError, match="not those the config was written for"):
        load_tokenizer(spark, path)
    vocab_table(spark, model).where("id <> 40").write.mode("overwrite").parquet(f"{path}/vocab")
    with pytest.raises(ValueError, match="gaps or repeats"):
        load_tokenizer(spark, path)
