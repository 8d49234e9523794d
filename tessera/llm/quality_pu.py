"""Quality classifier by positive-unlabelled learning.

Trusted positives (labelled good, outside the held-out fold) and a sample of
unlabelled web text train a linear scorer by the non-negative unbiased risk of
Kiryo et al. (2017): ``pi R+(P) + max(0, R-(U) - pi R-(P))`` with the logistic
loss. The class prior ``pi`` is estimated first: a classifier of P against U is
cut where the share of U above the cut, relative to that of P, is smallest.

The features are ratios of counts in the whole text (symbols, shouted words,
repeated passages, lines and neighbours, missing function words, odd word
lengths), each shrunk towards a clean text's for short texts and bent by
``x / (x + c)``. They and the score are built-in functions. Only the model is
fitted on the driver, on at most ``POSITIVES`` + ``UNLABELLED`` rows of
``len(FEATURES)`` numbers, chosen by a hash of doc_id.

Defined results: a null or empty text scores like a text of no words (about
the model's best score); without trusted positives every score is 1 (nothing
is rejected untaught); rows without doc_id are never held out; repeated rows
are scored one by one; a document with conflicting labels isn't trusted;
extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bind, hash_sample, narrow, table, words_of
from .quality_rules import metrics

POSITIVES, UNLABELLED = 6_000, 18_000      # bounds of the training sample
SHRINK = 20.0                              # words of clean text every text is diluted with
BEND = 0.05
MEAN_WORD, STOP_SHARE = 5.1, 0.12          # of running text
KEEP = 0.7
FEATURES = ("symbols", "shouts", "word_length", "stop_gap", "repeats", "dup_lines", "neighbours")
FOLDS, HELD_OUT = 4, 2


def held_out(doc_id: Column, folds: int = FOLDS, fold: int = HELD_OUT) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def features(text: Column) -> Column:
    """array<double> of ``FEATURES``, each in [0, 1), 0 for clean text."""
    same = bind(words_of(text), lambda w: F.size(F.filter(w, lambda x, i: (i > 0) & (F.get(w, i - 1) == x))))

    def of(m: Column) -> Column:
        n = m["n_words"].cast("double")
        base = n + SHRINK
        raw = (
            m["n_symbols"] / base,
            m["n_shout_words"] / base,
            F.greatest(F.abs(m["word_chars"] - MEAN_WORD * n) / base - 1.0, F.lit(0.0)),
            F.greatest(STOP_SHARE * n - m["n_stop_words"], F.lit(0.0)) / base,
            m["n_repeat_words"] / base,
            m["lines"]["n_dup_lines"] / (m["lines"]["n_lines"] + 3.0),
            m["same"] / base,
        )
        return F.array(*[x / (x + F.lit(BEND)) for x in raw])

    return bind(F.struct(metrics(text).alias("m"), same.alias("same")), lambda s: of(s["m"].withField("same", s["same"])))


def _logistic(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, -z)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def class_prior(p: np.ndarray, u: np.ndarray) -> float:
    """Share of positives in ``u``: the smallest ratio, over cuts that keep a
    tenth of ``p`` at least, of the shares of u and p above the cut of a
    classifier of p against u, with a margin for the sample's size."""
    x = np.vstack([p, u])
    y = np.r_[np.ones(len(p)), np.zeros(len(u))]
    weight = np.where(y == 1, 0.5 / len(p), 0.5 / len(u))
    w = _descend(lambda g: (weight * np.where(y == 1, -_sigmoid(-g), _sigmoid(g))) @ _one(x), x, x.shape[1] + 1)
    sp, su = np.sort(_one(p) @ w), np.sort(_one(u) @ w)
    cuts = np.unique(np.quantile(sp, np.linspace(0, 0.9, 91)))
    share_p = 1 - np.searchsorted(sp, cuts, "left") / len(sp)
    share_u = 1 - np.searchsorted(su, cuts, "left") / len(su)
    margin = np.sqrt(np.log(40) / 2 / len(sp)) + np.sqrt(np.log(40) / 2 / len(su))
    best = np.argmin((share_u + margin) / share_p)
    return float(np.clip(share_u[best] / share_p[best], 0.05, 0.98))


def _one(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, np.ones((len(x), 1))])


def _descend(gradient, x, size: int, steps: int = 600, rate: float = 0.1, decay: float = 1e-4) -> np.ndarray:
    """Adam on full batches, from zero."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    data = _one(x)
    for t in range(1, steps + 1):
        g = gradient(data @ w) + decay * np.r_[w[:-1], 0]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def fit(p: np.ndarray, u: np.ndarray, prior: float) -> np.ndarray:
    """Weights (last: intercept) of the non-negative unbiased risk's minimum."""
    n_p, data = len(p), np.vstack([p, u])

    def gradient(z: np.ndarray) -> np.ndarray:
        zp, zu = z[:n_p], z[n_p:]
        as_positive = -prior * _sigmoid(-zp) / n_p                      # of pi R+(P)
        negative_risk = _logistic(-zu).mean() - prior * _logistic(-zp).mean()
        u_part, p_part = _sigmoid(zu) / len(u), -prior * _sigmoid(zp) / n_p
        sign = 1.0 if negative_risk >= 0 else -1.0                      # step back when the risk turns negative
        if sign < 0:
            as_positive = as_positive * 0
        return np.r_[as_positive + sign * p_part, sign * u_part] @ _one(data)

    return _descend(gradient, data, data.shape[1] + 1)


def train(docs: DataFrame, trusted: DataFrame, seed: int = 3) -> tuple[np.ndarray, float] | None:
    """Fit on ``docs`` (doc_id, text) with ``trusted`` (doc_id) positives."""
    def some(ids: DataFrame, salt: str, bound: int) -> DataFrame:
        return hash_sample(ids.where(F.col("doc_id").isNotNull()).select("doc_id"), "doc_id", bound, f"{salt}{seed}")

    pick = some(trusted, "p", POSITIVES).withColumn("trusted", F.lit(True)).unionByName(
        some(docs, "u", UNLABELLED).withColumn("trusted", F.lit(False)))
    # one text of each chosen id: what reaches the driver is bounded however often an id repeats
    rows = docs.join(F.broadcast(pick), "doc_id").select("trusted", "doc_id", features(F.col("text")).alias("f")) \
        .groupBy("trusted", "doc_id").agg(F.min("f").alias("f")).toArrow()
    kind = np.asarray(rows.column("trusted")).astype(bool)
    x = np.array(rows.column("f").to_pylist(), np.float64).reshape(len(kind), len(FEATURES))
    if not kind.any() or kind.all():
        return None
    prior = class_prior(x[kind], x[~kind])
    return fit(x[kind], x[~kind], prior), prior


def _score(d: DataFrame, labels: DataFrame, folds: int, fold: int) -> Column:
    """The fitted score of the column ``text`` of ``d`` (doc_id, text)."""
    teach = narrow(labels, {"doc_id": "long", "quality": "int"}).where(~held_out(F.col("doc_id"), folds, fold))
    trusted = teach.groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1")
    model = train(d, trusted)
    if model is None:
        return F.lit(1.0)
    w = [float(v) for v in model[0]]
    z = bind(features(F.col("text")), lambda f: sum((F.get(f, F.lit(i)) * F.lit(w[i]) for i in range(len(FEATURES))), F.lit(w[-1])))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def classify(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, fold: int = HELD_OUT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.
    ``labels`` (doc_id, quality) teach outside the held-out fold only."""
    d = narrow(docs, {"doc_id": "long", "text": "string"})
    score = _score(d, labels, folds, fold)
    return d.select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= KEEP).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, fold: int = HELD_OUT) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is at least ``KEEP``; a
    filter in place, without a join."""
    return docs.where(_score(narrow(docs, {"doc_id": "long", "text": "string"}), labels, folds, fold) >= KEEP)


# query --------------------------------------------------------------------
def op6_quality_classifier(spark, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
