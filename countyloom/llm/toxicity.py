"""Toxicity classifier learned from confirmed toxic texts and unlabelled text (non-negative positive-unlabelled learning)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countyloom.llm.common import Words, held_out, text_blocks

BITS = 18


@dataclass(frozen=True)
class Settings:
    """`positives` and `unlabelled` bound the texts that are fitted: those whose hashed ids come first.

    A feature is fitted if it is in `least_texts` fitted texts and its share among the toxic texts is `least_z` standard
    errors from its share among the unlabelled ones.
    """

    positives: int = 1500
    unlabelled: int = 4500
    epochs: int = 30
    batch: int = 128
    rate: float = 0.3
    momentum: float = 0.9
    seed: int = 11
    least_prior: float = 0.01
    least_texts: int = 5
    least_z: float = 3.5


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float


def features(words: Words) -> list[np.ndarray]:
    """Distinct hashed features of each text: its words and their first four, five and six bytes."""
    found = [(words.word, words.doc), *(words.prefixes(k) for k in (4, 5, 6))]
    cuts = [np.searchsorted(d, np.arange(words.count + 1)) for _, d in found]
    ids = [(h >> np.uint64(64 - BITS)).astype(np.int64) for h, _ in found]
    return [np.unique(np.concatenate([x[c[i] : c[i + 1]] for x, c in zip(ids, cuts, strict=True)])) for i in range(words.count)]


def _all_features(texts: list[str]) -> list[np.ndarray]:
    return [f for a, b in text_blocks(texts) for f in features(Words(texts[a:b]))]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _chosen(positive: list[np.ndarray], unlabelled: list[np.ndarray], settings: Settings) -> np.ndarray:
    """Which features tell the toxic sample from the unlabelled one."""
    p, u = (np.bincount(np.concatenate(rows), minlength=1 << BITS) for rows in (positive, unlabelled))
    p_share, u_share = (p + 0.5) / (len(positive) + 1), (u + 0.5) / (len(unlabelled) + 1)
    z = (p_share - u_share) / np.sqrt(u_share * (1 - np.minimum(u_share, 0.999)) / len(positive))
    return (np.abs(z) >= settings.least_z) & (p + u >= settings.least_texts)


def fit(positive: list[str], unlabelled: list[str], prior: float, settings: Settings) -> Model:
    """Minimises prior * R+(positive) + max(0, R-(unlabelled) - prior * R-(positive)) by gradient descent on mini-batches.

    R+ and R- are mean logistic losses for the labels 1 and 0; the second term estimates the risk on non-toxic text, which
    can't be negative, so a batch where it falls below zero moves by the first term alone. The model is the mean over the
    second half of the steps, which evens out the last batches. Without positives or unlabelled
    text every score is the prior.
    """
    base = float(np.log(prior / (1 - prior)))
    weights, bias = np.zeros(1 << BITS), base
    if not positive or not unlabelled:
        return Model(weights.astype(np.float32), base)
    pos, unl = _all_features(positive), _all_features(unlabelled)
    chosen = _chosen(pos, unl, settings)
    pos, unl = [f[chosen[f]] for f in pos], [f[chosen[f]] for f in unl]
    rng = np.random.default_rng(settings.seed)
    pull, pull_bias, step = np.zeros(len(weights)), 0.0, 0
    late, late_bias, counted = np.zeros(len(weights)), 0.0, 0
    per = max(1, settings.batch // 4)

    def outputs(rows):
        sizes = np.array([len(r) for r in rows])
        ids = np.concatenate(rows)
        return ids, sizes, np.bincount(np.repeat(np.arange(len(rows)), sizes), weights[ids], len(rows)) + bias

    for epoch in range(settings.epochs):
        p_order, u_order = rng.permutation(len(pos)), rng.permutation(len(unl))
        for a in range(0, len(unl), settings.batch):
            p_rows = [pos[p_order[(step * per + i) % len(pos)]] for i in range(min(per, len(pos)))]
            p_ids, p_sizes, p_out = outputs(p_rows)
            u_ids, u_sizes, u_out = outputs([unl[i] for i in u_order[a : a + settings.batch]])
            step += 1
            # By the outputs, log(1 + exp(-x)) has the derivative p - 1 and log(1 + exp(x)) has p.
            p_grad = prior * (_sigmoid(p_out) - 1) / len(p_rows)
            u_grad = np.zeros(len(u_out))
            if np.logaddexp(0, u_out).mean() >= prior * np.logaddexp(0, p_out).mean():
                p_grad -= prior * _sigmoid(p_out) / len(p_rows)
                u_grad = _sigmoid(u_out) / len(u_out)
            each = np.concatenate([np.repeat(p_grad, p_sizes), np.repeat(u_grad, u_sizes)])
            pull = settings.momentum * pull + np.bincount(np.concatenate([p_ids, u_ids]), each, len(weights))
            pull_bias = settings.momentum * pull_bias + p_grad.sum() + u_grad.sum()
            weights -= settings.rate * pull
            bias -= settings.rate * pull_bias
            if 2 * epoch >= settings.epochs:
                late, late_bias, counted = late + weights, late_bias + bias, counted + 1
    return Model((late / counted).astype(np.float32), float(late_bias / counted))


def training_texts(docs: DataFrame, labels: DataFrame, settings: Settings) -> tuple[list[str], list[str], float]:
    """Confirmed toxic texts, unlabelled texts, and the share of toxic rows among the labelled ones outside the held-out fold.

    Unlabelled texts are a hashed sample of all documents, whatever their labels, which are not looked at. An id gives one text.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    share = known.agg(F.avg("toxic")).first()[0]
    order = F.xxhash64(F.lit("toxic"), "_id")
    toxic = known.where("toxic = 1").select(F.col("doc_id").alias("_id")).distinct().orderBy(order, "_id").limit(settings.positives)
    found = docs.select("doc_id", "text").join(F.broadcast(toxic), F.col("doc_id") == F.col("_id")).groupBy("doc_id").agg(F.min("text").alias("text"))
    positive = [r.text or "" for r in sorted(found.collect(), key=lambda r: (r.doc_id, r.text or ""))]
    picked = docs.where(~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("_id")).distinct()
    picked = picked.orderBy(F.xxhash64(F.lit("any"), "_id"), "_id").limit(settings.unlabelled)
    found = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("_id")).groupBy("doc_id").agg(F.min("text").alias("text"))
    unlabelled = [r.text or "" for r in sorted(found.collect(), key=lambda r: (r.doc_id, r.text or ""))]
    least = settings.least_prior
    return positive, unlabelled, min(max(share if share is not None else least, least), 1 - least)


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    return fit(*training_texts(docs, labels, settings), settings)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with `score` (0 to 1) and `predicted`, from each whole text.

    Null and empty texts have no features and get the bias alone. Columns of these names in `docs` are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("score", "predicted")]

    @F.pandas_udf("double")
    def scored(text: pd.Series) -> pd.Series:
        weights, values = shared.value.weights, text.tolist()
        out = np.full(len(values), shared.value.bias)
        for a, b in text_blocks(values):
            out[a:b] += [weights[f].sum(dtype=np.float64) for f in features(Words(values[a:b]))]
        return pd.Series(_sigmoid(out))

    return docs.select(*kept, scored("text").alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
