"""Quality classifier from supervised subword embeddings."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countyloom.llm.common import Words, held_out, mix, text_blocks

BITS = 16
SIZE = 4 << BITS


@dataclass(frozen=True)
class Settings:
    """`train_rows` bounds the labelled rows that are fitted: those whose hashed ids come first."""

    train_rows: int = 4000
    dim: int = 12
    epochs: int = 8
    rate: float = 1.0
    seed: int = 7
    cut: float = 0.3


@dataclass(frozen=True)
class Model:
    """What scoring needs: each hashed feature's vector times the softmax weights, as log-odds of label 1 over 0."""

    odds: np.ndarray
    bias: float


def features(words: Words) -> list[np.ndarray]:
    """Hashed features of each text, with repetitions: words, runs of two and three bytes inside them, and word pairs.

    A pair of words stands for itself, or for "the same again" where a word equals one of the four before it.
    """
    again = np.zeros(len(words.word), np.int64)
    for back in (4, 3, 2, 1):
        same = (words.word[back:] == words.word[:-back]) & (words.doc[back:] == words.doc[:-back])
        again[back:][same] = back
    pair = words.word.copy()
    pair[1:] += mix(words.word[:-1])
    pair = mix(np.where(again > 0, again, pair).astype(np.uint64))
    found = [(words.word, words.doc, 0), (pair, words.doc, 1), (*words.grams(2), 2), (*words.grams(3), 3)]
    cuts = [np.searchsorted(d, np.arange(words.count + 1)) for _, d, _ in found]
    ids = [(h >> np.uint64(64 - BITS)).astype(np.int64) + (kind << BITS) for h, _, kind in found]
    return [np.concatenate([x[c[i] : c[i + 1]] for x, c in zip(ids, cuts, strict=True)]) for i in range(words.count)]


def training_rows(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """At most `rows` labelled documents outside the held-out fold, as (_id, _label, text); one text of each id."""
    chosen = labels.where(F.col(label).isin(0, 1) & ~held_out(F.col("doc_id"))).select(
        F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_label")
    ).distinct()
    chosen = chosen.orderBy(F.xxhash64(F.lit("train"), "_id"), "_id", "_label").limit(rows)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    return found.groupBy("_id", "_label").agg(F.coalesce(F.min("text"), F.lit("")).alias("text"))


def fit(samples: list[tuple[str, int]], settings: Settings) -> Model:
    """Embeddings and softmax weights by stochastic gradient descent; a rate that falls to zero, one text a step.

    With no samples, or with one class only, every text gets the share of label 1 (0.5 without samples).
    """
    y = np.array([label for _, label in samples], np.int64)
    if len(set(y.tolist())) < 2:
        share = float(y.mean()) if len(y) else 0.5
        return Model(np.zeros(SIZE, np.float32), float(np.log(max(share, 1e-3) / max(1 - share, 1e-3))))
    texts = [t for t, _ in samples]
    sparse = []
    for a, b in text_blocks(texts):
        for f in features(Words(texts[a:b])):
            ids, counts = np.unique(f, return_counts=True)
            sparse.append((ids.astype(np.int32), (counts / max(1, counts.sum())).astype(np.float32)[:, None]))
    rng = np.random.default_rng(settings.seed)
    vectors = rng.uniform(-1, 1, (SIZE, settings.dim)).astype(np.float32) / settings.dim
    weights, bias = np.zeros((2, settings.dim), np.float32), np.zeros(2, np.float32)
    steps, done = settings.epochs * len(sparse), 0
    for _ in range(settings.epochs):
        for i in rng.permutation(len(sparse)):
            ids, share = sparse[i]
            rate = settings.rate * (1 - done / steps)
            done += 1
            own = vectors[ids]
            mean = (own * share).sum(0)
            out = weights @ mean + bias
            out = np.exp(out - out.max())
            error = out / out.sum()
            error[y[i]] -= 1
            back = error @ weights
            weights -= rate * np.outer(error, mean)
            bias -= rate * 0.1 * error
            # A document's share of each vector's gradient is scaled up to the size of a word's own step.
            vectors[ids] = own - rate * np.minimum(share * 100, 1) * back
    return Model((vectors @ (weights[1] - weights[0])).astype(np.float32), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """The model of the bounded sample, fitted in one task, in order of id; the driver gets what scoring needs, 1 MB."""

    def fitted(frames):
        samples = sorted(s for f in frames for s in zip(f["_id"].tolist(), f["text"].tolist(), f["_label"].tolist(), strict=True))
        model = fit([(text, label) for _, text, label in samples], settings)
        yield pd.DataFrame({"odds": [model.odds.astype("<f4").tobytes()], "bias": [model.bias]})

    sample = training_rows(docs, labels, "quality", settings.train_rows)
    found = sample.repartition(1).mapInPandas(fitted, "odds binary, bias double").first()
    if found is None:  # an empty sample may have no task at all
        return fit([], settings)
    return Model(np.frombuffer(found["odds"], "<f4"), found["bias"])


def score(docs: DataFrame, model: Model, settings: Settings = Settings()) -> DataFrame:
    """`docs` with `score` (0 to 1) and `predicted`: the mean of the features' log-odds of the whole text through the softmax.

    Null and empty texts have no features and get the bias alone. Columns of these names in `docs` are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("score", "predicted")]

    @F.pandas_udf("double")
    def scored(text: pd.Series) -> pd.Series:
        odds, out, values = shared.value.odds, np.full(len(text), shared.value.bias), text.tolist()
        for a, b in text_blocks(values):
            for i, f in enumerate(features(Words(values[a:b])), a):
                if len(f):
                    out[i] += odds[f].mean(dtype=np.float64)
        return pd.Series(1 / (1 + np.exp(-np.clip(out, -500, 500))))

    return docs.select(*kept, scored("text").alias("score")).withColumn("predicted", (F.col("score") >= settings.cut).cast("int"))
