"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are the hashed character n-grams present in a text (lower case, white space as one blank). Each is worth its
log-count ratio between toxic and other training texts; a logistic regression over these values gives the weights.
The fit reads a bounded hash sample of the labelled rows of each class; everything is scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, labelled_sample, small_batches, staged, table, trimmed

ORDERS = (3, 4, 5)
BITS = 20
#: Expected number of labelled rows of each class that the fit reads (drawn by a hash of doc_id).
TRAIN_PER_CLASS = 3000
#: Features the regression weighs: those with the strongest evidence, present in at least MIN_DOCS training texts. As many
#: as PER_ROW for each training row of the rarer class, within these bounds: few rows cannot tell more features apart.
LEAST_FEATURES, FEATURES, PER_ROW = 500, 8000, 3
MIN_DOCS = 5
THRESHOLD = 0.3
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def grams(text: str | None) -> np.ndarray:
    """The distinct hashed n-grams of the whole text, ascending."""
    clean = f" {' '.join((text or '').lower().split())} "
    c = np.frombuffer(clean.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    parts, h = [], np.zeros(len(c), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        if len(c) < n:
            break
        h = (h[: len(c) - n + 1] ^ c[n - 1 :]) * _MIX[0]
        h ^= h >> np.uint64(29)
        if n in ORDERS:
            parts.append(((h * _MIX[1]) >> np.uint64(64 - BITS)).astype(np.int32))
    if not parts:
        return np.empty(0, np.int32)
    found = np.concatenate(parts)
    found.sort()
    return found[np.r_[True, found[1:] != found[:-1]]]


class Model:
    """score(text): probability of label 1."""

    def __init__(self, features: np.ndarray, weights: np.ndarray, bias: float) -> None:
        self.weights = np.zeros(1 << BITS, np.float32)
        self.weights[features] = weights
        self.bias = bias

    def score(self, text: str | None) -> float:
        z = self.bias + float(self.weights[grams(text)].sum(dtype=np.float64))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _logistic(rows: list[np.ndarray], labels: np.ndarray, scale: np.ndarray, ridge: float = 3.0, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Weights of the scaled features by gradient descent with a step of its own for each weight."""
    row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
    col = np.concatenate(rows) if rows else np.empty(0, np.int32)
    w, b = np.zeros(len(scale)), 0.0
    gw, gb = np.full(len(scale), 1e-8), 1e-8
    for _ in range(rounds):
        z = b + np.bincount(row, (scale * w)[col], len(rows))
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels
        dw, db = scale * np.bincount(col, error[row], len(scale)) + ridge * w, float(error.sum())
        gw += dw * dw
        gb += db * db
        w -= 0.3 * dw / np.sqrt(gw)
        b -= 0.3 * db / np.sqrt(gb)
    return w, b


def fit(labelled: DataFrame, counts: dict[int, int]) -> Model:
    """A model from a bounded sample of rows (text, label 0/1) drawn from `counts` labelled rows of each label.

    Without rows of both classes every score is the share of label 1.
    """
    sample = staged(labelled.select("text", "label"), "toxic-sample")
    positive, negative = counts.get(1, 0), counts.get(0, 0)
    n = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if not n.get(1) or not n.get(0):
        share = (positive + 1) / (positive + negative + 2)
        return Model(np.empty(0, np.int64), np.empty(0), float(np.log(share / (1 - share))))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"]):
                total[int(label), grams(text)] += 1
        seen = np.flatnonzero(total.any(axis=0))
        yield pd.DataFrame({"gram": seen, "negative": total[0, seen], "positive": total[1, seen]})

    sums = sample.mapInPandas(count, "gram long, negative long, positive long").groupBy("gram").agg(F.sum("negative").alias("negative"), F.sum("positive").alias("positive"))
    p, q = (F.col("positive") + 1) / F.lit(n[1] + 2.0), (F.col("negative") + 1) / F.lit(n[0] + 2.0)
    ratio = F.log(p / q)
    most = min(FEATURES, max(LEAST_FEATURES, PER_ROW * min(n[0], n[1])))
    evidence = F.abs(ratio) * F.sqrt(F.col("positive") + F.col("negative"))
    best = sums.filter(F.col("positive") + F.col("negative") >= MIN_DOCS).select("gram", ratio.alias("ratio"), evidence.alias("evidence")).orderBy(F.desc("evidence"), "gram").limit(most).collect()
    best.sort(key=lambda r: r["gram"])
    features, ratios = np.array([r["gram"] for r in best], np.int64), np.array([r["ratio"] for r in best])
    place = np.full(1 << BITS, -1, np.int32)
    place[features] = np.arange(len(features))

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = [place[grams(t)] for t in batch["text"]]
            yield pd.DataFrame({"own": [x[x >= 0].tobytes() for x in own], "label": batch["label"]})

    rows = sample.mapInPandas(project, "own binary, label int").collect()  # the documented sample of at most FEATURES numbers each
    rows.sort(key=lambda r: (r["label"], bytes(r["own"])))
    weights, bias = _logistic([np.frombuffer(r["own"], np.int32) for r in rows], np.array([r["label"] for r in rows], float), ratios)
    # back from the sample's class shares to those of all labelled rows
    bias += float(np.log(positive / negative) - np.log(n[1] / n[0]))
    return Model(features, weights * ratios, bias)


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs plus score; a null text counts as empty. Nothing shuffles.

    A column of docs that is named score is replaced; all others, repeated rows too, stay. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 4 MB whatever the corpus

    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shared.value.score(t) for t in texts], dtype=float)

    score = F.pandas_udf(trimmed(scores), "double", F.PandasUDFType.SCALAR_ITER)
    return docs.withColumn("score", score(F.col(text).cast("string")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted (1 if score >= 0.3). Only the text is read for a score."""
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    sample, counts = labelled_sample(docs, table(spark, sf_dir, "labels"), "toxic", TRAIN_PER_CLASS)
    model = fit(sample, counts)
    out = scored(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
