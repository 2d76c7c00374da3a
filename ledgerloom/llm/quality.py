"""Quality: a generalised additive model with pairwise interactions over measures of a text.

A text is measured whole (lengths, shares of character classes, repetition of words, lines and word pairs, sentence shape).
Every measure is cut into bins at quantiles of the training rows. Cyclic boosting goes round the measures again and again;
in each turn a shallow tree on one measure's bins takes a small step against the logistic loss, and all trees of a measure
add up to one table, a value for each bin. Then the pairs of measures whose joint bins still explain most are boosted in
the same way into two-dimensional tables. A score adds one table entry for each measure and pair, for all rows at once.

The fit reads a bounded hash sample of the labelled rows of each class; the number of rounds comes from folds of these rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, labelled_sample, small_batches, table, trimmed

#: Expected number of labelled rows of each class that the fit reads (drawn by a hash of doc_id).
TRAIN_PER_CLASS = 5000
THRESHOLD = 0.7
#: Most bins of a measure, of a measure in a pair, and pairs; step of a tree; rounds of the measures and of the pairs at most.
BINS, PAIR_BINS, PAIRS = 32, 8, 12
STEP, ROUNDS, PAIR_ROUNDS = 0.15, 200, 60
#: Least weight of a leaf (sum of p (1 - p)) and ridge on its value; folds that choose the rounds.
LEAF, RIDGE, FOLDS = 0.5, 2.0, 3
MEASURES = (
    "log_chars log_words word_size long_words short_words upper digits marks odd_marks wide blanks shouts top_word distinct_words "
    "distinct_pairs distinct_lines line_size ended_lines sentence_size char_spread title_words marked_words"
).split()
#: Class of each code point below 128: 1 lower, 2 upper, 3 digit, 4 blank, 5 usual mark, 6 other mark.
_CLASS = np.array([4 if c in " \t\n\x0b\x0c\r" else 1 if c.islower() else 2 if c.isupper() else 3 if c.isdigit() else 5 if c in ".,;:'\"?-()" else 6 for c in map(chr, range(128))])


def measures(text: str | None) -> np.ndarray:
    """The measures of a whole text; those of a null text are those of an empty one."""
    text = text or ""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    plain = points[points < 128]
    kinds = np.bincount(_CLASS[plain], minlength=7) if len(plain) else np.zeros(7, np.int64)
    wide = len(points) - len(plain)
    words = text.split()
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    n, chars = max(1, len(words)), max(1, len(points) - int(kinds[4]))
    letters = max(1, int(kinds[1] + kinds[2]) + wide)
    counts = Counter(words)
    number = {w: k for k, w in enumerate(counts)}
    seq = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    pairs = len(np.unique(seq[:-1] * len(number) + seq[1:])) if len(seq) > 1 else 0
    lines = [x for x in text.splitlines() if x.strip()]
    ends = sum(text.count(c) for c in ".!?")
    seen = np.bincount(np.minimum(plain, 127), minlength=128)[33:] if len(plain) else np.zeros(95, np.int64)
    share = seen[seen > 0] / max(1, seen.sum())
    return np.array(
        [
            np.log1p(len(points)), np.log1p(len(words)), sizes.sum() / n, (sizes > 15).sum() / n, (sizes <= 3).sum() / n, kinds[2] / letters, kinds[3] / chars,
            kinds[5] / chars, kinds[6] / chars, wide / chars, kinds[4] / max(1, len(points)), text.count("!") / n, max(counts.values(), default=0) / n, len(counts) / n,
            pairs / max(1, len(seq) - 1), len({zlib.crc32(x.encode("utf-8", "surrogatepass")) for x in lines}) / max(1, len(lines)), np.log1p(len(points) / max(1, len(lines))),
            sum(x.rstrip()[-1] in ".!?" for x in lines) / max(1, len(lines)), np.log1p(n / (ends + 1)), float(-(share * np.log(share)).sum()),
            sum(w[:1].isupper() for w in words) / n, sum(not w[-1].isalnum() for w in words) / n,
        ],
        float,
    )


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Best gain and place to cut bins along the first axis into two leaves (gain 0: none)."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    all_g, all_h = g.sum(), h.sum()
    gain = left_g**2 / (left_h + RIDGE) + (all_g - left_g) ** 2 / (all_h - left_h + RIDGE) - all_g**2 / (all_h + RIDGE)
    gain[(left_h < LEAF) | (all_h - left_h < LEAF)] = 0
    return (float(gain.max()), int(gain.argmax()) + 1) if len(gain) else (0.0, 0)


def _leaves(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A tree of two levels on the bins of one measure: the step of every bin."""
    out = np.full(len(g), g.sum() / (h.sum() + RIDGE))
    gain, at = _cut(g, h)
    for part in (slice(0, at), slice(at, len(g))) if gain > 0 else ():
        gain, inner = _cut(g[part], h[part])
        base = part.start
        for leaf in (slice(base, base + inner), slice(base + inner, part.stop)) if gain > 0 else (part,):
            out[leaf] = g[leaf].sum() / (h[leaf].sum() + RIDGE)
    return out


def _pair_leaves(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """A tree on the joint bins of two measures, cut along one and then, on each side, along the other: gain, step of every cell."""
    best = (0.0, np.zeros(g.shape))
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        for at in range(1, len(a)):
            out, total = np.zeros(a.shape), -g.sum() ** 2 / (h.sum() + RIDGE)
            for part in (slice(0, at), slice(at, len(a))):
                x, y = a[part].sum(axis=0), b[part].sum(axis=0)
                gain, inner = _cut(x, y)
                for leaf in (slice(0, inner), slice(inner, len(x))) if gain > 0 else (slice(0, len(x)),):
                    value = x[leaf].sum() / (y[leaf].sum() + RIDGE)
                    out[part, leaf] = value
                    total += value * x[leaf].sum()
            if total > best[0] + 1e-12:
                best = (total, out.T if turned else out)
    return best


class Additive:
    """A table for each measure and for each chosen pair, and a bias: score(measures) adds their entries."""

    def __init__(self, x: np.ndarray, bins: int = BINS, pair_bins: int = PAIR_BINS) -> None:
        def edges(most: int) -> list[np.ndarray]:
            cuts = [np.unique(np.quantile(c, np.arange(1, most) / most)) if len(c) else np.empty(0) for c in x.T]
            return [c[c > col.min()] if len(c) else c for c, col in zip(cuts, x.T)]

        self.edges, self.pair_edges = edges(bins), edges(pair_bins)
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: dict[tuple[int, int], np.ndarray] = {}
        self.bias = 0.0

    @staticmethod
    def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
        """Bin numbers, a row for each measure: bin k holds values from edge k - 1 on and below edge k."""
        return np.array([np.searchsorted(e, c, "right") for e, c in zip(edges, x.T)]).reshape(len(edges), len(x))

    def margin(self, x: np.ndarray) -> np.ndarray:
        own, joint = self.binned(x, self.edges), self.binned(x, self.pair_edges)
        z = np.full(len(x), self.bias)
        for t, b in zip(self.tables, own):
            z += t[b]
        for (i, j), t in self.pairs.items():
            z += t[joint[i], joint[j]]
        return z

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.margin(x))


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.logaddexp(0, np.where(y > 0, -z, z)).mean()) if len(z) else 0.0


def boosted(x: np.ndarray, y: np.ndarray, rounds: int, pair_rounds: int, watch: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[Additive, list[float], list[float]]:
    """A model after so many rounds of the measures and then of the pairs; with `watch` (measures, labels), its loss after each round."""
    model = Additive(x)
    share = (y.sum() + 1) / (len(y) + 2)
    model.bias = float(np.log(share / (1 - share)))
    own, joint = model.binned(x, model.edges), model.binned(x, model.pair_edges)
    z, losses, pair_losses = np.full(len(y), model.bias), [], []
    if watch:
        seen, seen_joint, seen_z = model.binned(watch[0], model.edges), model.binned(watch[0], model.pair_edges), np.full(len(watch[1]), model.bias)
    for _ in range(rounds):
        for k, t in enumerate(model.tables):
            if len(t) < 2:
                continue
            p = _sigmoid(z)
            step = STEP * _leaves(np.bincount(own[k], y - p, len(t)), np.bincount(own[k], p * (1 - p), len(t)))
            t += step
            z += step[own[k]]
            if watch:
                seen_z += step[seen[k]]
        if watch:
            losses.append(_loss(seen_z, watch[1]))
    if pair_rounds:
        sizes = [len(e) + 1 for e in model.pair_edges]
        cell = {(i, j): joint[i] * sizes[j] + joint[j] for i in range(len(sizes)) for j in range(i) if min(sizes[i], sizes[j]) > 1}

        def tree(pair: tuple[int, int]) -> tuple[float, np.ndarray]:
            p, shape = _sigmoid(z), (sizes[pair[0]], sizes[pair[1]])
            g, h = (np.bincount(cell[pair], v, shape[0] * shape[1]).reshape(shape) for v in (y - p, p * (1 - p)))
            return _pair_leaves(g, h)

        gains = {pair: tree(pair)[0] for pair in cell}
        for pair in sorted(gains, key=lambda pair: (-gains[pair], pair))[:PAIRS]:
            model.pairs[pair] = np.zeros((sizes[pair[0]], sizes[pair[1]]))
        for _ in range(pair_rounds):
            for (i, j), t in model.pairs.items():
                step = STEP * tree((i, j))[1]
                t += step
                z += step[joint[i], joint[j]]
                if watch:
                    seen_z += step[seen_joint[i], seen_joint[j]]
            if watch:
                pair_losses.append(_loss(seen_z, watch[1]))
    return model, losses, pair_losses


def _best(losses: list[list[float]]) -> int:
    """The number of rounds of least mean loss over the folds."""
    return int(np.mean(losses, axis=0).argmin()) + 1 if losses and losses[0] else 0


def fit(x: np.ndarray, y: np.ndarray) -> Additive:
    """A model of labels 0/1 from measures, a row for each training text; rounds are chosen by folds of these rows alone."""
    fold = np.arange(len(y)) % FOLDS
    parts = [(fold != k, fold == k) for k in range(FOLDS)]
    rounds = _best([boosted(x[a], y[a], ROUNDS, 0, (x[b], y[b]))[1] for a, b in parts])
    runs = [boosted(x[a], y[a], rounds, PAIR_ROUNDS, (x[b], y[b])) for a, b in parts]
    return boosted(x, y, rounds, _best([r[2] for r in runs]))[0]


def measured(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """The columns `keep` and x: the measures of each text."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([measures(t) for t in texts], dtype=object)

    return docs.select(*keep, F.pandas_udf(trimmed(run), "array<double>", F.PandasUDFType.SCALAR_ITER)(F.col(text).cast("string")).alias("x"))


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = TRAIN_PER_CLASS) -> Additive:
    """A model from about per_class labelled rows of each label outside the held-out quarter.

    Null labels and others than 0 and 1 take no part; of several labels of a doc_id the largest counts, of several texts
    the first in code-point order. Without rows of both labels every score is the share of label 1 (0.5 without any).
    """
    sample, counts = labelled_sample(docs, labels, label, per_class)
    positive, negative = counts.get(1, 0), counts.get(0, 0)
    rows = measured(sample, "doc_id", "label").collect()  # the documented sample, len(MEASURES) numbers each
    rows.sort(key=lambda r: zlib.crc32(str(r["doc_id"]).encode()))
    x, y = np.array([r["x"] for r in rows]).reshape(-1, len(MEASURES)), np.array([r["label"] for r in rows], float)
    ones, zeros = int(y.sum()), int(len(y) - y.sum())
    if not ones or not zeros:
        model = Additive(np.empty((0, len(MEASURES))))
        model.bias = float(np.log((positive + 1) / (negative + 1)))
        return model
    model = fit(x, y)
    # back from the sample's class shares to those of all labelled rows
    model.bias += float(np.log(positive / negative) - np.log(ones / zeros))
    return model


def scored(docs: DataFrame, model: Additive, text: str = "text") -> DataFrame:
    """docs plus score; a null text counts as empty. Nothing shuffles.

    A column of docs that is named score is replaced; all others, repeated rows too, stay. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some ten thousand numbers

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(shared.value.score(np.array([measures(t) for t in texts]).reshape(-1, len(MEASURES))))

    return docs.withColumn("score", F.pandas_udf(trimmed(run), "double", F.PandasUDFType.SCALAR_ITER)(F.col(text).cast("string")))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted (1 if score >= 0.7). Only the text is read for a score."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = scored(docs, learn(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
