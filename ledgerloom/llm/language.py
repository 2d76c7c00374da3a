"""Language identification with rank-order n-gram profiles (out-of-place distance).

A language's profile is the list of its most frequent letter n-grams (one to three letters, a blank for word ends).
A document's own most frequent n-grams are compared with each profile: every n-gram adds the difference of its two
ranks, or the profile length where the profile lacks it. The nearest profile names the language.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import held_out, small_batches, table, trimmed, uniform53

#: n-grams of a profile, and of a document at most.
PROFILE = 400
#: Expected number of documents of one language that its profile is learned from (drawn by a hash of doc_id).
TRAIN_PER_LANGUAGE = 4000
UNDETERMINED = "und"
_LETTER, _MARK = 1, 2


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Of every code point: a letter, a combining mark (which belongs to the word it stands in), or neither (0)."""
    kind = {"L": _LETTER, "M": _MARK}
    return np.fromiter((kind.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)), np.uint8, 0x110000)


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of the whole text (letters packed in 21 bits each, ascending) and their counts.

    Words are runs of letters and combining marks, in lower case; a text without a letter has none.
    """
    c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    kind = _kinds()[c]
    if not (kind == _LETTER).any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    own = kind > 0
    first = int(own.argmax())
    c = np.where(own, c, 32)[first - 1 :]
    c = c[np.r_[True, (c[1:] != 32) | (c[:-1] != 32)]]
    pair = c[:-1] << 21 | c[1:]
    grams = np.concatenate([c[c != 32], pair, (pair[:-1] << 21 | c[2:])[c[1:-1] != 32]])
    grams.sort()
    starts = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]])
    return grams[starts], np.diff(np.r_[starts, len(grams)])


def top_grams(text: str, most: int) -> np.ndarray:
    """The most frequent n-grams, ties by code."""
    grams, counts = gram_counts(text)
    return grams[np.argsort(-counts, kind="stable")[:most]]


class Profiles:
    """Ranks of n-grams in every language's profile: one row for each gram and language that has it, by gram."""

    def __init__(self, ranked: dict[str, list[int]], size: int) -> None:
        self.languages = sorted(ranked)
        self.size = size
        rows = sorted((g, k, rank) for k, name in enumerate(self.languages) for rank, g in enumerate(ranked[name]))
        self.gram, self.language, self.rank = (np.array([r[i] for r in rows], np.int64) for i in range(3))

    def distances(self, own: np.ndarray) -> np.ndarray:
        """Out-of-place distance of a ranked list of n-grams to every language: `size` for each gram that it lacks."""
        low, high = np.searchsorted(self.gram, own, "left"), np.searchsorted(self.gram, own, "right")
        place = np.repeat(np.arange(len(own)), high - low)
        at = np.arange(len(place)) + np.repeat(low - np.cumsum(high - low) + high - low, high - low)
        nearer = self.size - np.abs(self.rank[at] - place)
        return self.size * len(own) - np.bincount(self.language[at], nearer, len(self.languages)).astype(np.int64)

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score (1 at distance 0, 0 at the largest distance)."""
        own = top_grams(text or "", self.size)
        if not len(own) or not self.languages:
            return UNDETERMINED, 0.0
        off = self.distances(own)
        best = int(off.argmin())  # ties: the first language by name
        return self.languages[best], float(1 - off[best] / (self.size * len(own)))


def learn_profiles(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", size: int = PROFILE, per_language: int = TRAIN_PER_LANGUAGE) -> Profiles:
    """Profiles from the rows of docs with a text and a language; about per_language rows of each language are read.

    The driver and every worker hold `size` numbers for each distinct language, whatever the corpus. Rows with a null
    id, text or language teach as their values allow: a null id is drawn as the empty text, a null text or language
    teaches nothing. Ties of n-grams go to the smaller code.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")).filter("lang is not null and text is not null")
    counts = rows.groupBy("lang").agg((F.lit(float(per_language)) / F.count(F.lit(1))).alias("share")).withColumnRenamed("lang", "__lang")
    drawn = rows.join(F.broadcast(counts), F.col("lang") == F.col("__lang"))  # one row for each language
    sample = drawn.filter(uniform53(4, F.col("id")) < F.col("share") * float(1 << 52)).select("lang", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, texts in batch.groupby("lang")["text"]:
                parts = [gram_counts(t) for t in texts]
                grams, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                n = np.bincount(inverse, np.concatenate([p[1] for p in parts]), len(grams)).astype(np.int64)
                yield pd.DataFrame({"lang": name, "gram": grams, "n": n})

    grams = sample.mapInPandas(trimmed(count), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    ranked: dict[str, list[int]] = {}
    for r in grams.withColumn("place", place).filter(F.col("place") <= size).orderBy("lang", "place").collect():
        ranked.setdefault(r["lang"], []).append(r["gram"])
    return Profiles(ranked, size)


def identified(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """docs plus lang_pred and score, both read from the text alone; nothing shuffles.

    lang_pred is UNDETERMINED (score 0) where the text is null or has no letter. Columns of docs that are named
    lang_pred or score are replaced; all others, repeated rows too, stay as they are. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)

    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([profiles.predict(t) for t in texts], columns=["lang", "score"])

    predict = F.pandas_udf(trimmed(predicted), "lang string, score double", F.PandasUDFType.SCALAR_ITER)
    found = docs.withColumn("__language", predict(F.col(text).cast("string")))
    return found.withColumns({"lang_pred": F.col("__language.lang"), "score": F.col("__language.score")}).drop("__language")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score. Held-out rows teach nothing; null texts get `und`."""
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = learn_profiles(docs.filter(~held_out(F.col("doc_id"))))
    return identified(docs.select("doc_id", "text"), profiles).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
