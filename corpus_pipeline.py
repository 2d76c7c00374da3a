"""A training corpus from raw documents: identify, deduplicate, mix, encode.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
Stages work on all rows that their predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import held_out, staged
from ledgerloom.llm.exact_dedup import exact_dedup
from ledgerloom.llm.language import UNDETERMINED, identified, learn_profiles
from ledgerloom.llm.minhash import near_dedup
from ledgerloom.llm.mixing import mixed_documents
from ledgerloom.llm.pieces import encoded

#: Least score (1 at out-of-place distance 0, 0 at the largest) at which a document is of the nearest language.
LANGUAGE_SCORE = 0.25


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are far from every language's profile go, and those without a letter (null and empty texts too).

    lang becomes the nearest language; other columns, whatever their names, and repeated rows stay as they are.
    """
    profiles = learn_profiles(docs.filter(~held_out(F.col("doc_id"))))
    slim = docs.select(F.struct(*docs.columns).alias("row"), F.col("text"))
    kept = identified(slim, profiles).filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LANGUAGE_SCORE))
    return kept.select(*[F.col("lang_pred").alias(c) if c == "lang" else F.col(f"row.`{c}`") for c in docs.columns])


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal without white space stays.

    Null texts count as empty; of a group the longest original text stays, then the smallest doc_id, and rows that repeat
    both collapse to one.
    """
    return exact_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, that of the smallest doc_id.

    Texts without words, null ones too, are classes of their own; rows with a null doc_id stay.
    """
    return near_dedup(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the target weights of the sources ask for, as whole rows.

    A null source is a source of its own, the last; texts without words follow their source's whole repetitions.
    """
    return mixed_documents(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and the ids themselves, one row per input row; a null text is empty."""
    return encoded(docs, keep_ids=True)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("mixing", mixture),
    ("pieces", pieces),
]

#: Language profiles, dart signatures and merges have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
