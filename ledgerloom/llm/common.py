"""Helpers that several training-data operators share."""

from __future__ import annotations

import ctypes
import functools
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six white-space characters of the contracts, [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"

#: Bytes of one Arrow batch; keeps a batch of long texts small in a Python worker.
BATCH_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir); on one machine a temporary one if none is set."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = getattr(shared_dir, "own", None)
    if own is None:
        own = shared_dir.own = tempfile.mkdtemp(prefix="ledgerloom-")
    return own


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage is cut, lost executors cost nothing upstream."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound the bytes that a Python worker is handed at once. All operators set the same bound, so that none changes the
    batches of another's frame that runs later."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def _hand_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than glibc
        pass


def trimmed(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run, and at the end of its partition unused memory goes back to the system: Spark keeps idle Python workers."""

    @functools.wraps(run)
    def whole(batches: Iterator) -> Iterator:
        yield from run(batches)
        _hand_back()

    return whole


def trimmed_group(run: Callable) -> Callable:
    """run(key, rows) of a group, and after a large group unused memory goes back to the system."""

    def whole(key, rows):
        out = run(key, rows)
        if len(rows) > 4096:
            _hand_back()
        return out

    return whole


def crc_mod4(doc_id: Column) -> Column:
    """crc32 of the id's decimal text, modulo 4; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4


def held_out(doc_id: Column) -> Column:
    return crc_mod4(doc_id) == 2


def uniform53(seed: int, *keys: Column) -> Column:
    """A reproducible whole number in [0, 2^52) drawn from the md5 of the keys."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, seed: int = 7) -> tuple[DataFrame, dict[int, int]]:
    """About per_class rows (doc_id, text, label) of each label 0/1 outside the held-out quarter; how many there are in all.

    labels with null or other values take no part; of several labels of one doc_id the largest counts, of several texts
    the first in code-point order, so that repeated rows of either table teach once.
    """
    known = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label")).filter("label in (0, 1) and doc_id is not null").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    share = F.when(F.col("label") == 1, min(1.0, per_class / max(1, counts.get(1, 0)))).otherwise(min(1.0, per_class / max(1, counts.get(0, 0))))
    few = known.filter(uniform53(seed, F.col("doc_id")) < share * float(1 << 52)).withColumnRenamed("doc_id", "__id")
    rows = docs.select("doc_id", "text").join(F.broadcast(few), F.col("doc_id") == F.col("__id"))  # about 2 per_class rows
    return rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label")), counts
