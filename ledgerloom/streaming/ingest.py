"""Resumable ingest of a landing zone with Structured Streaming's file source.

Each run reads the files that no earlier run has read (trigger availableNow) and appends them. The checkpoint remembers
files, and a batch that is repeated after a failure replaces its own partition, so a page is never counted twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ingest(spark: SparkSession, source: str, target: str, checkpoint: str, schema: str, transform: Callable[[DataFrame], DataFrame] | None = None, file_format: str = "json", max_files: int | None = None) -> int:
    """Append what is new under source to target (partitioned by batch_id); the number of batches that ran."""
    reader = spark.readStream.schema(schema).format(file_format)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.load(source)
    ran: list[int] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch) if transform else batch
        out.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(target)
        ran.append(batch_id)

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return len(ran)


def ingested(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target).drop("batch_id")
