"""Landing raw pages and publishing tables with their metadata.

A published table is a set of part directories, and one small pointer file per directory names the parts and the metadata of
all its tables. Publishing writes new parts beside the old ones and then replaces the pointer, which is the only step that
readers can see: before it they find the old tables, after it the new ones, several tables together. What a broken publish
has written is never pointed at. A table with a period and buckets is split into parts by them, and an update rewrites only
the parts that its rows touch. Old parts stay for readers that have begun with them, until `vacuumed` removes them.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators import metrics
from ..sources.tables import POINTER, current, read_parts, store


@dataclass(frozen=True)
class Dataset:
    """What a published table is: its name, keys and how it is replaced.

    period (a date pattern) and buckets (of the first sort column) split it into parts that an update rewrites one by one.
    """

    name: str
    group: str
    write_mode: str
    completeness: str
    keys: list[str]
    date: str | None = None
    entity: str | None = None
    sort: list[str] = field(default_factory=list)
    period: str | None = None
    buckets: int = 1

    def identity(self) -> dict:
        out = {"dataset_name": self.name, "dataset_group": self.group, "write_mode": self.write_mode, "completeness_profile": self.completeness, "primary_key": self.keys}
        return out | ({"date_column": self.date} if self.date else {}) | ({"entity_column": self.entity} if self.entity else {})


def state(df: DataFrame, dataset: Dataset, required: list[str], extra: DataFrame | None = None) -> dict:
    """Metadata of a table: identity, time, state, and one row of further measures."""
    row = metrics.frame_state(df, dataset.keys, required, dataset.date, dataset.entity).first().asDict()
    more = extra.first().asDict() if extra is not None else {}
    now = dt.datetime.now(dt.UTC).replace(tzinfo=None).isoformat(timespec="seconds") + "Z"
    return {"generated_at_utc": now} | dataset.identity() | row | more


def measured_state(spark: SparkSession, directory: str, entry: dict, dataset: Dataset) -> dict:
    """Metadata of a table in parts whose rows the caller has counted: of the data, only the last period's parts are read."""
    periods = [p.rsplit("-", 1)[0] for p in entry["parts"]]
    last = [p for p in entry["parts"] if p.rsplit("-", 1)[0] == max(periods)]
    row = metrics.latest_coverage(read_parts(spark, directory, entry, last), dataset.date, dataset.entity).first().asDict()
    now = dt.datetime.now(dt.UTC).replace(tzinfo=None).isoformat(timespec="seconds") + "Z"
    return {"generated_at_utc": now, "missing_required_columns": []} | dataset.identity() | row


def part_of(dataset: Dataset, day: Column, key: Column) -> Column:
    """The name of the part that a row belongs to."""
    return F.concat_ws("-", F.date_format(day, dataset.period), F.pmod(F.xxhash64(key), F.lit(dataset.buckets)).cast("string"))


def touched_parts(plan: DataFrame, dataset: Dataset, key: str, since: str, known: list[str]) -> list[str]:
    """Those of the known parts that may hold rows of the planned keys from their dates on (one row a part comes back)."""
    names = plan.sparkSession.createDataFrame([(n, n.rsplit("-", 1)[0], n.rsplit("-", 1)[1]) for n in known], "name string, period string, bucket string")
    own = plan.select(F.date_format(since, dataset.period).alias("first"), F.pmod(F.xxhash64(key), F.lit(dataset.buckets)).cast("string").alias("bucket"))
    first = own.groupBy("bucket").agg(F.min("first").alias("first"))  # periods sort as text
    return sorted(r["name"] for r in names.join(first, "bucket").filter(F.col("period") >= F.col("first")).collect())


def _write_parts(df: DataFrame, base: str, version: str, dataset: Dataset) -> dict[str, str]:
    """df, in the dataset's order, under base/version; the directory of every part, relative to base's parent."""
    spark, name = df.sparkSession, base.rsplit("/", 1)[-1]
    out = f"{base}/{version}"
    if dataset.period is None:
        if dataset.sort:
            df = df.repartitionByRange(*dataset.sort).sortWithinPartitions(*dataset.sort)
        df.write.option("compression", "zstd").parquet(out)
        return {"": f"{name}/{version}"}
    part = part_of(dataset, F.col(dataset.date), F.col(dataset.sort[0]))
    rows = df.withColumn("__part", part).hint("rebalance", "__part").sortWithinPartitions("__part", *dataset.sort)
    rows.write.option("compression", "zstd").partitionBy("__part").parquet(out)
    fs, at = store(spark, out)
    found = [x.getPath().getName() for x in fs.listStatus(at)]
    return {d.split("=", 1)[1]: f"{name}/{version}/{d}" for d in found if d.startswith("__part=")}


def _put(spark: SparkSession, path: str, text: str, overwrite: bool) -> None:
    fs, at = store(spark, path)
    out = fs.create(at, overwrite)
    out.write(bytearray(text.encode()))
    out.close()


def switch(spark: SparkSession, directory: str, pointer: dict) -> None:
    """Replace the pointer in one step. Earlier pointers stay beside it, by generation."""
    text = json.dumps(pointer, sort_keys=True, default=str)
    _put(spark, f"{directory}/_generations/{pointer['generation']:08d}.json", text, False)
    draft = f"{directory}/_generations/.{uuid.uuid4().hex}"
    _put(spark, draft, text, False)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    _, at = store(spark, f"{directory}/{POINTER}")
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), conf).rename(store(spark, draft)[1], at, options)


def _generations(spark: SparkSession, directory: str) -> list[str]:
    fs, at = store(spark, f"{directory}/_generations")
    return sorted(n for x in fs.listStatus(at) if not (n := x.getPath().getName()).startswith(".")) if fs.exists(at) else []


def publish(tables: dict[str, tuple[DataFrame, Dataset, dict]], directory: str, touched: dict[str, list[str]] | None = None) -> dict[str, dict]:
    """Write all tables, then point at them together. tables: name to (table, dataset, further metadata).

    touched: for a table of which only some parts are given, the names of the parts that its rows replace; parts that are
    neither named nor written stay. Metadata describes the whole table; of a table in parts whose counts are given it is not
    read again. Returns the new entries by name.
    """
    touched = touched or {}
    spark = next(iter(tables.values()))[0].sparkSession
    before = current(spark, directory)
    done: dict[str, dict] = {}
    version = dt.datetime.now(dt.UTC).strftime("v%Y%m%dT%H%M%S-") + uuid.uuid4().hex[:8]
    for name, (df, dataset, extra) in tables.items():
        parts = _write_parts(df, f"{directory}/{name}", version, dataset)
        if name in touched:
            old = before["tables"].get(name, {}).get("parts", {})
            parts = {k: v for k, v in old.items() if k not in touched[name]} | parts
        entry = {"parts": parts, "schema": df.schema.jsonValue()}
        counted = dataset.period is not None and {"row_count", "duplicate_key_count", "min_date", "max_date"} <= set(extra)
        about = measured_state(spark, directory, entry, dataset) if counted else state(read_parts(spark, directory, entry), dataset, df.columns)
        about |= {"table": name} | extra
        done[name] = entry | {"metadata": json.loads(json.dumps(about, default=str))}
    taken = [int(n.split(".")[0]) for n in _generations(spark, directory)]
    now = current(spark, directory)  # tables that others have published meanwhile stay theirs
    switch(spark, directory, {"generation": max([now["generation"], *taken]) + 1, "tables": now["tables"] | done})
    return done


def vacuumed(spark: SparkSession, directory: str, keep: int = 2) -> list[str]:
    """Delete the versions that neither the pointer nor the last `keep` generations name; what was deleted.

    Not while a publish into the same directory is running: its parts are named last.
    """
    names = _generations(spark, directory)
    last = [current(spark, directory), *[current(spark, directory, f"_generations/{n}") for n in names[-keep:]]] if keep else [current(spark, directory)]
    used = {"/".join(p.split("/")[:2]) for pointer in last for t in pointer["tables"].values() for p in t["parts"].values()}
    fs, at = store(spark, directory)
    gone = []
    for table in fs.listStatus(at):
        name = table.getPath().getName()
        for version in fs.listStatus(table.getPath()) if table.isDirectory() and not name.startswith("_") else ():
            path = f"{name}/{version.getPath().getName()}"
            if path not in used:
                fs.delete(version.getPath(), True)
                gone.append(path)
    for n in names[:-keep] if keep else names:
        fs.delete(store(spark, f"{directory}/_generations/{n}")[1], False)
    return sorted(gone)


def land_json_pages(pages: DataFrame, path: str, provider: str, endpoint: str, params: dict[str, str] | None = None) -> DataFrame:
    """Write pages (body) as gzip JSON lines with sorted keys under path; the manifest, one row."""
    if not path.rstrip("/").endswith(".jsonl.gz"):
        raise ValueError("raw provider snapshot path must end with .jsonl.gz")
    pages.select(F.coalesce(X.canonical_json("body"), F.col("body")).alias("value")).write.mode("overwrite").option("compression", "gzip").text(path)
    return manifest(pages.sparkSession, path, provider, endpoint, params)


def land_text(pages: DataFrame, path: str, provider: str, url: str) -> DataFrame:
    """Write whole texts (body) under path, one file each partition; the manifest, one row."""
    pages.select(F.col("body").alias("value")).write.mode("overwrite").text(path)
    return manifest(pages.sparkSession, path, provider, url, None)


def manifest(spark: SparkSession, path: str, provider: str, endpoint: str, params: dict[str, str] | None) -> DataFrame:
    """Lines, bytes and one digest over the digests of the landed files; secret parameters are redacted.

    Digests are folded in two levels, by their first three digits and then over at most 4,096 groups, so that no task
    gathers the digests of all files. A file is hashed whole where it is read, and may have 2 GB at most.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).filter(F.col("length") > 0)
    fold = lambda c: F.sha2(F.array_join(F.array_sort(F.collect_list(c)), "\n"), 256).alias("sha256")
    groups = files.select("length", F.sha2("content", 256).alias("own")).groupBy(F.substring("own", 1, 3)).agg(F.sum("length").alias("length"), fold("own"))
    sums = groups.agg(F.sum("length").alias("byte_count"), fold("sha256"))
    count = spark.read.text(path).agg(F.count(F.lit(1)).alias("page_count"))
    given: Column = F.create_map(*[F.lit(x) for kv in (params or {}).items() for x in kv]) if params else F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return sums.crossJoin(count).select(F.lit(provider).alias("provider"), X.safe_url(F.lit(endpoint)).alias("source_endpoint"), F.lit("jsonl.gz" if path.rstrip("/").endswith(".jsonl.gz") else "text").alias("format"), "page_count", "byte_count", "sha256", X.redacted(given).alias("request_params"), F.lit(path.rstrip("/").rsplit("/", 1)[-1]).alias("raw_file"))
