"""Published tables and their metadata as DataFrames."""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def store(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


#: The file of a directory that names its published tables, their parts and metadata.
POINTER = "_current.json"


def current(spark: SparkSession, directory: str, pointer: str = POINTER) -> dict:
    """The generation and tables that a directory's pointer names; generation 0 without tables before the first publish."""
    fs, at = store(spark, f"{directory}/{pointer}")
    if not fs.exists(at):
        return {"generation": 0, "tables": {}}
    stream = fs.open(at)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def is_published(spark: SparkSession, directory: str, name: str) -> bool:
    return name in current(spark, directory)["tables"]


def read_parts(spark: SparkSession, directory: str, entry: dict, parts: list[str] | None = None) -> DataFrame:
    """The rows of a pointer's table, or of the named parts only."""
    schema = StructType.fromJson(entry["schema"])
    paths = sorted(f"{directory}/{p}" for k, p in entry["parts"].items() if parts is None or k in parts)
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*paths) if paths else spark.createDataFrame([], schema)


def published(spark: SparkSession, directory: str, name: str, columns: list[str] | None = None, parts: list[str] | None = None) -> DataFrame:
    """A published table, read with the named columns and parts only; FileNotFoundError if there is none."""
    tables = current(spark, directory)["tables"]
    if name not in tables:
        raise FileNotFoundError(f"no table {name} published in {directory}")
    table = read_parts(spark, directory, tables[name], parts)
    return table.select(*columns) if columns else table


def required_table(spark: SparkSession, directory: str, name: str, what: str) -> DataFrame:
    """A published table; FileNotFoundError that says what is missing if it has not been published."""
    if not is_published(spark, directory, name):
        raise FileNotFoundError(f"{what} not found: {directory}/{name}")
    return published(spark, directory, name)


def metadata(spark: SparkSession, directory: str, name: str, schema: str) -> DataFrame:
    """The metadata of a published table as one row of the given fields; fields it lacks are null."""
    about = json.dumps(current(spark, directory)["tables"][name]["metadata"])
    return spark.createDataFrame([(about,)], "about string").select(F.from_json("about", schema).alias("m")).select("m.*")


def bar_state(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """(max_date) of a published bar table."""
    return metadata(spark, directory, name, "max_date string").select(F.to_date("max_date").alias("max_date"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir); on one machine a temporary one if none is set."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not hasattr(shared_dir, "own"):
        shared_dir.own = tempfile.mkdtemp(prefix="ledgerloom-")
    return shared_dir.own


def written(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: what was costly to compute is computed once."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
