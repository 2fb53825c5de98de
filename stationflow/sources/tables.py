"""Tables by layer and name, CSV reads, file listing, databases.

Tables are Parquet directories ``root/layer/name``. Parquet cannot overwrite a
path that the same plan reads, so a table that is rebuilt from itself takes a
new ``run`` directory each time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LAYERS = ("raw", "bronze", "silver", "gold")


def table_path(root: str, layer: str, name: str, run: str | None = None) -> str:
    if layer not in LAYERS:
        raise ValueError(f"layer must be one of {LAYERS}, not {layer!r}")
    path = f"{root.rstrip('/')}/{layer}/{name}"
    return path if run is None else f"{path}/run={run}"


def checkpoint_path(root: str, layer: str, name: str) -> str:
    """Stream checkpoints live beside the layers, never inside a table."""
    return f"{root.rstrip('/')}/checkpoints/{layer}/{name}"


def read_table(
    spark: SparkSession,
    root: str,
    layer: str,
    name: str,
    run: str | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """A ``schema`` keeps text partition values as text."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(table_path(root, layer, name, run))


def write_table(
    df: DataFrame,
    root: str,
    layer: str,
    name: str,
    run: str | None = None,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Overwrites the table and its schema; returns the stored table."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(table_path(root, layer, name, run))
    return read_table(df.sparkSession, root, layer, name, run, df.schema)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Header and inferred types; for exploring a file, not for ingest."""
    return spark.read.csv(path, header=True, inferSchema=True)


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def input_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and modification time of each file; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    )


def use_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Creates the database if it is missing and makes it current."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")
    spark.sql(f"USE {name}")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under the cluster's shared ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to its warehouse folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def store(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to a new scratch table and read back.

    For a result that several later plans start from: it is computed once, and a
    lost executor costs a read rather than a recomputation.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
