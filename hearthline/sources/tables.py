"""Stored tables: reading with declared schemas, appending history and logs, reloading snapshots."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def append_history(events: DataFrame, path: str, batch: str | None = None) -> None:
    """Adds the events as the part ``batch`` (a new one by default). A part that is written again replaces itself."""
    name = batch or f"run-{uuid.uuid4().hex}"
    if batch:
        delete(events.sparkSession, f"{path}/batch={name}")  # whole, for this attempt may lack a type that a failed one had
    events.withColumn("batch", F.lit(name)).write.mode("append").partitionBy("batch", "event_type").parquet(path)


def append_runs(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def append_gazetteer(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def replace_snapshots(rows: DataFrame, path: str) -> None:
    """Truncate and reload; of rows that share an id, the one whose city, place and week come first stays."""
    rest = F.struct(*[c for c in rows.columns if c != "id"])
    one = rows.groupBy("id").agg(F.min_by(rest, F.struct("city", "neighbourhood", "snapshot_week", F.xxhash64(rest))).alias("r"))
    one.select("id", "r.*").select(*rows.columns).write.mode("overwrite").parquet(path)
