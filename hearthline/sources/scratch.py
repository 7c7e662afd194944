"""Folders for what a job writes on its way, where driver and executors all see them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's ``spark.checkpoint.dir``; below one of our own only on one machine where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master, app = spark.sparkContext.master, spark.sparkContext.applicationId
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("on a cluster, spark.checkpoint.dir must name a folder that all executors share")
        base = _own[app] = _own.get(app) or "file://" + tempfile.mkdtemp(prefix="hearthline-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read again."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
