"""State stored in buckets of its keys: a join on them leaves it where it is, and only the other side is shuffled."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Buckets of a stored state: as many as tasks that later work on it, so that each holds what one task can sort.
BUCKETS = 64


def write_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Writes ``df`` below ``path`` in buckets of its keys, each sorted by them, and returns the table."""
    name = f"bucketed_{uuid.uuid4().hex}"
    # one task a bucket, so that each bucket is one sorted file
    placed = df.repartition(buckets, *keys)
    placed.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def open_bucketed(spark: SparkSession, path: str, schema: str, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """A table that an earlier session wrote: files do not tell their buckets, so keys and their number are named again."""
    name, by = f"bucketed_{uuid.uuid4().hex}", ", ".join(keys)
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)
