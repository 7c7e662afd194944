"""Small tables for tests."""

from pyspark.sql import DataFrame, SparkSession


def rows(spark: SparkSession, data: list, schema: str) -> DataFrame:
    return spark.createDataFrame(data, schema)
