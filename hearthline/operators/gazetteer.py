"""Coordinates from a gazetteer table keyed by lower-cased place and city."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _key(place: Column, city: Column) -> list[Column]:
    return [F.lower(place).alias("_nb"), F.lower(F.coalesce(city, F.lit(""))).alias("_city")]


def lookup(gazetteer: DataFrame) -> DataFrame:
    """One row per lower-cased key; where several rows fall together, the first by place and city."""
    keyed = gazetteer.select(*_key(F.col("neighbourhood"), F.col("city")), "neighbourhood", "city", "lat", "lng")
    return keyed.groupBy("_nb", "_city").agg(F.min_by(F.struct("lat", "lng"), F.struct("neighbourhood", "city")).alias("g")).select("_nb", "_city", F.col("g.lat").alias("lat"), F.col("g.lng").alias("lng"))


def enrich(df: DataFrame, gazetteer: DataFrame, place: str = "neighbourhood", city: str = "city") -> DataFrame:
    """The rows with lat, lng and geocoded. Whether the gazetteer is broadcast is left to Spark, which knows its size."""
    rest = df.drop("lat", "lng", "geocoded")
    out = rest.withColumns({"_nb": F.when(F.col(place) != "", F.lower(place)), "_city": F.lower(F.coalesce(city, F.lit("")))}).join(lookup(gazetteer), ["_nb", "_city"], "left")
    return out.drop("_nb", "_city").withColumn("geocoded", F.col("lat").isNotNull())


def gazetteer_misses(df: DataFrame, gazetteer: DataFrame, place: str = "neighbourhood", city: str = "city") -> DataFrame:
    """The distinct keys that the gazetteer lacks, with the text of a geocoding question."""
    keys = df.where(F.col(place) != "").select(*_key(F.col(place), F.col(city)), F.col(place).alias("neighbourhood"), F.col(city).alias("city"))
    keys = keys.groupBy("_nb", "_city").agg(F.min(F.struct("neighbourhood", "city")).alias("k"))
    out = keys.join(lookup(gazetteer), ["_nb", "_city"], "left_anti").select("k.neighbourhood", "k.city")
    where = F.coalesce(F.when(F.col("city") != "", F.col("city")), F.lit("Nigeria"))
    return out.withColumn("query_text", F.concat_ws(", ", "neighbourhood", where, F.lit("Nigeria")))


def extend_gazetteer(gazetteer: DataFrame, new: DataFrame) -> DataFrame:
    """The rows to append: keys (as written) that the table has not, one each."""
    fresh = new.select("neighbourhood", F.coalesce("city", F.lit("")).alias("city"), "lat", "lng").groupBy("neighbourhood", "city").agg(F.min(F.struct("lat", "lng")).alias("g"))
    return fresh.join(gazetteer.select("neighbourhood", "city"), ["neighbourhood", "city"], "left_anti").select("neighbourhood", "city", "g.lat", "g.lng")
