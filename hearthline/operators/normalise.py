"""Raw listings to typed rows; rows that cannot be read go to quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.functions import listing as L
from hearthline.operators.places import resolve_places

REQUIRED = ("external_id", "source", "url")


def typed(raw: DataFrame) -> DataFrame:
    """All columns but the place, and ``normalise_error`` (null for a good row)."""
    price, area = L.price_kobo(F.col("raw_price")), L.floor_area_sqm(F.col("raw_floor_area"))
    missing = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED])
    error = F.when(missing != "", F.concat(F.lit("missing "), missing)).when(L.unreadable_area(F.col("raw_floor_area")), F.lit("unreadable floor area"))
    return raw.withColumn("_price", price).select(
        "external_id", "source", "url", "title", "description",
        F.col("_price.kobo").alias("price_kobo"), F.col("_price.failed").alias("price_parse_failed"),
        L.price_type(F.col("raw_price_type"), F.col("title"), F.col("description")).alias("price_type"),
        L.listing_type(F.col("property_type_raw"), F.col("title"), F.col("description")).alias("property_type"),
        L.first_int(F.col("raw_bedrooms")).alias("bedrooms"), L.first_int(F.col("raw_bathrooms")).alias("bathrooms"),
        area.try_cast("decimal(8,2)").alias("floor_area_sqm"), F.when(area.isNotNull(), "PORTAL").otherwise("NONE").alias("floor_area_source"), "raw_address",
        L.city(F.col("raw_address"), F.col("title")).alias("city"), "agent_name", L.signal_flag(F.col("description")).alias("diaspora_targeted"), error.alias("normalise_error"),
    )


def normalised(raw: DataFrame, vocabulary: list[str], *, fuzzy: bool = True) -> DataFrame:
    """The whole typed row: place by each distinct address, no coordinates yet, and ``normalise_error``."""
    rows = resolve_places(typed(raw), "raw_address", vocabulary, fuzzy=fuzzy)
    nowhere = F.lit(None).cast("double")
    return rows.withColumns({"lat": nowhere, "lng": nowhere, "geocoded": F.lit(False)})


def normalise(raw: DataFrame, vocabulary: list[str]) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine)."""
    rows = normalised(raw, vocabulary)
    return rows.where("normalise_error is null").drop("normalise_error"), rows.where("normalise_error is not null")


def from_sources(raw: DataFrame, sources: list[str] | None) -> DataFrame:
    """The rows of the named sources; of all if none are named."""
    return raw if sources is None else raw.where(F.col("source").isin(*sources))


def concatenate(*feeds: DataFrame) -> DataFrame:
    out = feeds[0]
    for f in feeds[1:]:
        out = out.unionByName(f)
    return out
