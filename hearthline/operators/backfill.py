"""Resolving and locating again the rows that earlier runs could not."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.operators.gazetteer import enrich
from hearthline.operators.places import resolve_places


@dataclass(frozen=True)
class BackfillResult:
    proposals: DataFrame
    stats: DataFrame
    state: DataFrame | None


def unresolved(listings: DataFrame) -> DataFrame:
    return listings.where("not neighbourhood_normalised")


def backfill(listings: DataFrame, gazetteer: DataFrame, vocabulary: list[str], *, dry_run: bool = True, fuzzy: bool = True) -> BackfillResult:
    """proposals: the rows that now resolve, with place and coordinates (null where the gazetteer has none); stats: one
    row; state: the listings with the proposals in place, unless ``dry_run``."""
    open_ = unresolved(listings)
    tried = resolve_places(open_.where("raw_address <> ''").select("id", "raw_address", "city"), "raw_address", vocabulary, fuzzy=fuzzy)
    found = enrich(tried.where("neighbourhood_normalised"), gazetteer)
    proposals = found.select("id", "neighbourhood", "city", "lat", "lng", "geocoded")
    counts = open_.agg(F.count(F.lit(1)).alias("candidates"), F.count_if(F.col("raw_address") != "").alias("processed"))
    done = proposals.agg(F.count(F.lit(1)).alias("normalised"), F.count_if("geocoded").alias("geocoded"))
    pct = lambda a, b: F.coalesce(F.round(F.try_divide(F.col(a) * 100.0, F.col(b)), 1), F.lit(0.0))
    stats = counts.crossJoin(done).withColumns({"normalised_pct": pct("normalised", "processed"), "geocoded_pct": pct("geocoded", "normalised")})  # one row by one row
    state = None
    if not dry_run:
        p = proposals.select("id", F.struct("neighbourhood", "lat", "lng", "geocoded").alias("_p"))
        j = listings.join(p, "id", "left")
        new = {c: F.when(F.col("_p").isNotNull(), F.col(f"_p.{c}")).otherwise(F.col(c)) for c in ("neighbourhood", "lat", "lng", "geocoded")}
        new["neighbourhood_normalised"] = F.col("_p").isNotNull() | F.col("neighbourhood_normalised")
        state = j.select(*[(new[f.name].cast(f.dataType) if f.name in new else F.col(f.name)).alias(f.name) for f in listings.schema])
    return BackfillResult(proposals, stats, state)
