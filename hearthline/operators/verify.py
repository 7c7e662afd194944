"""Verifying listings: which are due, what a fetch tells, and what follows for the state."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.functions.ranks import numbered
from hearthline.functions.time import moment, next_check_at, seconds_between, whole_days
from hearthline.params import DEFAULT, Params
from hearthline.vocab import REMOVAL_PHRASES


@dataclass(frozen=True)
class CheckOutcome:
    state: DataFrame
    events: DataFrame
    stats: DataFrame


def overdue_ratio(now: Column, params: Params = DEFAULT) -> Column:
    """Time since the last check over the time allowed, by age; 1 for a listing without a next check."""
    (young, middle, old), (a, b) = params.recheck_seconds, params.cohort_days
    first = F.col("first_seen_at")
    allowed = F.when(first >= now - F.expr(f"interval '{a}' day"), young).when(first >= now - F.expr(f"interval '{b}' day"), middle).otherwise(old)
    return F.when(F.col("next_health_check_at").isNull(), 1.0).otherwise(F.try_divide(seconds_between(F.col("last_health_check_at"), now), allowed.cast("double")))


def check_candidates(listings: DataFrame, *, now, force_all: bool = False, params: Params = DEFAULT) -> DataFrame:
    """The listings to verify, most overdue first, with their rank and batch. A ratio that is unknown ranks first.
    ``force_all`` takes all active listings, most missed first, without a limit, and ranks them in range partitions."""
    at = moment(now)
    rows = listings.where("listing_status = 'ACTIVE'")
    last = F.col("last_health_check_at").asc_nulls_first()
    if force_all:
        rows = rows.select("id", "source", "external_id", "url", "first_seen_at", "price_kobo", "missed_run_count", "last_health_check_at")
        ranked = numbered(rows, [F.col("missed_run_count").desc(), last, F.col("id")])
        return ranked.withColumn("batch", F.floor((F.col("rank") - 1) / params.check_batch).cast("int"))
    due = rows.where((F.col("missed_run_count") > 0) & (F.col("next_health_check_at").isNull() | (F.col("next_health_check_at") < at)))
    order = [F.col("ratio").desc_nulls_first(), last, F.col("id")]
    top = due.withColumn("ratio", overdue_ratio(at, params)).orderBy(*order).limit(params.checks_per_run)
    ranked = top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))  # at most checks_per_run rows
    return ranked.select("id", "source", "external_id", "url", "first_seen_at", "price_kobo", "ratio", "rank", F.floor((F.col("rank") - 1) / params.check_batch).cast("int").alias("batch"))


#: Reasons for which a listing counts as gone.
REMOVED = ("not_found", "redirected", "phrase")


def with_reason(fetch_log: DataFrame, phrases=REMOVAL_PHRASES) -> DataFrame:
    body = F.lower(F.col("body"))
    phrase = F.exists(F.array(*[F.lit(p) for p in phrases]), lambda p: body.contains(p))
    moved = (F.col("final_url") != F.col("url")) & ~F.col("final_url").contains(F.col("external_id"))
    reason = F.when(F.col("status") == 404, "not_found").when(moved, "redirected").when((F.col("status") == 200) & phrase, "phrase").when(F.col("status") == 200, "live").otherwise("unreachable")
    return fetch_log.withColumn("reason", F.when(F.col("error").isNull(), reason))


def classify_fetches(fetch_log: DataFrame, phrases=REMOVAL_PHRASES, observed: DataFrame | None = None) -> DataFrame:
    """What each fetch tells: is_removed, reason and, where (listing_id, observed_price) of the page is given, the
    observed price. Failed requests confirm as active; rows with an error tell nothing."""
    out = with_reason(fetch_log, phrases)
    removed = F.col("reason").isin(*REMOVED)
    if observed is not None:
        out = out.join(observed.select("listing_id", "observed_price"), "listing_id", "left")
    else:
        out = out.withColumn("observed_price", F.lit(None).cast("bigint"))
    price = F.when(F.col("reason") == "live", F.col("observed_price"))
    return out.select("listing_id", "source", "external_id", removed.alias("is_removed"), price.alias("observed_price"), "reason", "error")


#: Bitmaps (4 KB each, for 32,768 ids) up to which they are broadcast.
BROADCAST_BITMAPS = 8192


def price_drop_bitmaps(history: DataFrame) -> DataFrame:
    """(bucket, bits): of each bucket of ids, which listings had a price drop. A task sends a bitmap per bucket, however many
    drops there are."""
    drops = history.where("event_type = 'PRICE_CHANGE' and new_value < old_value and listing_id is not null")
    return drops.groupBy(F.bitmap_bucket_number("listing_id").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("listing_id")).alias("_bits"))


def with_drops(state: DataFrame, history: DataFrame, name: str) -> DataFrame:
    """The state with a flag for a past price drop. The bitmaps are broadcast while the ids span few buckets, which their
    range tells without reading the drops; then the state is not shuffled."""
    maps = price_drop_bitmaps(history)
    low, high, spread = state.agg(F.min("id"), F.max("id"), F.max(F.bitmap_bucket_number("id")) - F.min(F.bitmap_bucket_number("id"))).first()
    if (spread or 0) < BROADCAST_BITMAPS:
        # of ids that the state has, so that the bound holds
        maps = F.broadcast(price_drop_bitmaps(history.where(F.col("listing_id").between(low, high))))
    at = F.bitmap_bit_position("id")
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("getbit", byte, (at % 8).cast("int"))
    return state.join(maps, F.bitmap_bucket_number("id") == F.col("_bucket"), "left").withColumn(name, F.coalesce(bit == 1, F.lit(False))).drop("_bucket", "_bits")


def suspected_sold(state: DataFrame, history: DataFrame, *, now, params: Params = DEFAULT) -> DataFrame:
    """(id, suspected_sold): at least so many days old (or of unknown age), with a past price drop."""
    age = whole_days(F.col("first_seen_at"), moment(now))
    flag = F.coalesce(age >= params.sold_min_days, F.lit(True)) & F.coalesce("dropped", F.lit(False))
    return with_drops(state.select("id", "first_seen_at"), history, "dropped").select("id", flag.alias("suspected_sold"))


def apply_checks(state: DataFrame, history: DataFrame, results: DataFrame, *, now, params: Params = DEFAULT) -> CheckOutcome:
    """results: one row per listing. Rows with an error change nothing and are only counted."""
    at = moment(now)
    good = results.where("error is null").select(F.col("listing_id").alias("id"), F.struct(F.coalesce("is_removed", F.lit(False)).alias("is_removed"), "observed_price").alias("r"))
    j = with_drops(state, history, "_dropped").join(good, "id", "left")
    checked, removed = F.col("r").isNotNull(), F.coalesce(F.col("r.is_removed"), F.lit(False))
    live = checked & ~removed
    repriced = F.coalesce(live & (F.col("r.observed_price") != F.col("price_kobo")), F.lit(False))
    old_enough = F.coalesce(whole_days(F.col("first_seen_at"), at) >= params.sold_min_days, F.lit(True))
    new = {
        "listing_status": F.when(removed, "REMOVED").otherwise(F.col("listing_status")),
        "suspected_sold": F.when(removed, old_enough & F.col("_dropped")).otherwise(F.col("suspected_sold")),
        "missed_run_count": F.when(live, 0).otherwise(F.col("missed_run_count")),
        "last_health_check_at": F.when(checked, at).otherwise(F.col("last_health_check_at")),
        "next_health_check_at": F.when(removed, None).when(live, next_check_at(F.col("first_seen_at"), at, params)).otherwise(F.col("next_health_check_at")),
        "last_seen_at": F.when(repriced, at).otherwise(F.col("last_seen_at")),
        "price_kobo": F.when(repriced, F.col("r.observed_price")).otherwise(F.col("price_kobo")),
    }
    out = j.select(*[(new[f.name].cast(f.dataType) if f.name in new else F.col(f.name)).alias(f.name) for f in state.schema])
    kind = F.when(removed, "REMOVED").when(repriced, "PRICE_CHANGE")
    note = F.when(removed, "confirmed removed by health checker").when(repriced, "detected by health checker")
    events = j.select(F.col("id").alias("listing_id"), kind.alias("event_type"), F.col("price_kobo").alias("old_value"), F.when(repriced & ~removed, F.col("r.observed_price")).alias("new_value"), at.cast("date").alias("event_date"), note.alias("notes"))
    stats = j.where(checked).agg(F.count(F.lit(1)).alias("checked"), F.count_if(removed).alias("confirmed_removed"), F.count_if(live).alias("confirmed_active"), F.count_if(repriced).alias("price_changes"))
    errors = results.agg(F.count_if(F.col("error").isNotNull()).alias("errors"))
    return CheckOutcome(out, events.where("event_type is not null"), stats.crossJoin(errors))  # one row by one row


def backfill_next_check(state: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Next checks for listings that were checked before the column was kept: by their age at that check."""
    (young, middle, old), (a, b) = params.recheck_seconds, params.cohort_days
    first, last = F.col("first_seen_at"), F.col("last_health_check_at")
    wait = lambda s: last + F.expr(f"interval '{s}' second")
    due = F.when(first >= last - F.expr(f"interval '{a}' day"), wait(young)).when(first >= last - F.expr(f"interval '{b}' day"), wait(middle)).otherwise(wait(old))
    fill = last.isNotNull() & F.col("next_health_check_at").isNull()
    return state.withColumn("next_health_check_at", F.when(fill, due).otherwise(F.col("next_health_check_at")))
