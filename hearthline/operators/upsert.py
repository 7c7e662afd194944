"""Folding a run's observations into the current state, with the events that tell what changed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from hearthline.functions.time import moment

KEYS = ["source", "external_id"]
#: What a repeated observation of an active listing overwrites.
OVERWRITTEN = ("price_kobo", "price_parse_failed", "url", "title")


@dataclass(frozen=True)
class UpsertResult:
    state: DataFrame
    events: DataFrame
    stats: DataFrame


def dedup_last(obs: DataFrame, keys: list[str], seq: str, seen: str | None = None) -> DataFrame:
    """The last row of each key by ``seq``; with ``seen``, also how many rows it had."""
    rest = [c for c in obs.columns if c not in keys]
    last = obs.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("_last"), F.count(F.lit(1)).alias("_seen"))
    return last.select(*keys, "_last.*", *([F.col("_seen").alias(seen)] if seen else []))


def active(listings: DataFrame) -> DataFrame:
    return listings.where("listing_status = 'ACTIVE'").select("source", "external_id", "price_kobo")


def missed_keys(state: DataFrame, obs: DataFrame, scraped_sources: list[str] | None = None) -> DataFrame:
    """Active listings of the scraped sources that the run did not see."""
    rows = state.where("listing_status = 'ACTIVE'")
    if scraped_sources is not None:
        rows = rows.where(F.col("source").isin(*scraped_sources))
    return rows.join(obs.select(*KEYS), KEYS, "left_anti").select(*KEYS, "missed_run_count")


def successful_sources(runs: DataFrame) -> DataFrame:
    return runs.where("status = 'SUCCESS' and raw_count > 0").select("source").distinct()


def _joined(state: DataFrame, obs: DataFrame, scraped: Column, seq: str) -> DataFrame:
    """State and last observations side by side, one row per key, with the case that holds: N new, R seen again after
    removal, U update, M missed, O as it was."""
    last = dedup_last(obs, KEYS, seq, "_seen")
    o = last.select(*KEYS, F.struct(*[c for c in last.columns if c not in KEYS]).alias("o"))
    s = state.select(*KEYS, F.struct(*[c for c in state.columns if c not in KEYS]).alias("s"))
    j = s.join(o, KEYS, "full_outer")
    live = F.col("s.listing_status") == "ACTIVE"
    case = F.when(F.col("o").isNotNull() & F.col("s").isNull(), "N").when(F.col("o").isNotNull() & ~live, "R").when(F.col("o").isNotNull(), "U").when(live & scraped, "M").otherwise("O")
    return j.withColumn("case", case)


COUNTED = ("new", "updated", "price_changes", "duplicates_dropped")
STATS = "source string, new long, updated long, price_changes long, duplicates_dropped long, seen long"


def _counts(among: Column | None = None) -> Column:
    """What the stats count of the joined rows, and the observed keys, as one metric."""
    own = F.col("o").isNotNull() if among is None else F.col("o").isNotNull() & among
    changed = (F.col("case") == "U") & (F.col("s.price_kobo") != F.col("o.price_kobo"))
    counts = {"new": F.count_if(own & F.col("case").isin("N", "R")), "updated": F.count_if(own & (F.col("case") == "U")), "price_changes": F.count_if(own & changed)}
    dropped = F.coalesce(F.sum(F.when(own, F.col("o._seen") - 1)), F.lit(0))
    return F.struct(*[c.alias(n) for n, c in counts.items()], dropped.alias("duplicates_dropped"), F.count_if(own).alias("seen"))


def upsert(state: DataFrame, obs: DataFrame, *, now, scraped_sources: list[str] | None = None, relist: bool = False, seq: str = "seq", joined_path: str | None = None, buckets: int | None = None) -> UpsertResult:
    """state: the new version; events: (source, external_id, event_type, old_value, new_value, event_date, notes);
    stats: one row per source and a total (source null). With ``relist``, a removed listing that is seen again becomes
    active and emits RELISTED; without, only its last_seen_at moves and LISTED is emitted again. Each of the three is a plan of its own over the
    join; with ``joined_path``, the join is executed once: written there for state and events, while the job that writes it
    observes the stats, of all observations and of those of each scraped source. With ``buckets``, the number of those in
    which the state is stored by its keys, observations are shuffled into the same ones, once, and the state stays."""
    if buckets:
        obs = obs.repartition(buckets, *KEYS)
    at = moment(now)
    j = _joined(state, obs, F.lit(True) if scraped_sources is None else F.col("source").isin(*scraped_sources), seq)
    spark, observed = j.sparkSession, None
    if joined_path:
        observed = Observation()
        j.observe(observed, _counts().alias("all"), *[_counts(F.col("source") == x).alias(f"s{k}") for k, x in enumerate(scraped_sources or ())]).write.mode("overwrite").parquet(joined_path)
        j = spark.read.schema(j.schema).parquet(joined_path)
    case, s, o = F.col("case"), lambda c: F.col(f"s.{c}"), lambda c: F.col(f"o.{c}")
    carried = {c for c in obs.columns if c not in KEYS}
    fixed = {
        "listing_status": F.lit("ACTIVE"), "suspected_sold": F.lit(False), "missed_run_count": F.lit(0), "first_seen_at": at, "last_seen_at": at,
        "last_health_check_at": F.lit(None), "next_health_check_at": F.lit(None), "id": F.lit(None),
    }

    def column(field) -> Column:
        c, kind = field.name, field.dataType
        own, seen = s(c), (o(c) if c in carried else F.lit(None)).cast(kind)
        new = fixed[c].cast(kind) if c in fixed else seen
        update = own
        if c in OVERWRITTEN and c in carried:
            update = seen
        elif c in ("lat", "lng"):
            update = F.coalesce(seen, own)
        elif c == "geocoded" and c in carried:
            update = F.coalesce(seen, own)
        elif c in ("last_seen_at", "missed_run_count", "listing_status"):
            update = fixed[c].cast(kind)
        again = at.cast(kind) if c == "last_seen_at" else F.lit("ACTIVE") if c == "listing_status" and relist else own
        missed = (own + 1).cast(kind) if c == "missed_run_count" else own
        return F.when(case == "N", new).when(case == "R", again).when(case == "U", update).when(case == "M", missed).otherwise(own).alias(c)

    out = j.select(*[F.col(c.name) if c.name in KEYS else column(c) for c in state.schema])
    changed = (case == "U") & (s("price_kobo") != o("price_kobo"))
    kind = F.when(case == "N", "LISTED").when(case == "R", "RELISTED" if relist else "LISTED").when(changed, "PRICE_CHANGE")
    events = j.select(*KEYS, kind.alias("event_type"), F.when(changed, s("price_kobo")).alias("old_value"), o("price_kobo").alias("new_value"), at.cast("date").alias("event_date"), F.lit(None).cast("string").alias("notes"))
    events = events.where("event_type is not null")
    if observed:
        told = observed.get
        rows = [(x, *told[f"s{k}"]) for k, x in enumerate(scraped_sources or ())]
        if sum(r[-1] for r in rows) == told["all"]["seen"]:  # else there are other sources, whose stats the written join has
            rows = spark.createDataFrame([*rows, (None, *told["all"])], STATS).where("source is null or seen > 0")
            return UpsertResult(out, events, rows.select("source", *[F.coalesce(c, F.lit(0)).alias(c) for c in COUNTED]))
    seen = obs.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))
    per = j.where("o is not null").groupBy("source").agg(
        F.count_if(case.isin("N", "R")).alias("new"), F.count_if(case == "U").alias("updated"), F.count_if(changed).alias("price_changes"), F.count(F.lit(1)).alias("keys")
    )
    per = per.join(seen, "source").select("source", "new", "updated", "price_changes", (F.col("rows") - F.col("keys")).alias("duplicates_dropped"))
    stats = per.rollup("source").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTED])
    return UpsertResult(out, events, stats)


def history_rows(events: DataFrame, state: DataFrame) -> DataFrame:
    """Events with the listing's id, for the history table."""
    return events.join(state.select(*KEYS, F.col("id").alias("listing_id")), KEYS).select("listing_id", "event_type", "old_value", "new_value", "event_date", "notes")
