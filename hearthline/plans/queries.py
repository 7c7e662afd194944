"""The registered queries of the listings operators, over listing-shaped views of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline import vocab
from hearthline.functions import listing as L
from hearthline.functions import web
from hearthline.operators import backfill as B
from hearthline.operators import extract, feeds, gazetteer, places, runlog, snapshots, upsert, verify
from hearthline.operators.normalise import concatenate, from_sources, normalised
from hearthline.sources.adapters import NOW, view
from hearthline.sources.bucketed import BUCKETS, write_bucketed
from hearthline.sources.logstate import LogState
from hearthline.sources.scratch import new_folder, written
from hearthline.streaming import runs
from hearthline.streaming.checks import apply_batch

#: For the order-based views, names made by rule.
NATIONS = [f"NATION_{k}" for k in range(20)]
SCRAPED = ["1-URGENT", "2-HIGH", "3-MEDIUM"]
PRIORITIES = [*SCRAPED, "4-NOT SPECIFIED", "5-LOW"]
#: When stored snapshots were computed.
BEFORE = "2001-12-10 00:00:00"
RUNS_NOW = "2024-01-31 10:00:00"
REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    REGISTRY[f.__name__] = f
    return f


def C(name: str):
    return F.col(name)


@query
def weekly_snapshots(s, d):
    return snapshots.weekly_snapshots(view(s, d, "listings_v"), view(s, d, "history_v"), as_of=NOW)


@query
def snapshots_refreshed(s, d):
    """Snapshots of four weeks ago, when a part of the prices was another, brought up to date: only places with changed
    listings are counted anew."""
    listings, history = view(s, d, "listings_v"), view(s, d, "history_v")
    changed = (C("id") % 50 == 1) & C("neighbourhood").isin(*NATIONS[1:4])
    before = listings.withColumn("price_kobo", F.when(changed, C("price_kobo") + 1000).otherwise(C("price_kobo")))
    stored = written(snapshots.weekly_snapshots(before, history, as_of=BEFORE), "snapshots")
    return snapshots.refresh_snapshots(stored, BEFORE, listings, history, listings.where(changed), as_of=NOW)


@query
def active_snapshot(s, d):
    return upsert.active(view(s, d, "listings_v"))


@query
def parse_price(s, d):
    p = view(s, d, "raw_v").select("external_id", L.price_kobo(C("raw_price")).alias("p"))
    return p.select("external_id", C("p.kobo").alias("price_kobo"), C("p.failed").alias("price_parse_failed"))


@query
def floor_area(s, d):
    return view(s, d, "raw_v").select("external_id", L.floor_area_sqm(C("raw_floor_area")).alias("floor_area_sqm"))


@query
def room_counts(s, d):
    return view(s, d, "raw_v").select("external_id", L.first_int(C("raw_bedrooms")).alias("bedrooms"), L.first_int(C("raw_bathrooms")).alias("bathrooms"))


@query
def price_type(s, d):
    return view(s, d, "raw_v").select("external_id", L.price_type(C("raw_price_type"), C("title"), C("description")).alias("price_type"))


@query
def property_type(s, d):
    return view(s, d, "raw_v").select("external_id", L.listing_type(C("property_type_raw"), C("title"), C("description")).alias("property_type"))


@query
def infer_city(s, d):
    return view(s, d, "raw_v").select("external_id", L.city(C("raw_address"), C("title")).alias("city"))


@query
def audience_flag(s, d):
    return view(s, d, "raw_v").select("external_id", L.signal_flag(C("description")).alias("diaspora_targeted"))


@query
def normalise_listings(s, d):
    """Good and quarantined rows in one table, with the place by all four tiers."""
    out = normalised(view(s, d, "raw_v"), list(vocab.SAMPLE_PLACES))
    return out.withColumn("floor_area_sqm", C("floor_area_sqm").cast("double"))


@query
def neighbourhood_exact(s, d):
    return places.resolve_places(view(s, d, "raw_v").select("external_id", "raw_address"), "raw_address", list(vocab.SAMPLE_PLACES), fuzzy=False)


@query
def neighbourhood_fuzzy(s, d):
    return places.resolve_places(view(s, d, "raw_v").select("external_id", "raw_address"), "raw_address", list(vocab.SAMPLE_PLACES))


@query
def dedup_last(s, d):
    return upsert.dedup_last(view(s, d, "obs_v"), upsert.KEYS, "seq")


def _upsert(s, d):
    return upsert.upsert(view(s, d, "listings_v"), view(s, d, "obs_v"), now=NOW, scraped_sources=SCRAPED)


@query
def upsert_state(s, d):
    return _upsert(s, d).state


@query
def upsert_events(s, d):
    return _upsert(s, d).events


@query
def upsert_stats(s, d):
    return _upsert(s, d).stats


@query
def upsert_state_bucketed(s, d):
    """The state lies in buckets of its keys; only observations are shuffled."""
    state = write_bucketed(view(s, d, "listings_v"), new_folder(s, "listings-bucketed"), upsert.KEYS)
    return upsert.upsert(state, view(s, d, "obs_v"), now=NOW, scraped_sources=SCRAPED, buckets=BUCKETS).state


def _upsert_once(s, d):
    return upsert.upsert(view(s, d, "listings_v"), view(s, d, "obs_v"), now=NOW, scraped_sources=PRIORITIES, joined_path=new_folder(s, "upsert-joined"))


@query
def upsert_once_stats(s, d):
    """All sources scraped; the job that writes the join observes the stats."""
    return _upsert_once(s, d).stats


@query
def upsert_once_state(s, d):
    return _upsert_once(s, d).state


@query
def upsert_of_successful(s, d):
    """The scraped sources are those whose run succeeded, by the run's statistics."""
    observed = view(s, d, "obs_v")
    done = observed.groupBy("source").agg(F.count(F.lit(1)).alias("raw_count"), F.when(C("source").isin("2-HIGH"), "FAILED").otherwise("SUCCESS").alias("status"))
    sources = [r["source"] for r in upsert.successful_sources(done).collect()]  # as many as there are scrapers
    return upsert.upsert(view(s, d, "listings_v"), observed, now=NOW, scraped_sources=sources).state


@query
def upsert_events_relisted(s, d):
    """Listings that come back after their removal are active again."""
    return upsert.upsert(view(s, d, "listings_v"), view(s, d, "obs_v"), now=NOW, scraped_sources=SCRAPED, relist=True).events


@query
def history_insert(s, d):
    return upsert.history_rows(_upsert(s, d).events, view(s, d, "listings_v"))


@query
def missed_keys(s, d):
    return upsert.missed_keys(view(s, d, "listings_v"), from_sources(view(s, d, "obs_v"), SCRAPED), SCRAPED)


def _resolved(s, d):
    return view(s, d, "listings_v").select("id", "neighbourhood", "city")


@query
def geocode_enrich(s, d):
    return gazetteer.enrich(_resolved(s, d), view(s, d, "gaz_v"))


@query
def geocode_misses(s, d):
    return gazetteer.gazetteer_misses(_resolved(s, d), view(s, d, "gaz_v"))


@query
def gazetteer_extend(s, d):
    new = view(s, d, "listings_v").select("neighbourhood", "city", (C("id") % 7).cast("double").alias("lat"), (C("id") % 5).cast("double").alias("lng"))
    return gazetteer.extend_gazetteer(view(s, d, "gaz_v"), new)


@query
def check_candidates(s, d):
    return verify.check_candidates(view(s, d, "listings_v"), now=NOW)


@query
def check_candidates_all(s, d):
    return verify.check_candidates(view(s, d, "listings_v"), now=NOW, force_all=True)


@query
def classify_fetch(s, d):
    f = view(s, d, "fetch_v")
    return verify.classify_fetches(f.drop("observed_price"), observed=f.select("listing_id", "observed_price"))


def _checks(s, d):
    f = view(s, d, "fetch_v")
    results = verify.classify_fetches(f.drop("observed_price"), observed=f.select("listing_id", "observed_price"))
    return verify.apply_checks(view(s, d, "listings_v"), view(s, d, "history_v"), results, now=NOW)


@query
def apply_checks_state(s, d):
    return _checks(s, d).state


@query
def log_state_checks(s, d):
    """The same results in four batches, each adding the rows that it changes to a log of segments."""
    f = view(s, d, "fetch_v")
    results = verify.classify_fetches(f.drop("observed_price"), observed=f.select("listing_id", "observed_price"))
    state, history = view(s, d, "listings_v"), view(s, d, "history_v")
    store = LogState(s, new_folder(s, "listings-log"))
    store.publish(state)
    for k in range(4):
        apply_batch(store, state.schema, history, results.where(F.pmod(C("listing_id"), F.lit(4)) == k), now=NOW, batch=f"checks-{k}")
    return store.read(state.schema)


@query
def missed_runs_stream(s, d):
    """What runs and checks saw, in three lots that arrive one after the other, each of as many files as tasks write it. The
    stream goes on from its checkpoint with each."""
    seen, path = written(view(s, d, "sight_v").withColumnRenamed("seen_at", "at"), "seen"), new_folder(s, "sightings")
    low, high = seen.agg(F.min("at").cast("long"), F.max("at").cast("long")).first()
    third = F.floor((C("at").cast("long") - (low or 0)) * 3 / F.lit(max(1, (high or 0) - (low or 0) + 1)))
    store, schema = LogState(s, new_folder(s, "missed-runs"), "listing_id"), s.createDataFrame([], runs.OUT).schema
    checkpoint = new_folder(s, "missed-runs-checkpoint")
    for k in range(3):
        seen.where(third == k).write.mode("append").parquet(path)
        runs.keep_missed_runs(s.readStream.schema(seen.schema).parquet(path), store, checkpoint).awaitTermination()
    return store.read(schema)


@query
def apply_checks_events(s, d):
    return _checks(s, d).events


@query
def check_stats(s, d):
    return _checks(s, d).stats


@query
def check_summary(s, d):
    return runlog.check_summary(_checks(s, d).stats)


@query
def next_check_backfill(s, d):
    return verify.backfill_next_check(view(s, d, "listings_v")).select("id", "next_health_check_at")


@query
def suspected_sold(s, d):
    return verify.suspected_sold(view(s, d, "listings_v"), view(s, d, "history_v"), now=NOW)


@query
def last_success(s, d):
    return runlog.last_success(view(s, d, "runs_v"))


@query
def run_due(s, d):
    return runlog.run_due(view(s, d, "runs_v"), now=RUNS_NOW)


@query
def run_summary(s, d):
    return runlog.run_summary(view(s, d, "runs_v"))


@query
def run_log(s, d):
    out = runlog.run_log_rows(runlog.merge_stats(view(s, d, "runs_v").groupBy("source").agg(F.max("status").alias("status"), F.max("error_message").alias("error")), _upsert(s, d).stats), run_at=NOW, duration=12.5)
    return out.withColumn("duration_seconds", C("duration_seconds").cast("double"))


@query
def successful_sources(s, d):
    return upsert.successful_sources(view(s, d, "runs_v").withColumn("raw_count", C("new_listings")))


@query
def total_listings(s, d):
    return runlog.total_listings(view(s, d, "listings_v"))


@query
def concatenated_feeds(s, d):
    raw = view(s, d, "raw_v").select("source", "external_id", "url")
    return concatenate(from_sources(raw, ["alpha"]), from_sources(raw, ["gamma"]), from_sources(raw, ["alpha"]))


@query
def error_alerts(s, d):
    return view(s, d, "fetch_v").select("listing_id", runlog.crash_text(C("body")).alias("message"))


@query
def quality_ratios(s, d):
    rows = gazetteer.enrich(view(s, d, "listings_v").select("neighbourhood", "city", "price_parse_failed"), view(s, d, "gaz_v"))
    return runlog.quality(rows)


def _backfill(s, d):
    return B.backfill(view(s, d, "listings_v"), view(s, d, "gaz_v"), NATIONS)


@query
def backfill_proposals(s, d):
    return _backfill(s, d).proposals


@query
def backfill_state(s, d):
    """The listings with the proposals in place."""
    return B.backfill(view(s, d, "listings_v"), view(s, d, "gaz_v"), NATIONS, dry_run=False).state


@query
def backfill_stats(s, d):
    return _backfill(s, d).stats


def _known(feed):
    return feed.where("in_state").select("source", "external_id").distinct()


@query
def feed_known_cutoff(s, d):
    feed = view(s, d, "feed_v")
    return feeds.new_in_feed(feed, _known(feed))


@query
def feed_failure_cutoff(s, d):
    f = view(s, d, "feed_v").select("source", "feed", "page", "position", "event_id", "is_item", "failed")
    return feeds.before_failures(f, n=12, order=["feed", "page", "position", "event_id"]).select("source", "feed", "position", "event_id", "run")


@query
def page_frontier(s, d):
    sources = list(web.PAGE_MARKS)
    f = view(s, d, "feed_v").select("source", "feed").distinct()
    mark = F.element_at(F.array(*[F.lit(x) for x in sources]), F.length("source") % len(sources) + 1)
    return web.page_frontier(f.select(mark.alias("source"), F.concat("source", F.lit("-"), "feed").alias("feed"), F.concat(F.lit("https://feed.test/"), "source", F.lit("/"), "feed").alias("base_url")))


def _site(s, d):
    """The pages' ids in the URL shapes of the four sources."""
    p = s.read.parquet(f"{d}/pages.parquet")
    code = (C("page_id") + 100000).cast("string")
    kind = F.when(C("page_id") % 3 == 0, "for-sale").when(C("page_id") % 3 == 1, "for-rent").otherwise("short-let")
    source = F.element_at(F.array(*[F.lit(x) for x in web.EXTERNAL_IDS]), (C("page_id") % 4 + 1).cast("int"))
    url = (
        F.when(C("page_id") % 4 == 0, F.concat(F.lit("https://a.test/property/"), kind, F.lit("-flat-"), code))
        .when(C("page_id") % 4 == 1, F.concat(F.lit("https://b.test/listings/"), kind, F.lit("-"), code, F.lit("?x=1")))
        .when(C("page_id") % 4 == 2, F.concat(F.lit("https://c.test/"), kind, F.lit("/"), (C("page_id") + 1000000).cast("string"), F.lit("-some-house")))
        .otherwise(F.concat(F.lit("https://d.test/houses-apartments-for-sale/x-"), F.lpad(code, 12, "0"), F.lit(".html")))
    )
    return p.select("page_id", source.alias("source"), url.alias("url"), "html")


@query
def external_ids(s, d):
    return _site(s, d).select("page_id", "source", "url", web.external_id(C("source"), C("url")).alias("external_id"), web.url_price_type(C("source"), C("url")).alias("raw_price_type"))


def _listing_pages(s, d):
    """Detail pages in the four sources' own layouts, made of the given orders."""
    return view(s, d, "site_v", "o_orderkey").select("source", "url", "html")


@query
def site_listings(s, d):
    return extract.extract_listings(_listing_pages(s, d))[0]


@query
def site_quarantine(s, d):
    return extract.extract_listings(_listing_pages(s, d))[1]


@query
def site_links(s, d):
    return extract.harvest_links(view(s, d, "result_v", "c_custkey").select("source", "url", "html"))


@query
def site_checks(s, d):
    """Fetched detail pages of all sources classified, with the price that each live page states."""
    p = view(s, d, "site_v", "o_orderkey")
    fetched = p.select(
        C("k").alias("listing_id"), "source", C("code").alias("external_id"), "url", F.when(C("k") % 9 == 0, 404).otherwise(200).alias("status"), C("url").alias("final_url"), C("html").alias("body"),
        F.when(C("k") % 23 == 0, "timeout").alias("error"),
    )
    return extract.checked_pages(fetched)
