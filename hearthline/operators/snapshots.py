"""Weekly market snapshots by place: counts, days on market, exact percentiles of the price in force."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.functions.time import moment
from hearthline.params import DEFAULT
from hearthline.sources.scratch import written

PERCENTILES = (0.25, 0.5, 0.75, 0.9)
#: Prices that double fall into so many bins.
BINS_PER_OCTAVE = 32
#: Listings and price changes that one task sorts and joins.
ROWS_PER_TASK = 500_000


def snapshot_base(listings: DataFrame, since: Column | None = None) -> DataFrame:
    """Listings with a resolved place and a city, and the columns that snapshots need."""
    rows = listings.where("neighbourhood_normalised and city is not null and neighbourhood is not null")
    own = [] if since is None else [since.alias("since")]
    return rows.select(F.col("id").alias("listing_id"), "city", "neighbourhood", "price_kobo", "listing_status", "first_seen_at", "last_seen_at", *own)


def price_changes(history: DataFrame) -> DataFrame:
    return history.where("event_type = 'PRICE_CHANGE'").select("listing_id", "id", "old_value", "new_value", "event_date")


def monday(c: Column) -> Column:
    return F.date_trunc("week", c).cast("date")


def price_weeks(changes: DataFrame) -> DataFrame:
    """Per listing and week with a change that tells an old value: the first such value, and whether a price was cut."""
    told = changes.where("old_value is not null and event_date is not null").withColumn("week", monday(F.col("event_date")))
    first = F.min(F.struct("event_date", "id", "old_value", "new_value"))["old_value"]
    return told.groupBy("listing_id", "week").agg(first.alias("old"), F.count_if(F.col("new_value") < F.col("old_value")).alias("cuts"))


def price_periods(weeks: DataFrame) -> DataFrame:
    """Per listing, the spans between its weeks of changes: start (null before the first), whether a price was cut in
    the start's week, end (null after the last) and the price that the next change tells to have held."""
    w = Window.partitionBy("listing_id").orderBy("week")
    after = F.lead("week").over(w)
    span = F.struct(F.col("week").alias("start"), (F.col("cuts") > 0).alias("cut"), F.date_sub(after, 7).alias("end"), F.lead("old").over(w).alias("told"))
    before = F.struct(F.lit(None).cast("date").alias("start"), F.lit(False).alias("cut"), F.date_sub("week", 7).alias("end"), F.col("old").alias("told"))
    spans = F.when(F.lag("week").over(w).isNull(), F.array(before, span)).otherwise(F.array(span))
    return weeks.select("listing_id", spans.alias("spans")).select("listing_id", F.explode("spans").alias("_s")).select("listing_id", "_s.*")


def by_listing(base: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both dealt out by listing into as many parts as their rows ask for. Parts that are put together by their bytes hold
    more rows the more alike these are, and no more parts than the session sets hold more rows the larger the tables are."""
    parts = max(base.sparkSession.sparkContext.defaultParallelism, -(-(base.count() + changes.count()) // ROWS_PER_TASK))
    return base.repartition(parts, "listing_id"), changes.repartition(parts, "listing_id")


def price_segments(base: DataFrame, changes: DataFrame, *, as_of) -> DataFrame:
    """One row per listing and span of completed weeks (Mondays ``lo`` to ``hi``) in which it was on the market at one
    price, with ``cut_week`` where one was cut. Before each change that tells an old value that value held, after the
    last one the present price. A column ``since``, a Monday or null, leaves out earlier weeks."""
    last = F.date_sub(monday(moment(as_of)), 7)
    end = F.when(F.col("listing_status") == "ACTIVE", last).otherwise(F.least(last, monday(F.col("last_seen_at"))))
    d = base.withColumn("_from", monday(F.col("first_seen_at"))).withColumn("_to", end).where("_from <= _to")
    d = d.join(price_periods(price_weeks(changes)), "listing_id", "left")
    d = d.withColumn("lo", F.greatest("_from", "start")).withColumn("hi", F.least("_to", "end"))
    if "since" in base.columns:
        d = d.withColumn("lo", F.greatest("lo", "since")).drop("since")
    d = d.where("lo <= hi")
    price = F.when(F.col("end").isNull(), F.col("price_kobo")).otherwise(F.col("told"))
    return d.withColumn("price", price).withColumn("cut_week", F.when(F.col("cut"), F.col("start"))).drop("_from", "_to", "start", "end", "told", "cut")


def _week_rows(spans: DataFrame) -> DataFrame:
    """Per place, price bin and week with listings: how many are on the market, new or cut, and their days on it. Each
    span counts where it begins and where it ends; running sums in between stand for its weeks."""
    keys = ("city", "neighbourhood", "bin")
    born = F.unix_date("first").cast("long")
    sunday = F.unix_date(F.date_add("hi", 6)).cast("long")
    # in the week in which a listing goes, its days end with its last day and not on Sunday
    late = F.when(monday(F.col("gone")) == F.col("hi"), F.greatest(F.lit(0), F.date_diff("gone", "first")) - (sunday - born))
    mark = lambda week, n, first, new, cut, days: F.struct(week.alias("week"), n.alias("n"), first.alias("born"), new.alias("new"), cut.alias("cuts"), days.alias("days"))
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    is_new, is_cut = (monday(F.col("first")) == F.col("lo")).cast("long"), F.coalesce((F.col("cut_week") == F.col("lo")).cast("long"), zero)
    marks = F.array(mark(F.col("lo"), one, born, is_new, is_cut, zero), mark(F.col("hi"), zero, zero, zero, zero, F.coalesce(late.cast("long"), zero)), mark(F.date_add("hi", 7), -one, -born, zero, zero, zero))
    m = spans.select(*keys, F.explode(marks).alias("m")).groupBy(*keys, F.col("m.week").alias("at")).agg(*[F.sum(f"m.{c}").alias(c) for c in ("n", "born", "new", "cuts", "days")])
    w = Window.partitionBy(*keys).orderBy("at")
    m = m.withColumn("next", F.lead("at").over(w)).withColumn("n", F.sum("n").over(w)).withColumn("born", F.sum("born").over(w)).where("n > 0")
    m = m.withColumn("week", F.explode(F.expr("sequence(at, date_sub(next, 7), interval 7 day)")))
    here = F.col("week") == F.col("at")
    point = {c: F.when(here, F.col(c)).otherwise(0) for c in ("new", "cuts")}
    days = F.col("n") * (F.unix_date("week") + 6) - F.col("born") + F.when(here, F.col("days")).otherwise(0)
    return m.select(*keys, "week", "n", *[v.alias(c) for c, v in point.items()], days.alias("days"))


def _ranks(prices: Column) -> list[Column]:
    """The places, from 1, of the prices between which the percentiles lie."""
    return [r(q * (prices - 1)) + 1 for q in PERCENTILES for r in (F.floor, F.ceil)]


def week_prices(spans: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per place and week, the exact percentiles. wanted: the bins of each place and week that hold a wanted rank, with the
    number of prices below and in all. Only spans of these bins are dealt out over the weeks that want them."""
    place = ["city", "neighbourhood"]
    d = spans.where("price is not null").groupBy(*place, "bin", "price", "lo", "hi").agg(F.count(F.lit(1)).alias("n"))
    d = d.join(wanted, [*place, "bin"]).where("week between lo and hi")
    d = d.groupBy(*place, "bin", "week", "price", "prices", "below").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy(*place, "bin", "week").orderBy("price").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("upto", F.col("below") + F.sum("n").over(upto))

    def percentile(q: float):
        at = q * (F.col("prices") - 1)
        nth = lambda n: F.max(F.when((F.col("upto") - F.col("n") < n) & (n <= F.col("upto")), F.col("price"))).cast("double")
        below, above = nth(F.floor(at) + 1), nth(F.ceil(at) + 1)
        return below + (above - below) * F.max(at - F.floor(at))

    return d.groupBy(*place, "week").agg(*[percentile(q).alias(name) for name, q in zip(("p25", "median_price_kobo", "p75", "p90"), PERCENTILES)])


def weekly_snapshots(listings: DataFrame, history: DataFrame, *, as_of, computed_at=None, min_listings: int = DEFAULT.week_min_listings, id_includes_city: bool = False, since=None) -> DataFrame:
    """One row per place and completed week (from the Monday ``since`` on, a column of the listings, if given and not null) with at least ``min_listings`` active listings.

    Changes are summed up per listing and week, so a listing has no more spans than weeks however many changes it has,
    and spans are counted at their ends, not once a week. Percentiles are exact and take two passes: counts per price
    bin tell in which bins the wanted ranks lie, and only the prices of these are ranked. The id leaves the city out by
    default; of one name in several cities the first city stands. Spans and counts, which several passes read, are written once.
    """
    base = written(snapshot_base(listings, since), "snapshot-base")
    spans = price_segments(*by_listing(base, price_changes(history)), as_of=as_of)
    first, seen = F.col("first_seen_at").cast("date"), F.when(F.col("listing_status") == "REMOVED", F.col("last_seen_at")).cast("date")
    # bins rise with the price; those below 1 share one
    octave = F.floor(F.log2(F.greatest("price", F.lit(1))) * BINS_PER_OCTAVE).cast("int")
    spans = spans.select("city", "neighbourhood", "price", F.when(F.col("price") < 1, -1).otherwise(F.when(F.col("price").isNotNull(), octave)).alias("bin"), "cut_week", first.alias("first"), seen.alias("gone"), "lo", "hi")
    spans = written(spans, "snapshot-spans")
    group = Window.partitionBy("city", "neighbourhood", "week")
    before = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    priced = F.when(F.col("bin").isNotNull(), F.col("n")).otherwise(0)
    rows = _week_rows(spans).withColumn("priced", priced)
    rows = rows.withColumn("below", F.coalesce(F.sum("priced").over(before), F.lit(0))).withColumn("prices", F.sum("priced").over(group)).withColumn("active", F.sum("n").over(group))
    rows = written(rows, "snapshot-counts")
    hit = F.lit(False)
    for rank in _ranks(F.col("prices")):
        hit = hit | ((F.col("below") < rank) & (rank <= F.col("below") + F.col("priced")))
    weeks = rows.groupBy("city", "neighbourhood", "week").agg(
        F.sum("n").alias("active_listing_count"), F.sum("new").alias("new_listings_count"), F.sum("cuts").alias("price_reduced_count"), F.round(F.sum("days") / F.sum("n"), 1).alias("avg_days_on_market"),
    ).where(F.col("active_listing_count") >= min_listings)
    wanted = rows.where(hit & (F.col("active") >= min_listings)).select("city", "neighbourhood", "bin", "week", "prices", "below")
    out = weeks.join(week_prices(spans, wanted), ["city", "neighbourhood", "week"], "left")
    name = F.concat("neighbourhood", F.date_format("week", "yyyy-MM-dd"))
    out = out.withColumn("id", F.md5(F.concat("city", name) if id_includes_city else name))
    out = out.select(
        "id", "city", "neighbourhood", F.col("week").alias("snapshot_week"), "avg_days_on_market", moment(computed_at or as_of).alias("computed_at"), "active_listing_count",
        "new_listings_count", "price_reduced_count", "median_price_kobo", "p25", "p75", "p90",
    )
    rest = [c for c in out.columns if c != "id"]
    return out.groupBy("id").agg(F.min_by(F.struct(*rest), "city").alias("_row")).select("id", "_row.*")


def refresh_snapshots(stored: DataFrame, stored_as_of, listings: DataFrame, history: DataFrame, changed: DataFrame, *, as_of, **options) -> DataFrame:
    """What ``weekly_snapshots`` gives for the present listings and history, from the rows that it gave at ``stored_as_of``.
    changed: (neighbourhood) of each listing that has changed since then, or whose history has, before and after. Those
    places are counted anew; all others get the weeks completed since, for which earlier weeks are not read."""
    names = changed.select("neighbourhood").where("neighbourhood is not null").distinct()
    monday_then = monday(moment(stored_as_of))
    marked = listings.join(names.withColumn("_anew", F.lit(True)), "neighbourhood", "left")
    fresh = weekly_snapshots(marked, history, as_of=as_of, since=F.when(F.col("_anew").isNull(), monday_then), **options)
    kept = stored.join(names, "neighbourhood", "left_anti").where(F.col("snapshot_week") < monday_then).withColumn("computed_at", moment(options.get("computed_at") or as_of))
    return kept.select(*fresh.columns).unionByName(fresh)
