"""State, verification, snapshots, feeds, extraction, stores and the stream, with invariants."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hearthline.operators import backfill, extract, feeds, gazetteer, runlog, snapshots, upsert, verify
from hearthline.sources.logstate import LogState
from hearthline.sources.tables import append_history
from hearthline.streaming.checks import checks_writer, stream_checks

NOW = "2024-03-01 12:00:00"
STATE = (
    "id long, external_id string, source string, url string, title string, price_kobo long, price_parse_failed boolean, lat double, lng double, geocoded boolean, listing_status string, suspected_sold boolean, "
    "missed_run_count smallint, first_seen_at timestamp_ntz, last_seen_at timestamp_ntz, last_health_check_at timestamp_ntz, next_health_check_at timestamp_ntz"
)
OBS = "source string, external_id string, url string, title string, price_kobo long, price_parse_failed boolean, lat double, lng double, geocoded boolean, seq long"


def listing(i, source="a", price=100, status="ACTIVE", days=100, missed=0, last=None, next_=None):
    seen = dt.datetime(2024, 3, 1, 12) - dt.timedelta(days=days)
    return (i, f"x{i}", source, f"https://t/x{i}", "t", price, price is None, 1.0, 2.0, True, status, False, missed, seen, seen, last, next_)


def obs(i, source="a", price=100, seq=0, geocoded=False):
    return (source, f"x{i}", f"https://t/new/x{i}", "new", price, price is None, 9.0 if geocoded else None, 9.5 if geocoded else None, geocoded, seq)


def frames(spark, state, seen):
    return spark.createDataFrame(state, STATE), spark.createDataFrame(seen, OBS)


def test_upsert_cases(spark):
    state, seen = frames(spark, [listing(1), listing(2, price=450), listing(3, status="REMOVED"), listing(4, missed=2), listing(5, source="b"), listing(6, price=None)], [obs(1), obs(2, price=400, seq=1), obs(2, price=1, seq=0), obs(3), obs(6, price=7), obs(9), obs(9, price=None, seq=5)])
    out = upsert.upsert(state, seen, now=NOW, scraped_sources=["a"])
    s = {r.external_id: r for r in out.state.collect()}
    now = dt.datetime(2024, 3, 1, 12)
    assert len(s) == 7 and (s["x1"].title, s["x1"].lat, s["x1"].geocoded, s["x1"].last_seen_at) == ("new", 1.0, False, now)
    assert s["x2"].price_kobo == 400 and s["x6"].price_kobo == 7 and s["x9"].price_kobo is None and s["x9"].first_seen_at == now
    assert (s["x3"].listing_status, s["x3"].title, s["x3"].last_seen_at) == ("REMOVED", "t", now)
    assert (s["x4"].missed_run_count, s["x5"].missed_run_count) == (3, 0) and s["x4"].listing_status == "ACTIVE"
    events = sorted((r.external_id, r.event_type, r.old_value, r.new_value) for r in out.events.collect())
    assert events == [("x2", "PRICE_CHANGE", 450, 400), ("x3", "LISTED", None, 100), ("x9", "LISTED", None, None)]
    stats = {r.source: (r.new, r.updated, r.price_changes, r.duplicates_dropped) for r in out.stats.collect()}
    assert stats == {"a": (2, 3, 1, 2), None: (2, 3, 1, 2)}
    again = upsert.upsert(out.state, seen, now=NOW, scraped_sources=["a"])
    assert sorted(r.event_type for r in again.events.collect()) == ["LISTED"]  # the removed one, as before
    relisted = upsert.upsert(state, seen, now=NOW, relist=True)
    assert [r.event_type for r in relisted.events.where("external_id = 'x3'").collect()] == ["RELISTED"] and relisted.state.where("external_id = 'x3'").first().listing_status == "ACTIVE"


def test_upsert_of_nothing(spark):
    state, seen = frames(spark, [], [])
    out = upsert.upsert(state, seen, now=NOW)
    assert out.state.count() == out.events.count() == 0 and [tuple(r) for r in out.stats.collect()] in ([], [(None, 0, 0, 0, 0)])
    many, none = frames(spark, [listing(i) for i in range(500)], [])
    assert upsert.upsert(many, none, now=NOW).state.where("missed_run_count = 1").count() == 500


HISTORY = "id long, listing_id long, event_type string, old_value long, new_value long, event_date date"


def history(spark, rows):
    return spark.createDataFrame([(k, i, "PRICE_CHANGE", a, b, dt.date.fromisoformat(d)) for k, (i, a, b, d) in enumerate(rows)], HISTORY)


def test_suspected_sold(spark):
    state = spark.createDataFrame([listing(1, days=45), listing(2, days=10), listing(3, days=60), listing(4, days=30)], STATE)
    h = history(spark, [(1, 9, 5, "2024-01-01"), (2, 9, 5, "2024-01-01"), (3, 5, 9, "2024-01-01"), (4, 9, 5, "2024-01-01")])
    assert {r.id: r.suspected_sold for r in verify.suspected_sold(state, h, now=NOW).collect()} == {1: True, 2: False, 3: False, 4: True}


FETCH = "listing_id long, source string, external_id string, url string, status int, final_url string, body string, error string"


def fetch(i, status=200, final=None, body="fine", error=None):
    return (i, "a", f"x{i}", f"https://t/x{i}", status, final or f"https://t/x{i}", body, error)


def test_classify_and_apply(spark):
    log = spark.createDataFrame([fetch(1), fetch(2, 404), fetch(3, final="https://t/"), fetch(4, final="https://t/moved/x4"), fetch(5, body="This ad has been DELETED!"), fetch(6, None), fetch(7, error="broken"), fetch(8, 500, final="https://t/")], FETCH)
    prices = spark.createDataFrame([(1, 90), (4, 100), (2, 5), (6, 5)], "listing_id long, observed_price long")
    c = verify.classify_fetches(log, observed=prices)
    assert {r.listing_id: (r.is_removed, r.observed_price) for r in c.collect()} == {1: (False, 90), 2: (True, None), 3: (True, None), 4: (False, 100), 5: (True, None), 6: (False, None), 7: (None, None), 8: (True, None)}
    state = spark.createDataFrame([listing(i, days=10 * i, missed=3) for i in range(1, 9)], STATE)
    out = verify.apply_checks(state, history(spark, [(3, 9, 5, "2024-01-01")]), c, now=NOW)
    s, now = {r.id: r for r in out.state.collect()}, dt.datetime(2024, 3, 1, 12)
    assert (s[1].price_kobo, s[1].last_seen_at, s[1].missed_run_count, s[1].next_health_check_at) == (90, now, 0, now + dt.timedelta(seconds=164160))
    assert s[4].next_health_check_at == now + dt.timedelta(seconds=587520) and s[6].next_health_check_at == now + dt.timedelta(seconds=1192320)
    assert [s[i].listing_status for i in (2, 3, 5, 8)] == ["REMOVED"] * 4 and [s[i].suspected_sold for i in (2, 3, 5, 8)] == [False, True, False, False] and s[2].next_health_check_at is None
    assert (s[7].missed_run_count, s[7].last_health_check_at) == (3, None)
    assert sorted((r.listing_id, r.event_type, r.new_value) for r in out.events.collect()) == [(1, "PRICE_CHANGE", 90), (2, "REMOVED", None), (3, "REMOVED", None), (5, "REMOVED", None), (8, "REMOVED", None)]
    assert out.stats.first().asDict() == {"checked": 7, "confirmed_removed": 4, "confirmed_active": 3, "price_changes": 1, "errors": 1}


def test_candidates(spark):
    at = lambda d: dt.datetime(2024, 3, 1, 12) - dt.timedelta(days=d)
    rows = [listing(1, days=5, missed=1, last=at(4), next_=at(2)), listing(2, missed=1), listing(3, missed=0), listing(4, missed=1, next_=at(1)), listing(5, missed=1, last=at(1), next_=at(-1)), listing(6, status="REMOVED", missed=1), listing(7, days=90, missed=9, last=at(20), next_=at(6))]
    state = spark.createDataFrame(rows, STATE)
    assert [r.id for r in verify.check_candidates(state, now=NOW).orderBy("rank").collect()] == [4, 1, 7, 2]
    everything = sorted((r.rank, r.batch, r.id) for r in verify.check_candidates(state, now=NOW, force_all=True).collect())
    assert everything == [(k + 1, 0, i) for k, i in enumerate([7, 2, 4, 1, 5, 3])]


def brute_snapshots(listings, changes, as_of):
    out = {}
    week = min(r[3] for r in listings).date()
    week -= dt.timedelta(days=week.weekday())
    while week + dt.timedelta(days=6) < as_of:
        sunday = week + dt.timedelta(days=6)
        groups = {}
        for i, city, nb, first, last, status, price in listings:
            if first.date() <= sunday and (status == "ACTIVE" or last.date() >= week):
                own = sorted((d, k, a, b) for k, j, a, b, d in changes if j == i)
                p = next((a for d, _, a, _ in own if d > sunday and a is not None), price)
                end = last.date() if status == "REMOVED" and last.date() <= sunday else sunday
                groups.setdefault((city, nb), []).append((p, max(0, (end - first.date()).days), week <= first.date() <= sunday, any(week <= d <= sunday and b < a for d, _, a, b in own)))
        for (city, nb), rows in groups.items():
            if len(rows) > 1:
                prices = sorted(p for p, *_ in rows if p is not None)
                at = lambda q: None if not prices else prices[int(q * (len(prices) - 1))] + (prices[min(len(prices) - 1, int(q * (len(prices) - 1)) + 1)] - prices[int(q * (len(prices) - 1))]) * (q * (len(prices) - 1) % 1)  # noqa: B023, E731
                out[city, nb, week] = (len(rows), sum(r[2] for r in rows), sum(r[3] for r in rows), sum(r[1] for r in rows) / len(rows), at(0.25), at(0.5), at(0.9))
        week += dt.timedelta(days=7)
    return out


def test_snapshots_match_brute_force(spark):
    import random

    rng = random.Random(3)
    day = lambda: dt.datetime(2023, 1, 1) + dt.timedelta(days=rng.randint(0, 120), hours=rng.randint(0, 23), microseconds=rng.choice([0, 999999]))
    listings = []
    for i in range(60):
        first = day()
        listings.append((i, rng.choice("AB"), rng.choice(["p", "q", "r"]) + rng.choice(["1", ""]), first, first + dt.timedelta(days=rng.randint(-20, 60)), rng.choice(["ACTIVE", "REMOVED"]), rng.choice([None, 10 * i])))
    changes = [(k, rng.randrange(60), rng.choice([None, 5 * k]), rng.randint(0, 500), day().date()) for k in range(120)]
    changes = [(k, i, a, b, d) for k, i, a, b, d in changes if a is not None]
    df = spark.createDataFrame([(*r, True) for r in listings], "id long, city string, neighbourhood string, first_seen_at timestamp_ntz, last_seen_at timestamp_ntz, listing_status string, price_kobo long, neighbourhood_normalised boolean")
    h = spark.createDataFrame([(k, i, "PRICE_CHANGE", a, b, d) for k, i, a, b, d in changes], HISTORY)
    out = snapshots.weekly_snapshots(df, h, as_of="2023-06-07 00:00:00", id_includes_city=True).collect()
    got = {(r.city, r.neighbourhood, r.snapshot_week): (r.active_listing_count, r.new_listings_count, r.price_reduced_count, r.avg_days_on_market, r.p25, r.median_price_kobo, r.p90) for r in out}
    want = brute_snapshots(listings, changes, dt.date(2023, 6, 7) - dt.timedelta(days=2))
    assert got.keys() == want.keys() and len(got) > 50
    for k, (n, new, red, days, *p) in want.items():
        assert got[k][:3] == (n, new, red) and got[k][3] == pytest.approx(days, abs=0.051) and [x if x is None else pytest.approx(x) for x in p] == list(got[k][4:]), k
    assert len({r.id for r in out}) == len(out)


def test_gazetteer(spark):
    gaz = spark.createDataFrame([("Lekki Phase 1", "LAGOS", 6.4698, 3.5852), ("lekki phase 1", "lagos", 1.0, 1.0), ("Jos", "", 2.0, 3.0)], "neighbourhood string, city string, lat double, lng double")
    rows = spark.createDataFrame([(1, "LEKKI phase 1", "Lagos"), (2, "Jos", None), (3, None, "LAGOS"), (4, "", ""), (5, "Nowhere", None), (6, "nowhere", "")], "id int, neighbourhood string, city string")
    out = {r.id: (r.lat, r.geocoded) for r in gazetteer.enrich(rows, gaz).collect()}
    assert out == {1: (6.4698, True), 2: (2.0, True), 3: (None, False), 4: (None, False), 5: (None, False), 6: (None, False)}
    assert [r.query_text for r in gazetteer.gazetteer_misses(rows, gaz).collect()] == ["Nowhere, Nigeria, Nigeria"]
    assert sorted(r.neighbourhood for r in gazetteer.extend_gazetteer(gaz, gaz.union(spark.createDataFrame([("Uyo", None, 5.0, 7.0)], gaz.schema))).collect()) == ["Uyo"]


def test_backfill(spark):
    gaz = spark.createDataFrame([("Lekki", "LAGOS", 6.4, 3.5)], "neighbourhood string, city string, lat double, lng double")
    df = spark.createDataFrame([(1, "12 Lekki rd", None, False, "LAGOS", 9.0, 9.0, True), (2, "elsewhere", None, False, None, None, None, False), (3, "", None, False, None, None, None, False), (4, "x", "Ikoyi", True, None, None, None, False), (5, "ikoyi", None, False, None, 8.0, 8.0, True)], "id long, raw_address string, neighbourhood string, neighbourhood_normalised boolean, city string, lat double, lng double, geocoded boolean")
    out = backfill.backfill(df, gaz, ["Lekki", "Ikoyi"], dry_run=False)
    s = {r.id: (r.neighbourhood, r.neighbourhood_normalised, r.lat, r.geocoded) for r in out.state.collect()}
    assert s == {1: ("Lekki", True, 6.4, True), 2: (None, False, None, False), 3: (None, False, None, False), 4: ("Ikoyi", True, None, False), 5: ("Ikoyi", True, None, False)}
    assert out.stats.first().asDict() == {"candidates": 4, "processed": 3, "normalised": 2, "geocoded": 1, "normalised_pct": 66.7, "geocoded_pct": 50.0}
    assert backfill.backfill(df, gaz, ["Lekki"]).state is None


def test_feed_cutoffs(spark):
    known = [f"k{i}" for i in range(20)]
    items = ["u1", "k0", "k1", "u2", "k2", "k3", "k4", "u3"]
    feed = spark.createDataFrame([("a", "f", 1 + i // 3, i, x) for i, x in enumerate(items)] + [("a", "g", 9, 0, "u9"), ("a", "g", 1, 0, "u8")], "source string, feed string, page int, position int, external_id string")
    state = spark.createDataFrame([("a", k) for k in known], "source string, external_id string")
    assert sorted(r.external_id for r in feeds.new_in_feed(feed, state, n=3).collect()) == ["u1", "u2", "u8"]
    f = spark.createDataFrame([("a", i, item, bad) for i, (item, bad) in enumerate([(True, True), (False, False), (True, True), (True, False), (False, True), (True, True), (True, False)])], "source string, position int, is_item boolean, failed boolean")
    assert feeds.before_failures(f, n=2, order=["position"]).count() == 3  # a page in between does not end the run
    assert feeds.before_failures(f, n=3, order=["position"]).count() == 7


@pytest.mark.parametrize("block", [1, 3, 1024])
def test_failure_runs_match_a_walk(spark, monkeypatch, block):
    monkeypatch.setattr(feeds, "BLOCK_POSITIONS", block)
    rng = random.Random(block)
    rows = [(s, f, p, i, rng.random() < 0.7, rng.random() < q) for s, q in (("a", 0.3), ("b", 0.8), (None, 0.7)) for f in ("x", "y") for p in (1, 2) for i in range(9)]
    got = feeds.before_failures(spark.createDataFrame(rows, "source string, feed string, page int, position int, is_item boolean, failed boolean"), n=4).collect()
    want, stopped, run = [], set(), {}
    for s, f, p, i, item, bad in rows:
        run[s] = run.get(s, 0) + 1 if bad else 0 if item else run.get(s, 0)
        if s not in stopped:
            want.append((s, f, p, i, run[s]))
        if run[s] >= 4:
            stopped.add(s)
    assert sorted((str(r.source), r.feed, r.page, r.position, r.run) for r in got) == sorted((str(w[0]), *w[1:]) for w in want)


PAGE = """<html><body><h1 class="page-heading">3 bed flat, Lekki</h1><div class="property-pricing"><div class="pricing"><h2><strong>45,000,000</strong><strong>&#8358;</strong></h2></div></div>
<div class="property-contact-block"><div class="property-pros"><ul><li>3 beds</li><li>2 baths</li></ul></div></div><div class="content-block"><p>Lekki, Lagos</p><div class="line-paragraph">A fine flat</div></div>
<div id="sidebar"><div class="flex-grow-1"><a><h4>Agent Co</h4></a></div></div></body></html>"""
LOOSE = """<div class=box><h1>Duplex</h1><span>Call us</span><h3>USD 1,200<br>per year</h3><p>4 bedrooms</p><p>Wuse, Abuja</p><div class="about-it">%s</div><div class="agent-box"><div><span>contact</span><h5>Own & Sons</h5></div></div></div>""" % ("words " * 30)
CENTRE = """<main><p>Flat for rent</p><h1>Flat</h1><span>&#8358;5,000,000</span><div><span>3</span><span>Bedrooms</span></div><div class="x"><span>Ikoyi, Lagos</span></div><section><div><h2>About this property</h2></div><div x-ref="body">Nice<br>one</div></section>
<div><div><h2>Marketed by</h2></div></div><a href="/agents/1">Best Agents</a></main>"""
HTML = "source string, url string, html string"


def test_extraction(spark):
    pages = spark.createDataFrame(
        [
            ("propertypro", "https://propertypro.ng/property/for-sale-flat-7NUGY", PAGE), ("propertypro", "https://propertypro.ng/property/for-rent-x-8NUGY", LOOSE), ("propertypro", "https://propertypro.ng/about", PAGE),
            ("propertypro", "https://propertypro.ng/property/x-9NUGY", "<p>nothing"), ("privateproperty", "https://privateproperty.ng/listings/short-let-6PBUWY", LOOSE), ("nigeriapropertycentre", "https://nigeriapropertycentre.com/for-rent/3364115-flat", CENTRE),
            ("jiji", "https://jiji.ng/x", '<link rel="canonical" href="https://jiji.ng/houses-apartments-for-sale/a-abcdefghijkl.html"><h1>T</h1><div class="qa-advert-price-view-title">₦ 5</div><div class="b-advert-icon-attribute">House</div><div class="b-advert-icon-attribute">4 bedrooms</div>'), ("jiji", "u", None),
        ],
        HTML,
    )
    good, bad = extract.extract_listings(pages)
    g = {r.external_id: r for r in good.collect()}
    assert {r.reason for r in bad.collect()} == {"no external id", "no price"} and bad.count() == 3
    a = g["7NUGY"]
    assert (a.title, a.raw_price, a.raw_price_type, a.raw_bedrooms, a.raw_address, a.description, a.agent_name) == ("3 bed flat, Lekki", "₦45,000,000", "FOR_SALE", "3 beds", "Lekki, Lagos", "A fine flat", "Agent Co")
    b = g["8NUGY"]
    assert (b.raw_price, b.raw_bedrooms, b.raw_address, b.agent_name) == ("USD 1,200per year", "4 bedrooms", "Wuse, Abuja", "Own & Sons") and b.description.startswith("words")
    c = g["3364115"]
    assert (c.raw_price, c.raw_price_type, c.raw_bedrooms, c.raw_address, c.description, c.property_type_raw, c.agent_name) == ("₦5,000,000", "FOR_RENT", "3 Bedrooms", "Ikoyi, Lagos", "Nice\none", "Flat for rent", "Best Agents")
    d = g["abcdefghijkl"]
    assert (d.url, d.raw_price_type, d.property_type_raw, d.raw_bedrooms) == ("https://jiji.ng/houses-apartments-for-sale/a-abcdefghijkl.html", "FOR_SALE", "House", "4 bedrooms")
    assert g["6PBUWY"].raw_price == "USD 1,200per year" and g["6PBUWY"].raw_price_type == "FOR_SHORT_LET"


def test_observed_prices_stay_with_their_fetch(spark):
    url = "https://propertypro.ng/property/for-sale-flat-7NUGY"
    jiji = lambda price, found: f'<link rel="canonical" href="https://jiji.ng/flat-{found}.html"><h1>T</h1><div class="qa-advert-price-view-title">₦ {price}</div>'
    rows = [
        (1, "propertypro", "7NUGY", url, 200, url, PAGE, None), (2, "jiji", "q", "u", 404, "u", PAGE, None), (3, "jiji", "abcdefghijkl", "u", 200, "u", jiji("7,000", "abcdefghijkl"), None),
        (4, "jiji", "abcdefghijkl", "u", 200, "u", jiji("8,000", "abcdefghijkl"), None), (5, "jiji", "abcdefghijkl", "u", 200, "u", jiji("9,000", "zzzzzzzzzzzz"), None), (6, "jiji", "a", "u", 200, "u", jiji("1", "abcdefghijkl"), "broken"),
        (7, "propertypro", "x", url, 200, url, PAGE + " Page not found", None), (8, "propertypro", "x", url, 503, url, PAGE, None), (3, "jiji", "abcdefghijkl", "u", 200, "u", jiji("7,500", "abcdefghijkl"), None),
    ]
    out = sorted((r.listing_id, r.external_id, r.is_removed, r.observed_price, r.reason, r.error) for r in extract.checked_pages(spark.createDataFrame(rows, FETCH)).collect() if r.listing_id != 6)
    assert out == [
        (1, "7NUGY", False, 4500000000, "live", None), (2, "q", True, None, "not_found", None), (3, "abcdefghijkl", False, 700000, "live", None), (3, "abcdefghijkl", False, 750000, "live", None), (4, "abcdefghijkl", False, 800000, "live", None),
        (5, "abcdefghijkl", False, 900000, "live", None), (7, "x", True, None, "phrase", None), (8, "x", False, None, "unreachable", None),
    ]


def test_links(spark):
    html = '<div class="pl-title"><a href="/property/a-7NUGY">x</a><a href="/b">y</a></div><div class="pl-title"><a href="/property/a-7NUGY">x</a></div><div class="pl-title">none</div>'
    centre = '<article><a href="/l/3364115-x">1</a><a href="/about">2</a><a href="https://o/3364116">3</a></article>'
    pages = spark.createDataFrame([("propertypro", "p", html), ("nigeriapropertycentre", "q", centre), ("jiji", "r", None)], HTML)
    assert [(r.url, r.external_id) for r in extract.harvest_links(pages).orderBy("page_url", "position").collect()] == [
        ("https://propertypro.ng/property/a-7NUGY", "7NUGY"), ("https://nigeriapropertycentre.com/l/3364115-x", "3364115"), ("https://o/3364116", "3364116"),
    ]


def test_run_log(spark):
    runs = spark.createDataFrame([("a", dt.datetime(2024, 3, 1), "SUCCESS"), ("a", dt.datetime(2024, 3, 1, 11), "FAILED"), ("b", dt.datetime(2024, 2, 28), "SUCCESS"), ("c", dt.datetime(2024, 3, 1), "FAILED")], "source string, run_at timestamp_ntz, status string")
    assert {r.source: r.due for r in runlog.run_due(runs, now=NOW).collect()} == {"a": False, "b": True, "c": True}
    log = runlog.run_log_rows(spark.createDataFrame([("a", 3)], "source string, new int"), run_at=NOW, duration=1.5).first()
    assert (log.new_listings, log.updated_listings, log.status, log.error_message) == (3, 0, "FAILED", None)
    from hearthline.schemas import SCRAPE_RUNS

    s = runlog.run_summary(spark.createDataFrame([(None, dt.datetime(2024, 3, 1), "a", 3, 1, 0, 2, "SUCCESS", None, None), (None, dt.datetime(2024, 3, 1), "b", 0, 0, 0, 0, "FAILED", None, None)], SCRAPE_RUNS).withColumn("duration_seconds", F.lit(125.7))).first()
    assert (s.new_listings, s.non_success, s.duration, s.lines) == (3, 1, "2m 5s", "a: 3 new, 1 updated\nb: FAILED - unknown error")


def test_state_versions_and_stream(spark, tmp_path):
    schema = spark.createDataFrame([], STATE).schema
    store, past = LogState(spark, str(tmp_path / "state")), str(tmp_path / "history")
    assert store.read(schema).count() == 0
    store.publish(spark.createDataFrame([listing(1, price=100), listing(2)], STATE))
    append_history(spark.createDataFrame([(1, "PRICE_CHANGE", 9, 5, dt.date(2024, 1, 1), None)], "listing_id long, event_type string, old_value long, new_value long, event_date date, notes string"), past)
    kind = "listing_id long, source string, external_id string, is_removed boolean, observed_price long, error string"
    spark.createDataFrame([(1, "a", "x1", True, None, None), (2, "a", "x2", False, 70, None)], kind).write.json(str(tmp_path / "in"))
    write = checks_writer(store, schema, past, lambda: NOW)
    q = stream_checks(spark.readStream.schema(kind).json(str(tmp_path / "in")), write, str(tmp_path / "cp"))
    q.processAllAvailable()
    q.stop()
    out = {r.id: (r.listing_status, r.suspected_sold, r.price_kobo) for r in store.read(schema).collect()}
    assert out == {1: ("REMOVED", True, 100), 2: ("ACTIVE", False, 70)}
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", q.id)
    write(spark.createDataFrame([(2, "a", "x2", True, None, None)], kind), 0)  # the stream's batch 0 again
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    assert store.read(schema).where("id = 2").first().listing_status == "ACTIVE" and spark.read.parquet(past).count() == 3


@pytest.mark.parametrize("where", ["before the events", "after the events", "after the version", "after the pointer"])
def test_a_batch_that_failed_on_its_way_is_applied_once(spark, tmp_path, monkeypatch, where):
    from hearthline.streaming import checks

    schema, past = spark.createDataFrame([], STATE).schema, str(tmp_path / "history")
    store = LogState(spark, str(tmp_path / "state"))
    store.publish(spark.createDataFrame([listing(1, price=100), listing(2, price=80)], STATE))
    kind = "listing_id long, source string, external_id string, is_removed boolean, observed_price long, error string"
    batch = spark.createDataFrame([(1, "a", "x1", False, 70, None), (2, "a", "x2", True, None, None)], kind)
    write = checks_writer(store, schema, past, lambda: NOW)

    def broken(f, then):
        def run(*a, **k):
            if then:
                f(*a, **k)
            raise OSError("lost")

        return run

    with monkeypatch.context() as m:
        if where == "before the events":
            m.setattr(checks, "append_history", broken(checks.append_history, False))
        elif where == "after the events":
            m.setattr(checks, "append_history", broken(checks.append_history, True))
        elif where == "after the version":
            m.setattr(spark, "createDataFrame", broken(spark.createDataFrame, False), raising=False)
        else:
            m.setattr(store, "publish", broken(store.publish, True))
        with pytest.raises(OSError):
            write(batch, 3)
    write(batch, 3)
    write(batch, 3)
    out = {r.id: (r.listing_status, r.suspected_sold, r.price_kobo) for r in store.read(schema).collect()}
    assert out == {1: ("ACTIVE", False, 70), 2: ("REMOVED", False, 80)}
    assert sorted((r.listing_id, r.event_type, r.new_value) for r in spark.read.parquet(past).collect()) == [(1, "PRICE_CHANGE", 70), (2, "REMOVED", None)]
    write(spark.createDataFrame([(1, "a", "x1", True, None, None)], kind), 4)
    assert store.read(schema).where("id = 1").first().suspected_sold and spark.read.parquet(past).count() == 3


def test_sinks(spark, tmp_path):
    from hearthline.schemas import SCRAPE_RUNS
    from hearthline.sources import tables

    day = dt.date(2024, 1, 1)
    snaps = [("i", "B", "n", day, 2.0), ("i", "A", "n", day, 1.0), ("j", "A", "m", day, 3.0)]
    df = spark.createDataFrame(snaps, "id string, city string, neighbourhood string, snapshot_week date, p25 double")
    for _ in range(2):  # the second reload replaces the first
        tables.replace_snapshots(df.repartition(3), str(tmp_path / "snap"))
    assert sorted((r.id, r.city) for r in tables.read_table(spark, str(tmp_path / "snap")).collect()) == [("i", "A"), ("j", "A")]
    run = spark.createDataFrame([(None, dt.datetime(2024, 3, 1), "a", 3, 1, 0, 2, "SUCCESS", None, None)], SCRAPE_RUNS)
    for _ in range(2):
        tables.append_runs(run, str(tmp_path / "runs"))
    assert tables.read_table(spark, str(tmp_path / "runs"), SCRAPE_RUNS).count() == 2
    place = spark.createDataFrame([("Lekki", "LAGOS", 6.4, 3.5)], "neighbourhood string, city string, lat double, lng double")
    tables.append_gazetteer(place, str(tmp_path / "gaz"))
    assert tables.read_table(spark, str(tmp_path / "gaz")).first().lat == 6.4


@pytest.mark.parametrize("scraped", [None, ["a"], ["a", "b", "c"]])
def test_one_written_join_gives_all_outputs(spark, tmp_path, scraped):
    state, seen = frames(spark, [listing(1), listing(2, price=450), listing(3, source="b")], [obs(1), obs(2, price=400), obs(2, price=300, seq=-1), obs(9), obs(3, source="b")])
    plain, written = upsert.upsert(state, seen, now=NOW, scraped_sources=scraped), upsert.upsert(state, seen, now=NOW, scraped_sources=scraped, joined_path=str(tmp_path / "joined"))
    for a, b in ((plain.state, written.state), (plain.events, written.events), (plain.stats, written.stats)):
        assert a.schema == b.schema and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert "FileScan parquet" in written.events._jdf.queryExecution().toString() and "FullOuter" not in written.events._jdf.queryExecution().toString()


def test_report_texts(spark):
    stats = spark.createDataFrame([(3, 1, 2, 0, 0), (3, 1, 2, 0, 4)], "checked long, confirmed_removed long, confirmed_active long, price_changes long, errors long")
    assert [r.lines.split("\n")[1:] for r in runlog.check_summary(stats).collect()] == [["Still active: 2", "Price changes: 0", "Confirmed removed: 1"], ["Still active: 2", "Price changes: 0", "Confirmed removed: 1", "Errors: 4"]]
    assert len(spark.createDataFrame([("é" * 1500,)], "m string").select(runlog.crash_text(F.col("m")).alias("m")).first().m) == 1000
