"""Snapshots of a listing with many changes."""

import contextlib
import datetime as dt
import io
import random

import pytest

from hearthline.operators import snapshots
from tests.test_operators import HISTORY, brute_snapshots


def test_a_listing_has_no_more_spans_than_weeks(spark):
    rng = random.Random(7)
    start = dt.datetime(2023, 1, 2)
    listings = [(i, "A", "p", start + dt.timedelta(days=3 * i), start + dt.timedelta(days=80), "ACTIVE" if i % 2 else "REMOVED", rng.choice([None, 50, 60])) for i in range(6)]
    changes = [(k, 0 if k % 3 else k % 6, rng.choice([None, 40, 50, 60]), rng.choice([None, 40, 50, 60]), (start + dt.timedelta(days=rng.randint(-30, 120))).date()) for k in range(900)]
    df = spark.createDataFrame([(*r, True) for r in listings], "id long, city string, neighbourhood string, first_seen_at timestamp_ntz, last_seen_at timestamp_ntz, listing_status string, price_kobo long, neighbourhood_normalised boolean")
    h = spark.createDataFrame([(k, i, "PRICE_CHANGE", a, b, d) for k, i, a, b, d in changes], HISTORY)
    out = snapshots.weekly_snapshots(df, h, as_of="2023-04-20 00:00:00", id_includes_city=True)
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        out.explain()
    assert "collect_list" not in plan.getvalue()
    changes = [(k, i, a, b, d) for k, i, a, b, d in changes if a is not None]
    want = brute_snapshots(listings, [(k, i, a, a if b is None else b, d) for k, i, a, b, d in changes], dt.date(2023, 4, 17))
    got = {(r.city, r.neighbourhood, r.snapshot_week): (r.active_listing_count, r.new_listings_count, r.price_reduced_count, r.avg_days_on_market, r.p25, r.median_price_kobo, r.p90) for r in out.collect()}
    assert got.keys() == want.keys() and len(got) > 10
    for k, (n, new, red, days, *p) in want.items():
        assert got[k][:3] == (n, new, red) and got[k][3] == pytest.approx(days, abs=0.051) and [x if x is None else pytest.approx(x) for x in p] == list(got[k][4:]), k


def test_percentiles_of_prices_of_all_magnitudes(spark):
    """Zero, negative, equal and very large prices, those next to powers of two, and places without any price."""
    rng = random.Random(11)
    start = dt.datetime(2023, 1, 2)
    prices = [None, -7, 0, 1, 2, 3, 63, 64, 65, 1 << 40, (1 << 40) + 1, (1 << 40) - 1, 10**15, 10**15 + 1]
    listings = [(i, "A", rng.choice(["p", "q"]), start + dt.timedelta(days=rng.randint(0, 40)), start + dt.timedelta(days=rng.randint(20, 90)), rng.choice(["ACTIVE", "REMOVED", "OTHER"]), rng.choice(prices)) for i in range(80)]
    listings += [(100 + i, "B", "none", start, start, "ACTIVE", None) for i in range(3)]
    listings += [(200, "B", "gone", start + dt.timedelta(days=2), start, "REMOVED", 5), (201, "B", "gone", start, start + dt.timedelta(days=1), "REMOVED", 5)]
    df = spark.createDataFrame([(*r, True) for r in listings], "id long, city string, neighbourhood string, first_seen_at timestamp_ntz, last_seen_at timestamp_ntz, listing_status string, price_kobo long, neighbourhood_normalised boolean")
    got = {(r.city, r.neighbourhood, r.snapshot_week): r for r in snapshots.weekly_snapshots(df, spark.createDataFrame([], HISTORY), as_of="2023-04-20 00:00:00", id_includes_city=True).collect()}
    want = brute_snapshots(listings, [], dt.date(2023, 4, 17))
    assert got.keys() == want.keys() and len(got) > 20
    for k, (n, new, cut, days, *p) in want.items():
        r = got[k]
        assert (r.active_listing_count, r.new_listings_count, r.price_reduced_count) == (n, new, cut), k
        assert r.avg_days_on_market == pytest.approx(days, abs=0.051) and [r.p25, r.median_price_kobo, r.p90] == [x if x is None else pytest.approx(x) for x in p], k


@pytest.mark.parametrize("weeks", [0, 1, 6])
def test_refresh_equals_a_full_rebuild(spark, weeks):
    rng = random.Random(weeks)
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)

    def rows(seed):
        r = random.Random(seed)
        return {i: [i, r.choice("AB"), f"p{r.randint(0, 5)}", True, r.choice((None, 100, 200, 350)), r.choice(("ACTIVE", "REMOVED")), day(r.randint(0, 80)), day(90 + r.randint(0, 20))] for i in range(120)}

    before, changes = rows(1), [(k, rng.randrange(120), "PRICE_CHANGE", rng.choice((50, 100)), rng.choice((60, 90)), day(rng.randint(0, 100)).date()) for k in range(150)]
    after = {i: list(r) for i, r in before.items()}
    touched = [i for i in rng.sample(range(120), 10) if before[i][2] in ("p1", "p2")][:4]
    for i in touched:
        after[i][4], after[i][2] = 777, "p3" if i % 2 else after[i][2]
    more = [(1000 + i, i, "PRICE_CHANGE", 500, 400, day(60).date()) for i in touched]
    kind = "id long, city string, neighbourhood string, neighbourhood_normalised boolean, price_kobo long, listing_status string, first_seen_at timestamp_ntz, last_seen_at timestamp_ntz"
    past = "id long, listing_id long, event_type string, old_value long, new_value long, event_date date"
    a, b = (spark.createDataFrame([tuple(r) for r in x.values()], kind) for x in (before, after))
    h1, h2 = spark.createDataFrame(changes, past), spark.createDataFrame(changes + more, past)
    then, now = f"{day(112):%Y-%m-%d} 00:00:00", f"{day(112 + 7 * weeks):%Y-%m-%d} 00:00:00"
    stored = snapshots.weekly_snapshots(a, h1, as_of=then)
    moved = [(before[i][2],) for i in touched] + [(after[i][2],) for i in touched]
    out = snapshots.refresh_snapshots(stored, then, b, h2, spark.createDataFrame(moved, "neighbourhood string"), as_of=now)
    full = snapshots.weekly_snapshots(b, h2, as_of=now)
    assert sorted(map(str, out.collect())) == sorted(map(str, full.collect())) and full.count() > 50


def test_parts_that_meet_grow_with_the_rows(spark, monkeypatch):
    """However many parts the session sets, a task joins no more listings and changes than it may."""
    start, seen, whole = dt.datetime(2023, 1, 2), [], snapshots.price_segments
    monkeypatch.setattr(snapshots, "ROWS_PER_TASK", 100, raising=False)
    monkeypatch.setattr(snapshots, "price_segments", lambda *a, **k: seen.append(whole(*a, **k)) or seen[0])
    listings = [(i, "A", f"p{i % 2}", start, start, "ACTIVE", 100 + i) for i in range(600)]
    changes = [(i, i, "PRICE_CHANGE", 50, 40, (start + dt.timedelta(days=20)).date()) for i in range(600)]
    df = spark.createDataFrame([(*r, True) for r in listings], "id long, city string, neighbourhood string, first_seen_at timestamp_ntz, last_seen_at timestamp_ntz, listing_status string, price_kobo long, neighbourhood_normalised boolean")
    got = {(r.neighbourhood, r.snapshot_week.day): (r.active_listing_count, r.median_price_kobo) for r in snapshots.weekly_snapshots(df, spark.createDataFrame(changes, HISTORY), as_of="2023-02-02 00:00:00").collect()}
    assert got == {("p0", 2): (300, 50), ("p0", 9): (300, 50), ("p0", 16): (300, 399), ("p0", 23): (300, 399), ("p1", 2): (300, 50), ("p1", 9): (300, 50), ("p1", 16): (300, 400), ("p1", 23): (300, 400)}
    assert seen[0].rdd.getNumPartitions() >= 12
