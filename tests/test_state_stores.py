"""Log-structured and bucketed state, ranks without one task, and streams that begin anew."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hearthline.functions.ranks import numbered
from hearthline.operators import upsert, verify
from hearthline.sources.bucketed import open_bucketed, write_bucketed
from hearthline.sources.logstate import LogState
from hearthline.sources.tables import append_history, exists
from hearthline.streaming import runs
from hearthline.streaming.checks import apply_batch, checks_writer, stream_checks
from tests.test_operators import HISTORY, NOW, OBS, STATE, history, listing, obs

RESULTS = "listing_id long, source string, external_id string, is_removed boolean, observed_price long, error string"


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_batches_equal_one_go_before_and_after_compaction(spark, tmp_path):
    rng = random.Random(2)
    state = spark.createDataFrame([listing(i, price=100 + i, days=rng.randint(1, 90), missed=i % 4) for i in range(1, 201)], STATE)
    past = history(spark, [(i, 9, 5, "2024-01-01") for i in range(1, 201, 3)])
    results = [(i, "a", f"x{i}", rng.random() < 0.3, rng.choice((None, 50, 100 + i)), "broken" if i % 11 == 0 else None) for i in rng.sample(range(1, 201), 90)]
    one = verify.apply_checks(state, past, spark.createDataFrame(results, RESULTS), now=NOW).state
    store = LogState(spark, str(tmp_path / "log"), ratio=10)  # keeps its segments
    store.publish(state)
    events = []
    for k in range(6):
        own = results[k::6]
        written = apply_batch(store, state.schema, past, spark.createDataFrame(own, RESULTS), now=NOW, batch=f"b{k}", record=lambda e: events.extend(e.collect()))
        assert written == sum(r[-1] is None for r in own)  # in proportion to the batch
    assert len(store.segments()) == 7 and store.holds("b3") and not store.holds("b9")
    assert rows_of(store.read(state.schema)) == rows_of(one) and len(events) > 30
    store.ratio = 0.25
    assert store.compact(state.schema) and len(store.segments()) == 1
    assert rows_of(store.read(state.schema)) == rows_of(one) and not store.compact(state.schema)
    store.vacuum()
    assert rows_of(store.read(state.schema)) == rows_of(one) and sum("segment-" in p.name for p in (tmp_path / "log").iterdir()) == 1


def test_segments_stay_few(spark, tmp_path):
    schema = "id long, v long"
    store, last = LogState(spark, str(tmp_path / "log")), {}
    rng = random.Random(3)
    store.publish(spark.createDataFrame([(i, 0) for i in range(200)], schema))
    for k in range(1, 9):
        own = {i: k for i in rng.sample(range(250), 12)}
        last |= own
        store.publish(spark.createDataFrame(list(own.items()), schema))
        sizes = [n for _, n in store.segments()]
        assert all(sum(sizes[j:]) < 0.25 * sizes[j - 1] for j in range(1, len(sizes)))
    struct = spark.createDataFrame([], schema).schema
    assert {r.id: r.v for r in store.read(struct).collect()} == {i: 0 for i in range(200)} | last
    some = spark.createDataFrame([(3,), (240,), (999,)], "id long")
    expected = {i: v for i, v in ({i: 0 for i in range(200)} | last).items() if i in (3, 240)}
    assert {r.id: r.v for r in store.read_keys(some, struct).collect()} == expected
    assert LogState(spark, str(tmp_path / "none")).read(struct).count() == 0


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(source")


def test_upsert_of_bucketed_state_shuffles_observations_alone(spark, tmp_path):
    rng = random.Random(4)
    state = spark.createDataFrame([listing(i, source=rng.choice("ab"), price=100, missed=i % 3, status=rng.choice(("ACTIVE", "REMOVED"))) for i in range(300)], STATE)
    seen = spark.createDataFrame([obs(i, source=rng.choice("ab"), price=rng.choice((100, 90)), seq=k) for k, i in enumerate(rng.choices(range(400), k=200))], OBS)
    stored = write_bucketed(state, str(tmp_path / "state"), upsert.KEYS, 16)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain, out = upsert.upsert(state, seen, now=NOW, scraped_sources=["a"]), upsert.upsert(stored, seen, now=NOW, scraped_sources=["a"], buckets=16)
        again = open_bucketed(spark, str(tmp_path / "state"), STATE, upsert.KEYS, 16)
        third = upsert.upsert(again, seen, now=NOW, scraped_sources=["a"], buckets=16)
        for a, b, c in ((plain.state, out.state, third.state), (plain.events, out.events, third.events)):
            # without buckets the state is shuffled, too
            assert exchanges(a) == 2 and exchanges(b) == exchanges(c) == 1 and "Bucketed: true" in b._jdf.queryExecution().executedPlan().toString()
            assert rows_of(a) == rows_of(b) == rows_of(c)
        missed = upsert.missed_keys(stored, seen, ["a"])
        assert exchanges(missed) == 1 and rows_of(missed) == rows_of(upsert.missed_keys(state, seen, ["a"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_ranks_without_one_task(spark):
    rng = random.Random(5)
    data = [(i, rng.choice((None, 1, 2, 3)), rng.random()) for i in range(2000)]
    df = spark.createDataFrame(data, "id long, a int, b double").repartition(7)
    out = numbered(df, [F.col("a").desc_nulls_last(), F.col("b"), F.col("id")], "place")
    expected = sorted(data, key=lambda r: (r[1] is None, -(r[1] or 0), r[2], r[0]))
    assert [r.id for r in sorted(out.collect(), key=lambda r: r.place)] == [r[0] for r in expected]
    assert sorted(r.place for r in out.collect()) == list(range(1, 2001)) and "Window" not in out._jdf.queryExecution().toString()
    assert numbered(df.where("false"), [F.col("id")]).count() == 0


@pytest.fixture
def fed(spark, tmp_path):
    def feed(name, results):
        spark.createDataFrame(results, RESULTS).coalesce(1).write.mode("append").json(str(tmp_path / name))

    schema = spark.createDataFrame([], STATE).schema
    store, past = LogState(spark, str(tmp_path / "state")), str(tmp_path / "history")
    store.publish(spark.createDataFrame([listing(i, price=100) for i in range(1, 6)], STATE))

    def run(name, checkpoint):
        q = stream_checks(spark.readStream.schema(RESULTS).json(str(tmp_path / name)), checks_writer(store, schema, past, lambda: NOW), str(tmp_path / checkpoint))
        q.processAllAvailable()
        q.stop()
        return {r.id: (r.listing_status, r.price_kobo) for r in store.read(schema).collect()}

    return feed, run, past


def test_restarts_and_new_checkpoints_lose_and_repeat_nothing(spark, fed):
    feed, run, past = fed
    feed("in", [(1, "a", "x1", False, 90, None)])
    assert run("in", "cp")[1] == ("ACTIVE", 90)
    feed("in", [(2, "a", "x2", True, None, None)])
    assert run("in", "cp")[2] == ("REMOVED", 100)  # goes on where it ended
    feed("other", [(3, "a", "x3", False, 70, None), (4, "a", "x4", True, None, None)])
    state = run("other", "another")  # another stream, whose batches count from 0 again
    assert state == {1: ("ACTIVE", 90), 2: ("REMOVED", 100), 3: ("ACTIVE", 70), 4: ("REMOVED", 100), 5: ("ACTIVE", 100)}
    seen = spark.read.parquet(past)
    assert sorted((r.listing_id, r.event_type) for r in seen.collect()) == [(1, "PRICE_CHANGE"), (2, "REMOVED"), (3, "PRICE_CHANGE"), (4, "REMOVED")]
    assert run("in", "cp") == state and spark.read.parquet(past).count() == 4


def test_a_part_of_the_history_replaces_all_of_a_failed_attempt(spark, tmp_path):
    kinds = "listing_id long, event_type string, old_value long, new_value long, event_date date, notes string"
    day, path = dt.date(2024, 1, 1), str(tmp_path / "history")
    append_history(spark.createDataFrame([(1, "PRICE_CHANGE", 9, 5, day, None), (2, "REMOVED", None, None, day, None)], kinds), path, "b1")
    append_history(spark.createDataFrame([(1, "PRICE_CHANGE", 9, 5, day, None)], kinds), path, "b1")
    append_history(spark.createDataFrame([(7, "REMOVED", None, None, day, None)], kinds), path, "b2")
    assert sorted((r.listing_id, r.event_type, r.batch) for r in spark.read.parquet(path).collect()) == [(1, "PRICE_CHANGE", "b1"), (7, "REMOVED", "b2")]
    assert exists(spark, path) and HISTORY


def test_price_drops_as_bitmaps(spark):
    rng = random.Random(8)
    ids = [*range(1, 300), *(rng.randrange(-(10**6), 10**6) for _ in range(300)), 0, 32768, 32769, 65536]
    ids = sorted(set(ids))
    state = spark.createDataFrame([listing(i, days=60) for i in ids], STATE)
    drops = rng.sample(ids, 200)
    past = history(spark, [(i, 9, 5, "2024-01-01") for i in drops] + [(i, 5, 9, "2024-01-01") for i in ids] + [(10**12, 9, 5, "2024-01-01")])
    out = verify.suspected_sold(state, past, now=NOW)
    assert {r.id for r in out.where("suspected_sold").collect()} == set(drops) and out.count() == len(ids)
    plan = verify.suspected_sold(state, past, now=NOW)._jdf.queryExecution().executedPlan().toString()
    # drops meet as bitmaps; the state is not shuffled
    assert plan.count("Exchange hashpartitioning") == 1 and "bitmap_construct_agg" in plan and "SortMergeJoin" not in plan
    assert verify.suspected_sold(state.where("false"), past, now=NOW).count() == 0


def test_missed_runs_in_any_order_with_restarts(spark, tmp_path):
    rng = random.Random(9)
    start = dt.datetime(2024, 1, 1)
    data = sorted({(rng.randint(1, 12), start + dt.timedelta(hours=rng.randint(0, 400)), rng.choice(runs.KINDS)) for _ in range(500)}, key=lambda r: (r[1], r[0], r[2]))

    def expected(rows):
        out = {}
        for i in {r[0] for r in rows}:
            count, kind, at = runs.fold(0, None, None, sorted((int((t - start).total_seconds()), k) for j, t, k in rows if j == i))
            out[i] = (count, kind, start + dt.timedelta(seconds=at))
        return out

    schema = "listing_id long, at timestamp, kind string"
    store, struct = LogState(spark, str(tmp_path / "log"), "listing_id"), spark.createDataFrame([], runs.OUT).schema

    def feed(rows):
        rng.shuffle(rows)
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))

    def run(checkpoint="cp"):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
        runs.keep_missed_runs(stream, store, str(tmp_path / checkpoint), "2 days").awaitTermination()
        return {r.listing_id: (r.missed_run_count, r.last_result, r.last_at) for r in store.read(struct).collect()}

    # neighbouring files overlap by less than the delay
    files = [data[:200], data[150:350:2] + data[200:260], data[151:350:2] + data[350:]]
    for k, f in enumerate(files):
        feed(list(f))
        assert run() == expected([r for g in files[: k + 1] for r in set(g)] if k == 0 else sorted({r for g in files[: k + 1] for r in g}))
    assert run() == expected(data)  # nothing new
    feed([(1, start, "seen"), (1, data[-1][1], data[-1][2])])  # too late, and one that may be there already
    assert run()[2] == expected(data)[2]
    assert run("another") == expected(sorted({*data, (1, start, "seen"), (1, data[-1][1], data[-1][2])}))
