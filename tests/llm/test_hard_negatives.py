"""Hard negatives against all pairs, the curve, the bounds, and how much of clustered vectors is read."""

import itertools
import math

import numpy as np
from pyspark.sql import functions as F

from hearthline.llm import hardnegatives as H
from hearthline.llm.staging import stage
from tests.llm.tables import rows

VECTORS = "vec_id long, embedding array<double>, label int, extra string"


def brute(data, step=100, positives=5, negatives=5, margin=80):
    known = [(i, [math.floor(256 * x) for x in v], y) for i, v, y, *_ in data if i is not None and y is not None and v is not None and len(v) == len(data[0][1]) and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, q, y in known:
        if a % step:
            continue
        scored = sorted(((-sum(x * z for x, z in zip(q, p, strict=True)), i, w == y) for i, p, w in known if i != a))
        for s, i, _ in [r for r in scored if r[2]][:positives]:
            fit = [(t, j) for t, j, same in scored if not same and margin * -s <= 100 * -t <= 100 * -s][:negatives]
            out += [(a, i, k + 1, j, -s, -t) for k, (t, j) in enumerate(fit)]
    return sorted(out)


def test_hilbert_keys_step_to_neighbours():
    for dim, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dim)))
        keys = H.hilbert_keys(cells, bits)
        assert len(set(keys)) == len(cells)
        walk = cells[sorted(range(len(cells)), key=keys.__getitem__)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_bounds_enclose_scores():
    rng = np.random.default_rng(2)
    anchors, block = rng.integers(-300, 300, (20, 9)), rng.integers(-300, 300, (50, 9))
    low, high = H.bounds(anchors, block.min(0)[None], block.max(0)[None])
    scores = anchors @ block.T
    assert (low[:, 0] <= scores.min(1)).all() and (high[:, 0] >= scores.max(1)).all()
    corner = np.where(anchors > 0, block.max(0), block.min(0))
    assert (high[:, 0] == (anchors * corner).sum(1)).all()
    big = np.full((1, 4), 1 << 29)
    assert H._products(big, big)[0, 0] == 4 << 58


def clustered(n=1500, dim=12, clusters=25):
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((clusters, dim))
    of = rng.integers(0, clusters, n)
    v = np.round(centres[of] + 0.08 * rng.standard_normal((n, dim)), 3)
    return [(k, v[k].tolist(), int((of[k] + (rng.random() < 0.3)) % 10), "x") for k in range(n)]


def test_clustered_vectors_read_few_blocks(spark):
    data = clustered()
    df = rows(spark, data, VECTORS)
    out = H.hard_negatives(df, F.col("vec_id") % 20 == 0, F.col("label"), block_rows=25, part_rows=300)
    expected = brute(data, step=20)
    assert sorted(map(tuple, out.collect())) == expected and len(expected) > 200
    index, dim = H.rows_in_order(df, F.col("label"), F.col("vec_id") % 20 == 0, "vec_id", "embedding", 256, 25, 300)
    zones = H.zone_maps(index, dim)
    best = {a: max(s for b, _, _, _, s, _ in expected if b == a) for a, *_ in expected}
    asked = index.join(rows(spark, [(a, s, (80 * s + 99) // 100) for a, s in best.items()], "id long, high long, low long"), "id").select(F.col("id").alias("anchor"), F.col("id").alias("tag"), "label", "q", F.lit(False).alias("same"), "low", "high")
    read, there = H.blocks_to_read(asked, zones, dim).count(), zones.count() * asked.count()
    assert read < 0.35 * there
    pairs = stage(index.where("part = 1").select("part", "block").distinct().withColumn("slice", F.lit(0)), "pairs")
    pruned = index.join(F.broadcast(pairs.where("slice >= 0")), ["part", "block"])
    assert "dynamicpruning" in pruned._jdf.queryExecution().executedPlan().toString() and pruned.count() == index.where("part = 1").count()


def test_near_random_vectors_ties_and_copies(spark):
    rng = np.random.default_rng(3)
    data = [(k, rng.standard_normal(6).round(1).tolist(), int(rng.integers(0, 3)), "x") for k in range(400)]
    data += [(1000 + k, data[0][1], k % 3, "x") for k in range(60)]  # one vector many times
    out = H.hard_negatives(rows(spark, data, VECTORS), F.col("vec_id") % 50 == 0, F.col("label"), block_rows=16, part_rows=100).collect()
    assert sorted(map(tuple, out)) == brute(data, step=50)


def test_odd_rows(spark):
    v = [0.5, -0.25, 1.0]
    data = [(0, v, 1, "a"), (1, v, 1, "a"), (2, v, 2, "a"), (3, None, 1, "a"), (4, [0.5, None, 1.0], 2, "a"), (5, [0.5, float("nan"), 1.0], 2, "a"), (6, [float("inf"), 0.0, 0.0], 2, "a"), (7, v, None, "a"), (8, [1.0], 2, "a"), (None, v, 2, "a"), (100, [0.0, 0.0, 0.0], 1, "a"), (9, [-v[0], -v[1], -v[2]], 3, "a"), (10, [0.45, -0.25, 1.0], 5, "a")]
    out = H.hard_negatives(rows(spark, data, VECTORS), F.col("vec_id") % 100 == 0, F.col("label"))
    assert sorted(map(tuple, out.collect())) == brute(data) and out.count() > 4
    for some in ([], [(1, v, 1, "a")], [(0, v, 1, "a")], [(0, None, 1, "a")]):
        assert H.hard_negatives(rows(spark, some, VECTORS), F.col("vec_id") % 100 == 0, F.col("label")).collect() == []
