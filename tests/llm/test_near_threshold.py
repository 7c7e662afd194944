"""Near duplicates at thresholds other than the query's."""

import random

import corpus_pipeline
import pytest

from hearthline.llm import minhash
from tests.llm.tables import rows
from tests.llm.test_texts import DOCS, brute_components, shingles


def changed(rng, base, n):
    out = list(base)
    for p in range(n):
        out[20 + p * (len(base) - 40) // n] = f"x{rng.random()}"
    return out


def test_copies_between_80_and_85_go(spark):
    rng = random.Random(1)
    base = [f"w{rng.random()}" for _ in range(300)]
    a, b = " ".join(base), " ".join(changed(rng, base, 6))
    assert 0.80 <= len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b)) < 0.85
    docs = rows(spark, [(1, a, "en", "s", 1), (2, b, "en", "s", 1)], DOCS)
    assert [r.doc_id for r in minhash.drop_near_duplicates(docs).collect()] == [1]
    assert [r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()] == [1]
    assert {r.component_id for r in minhash.near_duplicates(docs, percent=85).collect()} == {1, 2}


@pytest.mark.parametrize("percent", [50, 15])
def test_low_thresholds_match_brute_force(spark, percent):
    rng, docs = random.Random(percent), []
    for _ in range(40):  # pairs on both sides of the threshold
        base = [f"w{rng.random()}" for _ in range(240)]
        docs += [(len(docs), " ".join(base)), (len(docs) + 1, " ".join(changed(rng, base, rng.randint(10, 40))))]
    out = {r.doc_id: r.component_id for r in minhash.near_duplicates(rows(spark, docs, "doc_id long, text string"), percent=percent).collect()}
    want = brute_components(docs, percent)
    assert out == want and 40 < len(set(want.values())) < 80


def test_shared_values_follow_the_threshold():
    assert minhash.sketch_plan(85) == (64, 38) and minhash.sketch_plan(80) == (64, 33) and minhash.sketch_plan(60) == (64, 18)
    assert minhash.sketch_plan(15)[0] > 64 and all(minhash.sketch_plan(p)[1] >= 1 for p in range(1, 101))
