"""The place indexes against comparing every name with every address."""

import difflib
import random

import pytest
from pyspark.sql import functions as F

from hearthline import vocab
from hearthline.operators import places
from tests.test_listing_columns import brute_place


@pytest.mark.parametrize("word", vocab.NOISE_WORDS)
def test_noise_words_go_on_both_sides(spark, word):
    names = [f"Ojota {word.title()} Ketu"]
    df = spark.createDataFrame([(1, "4 Ojota Ketu, Lagos"), (2, f"Ojota {word} Ketu"), (3, "Ketu Ojota")], "i int, a string")
    assert {r.i: r.neighbourhood_normalised for r in places.resolve_places(df, "a", names, fuzzy=False).collect()} == {1: True, 2: True, 3: False}


def test_similar_places_with_noise(spark):
    names = ["Ojota Bus Stop Ketu", "GRA", "Vi", "Ibeju-Lekki", "Ikeja GRA Extension", "Aba"]
    addresses = ["Ojotta Ketu, Lagos", "5 Road, G.R.A", "Old GRA close", "xvix", "Ibejulekki", "Ikeja GRA", "abba road", "Abaa", "ojota stop ketuu/none"]
    df = spark.createDataFrame(list(enumerate(addresses)), "i int, a string")
    out = {r.i: (r.neighbourhood, r.neighbourhood_normalised) for r in places.resolve_places(df, "a", names).collect()}
    assert [out[i] for i in range(len(addresses))] == [brute_place(a, names) for a in addresses]


def text(rng, letters, low, high):
    return "".join(rng.choice(letters) for _ in range(rng.randint(low, high)))


def test_many_names(spark):
    """200,000 names: what the plan holds does not grow with them, and the result is that of comparing all."""
    rng = random.Random(5)
    names = [f"{text(rng, 'abcdefghijklmnop', 3, 9)} {text(rng, 'abcdefghijklmnop', 2, 8)}".title() for _ in range(200_000)] + ["Qz", "Q"]
    some = rng.sample(names, 150)
    addresses = [f"{k} {n}, Somewhere" for k, n in enumerate(some[:100])] + [f"no. {k} xyz uvw" for k in range(20)] + ["zzqzz", "qqq", "The Estate, " + names[7].upper()]
    vocabulary = spark.createDataFrame(list(enumerate(names)), "pos long, name string")
    df = spark.createDataFrame(list(enumerate(addresses)), "i int, a string")
    found = places.exact_places(df, "a", vocabulary)
    got = {r.a: r.place for r in found.collect()}
    clean = lambda t: " ".join("".join(c if c.isalnum() else " " for c in t.lower()).split())
    order = sorted(((-len(n), k), n, clean(n)) for k, n in enumerate(names))
    expected = {a: next((n for _, n, c in order if c in clean(a)), None) for a in addresses}
    assert got == {a: p or got[a] for a, p in expected.items()} and sum(p is not None for p in expected.values()) > 100
    assert len(found._jdf.queryExecution().executedPlan().toString()) < 40_000


def test_similar_pairs_lose_none(spark):
    rng = random.Random(6)
    base = [text(rng, "abcde", 4, 14) for _ in range(150)]
    words = [(tier, w) for w in base for tier in (3, 4)]

    def changed(w):
        w = list(w)
        for _ in range(rng.randint(0, 2)):
            k = rng.randrange(len(w))
            w[k : k + rng.randint(0, 1)] = text(rng, "abcde", 0, 2)
        return "".join(w)

    parts = {(rng.choice((3, 4)), changed(rng.choice(base))) for _ in range(400)}
    parts = [(t, p) for t, p in parts if len(p) >= t]
    pairs = places.similar_pairs(spark.createDataFrame(parts, "tier int, part string"), spark.createDataFrame(words, "tier int, word string"), 0.85)
    got = {tuple(r) for r in pairs.select("tier", "part", "word").collect()}
    close = lambda p, w, t: difflib.SequenceMatcher(None, p, w).ratio() >= 0.85 and (t == 3 or abs(len(p) - len(w)) <= 1)
    expected = {(t, p, w) for t, p in parts for u, w in words if t == u and close(p, w, t)}
    assert expected <= got and len(expected) > 100
    assert len(got) < 0.1 * len(parts) * len(base)  # few of all pairs are scored
    with pytest.raises(ValueError, match="bigram"):
        places.fuzzy_places(spark.range(1).select(F.lit("x").alias("a"), F.lit("x").alias("_clean")), "a", ["x"], 0.8)


def test_empty_vocabulary_and_no_addresses(spark):
    df = spark.createDataFrame([(1, "Lekki"), (2, None), (3, "")], "i int, a string")
    assert {r.i: r.neighbourhood for r in places.resolve_places(df, "a", df.select(F.lit("x").alias("name"), F.lit(1).alias("pos")).where("false")).collect()} == {1: "Lekki", 2: None, 3: None}
    assert places.resolve_places(df.where("false"), "a", ["Lekki"]).collect() == []
