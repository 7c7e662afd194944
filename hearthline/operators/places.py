"""Place names found in addresses, in four tiers: as a part of the address, as a part without noise words, by a similar
chunk between commas, by a similar word. Longer names come first, then the vocabulary's order.

The vocabulary is a table of any size, and no tier compares all names with all addresses. Tiers one and two are a
many-pattern index: a name is listed under the rarest of its grams, an address looks up its own grams in an equi-join,
and containing the whole name is the verification. Tiers three and four filter by shared grams: a ratio of at least the
threshold leaves so few letters unmatched that a part and a name share a known number of bigrams, so they meet under one
of the rarest few of each; only what shares enough is scored in Python. Addresses, and their parts, are resolved once each.
"""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.functions.listing import match_text, noise_free, without_noise
from hearthline.params import DEFAULT, Params

#: Letters of the grams under which names are listed; a shorter name is listed under its whole text.
GRAM = 4
#: Names up to which their index is broadcast.
BROADCAST_NAMES = 100_000
#: The ratio above which similar texts of three letters and more are sure to share a bigram.
LEAST_RATIO = 0.8

Vocabulary = list[str] | DataFrame


def name_table(addresses: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(rank, name, clean, bare); a table of names has the columns ``name`` and ``pos``, its order of preference."""
    if isinstance(vocabulary, list):
        vocabulary = addresses.sparkSession.createDataFrame(list(enumerate(vocabulary)), "pos long, name string")
    rank = F.struct((-F.length("name")).alias("longest"), F.col("pos").cast("long").alias("pos"))
    clean = match_text(F.col("name"))
    return vocabulary.where("name is not null").select(rank.alias("rank"), "name", clean.alias("clean"), without_noise(clean).alias("bare"))


def _grams(text: Column, size: int | Column) -> Column:
    """The grams of a text, from left to right."""
    size = F.lit(size)
    return F.when(F.length(text) >= size, F.transform(F.sequence(F.lit(1), F.length(text) - size + 1), lambda i: F.substring(text, i, size))).otherwise(F.array().cast("array<string>"))


def _small(names: DataFrame) -> DataFrame:
    """The table as one to broadcast, if it is that small."""
    return F.broadcast(names) if names.limit(BROADCAST_NAMES + 1).count() <= BROADCAST_NAMES else names


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratio of matching blocks, twice their length over both lengths; the order of arguments matters."""
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def name_index(names: DataFrame) -> DataFrame:
    """(tier, gram, text, rank, name): each name once a tier, under its rarest gram."""
    texts = names.select(F.explode(F.array(F.struct(F.lit(1).alias("tier"), F.col("clean").alias("text")), F.struct(F.lit(2).alias("tier"), F.col("bare").alias("text")))).alias("t"), "rank", "name")
    texts = texts.select("t.tier", "t.text", "rank", "name").where((F.col("text") != "") & ((F.col("tier") == 1) | (F.length("text") > 2)))
    texts = texts.groupBy("tier", "text").agg(F.min("rank").alias("rank"), F.min_by("name", "rank").alias("name"))
    size = F.least(F.length("text"), F.lit(GRAM))
    each = texts.select("tier", "text", "rank", "name", F.explode(F.array_distinct(_grams(F.col("text"), size))).alias("gram"))
    often = each.groupBy("tier", "gram").count()
    rarest = each.join(often, ["tier", "gram"]).groupBy("tier", "text").agg(F.min(F.struct("count", "gram"))["gram"].alias("gram"), F.first("rank").alias("rank"), F.first("name").alias("name"))
    return rarest.select("tier", "gram", "text", "rank", "name")


def exact_places(addresses: DataFrame, address: str, vocabulary: Vocabulary) -> DataFrame:
    """The distinct addresses, cleaned (``_clean``), with place: tiers one and two."""
    index = name_index(name_table(addresses, vocabulary))
    sizes = sorted(r[0] for r in index.select(F.length("gram")).distinct().collect())  # 1 to GRAM
    d = addresses.where(F.col(address) != "").select(address).distinct()
    # a row number, always at least 0, keeps later filters above this step: they would run once a row, below the distinct
    d = d.withColumn("_clean", F.when(F.monotonically_increasing_id() >= 0, match_text(F.col(address))))
    d = d.withColumn("_bare", F.when(F.monotonically_increasing_id() >= 0, without_noise(F.col("_clean"))))
    tiers = F.array(F.struct(F.lit(1).alias("tier"), F.col("_clean").alias("within")), F.struct(F.lit(2).alias("tier"), F.col("_bare").alias("within")))
    probes = d.select(address, F.explode(tiers).alias("t")).select(address, "t.tier", "t.within")
    every = F.array_distinct(F.flatten(F.array(*[_grams(F.col("within"), n) for n in sizes]))) if sizes else F.array().cast("array<string>")
    met = probes.withColumn("gram", F.explode(every)).join(_small(index), ["tier", "gram"]).where(F.col("within").contains(F.col("text")))
    found = met.groupBy(address).agg(F.min_by("name", F.struct("tier", "rank")).alias("place"))
    return d.select(address, "_clean").join(found, address, "left")


def shared_bigrams(a: Column, b: Column, threshold: float) -> Column:
    """How many bigrams texts of these lengths share at least if their ratio reaches the threshold: a letter of the one
    without a partner breaks two of its bigrams at most, one of the other that stands in between breaks one."""
    matched = F.ceil(F.lit(threshold) * (a + b) / 2 - 1e-9)
    return (3 * matched - a - b - 1).cast("int")


def similar_pairs(parts: DataFrame, words: DataFrame, threshold: float) -> DataFrame:
    """From distinct (tier, part) and (tier, word): the pairs that share enough bigrams, and are near enough in length, to
    reach the threshold. Part and word each look under the rarest of their bigrams, as many as they may not share and one."""

    def listed(texts: DataFrame, text: str, often: DataFrame | None) -> DataFrame:
        pairs = _grams(F.col(text), 2)
        # of bigrams that a text has twice, the second is another one
        grams = F.transform(pairs, lambda g, i: F.concat(g, F.size(F.filter(F.slice(pairs, F.lit(1), i), lambda x: x == g)).cast("string")))
        n = F.length(text)
        # the shortest that can be similar
        least = F.ceil(n * threshold / (2 - threshold) - 1e-9)
        needed = F.greatest(F.lit(1), F.ceil((1.5 * threshold - 1) * (n + least) - 1 - 1e-9)).cast("int")
        each = texts.select("tier", text, grams.alias("grams"), (n - 1 - needed + 1).alias("room"))
        if often is None:
            return each
        ranked = each.select("tier", text, "grams", "room", F.explode("grams").alias("gram")).join(often, ["tier", "gram"], "left")
        ranked = ranked.groupBy("tier", text).agg(F.first("grams").alias("grams"), F.first("room").alias("room"), F.sort_array(F.collect_list(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "gram"))).alias("all"))
        return ranked.select("tier", text, "grams", F.explode(F.slice("all", F.lit(1), F.greatest("room", F.lit(1)))).alias("g")).select("tier", text, "grams", F.col("g.gram").alias("gram"))

    often = listed(words, "word", None).select("tier", F.explode("grams").alias("gram")).groupBy("tier", "gram").count()
    left, right = listed(parts, "part", _small(often)), listed(words, "word", _small(often)).withColumnRenamed("grams", "own")
    a, b = F.length("part"), F.length("word")
    near = (2 * F.least(a, b) >= threshold * (a + b)) & ((F.col("tier") == 3) | (F.abs(a - b) <= 1))
    met = left.join(_small(right), ["tier", "gram"]).where(near & (F.size(F.array_intersect("grams", "own")) >= shared_bigrams(a, b, threshold)))
    return met.select("tier", "part", "word").distinct()


def fuzzy_places(open_: DataFrame, address: str, vocabulary: Vocabulary, threshold: float = DEFAULT.place_ratio) -> DataFrame:
    """(address, place) for addresses (with ``_clean``) that a similar chunk or word resolves."""
    if threshold <= LEAST_RATIO:
        raise ValueError(f"similar texts need not share a bigram at a ratio of {LEAST_RATIO}")
    names = name_table(open_, vocabulary)
    both = F.array(F.struct(F.lit(3).alias("tier"), F.col("bare").alias("word")), F.struct(F.lit(4).alias("tier"), F.col("clean").alias("word")))
    words = names.select(F.explode(both).alias("w"), "rank", "name").select("w.*", "rank", "name").where(F.length("word") >= F.when(F.col("tier") == 3, 2).otherwise(4))
    words = words.groupBy("tier", "word").agg(F.min("rank").alias("rank"), F.min_by("name", "rank").alias("name"))

    def parts(tier: int, items: Column, least: int) -> DataFrame:
        return open_.select(address, F.lit(tier).alias("tier"), F.posexplode(items).alias("pos", "part")).where(F.length("part") >= least)

    chunks = F.transform(F.split(F.col(address), "[,/]"), noise_free)
    pieces = parts(3, chunks, 3).unionByName(parts(4, F.split("_clean", " "), 4))
    pairs = similar_pairs(pieces.select("tier", "part").distinct(), words.select("tier", "word"), threshold)
    scored = pairs.where(similarity("part", "word") >= threshold).join(words, ["tier", "word"])
    best = scored.groupBy("tier", "part").agg(F.min("rank").alias("rank"), F.min_by("name", "rank").alias("name"))
    return pieces.join(best, ["tier", "part"]).groupBy(address).agg(F.min_by("name", F.struct("tier", "pos", "rank")).alias("place"))


def resolve_places(df: DataFrame, address: str, vocabulary: Vocabulary, *, params: Params = DEFAULT, fuzzy: bool = True) -> DataFrame:
    """The rows with neighbourhood and neighbourhood_normalised; an address that stays open is cut to 60 characters."""
    found = exact_places(df, address, vocabulary)
    places = found.where("place is not null").select(address, "place")
    if fuzzy:
        places = places.unionByName(fuzzy_places(found.where("place is null"), address, vocabulary, params.place_ratio))
    out = df.join(places, address, "left")
    given = F.when(F.col(address) != "", F.substring(address, 1, params.place_chars))
    columns = [c for c in out.columns if c not in ("place", address)]
    return out.select(address, *columns, F.coalesce("place", given).alias("neighbourhood"), F.col("place").isNotNull().alias("neighbourhood_normalised"))
