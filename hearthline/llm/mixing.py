"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only.

A source with target T and S words is to be taken T / S times. The whole part of that are certain copies of each of its
documents. What is left of the target is drawn: a document's inclusion odds follow from the chance p = min(1, c * w), w
being the length of its size in binary, and c such that the drawn words are expected to be those left. Chances of 1 are
certain copies, too. The others are ranked by the Pareto statistic (u / (1 - u)) / (p / (1 - p)), u being a hash of id
and text, and taken from the smallest on up to the words left, so that reruns agree. Where a source then lacks more than
CLOSE of its target, later documents of its ranking go in as they fit, until it lacks less or none fits; if it still
lacks more, the first that ends nearer to the target although it goes beyond.

Edge cases: null text or one without words has size 0 and takes 0 words; null sources form one source, ordered last;
very long texts are counted whole; an empty table gives an empty result; rows that repeat an id, or have none, are drawn
each by its own text; rows that repeat both are alike, share their u and are ranked side by side; other columns are not
read. Targets pass through windows over all sources, which are taken to be few; documents meet in windows only where
they share a source and one of 16.8 million classes of ranks, or where their source lacks more than CLOSE of its target:
it lacks less than one document, so such a target is no larger than 1 / CLOSE of its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.llm.staging import keyed_join, stage, unstage

WORD = r"[^\x20\x09-\x0D]+"
#: Ranks fall into so many classes, and those of the class in which a source is completed into as many again.
RANK_CLASSES = 4096
#: Share of its target that a source may lack when no more documents are tried.
CLOSE = 0.01
#: Sources up to which their targets are broadcast.
BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=(3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """From (source_key, size): each source's words and its target. Sources in order take ``weights`` in turn; no
    target exceeds ``most`` times its source, and what is cut is dealt to the others by weight."""
    by_key, by_ratio = Window.orderBy("source_key"), Window.orderBy("ratio", "source_key")
    w = F.array(*[F.lit(float(x)) for x in weights])
    s = sizes.groupBy("source_key").agg(F.sum("size").alias("source_words"))
    s = s.withColumn("weight", w[(F.row_number().over(by_key) - 1) % len(weights)]).withColumn("cap", most * F.col("source_words"))
    s = s.withColumn("ratio", F.col("cap") / F.col("weight"))
    everyone = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    # With sources by rising cap / weight, level k is each weight's share once the first k sources hold their caps;
    # the right k is the first whose next source lies above its level.
    s = (
        s.withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("rest", F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", (share * F.sum("source_words").over(everyone) - F.col("capped")) / F.col("rest"))
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(everyone)["level"])
    )
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("weight")))
    return s.select("source_key", "source_words", target.alias("target"))


def _few(table: DataFrame, most: int) -> DataFrame:
    return F.broadcast(table) if table.limit(most + 1).count() <= most else table


def inclusion_chances(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """(source_key, w): certain copies, the chance p of one more, and the source's words, target and words left. Chances
    are in proportion to w, but none above 1; with the largest k classes at 1, the others share what is left by w."""
    c = sized.groupBy("source_key", "w").agg(F.sum("size").alias("words")).join(targets, "source_key")
    ratio = F.when(F.col("source_words") > 0, F.col("target") / F.col("source_words")).otherwise(0.0)
    c = c.withColumn("certain", F.floor(ratio + 1e-12).cast("long")).withColumn("left", F.greatest(F.lit(0.0), F.col("target") - F.col("certain") * F.col("source_words")))
    source = Window.partitionBy("source_key")
    larger = source.orderBy(F.desc("w")).rowsBetween(Window.unboundedPreceding, -1)
    c = c.withColumn("capped", F.coalesce(F.sum("words").over(larger), F.lit(0))).withColumn("shares", F.sum(F.col("words") * F.col("w")).over(source) - F.coalesce(F.sum(F.col("words") * F.col("w")).over(larger), F.lit(0)))
    level = F.when(F.col("shares") > 0, (F.col("left") - F.col("capped")) / F.col("shares"))
    c = c.withColumn("level", level).withColumn("level", F.min(F.when(F.col("level") * F.col("w") <= 1, F.struct(-F.col("w"), "level"))).over(source)["level"])
    p = F.when(F.col("left") > 0, F.least(F.lit(1.0), F.coalesce(F.col("level") * F.col("w"), F.lit(1.0)))).otherwise(0.0)
    return c.select("source_key", "w", "source_words", "target", "certain", "left", p.alias("p"))


def _completed(d: DataFrame, keys: list[str], of: str) -> DataFrame:
    """Per source, the class ``of`` with the word that completes it: from sums per class alone. ``start`` are the words
    before these classes."""
    upto = Window.partitionBy(*keys).orderBy(of).rowsBetween(Window.unboundedPreceding, -1)
    c = d.groupBy(*keys, of).agg(F.sum("size").alias("words"), F.first("left").alias("left"), F.first("start").alias("start"))
    c = c.withColumn("before", F.col("start") + F.coalesce(F.sum("words").over(upto), F.lit(0))).where("before < left and before + words >= left")
    cut = c.groupBy(*keys).agg(F.min(F.struct(of, "before")).alias("cut"))
    return cut.select(*keys, F.col(f"cut.{of}").alias(f"cut_{of}"), F.col("cut.before").alias(f"before_{of}"))


def _filled(drawn: DataFrame) -> DataFrame:
    """The staged draw, with further documents in those sources that lack more than CLOSE of their targets. A round takes
    what stands first in the ranking, of the documents that fit, up to the first that fits no more. Last, a document that
    goes beyond the target goes in where that ends nearer to it."""
    order, source = ["rank", "id", "size", "n"], Window.partitionBy("source_key")
    given = F.sum(F.when(F.col("rank").isNotNull(), F.col("extra") * F.col("size")).otherwise(0))
    lack = drawn.where("left > 0").groupBy("source_key").agg((F.first("left") - given).alias("lack"), (F.first("target") * CLOSE).alias("close"), F.lit(None).cast("struct<rank:double,id:long,size:long,n:long>").alias("last"))
    open_ = drawn.where("rank is not null and extra = 0 and size > 0")
    needy = lack = stage(lack.where("lack > close"), "mix-lack")
    if not needy.limit(1).count():
        return drawn
    more = drawn.where("false").select("source_key", "n", "size")
    while lack.limit(1).count():
        fits = open_.join(_few(lack, BROADCAST_SOURCES), "source_key").where(F.col("size") <= F.col("lack"))
        fits = fits.where(F.col("last").isNull() | (F.struct(*order) > F.col("last")))
        before = F.coalesce(F.sum("size").over(source.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        took = stage(fits.withColumn("before", before).where("before + size <= lack and lack - before > close").select("source_key", *order, "lack", "close"), "mix-took")
        lack = took.groupBy("source_key").agg((F.first("lack") - F.sum("size")).alias("lack"), F.first("close").alias("close"), F.max(F.struct(*order)).alias("last"))
        lack = stage(lack.where("lack > close"), "mix-lack")
        more = more.unionByName(took.select("source_key", "n", "size"))
    more = stage(more, "mix-more")
    left = needy.join(more.groupBy("source_key").agg(F.sum("size").alias("got")), "source_key", "left").select("source_key", "close", (F.col("lack") - F.coalesce("got", F.lit(0))).alias("lack"))
    beyond = open_.join(_few(left.where("lack > close"), BROADCAST_SOURCES), "source_key").where(F.col("size") < 2 * F.col("lack")).join(more.select("n"), "n", "left_anti")
    beyond = beyond.groupBy("source_key").agg(F.min(F.struct(*order))["n"].alias("n"))
    more = stage(more.select(F.col("n").alias("_n")).unionByName(beyond.select(F.col("n").alias("_n"))), "mix-more")
    filled = keyed_join(drawn, more, F.col("n") == F.col("_n"), "left")
    return filled.withColumn("copies", F.col("copies") + F.col("_n").isNotNull().cast("long"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=(3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0, seed: int = 17, row_col: str | None = None) -> DataFrame:
    """One row per document: id, size, source_size, target, copies, taken (= copies * size), chance (that of the drawn
    copy); and ``row_col``, a key of rows that tells those apart that repeat an id or have none, where one is given.
    ``most`` is a whole number."""
    row = ["row"] if row_col else []
    key = F.struct(F.col(source_col).isNull().alias("last"), F.coalesce(source_col, F.lit("")).alias("name"))
    size = word_count(F.col(text_col)).alias("size")
    name = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("null")), F.coalesce(text_col, F.lit("")))
    u = (F.conv(F.substring(F.md5(name), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)
    sized = docs.select(F.col(id_col).cast("long").alias("id"), size, u.alias("u"), key.alias("source_key"), *[F.col(row_col).alias(r) for r in row])
    sized = stage(sized.withColumn("w", F.length(F.bin("size")).cast("long")), "mix-sizes")
    targets = stage(source_targets(sized, weights, share, most), "mix-targets")
    chances = stage(inclusion_chances(sized, _few(targets, BROADCAST_SOURCES)), "mix-chances")
    unstage(targets)
    u = F.col("u")
    drawn = (F.col("p") > 0) & (F.col("p") < 1)
    even = F.col("rank") / (1 + F.col("rank")) * RANK_CLASSES
    d = (
        sized.join(_few(chances, BROADCAST_SOURCES), ["source_key", "w"])
        .withColumn("rank", F.when(drawn, (u / (1 - u)) / (F.col("p") / (1 - F.col("p")))))
        .withColumn("class", F.floor(even).cast("int")).withColumn("part", F.floor((even - F.floor(even)) * RANK_CLASSES).cast("int"))
    )
    # chances of 1 are certain and come before all ranks
    sure = stage(d.where("p = 1").groupBy("source_key").agg(F.sum("size").alias("start")), "mix-sure")
    d = d.join(_few(sure, BROADCAST_SOURCES), "source_key", "left").withColumn("start", F.coalesce("start", F.lit(0))).withColumn("sure", F.col("start"))
    cut = stage(_completed(d.where("rank is not null"), ["source_key"], "class"), "mix-cuts")
    d = d.join(_few(cut, BROADCAST_SOURCES), "source_key", "left")
    near = d.where("rank is not null and class = cut_class").withColumn("start", F.col("before_class"))
    parts = stage(_completed(near, ["source_key"], "part"), "mix-parts")
    d = d.join(_few(parts, BROADCAST_SOURCES), "source_key", "left")
    at_edge = F.coalesce((F.col("class") == F.col("cut_class")) & (F.col("part") == F.col("cut_part")), F.lit(False))
    order = Window.partitionBy("source_key").orderBy("rank", "id", "size", *row).rowsBetween(Window.unboundedPreceding, -1)
    so_far = F.col("before_part") + F.coalesce(F.sum("size").over(order), F.lit(0))
    edge = d.where(at_edge).withColumn("so_far", so_far).withColumn("extra", (F.col("so_far") + F.col("size") <= F.col("left")).cast("long"))
    ahead = (F.col("class") < F.col("cut_class")) | ((F.col("class") == F.col("cut_class")) & (F.col("part") < F.col("cut_part")))
    extra = F.when(F.col("p") <= 0, False).when((F.col("p") >= 1) | F.col("cut_class").isNull(), True).otherwise(ahead)
    whole = d.where(~at_edge).withColumn("extra", extra.cast("long"))
    columns = ["id", "size", F.col("source_words").alias("source_size"), "target", (F.col("certain") + F.col("extra")).alias("copies"), F.col("p").alias("chance"), *row]
    # of what the ranking has to give, ``left`` is what comes after the certain ones
    ranked = ["source_key", "rank", "extra", (F.col("left") - F.coalesce("sure", F.lit(0))).alias("left")]
    drawn = whole.select(*columns, *ranked).unionByName(edge.select(*columns, *ranked)).withColumn("n", F.monotonically_increasing_id())
    out = _filled(stage(drawn, "mix-drawn"))
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "chance", *[F.col(r).alias(row_col) for r in row])
