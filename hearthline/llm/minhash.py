"""MinHash near-duplicate detection with bottom-k sketches of one hash function.

1. A document's set is its distinct 5-word shingles; its sketch is the k smallest of their hashes. Documents with the
   same set are one node from here on, so copies are never paired with each other.
2. The inverted lists of retained values generate overlaps. Two sets of the asked similarity share at least ``shared``
   of k retained values (or that part of a set smaller than that; ``sketch_plan`` sets both so that the chance to share
   fewer is at most MISS a pair), so they meet in one of the k - shared + 1 rarest values of each: only those are listed,
   and passages that many documents share, being frequent values, hardly are.
3. In short lists, all members are first paired with one of them, the same in most lists of a group of copies; what is
   then in lists of several components is paired across these. Nodes of long lists are listed anew, by the rarest
   shingles of their whole sets (of which a similar set shares the asked part), so that only near copies still meet in
   long lists. These are met by pivots: a few documents of a list are paired with all of it, and only members that are
   not yet in one component stay for the next round, with twice as many pivots. Rounds go on until every list is in one
   component or all its pairs were met, so no link between components is lost and none of the rounds makes all pairs of
   a large group.
4. The similarity estimated from the sketch of the union drops pairs; exact sets confirm the rest. A set is known by two
   independent hashes of each shingle: sets count as equal if both digests are, and a link must hold under both, so
   that only shingles that collide under both at once could mislead it.

Edge cases: null or wordless text has an empty set, is its own component and is kept; rows that repeat an id are one
document (their texts' sets are linked); rows with a null id stand alone, with a null component, and are kept; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.llm.components import connected_components
from hearthline.llm.staging import is_small, keyed_join, stage, unstage, with_row_key
from hearthline.llm.textbytes import long_lists, mix, shingle_hashes, slices, tidy, utf8, word_hashes, words

WIDTH = 5
#: Similarity, in percent, from which near duplicates are dropped.
PERCENT = 80
#: Retained values, more where the similarity is so low that few would be shared.
SKETCH = 64
#: Chance at most to miss a pair of just the asked similarity.
MISS = 2e-7
#: Of the two hashes of a shingle.
SEEDS = (1, 2)
#: Lists up to this length are paired whole; of longer ones about PIVOTS documents are pivots in the first round.
WHOLE = 16
PIVOTS = 4


def sketch_plan(percent: int) -> tuple[int, int]:
    """Values to retain, and how many of them two sets of that similarity share but for a chance of MISS: each of the
    k smallest values of their union is in both with that similarity as chance."""
    p, k = percent / 100, SKETCH
    if not 0 < p <= 1:
        raise ValueError(f"percent must be 1 to 100: {percent}")
    while (1 - p) ** k > MISS:
        k *= 2
    fewer, shared = 0.0, 0
    while shared < k:
        fewer += math.comb(k, shared) * p**shared * (1 - p) ** (k - shared)
        if fewer > MISS:
            break
        shared += 1
    return k, shared


def _distinct(hashes: np.ndarray, at: np.ndarray):
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        x = np.sort(hashes[a:b])
        yield x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


def set_hashes(column: pa.Array, width: int):
    """For each text the sorted distinct hashes of its shingles, under two seeds."""
    data, offsets = utf8(column)
    for i, j in slices(offsets):
        part, own = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        starts, ends, first = words(part, own)
        yield from zip(*(_distinct(*shingle_hashes(word_hashes(part, starts, ends, seed), first, width)) for seed in SEEDS), strict=True)


def digests(x: np.ndarray, y: np.ndarray) -> list[int]:
    return [int(mix(z).sum(dtype=np.uint64).view(np.int64)) for z in (x, y)]


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int = WIDTH, k: int = SKETCH) -> DataFrame:
    """id, n_shingles, two digests of the whole set (two longs), sketch."""

    @tidy
    def run(batches):
        for batch in batches:
            n, low, high, kept = [], [], [], []
            for x, y in set_hashes(batch.column(1), width):
                n.append(max(len(x), len(y)))
                d1, d2 = digests(x, y)
                low.append(d1)
                high.append(d2)
                kept.append(x[:k])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(low, pa.int64()), pa.array(high, pa.int64()), long_lists(kept)], ["id", "n", "d1", "d2", "sketch"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, n long, d1 long, d2 long, sketch array<long>")


def full_sets(texts: DataFrame, width: int = WIDTH) -> DataFrame:
    """From (node, text, d1, d2): node and its whole set, under both hashes; texts of other digests are left out."""
    names = ["node", "shingles", "again"]

    @tidy
    def run(batches):
        for batch in batches:
            nodes, made, again, size = [], [], [], 0
            known = zip(*(batch.column(c).to_pylist() for c in (0, 2, 3)), strict=True)
            for (node, *known_by), (x, y) in zip(known, set_hashes(batch.column(1), width), strict=True):
                if known_by != digests(x, y):
                    continue
                nodes.append(node)
                made.append(x)
                again.append(y)
                size += len(x)
                if size > 1 << 19:
                    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), long_lists(made), long_lists(again)], names)
                    nodes, made, again, size = [], [], [], 0
            if nodes:
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), long_lists(made), long_lists(again)], names)

    return texts.mapInArrow(run, "node long, shingles array<long>, again array<long>")


def _estimate(a: Column, b: Column, k: int) -> Column:
    """Of the k smallest values of the union, the share that is in both sketches."""
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, k)
    return F.size(F.array_intersect(F.array_intersect(a, b), union)) / F.size(union)


def inverted_lists(nodes: DataFrame, values: str, needed: Column) -> DataFrame:
    """(value, node, n, pos): each node in the lists of its rarest values, and how many rarer ones it has. Two nodes that
    share at least ``needed`` of their values meet in one of the rarest size - needed + 1 of each; lists of one node are
    left out."""
    each = nodes.select("node", F.explode(values).alias("value"))
    lists = stage(each.groupBy("value").count().where("count > 1"), "near-counts")
    shared = each.join(lists, "value").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("count", "value"))).alias("v"))
    shared = shared.join(nodes.select("node", "n", F.size(values).alias("k"), needed.alias("needed")), "node")
    # values that no other node has come first among the rarest
    alone = F.col("k") - F.size("v")
    room = F.col("k") - F.col("needed") + 1 - alone
    out = shared.where(room > 0).select("node", "n", alone.alias("alone"), F.posexplode(F.slice("v", F.lit(1), room)).alias("i", "v"))
    out = stage(out.select(F.col("v.value").alias("value"), "node", "n", (F.col("alone") + F.col("i")).cast("long").alias("pos")), "near-index")
    unstage(lists)
    return out


def _hopeful(lists: DataFrame, percent: int) -> DataFrame:
    """The entries of lists by whole sets that some entry of another component can still match. If two sets meet first
    in a value, they share at most what each has from there on, n - pos, and need percent / (100 + percent) of both
    sizes. What partners offer is summed up per list and size class, for the list's main component (that of the member
    with fewest rare values) and for the others."""
    main = F.min(F.struct("pos", F.xxhash64("node").alias("r"), "c"))["c"]
    whose = stage(lists.groupBy("value").agg(main.alias("main"), F.min("c").alias("c1"), F.max("c").alias("c2")).where("c1 < c2").select("value", "main"), "near-main")
    lists = lists.join(whose, "value").withColumn("inside", F.col("c") == F.col("main")).drop("main")
    offer = (100 + percent) * (F.col("n") - F.col("pos")) - percent * F.col("n")
    by_class = lists.groupBy("value", "inside", F.floor(F.log(F.col("n")) / 0.03).alias("class")).agg(F.min("n").alias("least"), F.max(offer).alias("offer"))
    classes = stage(by_class.groupBy("value").agg(F.collect_list(F.struct("least", "offer", "inside")).alias("classes")), "near-classes")
    other = lambda x: ~F.col("inside") | ~x["inside"]
    fits = F.exists("classes", lambda x: (x["offer"] >= percent * F.col("n")) & (offer >= percent * x["least"]) & other(x))
    out = stage(lists.join(classes, "value").where(fits).drop("classes", "inside"), "near-hopeful")
    unstage(whose, classes)
    return out


def _alike(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _of_both(pairs: DataFrame, table: DataFrame) -> DataFrame:
    """The staged pairs with the columns of ``table`` (node, ...) for ``a`` and for ``b``. While the pairs are few, only
    the rows that they name are moved."""
    columns = [c for c in table.columns if c != "node"]
    a, b = (table.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]) for side in "ab")
    if is_small(pairs):
        return a.join(F.broadcast(pairs), "a").join(b.join(F.broadcast(pairs.select("b").distinct()), "b", "left_semi"), "b")
    return pairs.join(a, "a").join(b, "b")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    def holds(c):
        both = F.size(F.array_intersect(f"{c}_a", f"{c}_b"))
        return 100 * both >= percent * (F.size(f"{c}_a") + F.size(f"{c}_b") - both)

    return stage(_of_both(pairs, sets).where(holds("shingles") & holds("again")).select("a", "b"), "near-links")


def pairs_that(pairs: DataFrame, sketch: DataFrame, condition: Column) -> DataFrame:
    """The pairs (a, b) whose two rows of ``sketch`` fulfil the condition, staged."""
    pairs = stage(pairs, "near-candidates")
    out = stage(_of_both(pairs, sketch).where(condition).select("a", "b"), "near-pairs")
    unstage(pairs)
    return out


def _union_estimate(nodes: DataFrame, percent: int) -> Callable[[DataFrame], DataFrame]:
    """Lets pairs pass by the sketch of their union."""
    k, shared = sketch_plan(percent)
    return lambda pairs: pairs_that(pairs, nodes.select("node", "sketch"), _estimate(F.col("sketch_a"), F.col("sketch_b"), k) >= shared / k)


def _sets_of(need: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """The whole sets of the needed nodes, staged."""
    need = stage(nodes.join(need, "node", "left_semi").select("node", "id", "d1", "d2"), "near-need")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sets = full_sets(keyed_join(texts, need, "id", "inner").select("node", "text", "d1", "d2"), width)
    # rows that repeat an id may repeat its text
    out = stage(sets.dropDuplicates(["node"]) if nodes._repeats else sets, "near-sets")
    unstage(need)
    return out


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()


def _short_links(short: DataFrame, nodes: DataFrame, docs: DataFrame, percent: int, id_col: str, text_col: str, width: int, passing: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Links from the staged short lists (value, node, n): of all members with one, then across components."""
    lot = F.struct(F.xxhash64("node").alias("r"), "node", "n")
    stars = short.join(short.groupBy("value").agg(F.min(lot).alias("c")), "value").where((F.col("node") != F.col("c.node")) & _alike("n", "c.n", percent))
    pairs = passing(stars.select(F.least("node", "c.node").alias("a"), F.greatest("node", "c.node").alias("b")).distinct())
    sets = _sets_of(_ends(pairs), nodes, docs, id_col, text_col, width)
    first = _confirmed(pairs, sets, percent)
    unstage(pairs, sets)
    label = connected_components(first)
    at = short.join(label, "node", "left").select("value", "node", "n", F.coalesce("component", "node").alias("c"))
    apart = at.groupBy("value").agg(F.min("c").alias("c1"), F.max("c").alias("c2"), F.min(lot)["node"].alias("center")).where("c1 < c2").select("value", "center")
    at = stage(at.join(apart, "value").where("node <> center").select("value", "node", "n", "c"), "near-apart")
    across = at.join(at.toDF("value", "b", "nb", "cb"), "value").where((F.col("node") < F.col("b")) & (F.col("c") != F.col("cb")) & _alike("n", "nb", percent))
    pairs = passing(across.select(F.col("node").alias("a"), "b").distinct())
    sets = _sets_of(_ends(pairs), nodes, docs, id_col, text_col, width)
    second = _confirmed(pairs, sets, percent)
    links = stage(first.unionByName(second), "near-links")
    unstage(label, at, pairs, sets, first, second)
    return links


def near_links(docs: DataFrame, nodes: DataFrame, percent: int, id_col: str, text_col: str, width: int = WIDTH, lists: DataFrame | None = None, passing: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(a, b): links that make the same components as all pairs of nodes with similarity of at least ``percent``. Nodes
    that can be similar meet in ``lists`` (value, node, n; staged), and ``passing`` stages those of the pairs that a sketch
    lets pass; both are by bottom-k sketches unless they are given."""
    share = F.ceil(F.col("n") * percent / 100).cast("int")
    if lists is None:
        lists = inverted_lists(nodes, "sketch", F.least(share, F.lit(sketch_plan(percent)[1])))
    passing = passing or _union_estimate(nodes, percent)
    sizes = stage(lists.groupBy("value").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "near-sizes")
    tagged = stage(lists.join(sizes, "value"), "near-tagged")
    unstage(lists, sizes)
    links = _short_links(tagged.where(F.col("size") <= WHOLE).select("value", "node", "n"), nodes, docs, percent, id_col, text_col, width, passing)
    long_ = stage(tagged.where(F.col("size") > WHOLE).select("node").distinct(), "near-long")
    unstage(tagged)
    if long_.limit(1).count() == 0:
        return links
    # nodes of long lists: listed anew by the rarest shingles of their whole sets, which leaves near copies alone in long lists
    sets = _sets_of(long_, nodes, docs, id_col, text_col, width)
    unstage(long_)
    whole = sets.select("node", F.size("shingles").cast("long").alias("n"), "shingles")
    lists, pivots, label = inverted_lists(whole, "shingles", share), PIVOTS, connected_components(links)
    old = [lists]
    while True:
        joined = lists.join(label, "node", "left").select("value", "node", "n", "pos", F.coalesce("component", "node").alias("c"))
        lists = _hopeful(joined, percent)
        unstage(label, *old)
        # pivots: the member with fewest rare values, which stands nearest to the others, and some by lot
        nearest = F.min(F.struct("pos", F.xxhash64("node").alias("r"), "node"))["node"]
        about = lists.groupBy("value").agg(F.count(F.lit(1)).alias("size"), nearest.alias("nearest"), F.min("c").alias("c1"), F.max("c").alias("c2"))
        about = stage(about.where("c1 < c2").select("value", "size", "nearest"), "near-about")
        if about.limit(1).count() == 0:
            unstage(lists, about, sets)
            return links
        draw = F.pmod(F.xxhash64("node", F.lit(pivots)), F.lit(1 << 30)) / float(1 << 30)
        pivot = (F.col("size") <= WHOLE) | (F.col("node") == F.col("nearest")) | (draw < pivots / F.col("size"))
        tagged = stage(lists.join(about, "value").withColumn("pivot", pivot), "near-tagged")
        unstage(lists, about)
        # each entry meets the array of its list's pivots, of which there are about WHOLE or ``pivots``, so rows are not
        # multiplied before pairs are distinct
        few = tagged.where("pivot").groupBy("value").agg(F.collect_list(F.struct("node", "n", "pos", "c")).alias("pivots"))
        few = stage(few, "near-pivots")

        def meets(p):
            reach = (100 + percent) * F.least(F.col("n") - F.col("pos"), p["n"] - p["pos"]) >= percent * (F.col("n") + p["n"])
            return (p["c"] != F.col("c")) & (~F.col("pivot") | (F.col("node") < p["node"])) & reach

        met = tagged.join(few, "value").select("node", F.transform(F.filter("pivots", meets), lambda p: p["node"]).alias("p")).where(F.size("p") > 0)
        met = met.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("p"))).alias("p")).select("node", F.explode("p").alias("p"))
        met = met.select(F.least("node", "p").alias("a"), F.greatest("node", "p").alias("b")).distinct()
        pairs = passing(met)
        more = _confirmed(pairs, sets, percent)
        before, links = links, stage(links.unionByName(more), "near-links")
        unstage(few, pairs, more, before)
        # what stays: members that were no pivots; what can match no more, or is of one component, goes in the next round
        lists = tagged.where("not pivot").select("value", "node", "n", "pos")
        if lists.limit(1).count() == 0:
            unstage(tagged, sets)
            return links
        label, old = connected_components(links), [tagged]
        pivots *= 2


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, width: int = WIDTH) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept, set_id (the smallest id with the same set)."""
    sk = stage(sketches(docs, id_col, text_col, width, sketch_plan(percent)[0]), "near-all")
    return labelled(sk, lambda nodes: near_links(docs, nodes, percent, id_col, text_col, width), id_col)


def labelled(sk: DataFrame, links_of: Callable[[DataFrame], DataFrame], id_col: str) -> DataFrame:
    """The result from the staged (id, n, d1, d2, ...) of all documents and what links the nodes, one per set."""
    real = sk.where("n > 0 and id is not null")
    # the smallest id of each set stands for it; sets have numbers of their own, for an id may have several
    named = real.groupBy("n", "d1", "d2").agg(F.min("id").alias("id"))
    named = stage(named.withColumn("node", F.monotonically_increasing_id()), "near-sets-once")
    twice = stage(real.groupBy("id").agg(F.min(F.struct("d1", "d2")).alias("x"), F.max(F.struct("d1", "d2")).alias("y"), F.count(F.lit(1)).alias("rows")).where("rows > 1"), "near-twice")
    repeats = twice.limit(1).count() > 0
    nodes = keyed_join(real, named, ["n", "d1", "d2", "id"], "inner").select("node", *sk.columns)
    nodes = stage(nodes.dropDuplicates(["node"]) if repeats else nodes, "near-nodes")
    nodes._repeats = repeats
    links = links_of(nodes)
    # an id with several sets links them
    of_id = real.join(twice.where("x <> y").select("id"), "id", "left_semi").join(named.drop("id"), ["n", "d1", "d2"]).select("id", "node").distinct()
    same = of_id.join(of_id.groupBy("id").agg(F.min("node").alias("b")), "id").select(F.col("node").alias("a"), "b").where("a <> b")
    label = connected_components(links.unionByName(same)) if repeats else connected_components(links)
    unstage(nodes)
    grouped = stage(named.join(label, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component", "node"), "near-grouped")
    least = grouped.groupBy("c").agg(F.min("id").alias("component"))
    named_ = stage(grouped.join(least, "c").select("n", "d1", "d2", F.col("id").alias("set_id"), "component"), "near-named")
    unstage(named, twice, label, links, grouped)
    out = sk.select("id", "n", "d1", "d2").join(named_, ["n", "d1", "d2"], "left")
    solid = F.col("id").isNotNull() & (F.col("n") > 0)
    component = F.when(solid, F.col("component")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"), F.when(solid, F.col("set_id")).otherwise(F.col("id")).alias("set_id"),
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The documents, all columns as they are, less all but one row of each component: that with the smallest id, null
    last. Each row is a document of its own here, also where ids repeat or are null."""
    rows, row = with_row_key(docs)
    label = near_duplicates(rows, row, text_col, percent).select(F.col(row).alias("_gone"), "component_id")
    label = stage(label.join(rows.select(F.col(row).alias("_gone"), F.col(id_col).cast("long").alias("_id")), "_gone"), "near-labels")
    first = F.min(F.struct(F.col("_id").isNull().alias("last"), "_id", "_gone"))["_gone"]
    groups = stage(label.groupBy("component_id").agg(first.alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1"), "near-groups")
    gone = stage(keyed_join(label, groups, "component_id", "inner").where("_gone <> _first").select("_gone"), "near-gone")
    unstage(label, groups)
    return keyed_join(rows, gone, rows[row] == gone["_gone"], "left_anti").drop(row)
