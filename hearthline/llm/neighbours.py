"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table's bucket is the vector of floor((a . v + b) / w) over normal vectors a. A query visits its own bucket and then
perturbed ones, in the order of their estimated success: moves of one coordinate are ranked by how near the query lies
to that border, and sets of moves by the expected sum of squares for their ranks (Lv et al. 2007). The candidates of
all tables are merged and ranked by exact distance. Buckets are as wide as neighbours are far: the median distance of the
k-th neighbours of SAMPLE rows, by one pass over all rows, so that clustered vectors are found in their clusters.

Rows are hashed once and lie in blocks of about BLOCK_ROWS, ordered by their first bucket, so that near rows share few
blocks. Queries' probes meet the buckets, each with the list of its blocks, in an equi-join; a query goes to the blocks that hold
any bucket it visits, and there meets the rows of these buckets alone. Queries that find fewer than k go to all blocks
and meet all rows.

Edge cases: vectors that are null, zero, of another length than most, or hold null or non-finite components take no
part, nor do rows without an id; rows with the query's id are not its neighbours; of query rows that repeat an id, one
stands; equal distances go by id; fewer rows than k give all of them; an empty table gives an empty result; other
columns are not read. Rows that repeat an id with the same vector are told apart only by standing in the result twice.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.llm.staging import keyed_join, stage, unstage
from hearthline.llm.textbytes import tidy

#: Tables, functions of each, buckets that a query visits in each, and their width as a multiple of the distance at which
#: neighbours usually lie.
TABLES, MOVES, PROBES, WIDTH = 16, 8, 60, 1.75
#: Rows, by lot, from whose k-th neighbours among all rows that distance is taken.
SAMPLE = 64
BLOCK_ROWS = 10_000
#: Queries that one task holds beside a block, and how many of them it works on at a time.
QUERY_SLICE, QUERY_STEP = 20_000, 256


def probe_order(moves: int, probes: int) -> np.ndarray:
    """The first sets of move ranks by expected success, padded with the rank 2 * moves (no move)."""
    j = np.arange(1, moves + 1)
    near = j * (j + 1) / (4 * (moves + 1) * (moves + 2))
    far = 1 - j[::-1] / (moves + 1) + j[::-1] * (j[::-1] + 1) / (4 * (moves + 1) * (moves + 2))
    cost = np.concatenate((near, far))
    sets, heap = [()], [(cost[0], (0,))]
    while heap and len(sets) < probes:
        total, s = heapq.heappop(heap)
        if len({min(x, 2 * moves - 1 - x) for x in s}) == len(s):  # not both moves of one coordinate
            sets.append(s)
        last = s[-1]
        if last + 1 < 2 * moves:
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*s[:-1], last + 1)))
            heapq.heappush(heap, (total + cost[last + 1], (*s, last + 1)))
    longest = max(map(len, sets))
    return np.array([(*s, *[2 * moves] * (longest - len(s))) for s in sets])


class Hashes:
    """All tables' functions; a bucket's key is a random linear form of its coordinates."""

    def __init__(self, dim: int, width: float, tables: int, moves: int, probes: int, seed: int):
        rng = np.random.default_rng(seed)
        self.a, self.b = rng.standard_normal((tables, moves, dim)), rng.uniform(0, 1, (tables, moves))
        self.form = rng.integers(1, 1 << 62, (tables, moves), dtype=np.int64)
        self.width, self.order = width, probe_order(moves, probes)

    def place(self, v: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
        x = v @ self.a[t].T / self.width + self.b[t]
        cell = np.floor(x)
        with np.errstate(over="ignore"):
            return (cell.astype(np.int64) * self.form[t]).sum(1), x - cell

    def probes(self, v: np.ndarray, t: int) -> np.ndarray:
        """Per query, the keys of the buckets it visits."""
        key, rest = self.place(v, t)
        move = np.argsort(np.concatenate((rest, 1 - rest), axis=1), axis=1, kind="stable")  # down costs rest, up 1 - rest
        step = np.concatenate((-self.form[t], self.form[t]))[move]
        step = np.concatenate((step, np.zeros((len(v), 1), np.int64)), axis=1)
        with np.errstate(over="ignore"):
            return key[:, None] + sum(step[:, self.order[:, c]] for c in range(self.order.shape[1]))


def finite_vector(v: Column, dim: int) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(v) == dim) & finite, F.lit(False))


def valid_vector(v: Column, dim: int) -> Column:
    return finite_vector(v, dim) & F.exists(v, lambda x: x != 0)


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _nearest(ids: np.ndarray, vectors: np.ndarray, query_id: int, query: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    at = at[ids[at] != query_id]
    distance = np.sqrt(((vectors[at] - query) ** 2).sum(1))
    if len(at) > k:
        near = distance <= np.partition(distance, k - 1)[k - 1]
        at, distance = at[near], distance[near]
    first = np.lexsort((ids[at], distance))[:k]
    return ids[at[first]], distance[first]


def _met(own: np.ndarray, probes: list[np.ndarray]) -> np.ndarray:
    """[query, row]: whether the query visits a bucket of the row. ``own`` are the rows' buckets by table."""
    met = np.zeros((len(probes[0]), len(own)), bool)
    for t, keys in enumerate(probes):
        owner = np.repeat(np.arange(len(keys)), keys.shape[1])
        order = np.argsort(keys, axis=None)
        keys, owner = keys.ravel()[order], owner[order]
        order = np.argsort(own[:, t], kind="stable")
        bucket, first = np.unique(own[order, t], return_index=True)
        low, high, ends = np.searchsorted(keys, bucket), np.searchsorted(keys, bucket, "right"), np.append(first[1:], len(own))
        for b in np.flatnonzero(high > low):
            met[np.ix_(owner[low[b] : high[b]], order[first[b] : ends[b]])] = True
    return met


def neighbour_distance(rows: DataFrame, dim: int, k: int, sample: int = SAMPLE) -> float:
    """The median distance, above zero, from some rows to their k-th neighbours; of staged or given (id, v) rows."""
    lot = rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("id", "v").toArrow()
    ids, vectors = lot["id"].to_numpy(), _vectors(lot["v"].combine_chunks(), dim)
    shared = rows.sparkSession.sparkContext.broadcast((ids, vectors))

    def run(batches):
        ids, vectors = shared.value
        best = np.full((len(ids), k), np.inf)
        for batch in batches:
            own, v = batch.column(0).to_numpy(), _vectors(batch.column(1), dim)
            for i in range(0, len(own), 1024):
                distance = np.sqrt(((vectors[:, None] - v[None, i : i + 1024]) ** 2).sum(2))
                distance[ids[:, None] == own[None, i : i + 1024]] = np.inf
                best = np.sort(np.concatenate((best, distance), axis=1), axis=1)[:, :k]
        at, _ = np.nonzero(np.isfinite(best))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(best[np.isfinite(best)])], ["of", "distance"])

    near = rows.select("id", "v").mapInArrow(tidy(run), "of int, distance double").groupBy("of").agg(F.slice(F.sort_array(F.collect_list("distance")), F.lit(k), F.lit(1)).alias("d"))
    found = sorted(r["d"][0] for r in near.collect() if r["d"] and r["d"][0] > 0)  # no more than the sample
    return found[len(found) // 2] if found else 0.0


def _search(index: DataFrame, visits: DataFrame, queries: DataFrame, n: int, dim: int, k: int, hashes: Hashes | None) -> DataFrame:
    """For each of the staged visits (query_id, block) the query's k best rows of the block, of the buckets that it
    visits; without hashes, of all."""
    shared = index.sparkSession.sparkContext.broadcast(hashes)
    slices = -(-n // QUERY_SLICE)
    slice_ = F.pmod(F.xxhash64("query_id"), F.lit(slices)).alias("slice")
    pairs = stage(visits.select("block", slice_).distinct(), "near-slices")
    left = keyed_join(index, pairs, "block", "inner").groupBy("block", "slice")
    right = visits.join(queries, "query_id").select("block", slice_, "query_id", "v").groupBy("block", "slice")
    names = ["query_id", "vec_id", "score"]

    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        hashes, out = shared.value, []
        ids, vectors = rows["id"].to_numpy(), _vectors(rows["v"].combine_chunks(), dim)
        own = rows["keys"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1) if hashes else None
        query_ids, query = asked["query_id"].to_numpy(), _vectors(asked["v"].combine_chunks(), dim)
        for i in range(0, len(query) if len(ids) else 0, QUERY_STEP):
            some = query[i : i + QUERY_STEP]
            met = _met(own, [hashes.probes(some, t) for t in range(len(hashes.a))]) if hashes else np.ones((len(some), len(ids)), bool)
            for q in range(len(some)):
                found, distance = _nearest(ids, vectors, query_ids[i + q], some[q], np.flatnonzero(met[q]), k)
                out.append((np.full(len(found), query_ids[i + q]), found, distance))
        columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.Table.from_arrays([pa.array(c) for c in columns], names)

    return left.cogroup(right).applyInArrow(run, "query_id long, vec_id long, score double")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", tables: int = TABLES, moves: int = MOVES, probes: int = PROBES, width: float = WIDTH, seed: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each row that ``is_query`` picks."""
    empty = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query")).where("id is not null and v is not null")
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if not length or not length["n"]:
        return empty
    dim = length["n"]
    rows = rows.where(valid_vector(F.col("v"), dim))
    about = rows.agg(F.avg(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)), F.count(F.lit(1))).first()
    if not about[0]:
        return empty
    # equal vectors, or fewer than k, have no such distance: then their length stands for it
    far = neighbour_distance(rows, dim, k) or float(np.sqrt(about[0]))
    hashes = Hashes(dim, width * float(f"{far:.3g}"), tables, moves, probes, seed)
    shared = vectors.sparkSession.sparkContext.broadcast(hashes)

    def keys(batches):
        for batch in batches:
            own = _vectors(batch.column(1), dim)
            made = np.stack([shared.value.place(own, t)[0] for t in range(tables)], axis=1).ravel() if len(own) else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1, dtype=np.int32) * tables), pa.array(made))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], ["id", "v", "keys"])

    def visited(batches):
        for batch in batches:
            query = _vectors(batch.column(1), dim)
            for t in range(tables if len(query) else 0):
                own = shared.value.probes(query, t)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0).to_numpy(), own.shape[1])), pa.array(np.full(own.size, t, np.int32)), pa.array(own.ravel())], ["query_id", "t", "bucket"])

    hashed = rows.select("id", "v").mapInArrow(keys, "id long, v array<double>, keys array<long>")
    blocks = max(1, -(-about[1] // BLOCK_ROWS))
    placed = hashed.repartitionByRange(blocks, F.col("keys")[0], "id") if blocks > 1 else hashed.coalesce(1)
    index = stage(placed.withColumn("block", F.spark_partition_id()), "near-vectors")
    queries = stage(rows.where("is_query").groupBy(F.col("id").alias("query_id")).agg(F.min("v").alias("v")), "near-queries")
    n = queries.count()
    if not n:
        return empty
    # a bucket has the list of its blocks, so that the join makes no more rows than there are probes
    buckets = index.select("block", F.posexplode("keys").alias("t", "bucket")).groupBy("t", "bucket").agg(F.sort_array(F.collect_set("block")).alias("blocks"))
    visits = queries.mapInArrow(visited, "query_id long, t int, bucket long").join(buckets, ["t", "bucket"])
    visits = visits.groupBy("query_id").agg(F.array_distinct(F.flatten(F.collect_set("blocks"))).alias("blocks")).select("query_id", F.explode("blocks").alias("block"))
    visits = stage(visits, "near-visits")
    found = stage(_ranked(_search(index, visits, queries, n, dim, k, hashes), k), "near-found")
    unstage(visits)
    few = stage(queries.join(found.groupBy("query_id").count(), "query_id", "left").where(F.coalesce("count", F.lit(0)) < k).select("query_id"), "near-few")
    n = few.count()
    if n:
        held = index.select("block").distinct()
        everywhere = stage(few.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(int(held.agg(F.max("block")).first()[0]))))), "near-visits")
        again = _ranked(_search(index, everywhere, queries, n, dim, k, None), k)
        found = found.join(few, "query_id", "left_anti").select(*found.columns).unionByName(again)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
