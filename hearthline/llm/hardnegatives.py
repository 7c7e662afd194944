"""Hard negatives by zone maps over candidates in Hilbert order.

1. Vectors become whole numbers, floor(scale * x), so scores (inner products) are exact. All rows are ordered along the
   Hilbert curve through their cells and written as Parquet in parts, each of consecutive blocks of BLOCK_ROWS rows.
2. A block's zone map holds the least and greatest value of each dimension, and its labels. Interval arithmetic gives from
   it, for an anchor, the lowest and highest score that a row of the block can have.
3. A request is an anchor's search for its best rows of its own label (positives) or of others (negatives) in a window of
   scores. It first meets the rows of the anchor's own block; the worst of k rows found there raises the window's lower
   end. Then it reads every block that may hold a row in its window, by label and bounds, and no other.
4. Positives come first; each opens the window of its negatives, from ``margin`` percent of its score to its score.

Nothing is approximate: near-random vectors, whose zone maps overlap, are read nearly whole, clustered ones are not.

Edge cases: rows without id or label, and vectors that are null, of another length than most, or hold null or non-finite
components take no part; zero vectors do. Rows with the anchor's id are not among its rows; of anchor rows that repeat an
id, one stands. Equal scores go by id; fewer rows than k give all of them; a positive with a negative score has no window;
an empty table gives an empty result; other columns are not read. Components so large that a score could leave 63 bits
stop the job with an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.llm.neighbours import finite_vector
from hearthline.llm.staging import keyed_join, stage, unstage
from hearthline.llm.textbytes import tidy

BLOCK_ROWS, PART_ROWS = 4096, 131_072
#: Bits of a cell in each dimension, and how many standard deviations about the mean the cells reach.
BITS, SPREAD = 4, 3.0
#: Requests, and zone maps, that one task compares; anchors that meet a block in one task, and those worked on at a time.
REQUEST_SLICE, ZONE_SLICE, ANCHOR_SLICE, STEP = 4096, 16_384, 20_000, 256
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> list[bytes]:
    """Places along the Hilbert curve (Skilling 2004), as bytes in their order. cells: [row, dimension], below 2 ** bits."""
    x = cells.astype(np.int64).T.copy()
    for k in range(bits - 1, 0, -1):
        low = (1 << k) - 1
        for d in range(len(x)):
            high = (x[d] >> k) & 1
            swap = np.where(high == 1, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(high == 1, low, swap)
            x[d] ^= swap
    for d in range(1, len(x)):
        x[d] ^= x[d - 1]
    flip = np.zeros_like(x[0])
    for k in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> k) & 1 == 1, (1 << k) - 1, 0)
    x ^= flip
    planes = np.stack([(x >> k) & 1 for k in range(bits - 1, -1, -1)])  # [bit, dimension, row]
    packed = np.packbits(planes.reshape(-1, x.shape[1]).T.astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: in floating point where these hold them, which is faster."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64) if top < 1 << 53 else a @ b.T


def bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[anchor, block]: the lowest and highest inner product with any vector between ``low`` and ``high``."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return _products(up, low) + _products(down, high), _products(up, high) + _products(down, low)


def rows_in_order(vectors: DataFrame, label: Column, is_anchor: Column, id_col: str, vector_col: str, scale: int, block_rows: int = BLOCK_ROWS, part_rows: int = PART_ROWS) -> tuple[DataFrame, int] | None:
    """The staged rows (id, label, q, is_anchor, block, part) along the curve, and their dimensions; None without rows."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    rows = rows.where("id is not null and label is not null and v is not null")
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if not length or not length["n"]:
        return None
    dim = length["n"]
    rows = rows.where(finite_vector(F.col("v"), dim)).withColumn("q", F.transform("v", lambda x: F.floor(scale * x))).drop("v")
    total = lambda f: F.sum(F.aggregate("q", F.lit(0.0), lambda s, x: s + f(x.cast("double"))))
    about = rows.agg(F.count(F.lit(1)), total(lambda x: x), total(lambda x: x * x), F.max(F.array_max(F.transform("q", F.abs)))).first()
    n = about[0]
    if not n:
        return None
    if about[3] * about[3] * dim > MOST:
        raise ValueError("components are too large for exact scores in 63 bits")
    mean = about[1] / (n * dim)
    spread = SPREAD * max(0.0, about[2] / (n * dim) - mean * mean) ** 0.5 or 1.0

    def keyed(batches):
        for batch in batches:
            cells = (_matrix(batch.column(2), dim) - (mean - spread)) / (2 * spread) * (1 << BITS)
            keys = hilbert_keys(np.clip(np.floor(cells), 0, (1 << BITS) - 1)) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], ["id", "label", "q", "is_anchor", "key"])

    def numbered(batches):
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            block = (part << 20) + (at + np.arange(batch.num_rows)) // block_rows
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(block), pa.array(np.full(batch.num_rows, part, np.int32))], ["id", "label", "q", "is_anchor", "block", "part"])

    columns = "id long, label string, q array<long>, is_anchor boolean"
    keys = rows.select("id", "label", "q", "is_anchor").mapInArrow(tidy(keyed), f"{columns}, key binary")
    placed = keys.repartitionByRange(-(-n // part_rows), "key", "id").sortWithinPartitions("key", "id").drop("key")
    return stage(placed.mapInArrow(tidy(numbered), f"{columns}, block long, part int"), "negatives-rows", by="part"), dim


def zone_maps(index: DataFrame, dim: int) -> DataFrame:
    """Staged (block, part, low, high, labels), one row per block."""

    def run(batches):
        for batch in batches:
            block, part, label, q = batch.column(0).to_numpy(), batch.column(1).to_numpy(), np.array(batch.column(2).to_pylist(), object), _matrix(batch.column(3), dim)
            first = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1]))) if len(block) else np.zeros(0, np.int64)
            ends = np.append(first[1:], len(block))
            low, high = (f.reduceat(q, first, axis=0) if len(first) else q for f in (np.minimum, np.maximum))
            labels = [sorted(set(label[i:j])) for i, j in zip(first, ends, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(block[first]), pa.array(part[first]), pa.array(list(low), pa.list_(pa.int64())), pa.array(list(high), pa.list_(pa.int64())), pa.array(labels, pa.list_(pa.string()))], ["block", "part", "low", "high", "labels"])

    each = index.select("block", "part", "label", "q").mapInArrow(tidy(run), "block long, part int, low array<long>, high array<long>, labels array<string>")
    # a block comes in few batches
    merged = lambda c, f: F.reduce(F.collect_list(c), F.first(c), lambda s, x: F.zip_with(s, x, f))
    zones = each.groupBy("block", "part").agg(merged("low", lambda a, b: F.least(a, b)).alias("low"), merged("high", lambda a, b: F.greatest(a, b)).alias("high"), F.array_distinct(F.flatten(F.collect_list("labels"))).alias("labels"))
    return stage(zones, "negatives-zones")


def blocks_to_read(requests: DataFrame, zones: DataFrame, dim: int) -> DataFrame:
    """(anchor, tag, block, part): the blocks that may hold a row of the request's kind in its window."""
    slices, n = -(-zones.count() // ZONE_SLICE), -(-requests.count() // REQUEST_SLICE)
    if not slices or not n:
        return requests.sparkSession.createDataFrame([], "anchor long, tag long, block long, part int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    left = requests.select("anchor", "tag", "label", "q", "same", "low", "high", F.pmod(F.xxhash64("anchor"), F.lit(n)).cast("int").alias("r"), every(slices).alias("z")).groupBy("r", "z")
    right = zones.withColumn("z", F.pmod(F.xxhash64("block"), F.lit(slices)).cast("int")).select("block", "part", F.col("low").alias("least"), F.col("high").alias("most"), "labels", "z", every(n).alias("r")).groupBy("r", "z")
    names = ["anchor", "tag", "block", "part"]

    def run(asked: pa.Table, zone: pa.Table) -> pa.Table:
        least, most, labels = _matrix(zone["least"], dim), _matrix(zone["most"], dim), zone["labels"].to_pylist()
        block, part = zone["block"].to_numpy(), zone["part"].to_numpy()
        with_label = {x: np.array([x in own for own in labels], bool) for x in {y for own in labels for y in own}}
        others = {x: np.array([any(y != x for y in own) for own in labels], bool) for x in set(asked["label"].to_pylist())}
        none, out = np.zeros(len(block), bool), []
        for i in range(0, asked.num_rows if len(block) else 0, STEP):
            some = asked.slice(i, STEP)
            low, high = bounds(_matrix(some["q"], dim), least, most)
            fits = (high >= some["low"].to_numpy()[:, None]) & (low <= some["high"].to_numpy()[:, None])
            kinds = zip(some["label"].to_pylist(), some["same"].to_pylist(), strict=True)
            r, z = np.nonzero(fits & np.stack([with_label.get(x, none) if same else others[x] for x, same in kinds]))
            out.append((some["anchor"].to_numpy()[r], some["tag"].to_numpy()[r], block[z], part[z]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.int32)]
        return pa.Table.from_arrays([pa.array(c) for c in columns], names)

    return left.cogroup(right).applyInArrow(run, "anchor long, tag long, block long, part int")


def _search(index: DataFrame, visits: DataFrame, requests: DataFrame, dim: int, k: int) -> DataFrame:
    """Of each request and block that it visits, the k best rows. Anchors of one part of the curve share their slices."""
    keys = ["part", "block", "slice"]
    asked = visits.join(requests, ["anchor", "tag"]).select(*keys, "anchor", "tag", "label", "q", "same", "low", "high")
    pairs = stage(asked.select(*keys).distinct(), "negatives-pairs")
    # the comparison tells Spark that the parts named here are worth to prune by
    left = keyed_join(index, pairs.where("slice >= 0"), ["part", "block"], "inner").select(*keys, "id", F.col("label").alias("own"), "q").groupBy(*keys)
    names = ["anchor", "tag", "id", "score"]

    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        ids, own, vectors, out = rows["id"].to_numpy(), np.array(rows["own"].to_pylist(), object), _matrix(rows["q"], dim), []
        for i in range(0, asked.num_rows if len(ids) else 0, STEP):
            some = asked.slice(i, STEP)
            anchor = some["anchor"].to_numpy()
            # several requests of an anchor share its scores
            _, first, place = np.unique(anchor, return_index=True, return_inverse=True)
            scores = _products(_matrix(some["q"], dim)[first], vectors)
            kinds = zip(anchor, some["tag"].to_numpy(), some["label"].to_pylist(), some["same"].to_pylist(), some["low"].to_numpy(), some["high"].to_numpy(), place, strict=True)
            for a, tag, label, same, low, high, p in kinds:
                score = scores[p]
                at = np.flatnonzero(((own == label) == same) & (score >= low) & (score <= high) & (ids != a))
                if len(at) > k:
                    at = at[score[at] >= np.partition(score[at], len(at) - k)[len(at) - k]]
                at = at[np.lexsort((ids[at], -score[at]))[:k]]
                out.append((np.full(len(at), a), np.full(len(at), tag), ids[at], score[at]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 4
        return pa.Table.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names)

    return left.cogroup(asked.groupBy(*keys)).applyInArrow(run, "anchor long, tag long, id long, score long")


def best_rows(index: DataFrame, zones: DataFrame, requests: DataFrame, dim: int, k: int) -> DataFrame:
    """Staged (anchor, tag, id, score, rank): the k best rows of each request (anchor, tag, label, q, same, low, high, slice,
    home, part)."""
    order = Window.partitionBy("anchor", "tag").orderBy(F.desc("score"), "id")
    ranked = lambda found: found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    home = requests.select("anchor", "tag", F.col("home").alias("block"), "part", "slice")
    asked = requests.drop("home", "part", "slice")
    near = _search(index, home, asked, dim, k)
    worst = ranked(near).where(F.col("rank") == k).select("anchor", "tag", F.col("score").alias("worst"))
    tight = stage(requests.join(worst, ["anchor", "tag"], "left").withColumn("low", F.greatest("low", F.coalesce("worst", "low"))).drop("worst"), "negatives-requests")
    visits = blocks_to_read(tight, zones, dim).join(tight.select("anchor", "tag", "slice"), ["anchor", "tag"])
    visits = stage(visits, "negatives-visits")
    out = stage(ranked(_search(index, visits, tight.drop("home", "part", "slice"), dim, k)), "negatives-found")
    unstage(tight, visits)
    return out


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 5, margin: int = 80, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = BLOCK_ROWS, part_rows: int = PART_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor and each of its first
    positives, the first rows of other labels that score from ``margin`` percent of the positive's score up to it."""
    empty = vectors.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    made = rows_in_order(vectors, label, is_anchor, id_col, vector_col, scale, block_rows, part_rows)
    if made is None:
        return empty
    index, dim = made
    zones = zone_maps(index, dim)
    one = F.min(F.struct("block", "part", "label", "q")).alias("r")
    anchors = stage(index.where("is_anchor").groupBy(F.col("id").alias("anchor")).agg(one).select("anchor", F.col("r.label").alias("label"), F.col("r.q").alias("q"), F.col("r.block").alias("home"), F.col("r.part").alias("part")), "negatives-anchors")
    most = anchors.groupBy("part").count().agg(F.max("count")).first()[0]
    if not most:
        return empty
    split = -(-most // ANCHOR_SLICE)
    anchors = anchors.withColumn("slice", F.col("part").cast("long") * split + F.pmod(F.xxhash64("anchor"), F.lit(split)))
    window = lambda low, high: [F.lit(low).cast("long").alias("low"), F.lit(high).cast("long").alias("high")]
    found = best_rows(index, zones, anchors.select("*", F.col("anchor").alias("tag"), F.lit(True).alias("same"), *window(LEAST, MOST)), dim, positives)
    opened = found.select("anchor", F.col("id").alias("tag"), F.col("score").alias("high"), F.ceil(F.col("score") * margin / F.lit(100).cast("decimal(3,0)")).cast("long").alias("low")).where("low <= high")
    asked = stage(anchors.join(opened, "anchor").withColumn("same", F.lit(False)), "negatives-windows")
    out = best_rows(index, zones, asked, dim, negatives).join(asked.select("anchor", "tag", F.col("high").alias("positive_score")), ["anchor", "tag"])
    return out.select(F.col("anchor").alias("anchor_id"), F.col("tag").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
