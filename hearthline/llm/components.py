"""Connected components of a link table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.staging import stage, unstage
from hearthline.llm.textbytes import tidy

#: Links that a task merges at a time.
CHUNK = 200_000


@tidy
def _stars(batches):
    """Merges the links at hand, chunk by chunk: each node and the smallest node that it reaches there."""

    def flush(a: list, b: list) -> pa.RecordBatch:
        up: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while up[top] != top:
                top = up[top]
            while up[x] != top:
                up[x], x = top, up[x]
            return top

        for x, y in zip(np.concatenate(a).tolist(), np.concatenate(b).tolist(), strict=True):
            up.setdefault(x, x)
            up.setdefault(y, y)
            x, y = root(x), root(y)
            up[max(x, y)] = min(x, y)
        pairs = [(x, r) for x in up if (r := root(x)) != x]
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in pairs], pa.int64()), pa.array([r for _, r in pairs], pa.int64())], ["node", "root"])

    a, b, held = [], [], 0
    for batch in batches:
        a.append(batch.column(0).to_numpy())
        b.append(batch.column(1).to_numpy())
        held += batch.num_rows
        if held >= CHUNK:
            yield flush(a, b)
            a, b, held = [], [], 0
    if held:
        yield flush(a, b)


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for each node that reaches a smaller one; component is the smallest that it reaches.

    A round merges links within chunks into stars around their smallest nodes, hangs each node below the smallest
    center it got, flattens these trees by doubling, and goes on with the links between what is left. Rounds end when
    no link is left; every table in between is written, and nothing but emptiness is asked from the driver. The result
    is a staged table.
    """
    e = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a <> b")
    edges, nodes = stage(e.mapInArrow(_stars, "node long, root long").distinct(), "cc-edges"), None
    while edges.limit(1).count():
        tree = stage(edges.groupBy("node").agg(F.min("root").alias("to")), "cc-tree")
        while True:
            above = tree.select(F.col("node").alias("top"), F.col("to").alias("over"))
            flat = stage(tree.join(above, F.col("to") == F.col("top"), "left").select("node", F.coalesce("over", "to").alias("to"), F.col("over").isNotNull().alias("moved")), "cc-tree")
            unstage(tree)
            tree, more = flat, flat.where("moved").limit(1).count()
            if not more:
                break
        tree_of = tree.select("node", "to")
        left = edges.join(tree_of, "node").select("root", F.col("to").alias("a")).join(tree_of.toDF("root", "rt"), "root", "left").select("a", F.coalesce("rt", "root").alias("b")).where("a <> b")
        following = stage(left.mapInArrow(_stars, "node long, root long").distinct(), "cc-edges")
        if nodes is None:
            nodes = tree
        else:
            moved = nodes.select("node", F.col("to").alias("at")).join(tree_of.toDF("at", "top"), "at", "left").select("node", F.coalesce("top", "at").alias("to"))
            merged = stage(moved.unionByName(tree_of), "cc-nodes")
            unstage(nodes, tree)
            nodes = merged
        unstage(edges)
        edges = following
    unstage(edges)
    if nodes is None:
        return links.sparkSession.createDataFrame([], "node long, component long")
    out = nodes.select("node", F.col("to").alias("component"))
    out._hearthline_path = nodes._hearthline_path  # for unstage
    return out
