"""Ordered feeds: where to stop, and what is new before that."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.params import DEFAULT


#: Positions of a feed's page that one task sorts together.
BLOCK_POSITIONS = 1024


def _chunk(position: str) -> Column:
    return F.floor(F.col(position) / BLOCK_POSITIONS)


def run_cutoff(df: DataFrame, partition: list[str], order: list[str], flag: Column, *, n: int, reset: Column | None = None, blocks: list[Column]) -> DataFrame:
    """The rows with ``run`` (length of the run of flagged rows that ends here; rows neither flagged nor resetting leave
    it as it is) and ``cutoff_order`` (the position, from 1, of the row that makes a run of ``n``; null if none does).

    ``blocks`` cut a partition into stretches of the order (they must not fall along it), so that no task sorts a whole
    partition: runs are counted in each block, and one small row per block carries them and the positions on."""
    reset = ~flag if reset is None else reset
    names = [f"_block{k}" for k in range(len(blocks))]
    out = df.withColumns(dict(zip(names, blocks, strict=True)) | {"_flag": F.coalesce(flag, F.lit(False)).cast("int"), "_reset": F.coalesce(reset, F.lit(False)).cast("int")})
    block = [*partition, *names]
    w = Window.partitionBy(*block).orderBy(*order)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = out.withColumns({"_at": F.row_number().over(w), "_island": F.sum("_reset").over(so_far)})
    inner = Window.partitionBy(*block, "_island").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = out.withColumn("_run", F.sum("_flag").over(inner))
    last = lambda c: F.max_by(c, "_at").alias(c)
    ends = out.groupBy(*block).agg(F.count(F.lit(1)).alias("_rows"), last("_island"), last("_run"))
    # the run that a block hands on is its own last one, and what it was handed if nothing in it resets
    along = Window.partitionBy(*partition).orderBy(*names).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = ends.withColumn("_since", F.count_if(F.col("_island") > 0).over(along))
    stretch = Window.partitionBy(*partition, "_since").orderBy(*names).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*partition).orderBy(*names)
    ends = ends.withColumns({"_on": F.sum("_run").over(stretch), "_first": F.sum("_rows").over(along) - F.col("_rows")})
    ends = ends.withColumn("_on", F.coalesce(F.lag("_on").over(before), F.lit(0)))
    ends = ends.select(*[F.col(c).alias(f"_k{k}") for k, c in enumerate(block)], "_on", "_first")
    same = [F.col(c).eqNullSafe(F.col(f"_k{k}")) for k, c in enumerate(block)]
    out = out.join(ends, same).withColumns({"run": F.col("_run") + F.when(F.col("_island") == 0, F.col("_on")).otherwise(0), "position_in_feed": F.col("_first") + F.col("_at")})
    stops = out.where(F.col("run") >= n).groupBy(*partition).agg(F.min("position_in_feed").alias("cutoff_order"))
    stops = stops.select(*[F.col(c).alias(f"_p{k}") for k, c in enumerate(partition)], "cutoff_order")
    at = [F.col(c).eqNullSafe(F.col(f"_p{k}")) for k, c in enumerate(partition)]
    return out.join(stops, at, "left").select(*df.columns, "run", "position_in_feed", "cutoff_order")


def new_in_feed(feed: DataFrame, known: DataFrame, *, n: int = DEFAULT.stop_after_known, page_cap: int = DEFAULT.pages_per_feed) -> DataFrame:
    """feed: (source, feed, page, position, external_id); the unknown items that come before the n-th known in a row."""
    capped = feed.where(F.col("page") <= page_cap)
    marked = capped.join(known.select("source", "external_id").distinct().withColumn("_known", F.lit(True)), ["source", "external_id"], "left").withColumn("is_known", F.coalesce("_known", F.lit(False))).drop("_known")
    cut = run_cutoff(marked, ["source", "feed"], ["page", "position"], F.col("is_known"), n=n, blocks=[F.col("page"), _chunk("position")])
    return cut.where(~F.col("is_known") & (F.col("cutoff_order").isNull() | (F.col("position_in_feed") < F.col("cutoff_order")))).select("source", "feed", "page", "position", "external_id")


def before_failures(fetches: DataFrame, *, n: int = DEFAULT.stop_after_failures, order: list[str] | None = None) -> DataFrame:
    """fetches: (source, ..., is_item, failed); a source's fetches up to its n-th failure in a row across its feeds.
    Only an item that was fetched ends a run of failures. ``order`` names columns, ``position`` among them."""
    ok = F.col("is_item") & ~F.col("failed")
    order = order or ["feed", "page", "position"]
    blocks = [_chunk(c) if c == "position" else F.col(c) for c in order[: order.index("position") + 1]]
    cut = run_cutoff(fetches, ["source"], order, F.col("failed"), n=n, reset=ok, blocks=blocks)
    return cut.where(F.col("cutoff_order").isNull() | (F.col("position_in_feed") <= F.col("cutoff_order")))
