"""Applying check results as they arrive, batch by batch, with the batch operators unchanged."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hearthline.operators.verify import apply_checks
from hearthline.sources.logstate import LogState
from hearthline.sources.tables import append_history, exists


def apply_batch(store: LogState, schema, history: DataFrame, results: DataFrame, *, now, batch: str | None = None, record=None) -> int:
    """Applies check results, one row per listing, to a log-structured state: reads and writes the checked listings' rows
    alone. ``record`` gets the events before the state is published. Returns how many rows were written."""
    good = results.where("error is null")
    ids = results.select(F.col("listing_id").alias("id"))
    own = history.join(F.broadcast(ids.select(F.col("id").alias("listing_id"))), "listing_id", "left_semi")
    out = apply_checks(store.read_keys(ids, schema), own, results, now=now)
    if record:
        record(out.events)
    return store.publish(out.state.join(F.broadcast(good.select(F.col("listing_id").alias("id"))), "id", "left_semi").select(*out.state.columns), batch)


def checks_writer(store: LogState, schema, history_path: str, now: Callable[[], str], stream: str = "checks"):
    """A foreachBatch function. A batch's events are a part of the history of its own, which replaces itself, and the
    state's manifest names the batch, as the last thing written: a batch that fails anywhere before is done anew from the
    old state and the other batches' history, and one that is given again after that changes nothing. Batches are told
    apart by the stream's id, which its checkpoint keeps, and their number. Of several results for a listing in one batch
    the last by ``checked_at`` stands, if that column is there."""

    def apply_checks_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId') or stream}-{batch_id}"
        if store.holds(name):
            return
        order = "checked_at" if "checked_at" in batch.columns else "listing_id"
        rest = [c for c in batch.columns if c != "listing_id"]
        last = batch.groupBy("listing_id").agg(F.max_by(F.struct(*rest), order).alias("r")).select("listing_id", "r.*")
        if exists(spark, history_path):
            history = spark.read.parquet(history_path).where(F.col("batch") != name)
        else:
            history = spark.createDataFrame([], "listing_id long, event_type string, old_value long, new_value long")
        apply_batch(store, schema, history, last, now=now(), batch=name, record=lambda events: append_history(events, history_path, name))

    return apply_checks_batch


def stream_checks(results: DataFrame, writer, checkpoint: str) -> StreamingQuery:
    return results.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint).start()
