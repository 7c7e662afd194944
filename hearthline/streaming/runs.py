"""Missed runs and last results of listings, kept up to date as what runs and checks saw arrives."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from hearthline.sources.logstate import LogState

#: What a run or a check tells of a listing; the first two set its missed runs to zero.
KINDS = ("seen", "active", "missed", "removed")
PRESENT = KINDS[:2]
OUT = "listing_id long, missed_run_count long, last_result string, last_at timestamp"
#: The count and last result up to the watermark, and what came since, which may still be out of order.
HELD = "missed long, kind string, at long, recent string"
DELAY = "1 day"


def fold(missed: int, kind: str | None, at: int | None, seen: list[tuple[int, str]]) -> tuple[int, str | None, int | None]:
    """Count and last result after the sightings (microseconds, kind), which are in order."""
    for at, kind in seen:  # noqa: B007  the last of each stays
        missed = 0 if kind in PRESENT else missed + (kind == "missed")
    return missed, kind, at


def _update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    missed, kind, at, recent = state.get if state.exists else (0, None, None, "")
    seen = {(int(t), k) for t, _, k in (x.partition(":") for x in recent.split(";") if x)} if recent else set()
    for frame in frames:
        seen |= set(zip(frame["micros"].tolist(), frame["kind"].tolist(), strict=True))
    ordered, mark = sorted(seen), state.getCurrentWatermarkMs() * 1000
    settled = [x for x in ordered if x[0] < mark]
    at = None if at is None or at < 0 else at
    missed, kind, at = fold(missed, kind, at, settled)
    rest = ordered[len(settled) :]
    state.update((missed, kind, -1 if at is None else at, ";".join(f"{t}:{k}" for t, k in rest)))
    count, last, when = fold(missed, kind, at, rest)
    yield pd.DataFrame({"listing_id": [key[0]], "missed_run_count": [count], "last_result": [last], "last_at": [pd.Timestamp(when, unit="us")]})


def missed_runs(sightings: DataFrame, delay: str = DELAY) -> DataFrame:
    """A stream of OUT rows from one of (listing_id, at, kind): a listing's row anew whenever something of it arrives.
    Sightings may be out of order by ``delay``; later ones, and repeated ones, change nothing."""
    rows = sightings.where(F.col("kind").isin(*KINDS) & F.col("listing_id").isNotNull() & F.col("at").isNotNull())
    rows = rows.withWatermark("at", delay).withColumn("micros", F.unix_micros("at"))
    return rows.groupBy("listing_id").applyInPandasWithState(_update, OUT, HELD, "update", GroupStateTimeout.EventTimeTimeout)


def keep_missed_runs(sightings: DataFrame, store: LogState, checkpoint: str, delay: str = DELAY) -> StreamingQuery:
    """Runs the stream over what there is, and adds each batch's rows to the store once, under the stream's id and the
    batch's number, so that neither a restart nor another stream's batches are lost or repeated."""

    def publish(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}-{batch_id}"
        if not store.holds(name):
            # a listing has one row a batch
            store.publish(batch, name)

    out = missed_runs(sightings, delay).writeStream.outputMode("update").foreachBatch(publish)
    return out.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
