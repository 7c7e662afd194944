"""The current state as a log of segments: a batch adds the rows that it changed, reading lets the latest row of a key win,
and segments are merged when the newer ones have grown to a part of the older.

A manifest names, per version, the segments that make up the state, oldest first, and the batch that was applied. It is
written last, so a failed write leaves no trace but files that nobody names. One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.sources.tables import delete, exists

#: A segment is merged with the next older one once it holds this share of its rows.
RATIO = 0.25
#: Rows of newer segments up to which their keys are broadcast to the oldest.
BROADCAST_ROWS = 500_000
MANIFEST = "version long, batch string, segments array<struct<name: string, rows: long>>"


class LogState:
    def __init__(self, spark: SparkSession, root: str, key: str = "id", ratio: float = RATIO):
        self.spark, self.root, self.key, self.ratio = spark, root.rstrip("/"), key, ratio

    def _manifest(self) -> DataFrame:
        path = f"{self.root}/manifest"
        return self.spark.read.schema(MANIFEST).json(path) if exists(self.spark, path) else self.spark.createDataFrame([], MANIFEST)

    def holds(self, batch: str) -> bool:
        """Whether a version that names this batch was published."""
        return self._manifest().where(F.col("batch") == batch).limit(1).count() > 0

    def segments(self) -> list[tuple[str, int]]:
        """(name, rows), oldest first."""
        return self._latest()[1]

    def _latest(self) -> tuple[int, list[tuple[str, int]]]:
        last = self._manifest().orderBy("version", ascending=False).first()
        return (last["version"], [(s["name"], s["rows"]) for s in last["segments"]]) if last else (-1, [])

    def _name(self, version: int, batch: str | None, segments: list[tuple[str, int]]) -> None:
        self.spark.createDataFrame([(version, batch, segments)], MANIFEST).coalesce(1).write.mode("append").json(f"{self.root}/manifest")

    def _rows(self, name: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    def _last_of(self, segments: list[DataFrame]) -> DataFrame:
        """Of each key the row of the last segment that has it."""
        if len(segments) == 1:
            return segments[0]
        rest = [c for c in segments[0].columns if c != self.key]
        every = None
        for k, s in enumerate(segments):
            s = s.select(self.key, F.struct(F.lit(k).alias("at"), F.struct(*rest).alias("row")).alias("r"))
            every = s if every is None else every.unionByName(s)
        return every.groupBy(self.key).agg(F.max_by("r.row", "r.at").alias("row")).select(self.key, "row.*").select(*segments[0].columns)

    def _merged(self, segments: list[tuple[str, int]], schema: T.StructType) -> DataFrame:
        """The oldest segment less the keys of newer ones, which are few, and the last rows of these."""
        if not segments:
            return self.spark.createDataFrame([], schema)
        oldest, newer = self._rows(segments[0][0], schema), [self._rows(name, schema) for name, _ in segments[1:]]
        if not newer:
            return oldest
        last = self._last_of(newer)
        keys = last.select(self.key)
        small = sum(n for _, n in segments[1:]) <= BROADCAST_ROWS
        return oldest.join(F.broadcast(keys) if small else keys, self.key, "left_anti").select(*oldest.columns).unionByName(last)

    def read(self, schema: T.StructType) -> DataFrame:
        return self._merged(self.segments(), schema)

    def read_keys(self, keys: DataFrame, schema: T.StructType) -> DataFrame:
        """The rows of the given keys (a column of the key's name, few rows); segments are in the key's order, so what lies
        outside the keys' range is not read."""
        low, high = keys.agg(F.min(self.key), F.max(self.key)).first()
        found = [self._rows(name, schema).where(F.col(self.key).between(low, high)).join(F.broadcast(keys.select(self.key).distinct()), self.key, "left_semi") for name, _ in self.segments()]
        return self._last_of(found) if found else self.spark.createDataFrame([], schema)

    def _write(self, rows: DataFrame, version: int, parts: int | None = None) -> tuple[str, int]:
        name, seen = f"segment-{version:08d}-{uuid.uuid4().hex[:8]}", Observation()
        placed = rows.repartitionByRange(parts, self.key) if parts else rows.repartitionByRange(self.key)
        placed.sortWithinPartitions(self.key).observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{self.root}/{name}")
        return name, seen.get["rows"]

    def publish(self, changed: DataFrame, batch: str | None = None) -> int:
        """Adds the rows, one per key, as a segment, and merges segments where it is time. Returns how many were added."""
        version, segments = self._latest()
        added = self._write(changed, version + 1)
        self._name(version + 1, batch, [*segments, added])
        self.compact(changed.schema)
        return added[1]

    def compact(self, schema: T.StructType) -> bool:
        """Merges the newest segments as long as they hold ``ratio`` of the next older one. Whether there was something."""
        version, segments = self._latest()
        first = len(segments) - 1
        while first > 0 and sum(n for _, n in segments[first:]) >= self.ratio * segments[first - 1][1]:
            first -= 1
        if first >= len(segments) - 1:
            return False
        merged = self._write(self._merged(segments[first:], schema), version + 1)
        self._name(version + 1, None, [*segments[:first], merged])
        return True

    def vacuum(self) -> None:
        """Deletes the files of segments that the last version does not name; for times without readers of older ones."""
        kept = {name for name, _ in self.segments()}
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        for status in root.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(root):
            name = status.getPath().getName()
            if name.startswith("segment-") and name not in kept:
                delete(self.spark, f"{self.root}/{name}")
