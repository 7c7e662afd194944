"""Placing documents on shards by a permutation-filled lookup table, in DataFrame functions only.

Each shard has its own permutation of the slots of a prime-sized table (an offset and a step from its name's hash).
Shards take turns; at its turn a shard claims the first slot of its permutation that is still free, until all slots are
claimed. Shards so hold equal numbers of slots within one, and a shard's leaving moves few slots of others. A document's
slot is its id's hash modulo the table's size; the table, of fixed size, is broadcast, so placing is one lookup.

Edge cases: a null id is placed as the text ``null``; rows that repeat an id share its shard; one shard takes all; an
empty table gives an empty result; other columns are kept, whatever their names.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.llm.staging import fresh

SLOTS = 5003
SHARDS = tuple(f"shard-{k:02d}" for k in range(16))


def _hash(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def fill_table(shards=SHARDS, slots: int = SLOTS) -> list[str]:
    """The shard of each slot. Its size is a parameter and knows nothing of the data."""
    if slots < 2 or any(slots % p == 0 for p in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be prime")
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must have names of their own")
    names = sorted(shards)
    at = [_hash("offset:" + x) % slots for x in names]
    step = [_hash("step:" + x) % (slots - 1) + 1 for x in names]
    owner: list[str | None] = [None] * slots
    for turn in range(slots):
        k = turn % len(names)
        while owner[at[k]] is not None:
            at[k] = (at[k] + step[k]) % slots
        owner[at[k]] = names[k]
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """First 32 bits of the key text's md5, modulo the table's size."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("null"))), 1, 8), 16, 10).cast("long") % slots


def lookup_table(spark: SparkSession, shards=SHARDS, slots: int = SLOTS) -> DataFrame:
    """(slot, shard): one literal, split and exploded by Spark."""
    if any("," in x for x in shards):
        raise ValueError("shard names hold no comma")
    table = F.split(F.lit(",".join(fill_table(shards, slots))), ",")
    return spark.range(1).select(F.posexplode(table).alias("slot", "shard")).select(F.col("slot").cast("long").alias("slot"), "shard")


def place(docs: DataFrame, id_col: str = "doc_id", shards=SHARDS, slots: int = SLOTS, slot_name: str = "slot", shard_name: str = "shard") -> DataFrame:
    """The rows with their slot and shard, in columns of these names, or of these and underscores where they are taken."""
    slot, shard = fresh(docs, slot_name), fresh(docs, shard_name)
    table = lookup_table(docs.sparkSession, shards, slots).toDF(slot, shard)
    return docs.withColumn(slot, slot_of(F.col(id_col), slots)).join(F.broadcast(table), slot).select(*docs.columns, slot, shard)


def write_sharded(docs: DataFrame, path: str, id_col: str = "doc_id", shards=SHARDS, slots: int = SLOTS) -> None:
    """Writes the rows in one folder per shard; slots spread each shard over many tasks, so none meets a shard alone."""
    placed = place(docs, id_col, shards, slots, "_slot", "_shard")
    slot, shard = placed.columns[-2:]
    placed.repartition(slot).drop(slot).write.partitionBy(shard).parquet(path)
