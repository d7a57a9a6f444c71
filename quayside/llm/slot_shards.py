"""Sharding through fixed virtual slots.

Every document hashes into one of ``SLOTS`` virtual slots for good. Bytes and
rows are summed per slot, and a small versioned table says which shard owns
each slot. Rebalancing edits that table only: it moves whole slots from the
fullest shard to the emptiest until no move or swap brings the two closer,
and stores the result as the next version. Adding a shard edits the table the
same way, moving slots into the new shard alone.

DataFrame functions only; the driver sees the slot sums (``SLOTS`` rows
whatever the input) and the map. A position inside its shard is the row's
number inside its slot plus the rows of the shard's earlier slots, so no task
sorts more than one slot. At 100 TB take more slots (65,536).

Edge cases: a null text counts 0 bytes (plus 1) and crc32 0; a null id hashes
by its text; repeated rows are placed one by one; an empty table has no rows.
Only the id and the text are read, so other columns' names cannot clash. One
document larger than a shard's share makes that shard larger by itself.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm.common import scratch

SLOTS = 4096
SHARDS = 8
MAP_SCHEMA = "map_version int, vslot int, shard int, bytes long, rows long"


def slotted(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and virtual slot of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    h = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")), F.xxhash64(text))
    return docs.select("doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"),
                       F.pmod(h, F.lit(slots)).cast("int").alias("vslot"))


def slot_sums(sized: DataFrame) -> DataFrame:
    return sized.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def rebalanced(owner: np.ndarray, weight: np.ndarray, shards: int) -> np.ndarray:
    """The owner of each slot after moves and swaps that even out the shards."""
    owner = owner.copy()
    load = np.bincount(owner, weight, shards).astype(np.int64)
    while True:
        high, low = int(load.argmax()), int(load.argmin())
        gap = int(load[high] - load[low])
        mine = np.flatnonzero((owner == high) & (weight > 0))
        theirs = np.flatnonzero(owner == low)
        # Moving a slot of weight d, or swapping two that differ by d, leaves |gap - 2d|.
        # A move is a swap with nothing; the best partner is next to weight - gap / 2.
        back = np.concatenate([[0], weight[theirs]])
        order = np.argsort(back, kind="stable")
        place = np.searchsorted(2 * back[order], 2 * weight[mine] - gap)
        near = order[np.clip(place[:, None] - [1, 0], 0, len(order) - 1)]
        d = weight[mine, None] - back[near]
        left = np.abs(gap - 2 * d)
        if gap == 0 or not left.size or left.min() >= gap:
            return owner
        i, j = np.unravel_index(int(left.argmin()), left.shape)
        owner[mine[i]] = low
        if near[i, j]:
            owner[theirs[near[i, j] - 1]] = high
        load[high] -= d[i, j]
        load[low] += d[i, j]


def grown(owner: np.ndarray, weight: np.ndarray, shards: int) -> np.ndarray:
    """Owners for one shard more: slots move from the fullest into the new one only."""
    owner, new = owner.copy(), shards
    load = np.bincount(owner, weight, shards + 1).astype(np.int64)
    share = int(weight.sum()) // (shards + 1)
    while load[new] < share:
        high = int(load[:new].argmax())
        mine = np.flatnonzero((owner == high) & (weight > 0))
        fits = mine[weight[mine] <= share - load[new]]
        if not len(fits) or load[high] <= load[new]:
            break
        take = fits[weight[fits].argmax()]
        owner[take] = new
        load[high] -= weight[take]
        load[new] += weight[take]
    return owner


def first_map(shards: int, slots: int = SLOTS) -> np.ndarray:
    return np.arange(slots) % shards


def store_map(spark: SparkSession, path: str, version: int, owner: np.ndarray,
              weight: np.ndarray, rows: np.ndarray) -> None:
    """Write one version of the slot map; earlier versions stay readable."""
    values = json.dumps([{"vslot": k, "shard": int(o), "bytes": int(w), "rows": int(n)}
                         for k, (o, w, n) in enumerate(zip(owner, weight, rows, strict=True))])
    kind = f"array<struct<{MAP_SCHEMA.split(', ', 1)[1].replace(' ', ':').replace(',:', ',')}>>"
    spark.range(1).select(F.inline(F.from_json(F.lit(values), kind))).select(
        F.lit(version).alias("map_version"), "*").coalesce(1).write.mode("overwrite").parquet(
        f"{path.rstrip('/')}/version-{version:06d}")


def read_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(MAP_SCHEMA).parquet(f"{path.rstrip('/')}/version-{version:06d}")


def place(sized: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Shard and gapless position of every document under one map version.

    The map has a fixed number of rows, so it is broadcast.
    """
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(
        Window.unboundedPreceding, -1)
    placed = slot_map.withColumn("offset", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    inside = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    return (sized.withColumn("n", F.row_number().over(inside).cast("long"))
            .join(F.broadcast(placed.select("vslot", "map_version", "shard", "offset")), "vslot")
            .withColumn("slot", F.col("offset") + F.col("n") - 1))


def shard_documents(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS,
                    map_path: str | None = None) -> DataFrame:
    """Place all documents into ``shards`` shards of near equal bytes."""
    spark = docs.sparkSession
    map_path = map_path or scratch(spark, "slot-map")
    sized = slotted(docs, slots)
    weight, rows = np.zeros(slots, np.int64), np.zeros(slots, np.int64)
    for r in slot_sums(sized).collect():      # at most ``slots`` rows
        weight[r.vslot], rows[r.vslot] = r.bytes, r["rows"]
    owner = first_map(shards, slots)
    store_map(spark, map_path, 1, owner, weight, rows)
    store_map(spark, map_path, 2, rebalanced(owner, weight, shards), weight, rows)
    return place(sized, read_map(spark, map_path, 2)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "vslot", "map_version")
