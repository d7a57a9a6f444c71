"""New-visitor repair of a stream by joins (T1), without keyed Python state.

The devices' first-visit days are rows of a folder that belongs to one query.
A micro-batch

1. finds the first day of each of its devices (`traffic.first_visit_days`: one
   aggregate with a map-side partial, so a device with half of the rows is one
   row per task);
2. writes them to a folder of its own, with the day of an earlier batch where
   there is one (`_fresh` is true where there is none);
3. reads that folder again and joins it to its records: a plain scan on one side
   of the join, so that AQE's skew join can split a hot device on the other.

Batch `b` reads what batches before it wrote, so running it again writes the
same folder with the same rows. Batch ids follow one another from 0. Every
`compact_every`-th batch also writes the days of all devices known by then, and
readers start there: at most that many folders are read, and none is listed.
Folders before the last of these may be removed.

A micro-batch scans the known days once (two narrow columns) and shuffles them
by device where they are too large to broadcast. With short triggers and very many
devices, `state.repair_is_new_stream` looks up only the batch's devices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators import traffic
from quayside.sources.logs import clean_log, log_keys

SCHEMA = "_mid string, _first_day string, _fresh boolean"


def _folders(path: str, kind: str, first: int, stop: int) -> list[str]:
    return [f"{path.rstrip('/')}/{kind}/batch={b}" for b in range(first, stop)]


def known_days(spark: SparkSession, path: str, batch_id: int, compact_every: int) -> DataFrame:
    """Days of all devices that came before a micro-batch, one row per device."""
    start = batch_id // compact_every * compact_every      # of the folders to add
    folders = (_folders(path, "all", start - 1, start) if start else []) + _folders(
        path, "batch", start, batch_id)
    if not folders:
        return spark.createDataFrame([], SCHEMA).drop("_fresh")
    return spark.read.schema(SCHEMA).parquet(*folders).where("_fresh").drop("_fresh")


def repair(raw: DataFrame, batch_id: int, path: str, compact_every: int = 100) -> DataFrame:
    """Valid log records of one micro-batch of topic text, `common.is_new`
    corrected by the devices' first days of this and all earlier batches."""
    spark = raw.sparkSession
    known = known_days(spark, path, batch_id, compact_every)
    earlier = known.withColumnRenamed("_first_day", "_known_day")
    days = traffic.first_visit_days(log_keys(raw)).join(earlier, "_mid", "left").select(
        "_mid", F.coalesce("_known_day", "_first_day").alias("_first_day"),
        F.col("_known_day").isNull().alias("_fresh"))
    own = _folders(path, "batch", batch_id, batch_id + 1)[0]
    days.write.mode("overwrite").parquet(own)
    current = spark.read.schema(SCHEMA).parquet(own)
    if (batch_id + 1) % compact_every == 0:
        known.withColumn("_fresh", F.lit(True)).unionByName(current.where("_fresh")).write.mode(
            "overwrite").parquet(_folders(path, "all", batch_id, batch_id + 1)[0])
    return traffic.repair_with(clean_log(raw, record=True), current.drop("_fresh"))
