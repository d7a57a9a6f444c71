"""Joins of streams whose rows are kept in tables instead of join state.

Every side of a join is a table of its own: the rows that have come so far. A
micro-batch

1. writes its rows of each side (one parse of the micro-batch for all sides);
2. joins its new rows of a side with all rows of the others, each combination
   once: sides before it give their earlier rows, sides behind it all rows;
3. hands the combinations to the job's `foreachBatch` writer.

So a match is found however late it comes, and the query holds no state: what a
micro-batch needs in memory does not grow with the history.

* **What is read.** Rows lie in folders by `bucket(key)`: runs of `WIDTH`
  consecutive numeric ids, so that what belongs together in time lies together; keys
  that are no numbers by hash. A micro-batch reads the buckets of its own keys
  only (all of them if they are more than `MAX_BUCKETS`).
* **Skew.** The writes are rebalanced by bucket, where AQE splits a large one, and
  the joins are plain joins of scans, whose hot keys AQE's skew join splits.
* **Files.** Batch `b` writes the folder of the span `b-(b+1)`. Where `b + 1` is a
  multiple of `fan`, `fan**2`, ... the last `fan` spans are also written as one
  (`merge`), so a reader opens at most `fan - 1` spans per power of `fan`, and a row
  is rewritten once per power. Which spans to read follows from the batch number.
* **Running again.** Batch `b` reads what batches before it wrote and overwrites
  its own folders, so a micro-batch that runs again gives the same rows.

A folder belongs to one query; batch ids follow one another from 0. Rows without
a key join nothing and are not kept. A span's parts may be removed once it is merged
and no earlier micro-batch runs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WIDTH = 100_000
HASHED = 64
MAX_BUCKETS = 1_000
FAN = 16
_PLACE = [T.StructField("_span", T.StringType()), T.StructField("_bucket", T.LongType())]


def bucket(key: Column) -> Column:
    """Folder of a key: its run of `WIDTH` ids, or a negative number by hash."""
    number = key.try_cast("long")
    return F.coalesce(F.when(number >= 0, F.floor(number / F.lit(WIDTH)).cast("long")),
                      -1 - F.pmod(F.xxhash64(key), F.lit(HASHED)))


def spans(start: int, stop: int, fan: int = FAN) -> list[tuple[int, int]]:
    """The fewest merged spans that make up the batches `start` to `stop` - 1;
    `start` is 0 or such that no larger span reaches over it."""
    out = []
    while start < stop:
        size = 1
        while start % (size * fan) == 0 and start + size * fan <= stop:
            size *= fan
        out.append((start, start + size))
        start += size
    return out


class Side:
    """The kept rows of one side of a join: columns of `schema`, found by `key`."""

    def __init__(self, path: str, name: str, schema: T.StructType, key: str, fan: int = FAN):
        self.path, self.schema, self.key, self.fan = f"{path.rstrip('/')}/{name}", schema, key, fan

    def _write(self, rows: DataFrame, span: tuple[int, int]) -> None:
        folder = f"{self.path}/_span={span[0]}-{span[1]}"
        rows.hint("rebalance", "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(
            folder)

    def _read(self, spark: SparkSession, parts: Sequence[tuple[int, int]],
              buckets: list[int] | None = None) -> DataFrame:
        if not parts:
            return spark.createDataFrame([], self.schema)
        schema = T.StructType(self.schema.fields + _PLACE)
        rows = (spark.read.option("basePath", self.path).schema(schema)
                .parquet(*[f"{self.path}/_span={a}-{b}" for a, b in parts]))
        if buckets is not None:
            rows = rows.where(F.col("_bucket").isin(buckets) if buckets else F.lit(False))
        return rows.select(*self.schema.names)

    def put(self, rows: DataFrame, batch_id: int) -> None:
        """Keep the rows of a micro-batch."""
        rows = rows.where(F.col(self.key).isNotNull())
        self._write(rows.withColumn("_bucket", bucket(F.col(self.key))), (batch_id, batch_id + 1))

    def new(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """Rows of the micro-batch itself."""
        return self._read(spark, [(batch_id, batch_id + 1)])

    def old(self, spark: SparkSession, batch_id: int,
            buckets: list[int] | None = None) -> DataFrame:
        """Rows of all micro-batches before."""
        return self._read(spark, spans(0, batch_id, self.fan), buckets)

    def upto(self, spark: SparkSession, batch_id: int,
             buckets: list[int] | None = None) -> DataFrame:
        """Rows of this and all micro-batches before."""
        return self._read(spark, [*spans(0, batch_id, self.fan), (batch_id, batch_id + 1)], buckets)

    def merge(self, spark: SparkSession, batch_id: int) -> None:
        """Write the spans that end with this micro-batch as one; run it behind the
        micro-batch's output."""
        size = self.fan
        while (batch_id + 1) % size == 0:
            span = (batch_id + 1 - size, batch_id + 1)
            step = size // self.fan
            parts = [(a, a + step) for a in range(*span, step)]
            rows = self._read(spark, parts)
            self._write(rows.withColumn("_bucket", bucket(F.col(self.key))), span)
            size *= self.fan


def buckets_of(rows: DataFrame, key: str) -> list[int] | None:
    """Buckets of the rows' keys, at most `MAX_BUCKETS`; None: more than that."""
    found = (rows.where(F.col(key).isNotNull()).select(bucket(F.col(key)).alias("b")).distinct()
             .limit(MAX_BUCKETS + 1).collect())
    return None if len(found) > MAX_BUCKETS else sorted(r["b"] for r in found)


def put_all(sides: Sequence[Side], frames: Sequence[DataFrame], batch_id: int) -> None:
    for side, rows in zip(sides, frames, strict=True):
        side.put(rows, batch_id)


def new_matches(spark: SparkSession, sides: Sequence[Side], batch_id: int,
                join: Callable[..., DataFrame]) -> DataFrame:
    """Rows of the inner join `join(*sides)` that hold a row of this micro-batch,
    each combination once. All sides are bucketed by the value they join on."""
    terms = []
    for i, side in enumerate(sides):
        fresh = side.new(spark, batch_id)
        near = buckets_of(fresh, side.key)
        if near == []:
            continue
        terms.append(join(*[s.old(spark, batch_id, near) for s in sides[:i]], fresh,
                          *[s.upto(spark, batch_id, near) for s in sides[i + 1:]]))
    if not terms:
        return join(*[s.new(spark, batch_id) for s in sides])
    return reduce(DataFrame.unionByName, terms)


def only_keys(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows whose `key` is among `keys` (one column, distinct)."""
    wanted = keys.toDF("_wanted")
    return rows.join(wanted, F.col(key) == F.col("_wanted"), "left_semi")


class KeptJoin:
    """Base of the kept joins of one job: `joined(batch, batch_id)` keeps a
    micro-batch's rows and returns the joined rows it brings; `merge(batch_id)`
    goes behind their output."""

    def __init__(self, path: str, keys: dict[str, str], split: Callable[[DataFrame],
                 dict[str, DataFrame]], join: Callable[..., DataFrame], fan: int = FAN):
        self.path, self.keys, self.split, self.join, self.fan = path, keys, split, join, fan
        self.sides: dict[str, Side] = {}

    def side(self, name: str, schema: T.StructType, key: str) -> Side:
        self.sides[name] = Side(self.path, name, schema, key, self.fan)
        return self.sides[name]

    def keep(self, batch: DataFrame, batch_id: int) -> list[Side]:
        """Write the micro-batch's rows of each side from one pass over it."""
        batch.persist()
        try:
            frames = self.split(batch)
            sides = [self.side(n, frames[n].schema, k) for n, k in self.keys.items()]
            put_all(sides, [frames[n] for n in self.keys], batch_id)
        finally:
            batch.unpersist()
        return sides

    def joined(self, batch: DataFrame, batch_id: int) -> DataFrame:
        return new_matches(batch.sparkSession, self.keep(batch, batch_id), batch_id, self.join)

    def merge(self, spark: SparkSession, batch_id: int) -> None:
        for side in self.sides.values():
            side.merge(spark, batch_id)


class KeptOrderDetail(KeptJoin):
    """The parts of order details (J5, J6). Details that meet their order are kept as
    a side of their own. A detail comes out once its order is known, and again
    with all its parts when a new activity or coupon comes, as in
    `state.merge_parts`; repeated records do not multiply its rows."""

    def __init__(self, path: str, split, join_order, join_parts, fan: int = FAN):
        keys = {"detail": "order_id", "order": "id", "activity": "order_detail_id",
                "coupon": "order_detail_id"}
        super().__init__(path, keys, split, join_order, fan)
        self.join_parts = join_parts

    def joined(self, batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        detail, order, activity, coupon = self.keep(batch, batch_id)
        met = new_matches(spark, [detail, order], batch_id, self.join)
        base = self.side("base", met.schema, "id")
        base.put(met, batch_id)
        parts = [base, activity, coupon]
        keys = reduce(DataFrame.union, [s.new(spark, batch_id).select(
            F.col(s.key).alias("_key")) for s in parts]).distinct()
        near = buckets_of(keys, "_key")
        rows = [only_keys(s.upto(spark, batch_id, near), s.key, keys) for s in parts]
        return self.join_parts(*rows).distinct()
