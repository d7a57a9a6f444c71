"""Start a streaming query with the warehouse's conventions.

* checkpoints live under the shared folder named by `spark.checkpoint.dir`
  (one sub-folder per query), so a restarted query resumes exactly where its
  last committed micro-batch ended;
* the default trigger is the reference's 3 s checkpoint interval;
* `available_now=True` drains what is there and stops (tests, back-fills).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from quayside.session import checkpoint_path

DEFAULT_TRIGGER = "3 seconds"


def start(df: DataFrame, name: str, *, sink: str = "memory", path: str | None = None,
          output_mode: str = "append", available_now: bool = False,
          trigger: str = DEFAULT_TRIGGER, options: dict | None = None,
          foreach_batch: Callable[[DataFrame, int], None] | None = None,
          checkpoint: str | None = None) -> StreamingQuery:
    """Start `df` as query `name`.

    `sink`: `memory` (query name = table name), `kafka` (`options` carry the
    servers; rows need `value` and optionally `key`/`topic`), a file format
    (`parquet`, `json`, `text`; exactly-once through the file sink log) with
    `path`, or `foreach_batch` for a custom idempotent merge.
    """
    spark = df.sparkSession
    w = (df.writeStream.queryName(name).outputMode(output_mode)
         .option("checkpointLocation", checkpoint or checkpoint_path(spark, "streams", name)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if foreach_batch is not None:
        return w.foreachBatch(foreach_batch).start()
    w = w.format(sink)
    return w.start(path) if path else w.start()


def run_available(df: DataFrame, name: str, **kw) -> StreamingQuery:
    """Drain the input with `availableNow` and wait for the query to finish."""
    q = start(df, name, available_now=True, **kw)
    q.awaitTermination()
    return q
