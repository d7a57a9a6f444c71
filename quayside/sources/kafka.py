"""Kafka topics as streaming sources (value and key text)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
                 max_offsets_per_trigger: int | None = None, options: dict | None = None) -> DataFrame:
    """`key`, `value` (UTF-8 text), `partition`, `offset`, `timestamp` of a topic.

    Requires the Kafka connector on the classpath. `max_offsets_per_trigger`
    bounds each micro-batch (and so the per-key state work in one batch).
    """
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load().select(F.col("key").cast("string").alias("key"),
                           F.col("value").cast("string").alias("value"),
                           "partition", "offset", "timestamp")


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same frame shape from JSON-lines files (tests, landed topics)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)
