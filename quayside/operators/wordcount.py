"""Keyed running word count (A1): the exactly-once demo job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.text import java_split


def word_counts(lines: DataFrame, value: str = "value") -> DataFrame:
    """Words split on single spaces (trailing empty pieces dropped) and
    counted per word. On a stream run with output mode `update`: every
    micro-batch emits the new totals of the words it touched. The count is
    partially aggregated before the shuffle, so a very frequent word costs
    one row per task."""
    words = lines.select(F.explode(java_split(F.col(value), " ")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def count_text(word="word", n="n"):
    """`word_n` text of one count, as written to the output topic."""
    return F.concat_ws("_", F.col(word), F.col(n).cast("string"))

