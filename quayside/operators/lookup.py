"""Lookup joins against the code dictionary.

The dictionary is the static side: per batch (or micro-batch) it is joined
inner on equality, so rows whose code has no entry are dropped. It is
broadcast only after its size has been checked; past the bound the join is
left to the planner (shuffle join, or an AQE broadcast once measured).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What may be shipped to every executor: rows, and bytes of their text.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 32 << 20


def bounded_broadcast(small: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                      max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """`broadcast(small)` when it has at most `max_rows` rows and `max_bytes`
    bytes (text plus 16 per column), else `small`.

    The check sums over at most `max_rows + 1` rows, so it stays cheap even
    when the side turns out to be large. Must be a batch frame.
    """
    sizes = [F.coalesce(F.octet_length(F.col(f.name).cast("string")), F.lit(0)) + 16
             for f in small.schema.fields]
    size = sum(sizes[1:], sizes[0]).cast("long")
    n, total = small.select(size.alias("size")).limit(max_rows + 1).agg(
        F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    return F.broadcast(small) if n <= max_rows and total <= max_bytes else small


def lookup(df: DataFrame, dic: DataFrame, code_col: str, name_col: str,
           checked: bool = False, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Inner equi-join of `df[code_col]` to `dic.dic_code`, adding `dic_name`
    as `name_col`. Pass `checked=True` when `dic` is already size-checked."""
    side = dic if checked else bounded_broadcast(dic, max_rows)
    side = side.select(F.col("dic_code").alias("_code"), F.col("dic_name").alias(name_col))
    return df.join(side, F.col(code_col) == F.col("_code"), "inner").drop("_code")


def prepared(dic: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Size-check the dictionary once for several lookups."""
    return bounded_broadcast(dic.select("dic_code", "dic_name"), max_rows)
