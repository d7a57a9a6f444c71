"""Routing rules (`table_process`): landed Debezium change text and preload.

The binlog reader itself is not rebuilt: rule changes are read as the JSON
text a CDC connector lands in a topic or files (`{op, before, after, source,
ts_ms}`), the same frame shape for batch and stream.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.schemas import RULE, RULE_CHANGE, RULE_FIELDS
from quayside.sources.ods import parse_once

# The rule changes used with the replayed change log, in
# binlog order (seq, op, source_table, source_type, sink_table, sink_type,
# sink_columns, sink_pk, sink_extend).
RULE_CHANGES = [
    (1, "r", "user_info", "ALL", "dim_user_info", "dim", "id,name", "id", None),
    (2, "r", "sku_info", "ALL", "dim_sku_info", "dim", "id,sku_name,brand", None, "SALT_BUCKETS=3"),
    (3, "c", "base_province", "ALL", "dim_base_province", "dim", "id,name", "", None),
    (4, "u", "user_info", "ALL", "dim_user_info", "dim", "id,name,province_id", "id", None),
    (5, "d", "base_province", "ALL", "dim_base_province", "dim", "id,name", "", None),
    (6, "r", "cart_info", "insert", "dwd_cart_info", "dwd", "id,user_id,sku_id", None, None),
]


def change_text(seq: int, op: str, rule: dict) -> str:
    """Debezium JSON of one rule change: the row goes to `before` on delete,
    to `after` otherwise (updates carry both)."""
    before = rule if op in ("d", "u") else None
    after = None if op == "d" else rule
    return json.dumps({"op": op, "before": before, "after": after, "seq": seq})


def rule_change_texts(spark: SparkSession, changes=RULE_CHANGES) -> DataFrame:
    """The change texts as a local relation (size checks run on the driver)."""
    texts = [change_text(c[0], c[1], dict(zip(RULE_FIELDS, c[2:]))) for c in changes]
    rows = ", ".join(f"({_sql_string(t)})" for t in texts)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(value)")


def _sql_string(text: str) -> str:
    """A Spark SQL string literal (backslash and quote escaped)."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def change_order(seq: Column, source: Column, ts_ms: Column) -> Column:
    """One number that orders rule changes: `seq` where there is one, else the
    binlog position (file number, then position), else the time, else 0."""
    number = F.regexp_extract(source["file"], r"(\d+)$", 1).try_cast("bigint")
    return F.coalesce(seq, F.shiftleft(number, 40) + source["pos"], ts_ms,
                      F.lit(0).cast("bigint"))


def parse_rule_changes(raw: DataFrame, value: str = "value", timed: bool = False) -> DataFrame:
    """Debezium change text -> one rule row per change (P4): the `before`
    image when the change is a delete, else `after`; plus `op` and `seq`, and
    with `timed` also `at`, the time of the change in epoch millis."""
    parsed = raw.select(parse_once(F.from_json(F.col(value), RULE_CHANGE)))
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    return parsed.select(*[image[f].alias(f) for f in RULE_FIELDS], "op", change_order(
        F.col("seq"), F.col("source"), F.col("ts_ms")).alias("seq"),
        *([F.col("ts_ms").alias("at")] if timed else []))


def preload_rules(rules: DataFrame) -> DataFrame:
    """Rules read in full from the config table (S6) in change-row shape:
    a snapshot (`op = 'r'`) ordered before every streamed change."""
    return rules.select(*[F.col(f).cast("string") for f in RULE_FIELDS],
                        F.lit("r").alias("op"), F.lit(-1).cast("bigint").alias("seq"))


def read_rules_jdbc(spark: SparkSession, url: str, table: str = "table_process",
                    properties: dict | None = None) -> DataFrame:
    from quayside.sources.jdbc import query_list
    return preload_rules(query_list(spark, url, f"select * from {table}", properties))


__all__ = ["RULE", "RULE_CHANGES", "parse_rule_changes", "preload_rules", "read_rules_jdbc",
           "rule_change_texts"]
