"""Reading the tracking-log topic `ods_log`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.schemas import ODS_LOG
from quayside.sources.ods import parse_once

CARRIED = ("offset", "partition", "timestamp")


def _valid(parsed: Column) -> Column:
    """JSON objects that carry `common.mid`, the key every later step needs."""
    return F.coalesce(parsed.getField("common")["mid"].isNotNull(), F.lit(False))


def parse_ods_log(raw: DataFrame, value: str = "value", record: bool = False) -> DataFrame:
    """`value` JSON text -> log record columns plus a `_valid` flag. With
    `record`, also the whole object as `record`, a map of variants: it keeps
    fields the schema does not name, and the types of all values."""
    keep = [c for c in CARRIED if c in raw.columns]
    whole = [F.from_json(F.col(value), "map<string,variant>").alias("record")] if record else []
    out = raw.select(parse_once(F.from_json(F.col(value), ODS_LOG)), *whole, *keep)
    return out.withColumn("_valid", F.coalesce(F.col("common")["mid"].isNotNull(), F.lit(False)))


def clean_log(raw: DataFrame, value: str = "value", record: bool = False) -> DataFrame:
    """Valid log records only."""
    return parse_ods_log(raw, value, record).filter("_valid").drop("_valid")


def rejected_log(raw: DataFrame, value: str = "value") -> DataFrame:
    """The side frame of rejected log text, for counting or dead-lettering."""
    return raw.filter(~_valid(F.from_json(F.col(value), ODS_LOG))).select(value)


KEY_SCHEMA = "common map<string,string>, ts long"


def log_keys(raw: DataFrame, value: str = "value") -> DataFrame:
    """Device id, new-visitor flag, time and arrival offset of each valid log
    record, parsing only `common` and `ts` (cheaper than the whole record)."""
    keep = [c for c in CARRIED if c in raw.columns]
    k = raw.select(parse_once(F.from_json(F.col(value), KEY_SCHEMA)), *keep)
    return k.select(F.col("common")["mid"].alias("mid"), F.col("common")["is_new"].alias("is_new"),
                    "ts", *keep).filter(F.col("mid").isNotNull())
