"""Accepted and rejected records of a topic from one pass.

Cleaning tags every record with the first reason to reject it (null: accepted)
instead of filtering, so the main and the side output, and the counts of both,
come from a single scan and a single parse. `split` writes them as one
`topic`, `value` frame, as a sink that routes by topic takes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.operators.cdc import BOOTSTRAP
from quayside.schemas import DEFAULT_DATABASE, ODS_ENVELOPE, ODS_LOG
from quayside.sources.ods import CARRIED, parse_once

ACCEPTED = "accepted"
# Why a record is rejected, in the order in which reasons are looked for.
NOT_A_RECORD = "not_a_record"           # no JSON object, or none of its fields is there
OTHER_DATABASE = "other_database"
OTHER_OPERATION = "other_operation"
NO_DATA = "no_data"
NO_DEVICE = "no_device"
CHANGE_REASONS = (NOT_A_RECORD, OTHER_DATABASE, OTHER_OPERATION, NO_DATA)
LOG_REASONS = (NOT_A_RECORD, NO_DEVICE)


def _parsed(raw: DataFrame, schema) -> DataFrame:
    keep = [c for c in CARRIED if c in raw.columns]
    return raw.select(parse_once(F.from_json("value", schema)), "value", *keep)


def _nothing(schema) -> Column:
    return F.coalesce(*[F.col(f.name).cast("string") if f.dataType.typeName() != "map"
                        and f.dataType.typeName() != "array" else F.to_json(f.name)
                        for f in schema.fields]).isNull()


def tagged_changes(raw: DataFrame, database: str = DEFAULT_DATABASE,
                   types=("insert", "update")) -> DataFrame:
    """Parsed change records with `value` and `reason`. The accepted ones are
    those of `cdc.clean_ods`, with the snapshot prefix taken off `type`."""
    ods = _parsed(raw, ODS_ENVELOPE)
    kind = F.regexp_replace("type", "^" + BOOTSTRAP, "")
    reason = (F.when(_nothing(ODS_ENVELOPE), NOT_A_RECORD)
               .when(~F.coalesce(F.col("database") == database, F.lit(False)), OTHER_DATABASE)
               .when(~F.coalesce(kind.isin(*types), F.lit(False)), OTHER_OPERATION)
               .when(~F.coalesce(F.size("data") > 0, F.lit(False)), NO_DATA))
    return ods.withColumns({"type": kind, "reason": reason})


def tagged_log(raw: DataFrame) -> DataFrame:
    """Parsed log records with `value` and `reason`; accepted as `clean_log`."""
    reason = (F.when(_nothing(ODS_LOG), NOT_A_RECORD)
               .when(F.col("common")["mid"].isNull(), NO_DEVICE))
    # A null `common` gives a null device as well.
    return _parsed(raw, ODS_LOG).withColumn("reason", reason)


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("reason").isNull()).drop("reason", "value")


def counted(tagged: DataFrame, name: str, reasons) -> DataFrame:
    """The frame with a counter per reason and one of accepted records, read
    from `StreamingQueryProgress.observedMetrics` or an `Observation`."""
    counts = [F.count(F.when(F.col("reason") == r, 1)).alias(r) for r in reasons]
    return tagged.observe(name, F.count(F.when(F.col("reason").isNull(), 1)).alias(ACCEPTED),
                          *counts)


def by_reason(tagged: DataFrame) -> DataFrame:
    """Records per reason (`accepted`: none)."""
    return tagged.groupBy(F.coalesce("reason", F.lit(ACCEPTED)).alias("reason")).agg(
        F.count("*").alias("n"))


def split(tagged: DataFrame, topic: str) -> DataFrame:
    """`topic`, `value`: accepted records as they came under `topic`, the others
    with their reason under `topic` + `_rejected`."""
    ok = F.col("reason").isNull()
    return tagged.select(
        F.when(ok, topic).otherwise(topic + "_rejected").alias("topic"),
        F.when(ok, F.col("value")).otherwise(
            F.to_json(F.struct("reason", "value"))).alias("value"))
