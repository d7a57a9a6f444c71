"""Reading the change-log topic `ods_db` (Kafka value text -> envelope)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.schemas import ODS_ENVELOPE

# Columns of a raw frame that are carried through parsing unchanged.
CARRIED = ("_table", "offset", "partition", "timestamp")


def parse_ods_db(raw: DataFrame, value: str = "value") -> DataFrame:
    """`value` JSON text -> `database, table, type, ts, data, old`.

    Text that is not a JSON object parses to all-NULL fields; cleaning and
    table filters drop such rows. Landing columns (`_table`, `offset`, ...)
    are carried along so filters on them reach the scan.
    """
    keep = [c for c in CARRIED if c in raw.columns]
    return raw.select(parse_once(F.from_json(F.col(value), ODS_ENVELOPE)), *keep)


def parse_once(parsed):
    """Expand a parsed struct into columns, evaluating the parse once per row.

    Selecting fields of ``from_json`` directly lets the optimizer copy the
    parse into every pushed-down predicate (one JSON parse per predicate).
    The one-row ``inline`` generator is a boundary for predicates on the
    parsed fields, while predicates on carried columns (``_table``) still
    reach the scan.
    """
    return F.inline(F.array(parsed))


def read_landed_ods_db(spark: SparkSession, path: str) -> DataFrame:
    """Change log landed as JSON-lines text partitioned by `_table`.

    The landing writer (`sinks.land_ods_db`) derives `_table` from each
    record, so a filter on it prunes whole directories.
    """
    return parse_ods_db(spark.read.format("text").load(path))
