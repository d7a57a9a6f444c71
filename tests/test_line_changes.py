"""The changes of all line tables from one join: the rows of a branch each."""

import datetime
import os
import re

import pytest
from pyspark.sql import functions as F

from quayside.plans.queries import QUERIES
from quayside.sources import replay
from tests.conftest import SF_SMALL

DAY = datetime.datetime(2024, 3, 1, 7, 8, 9)


def tables(spark, path):
    """Lines with and without order and part, null keys and flags; an order and
    part keys that repeat."""
    lines = [(o, p, 3, n, 5.0, 10.25, flag, status, DAY) for n, (o, p, flag, status) in enumerate([
        (1, 1, "A", "F"), (1, 2, "R", "F"), (2, 1, "R", "O"), (2, 9, "R", "F"), (3, 2, "N", "O"),
        (6, 2, "R", "F"), (7, 1, "A", "F"), (None, 1, "A", "F"), (2, None, "R", "F"),
        (1, 2, None, None), (6, 3, "A", None)])]
    lines.append((3, 1, None, None, None, None, "R", "F", None))
    frames = {
        "lineitem": (lines + lines[:2], "l_orderkey long, l_partkey long, l_suppkey long, "
                     "l_linenumber int, l_quantity double, l_extendedprice double, "
                     "l_returnflag string, l_linestatus string, l_shipdate timestamp"),
        "orders": ([(1, 5, DAY), (2, None, DAY), (2, 6, DAY), (3, 7, None), (6, 8, DAY),
                    (None, 1, DAY)],
                   "o_orderkey long, o_custkey long, o_orderdate timestamp"),
        "part": ([(1, "one", 1.5), (2, "two", 2.5), (2, "zwei", None), (2, "two", 2.5),
                  (3, None, None), (None, "none", 1.0)],
                 "p_partkey long, p_name string, p_retailprice double")}
    for name, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(
            os.path.join(path, f"{name}.parquet"))
    return replay.Tables(spark, path)


def test_one_join_writes_the_rows_of_every_branch(spark, scratch):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    t = tables(spark, scratch)
    got = sorted(map(tuple, replay.line_changes(t).collect()))
    branches = [replay.ODS_TABLES[k](t) for k in replay.LINE_TABLES]
    want = sorted(tuple(r) for b in branches for r in b.collect())
    assert got == want
    counts = {k: sum(r[1] == k for r in got) for k in replay.LINE_TABLES}
    # By hand: a detail per order and part of the line's keys, other changes
    # per order of the line's key.
    assert counts == {"order_detail": 21, "order_detail_activity": 3, "order_detail_coupon": 10,
                      "order_refund_info": 12, "refund_payment": 13}


@pytest.mark.parametrize("key", ["ods_envelope_parse", "ods_clean", "rejects_by_reason"])
def test_readers_of_every_table_join_the_lines_once(spark, key):
    plan = QUERIES[key](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[l_orderkey#", plan)) == 1


def test_whole_topic_has_the_same_rows(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    parts, whole = (replay.ods_db(spark, SF_SMALL, whole=w) for w in (False, True))
    assert whole.columns == parts.columns
    assert whole.exceptAll(parts).count() == 0 and parts.exceptAll(whole).count() == 0
    assert whole.select(F.count("*")).first() == parts.select(F.count("*")).first()
