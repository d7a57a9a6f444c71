"""Topic rows that no order of the other side meets are left out before the join."""

import re

from pyspark.sql import functions as F

from quayside.operators import digest, trade
from quayside.plans.queries import QUERIES
from quayside.schemas import DWD_TRADE_ORDER_DETAIL
from tests.conftest import SF_SMALL

READERS = {"trade_pay_detail_suc": "order_id", "pay_within_ttl": "order_id",
           "pay_within_idle_ttl": "order_id", "trade_cancel_detail": "id"}


def plan_of(spark, name):
    return QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


def test_rows_that_meet_a_key_stay_and_few_others(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("k")).unionByName(
        spark.createDataFrame([(None,), ("",), ("é",), ("7",)], "k string"))
    keys = spark.range(0, 20000, 10).select(F.col("id").cast("string").alias("o")).unionByName(
        spark.createDataFrame([(None,), ("é",), ("é",), ("10",)], "o string"))
    got = digest.may_meet(df, "k", keys, "o")
    assert got.columns == ["k"]
    kept = [r.k for r in got.collect()]
    want = {str(n) for n in range(0, 20000, 10)} | {"é"}
    assert want <= set(kept) and len(kept) == len(set(kept)) < len(want) + 40
    assert digest.may_meet(df, "k", keys.filter("o = 'none'"), "o").count() == 0
    every = spark.range(20000).select(F.col("id").cast("string").alias("o"))
    assert digest.may_meet(df.filter("k <> '' and k <> 'é'"), "k", every, "o").count() == 20001


def test_joined_rows_are_those_of_all_details(spark):
    """Null and repeated order ids, figures with letters, several payments."""
    details = [("a", "1", "x", "5"), ("a", "1", "x", "5"), ("b-2", "2", "9", None), ("c", None, "1", "2"),
               (None, "3", "1.5", ""), ("d", "4", "F", "e"), ("7", "5", "8", "9")]
    od = spark.createDataFrame(details, "id string, order_id string, sku_id string, sku_num string")
    od = od.select(*[F.col(f.name) if f.name in od.columns else
                     (F.lit(3) if f.name == "ts" else F.lit(None)).cast(f.dataType).alias(f.name)
                     for f in DWD_TRADE_ORDER_DETAIL.fields])
    paid = spark.createDataFrame(
        [("u", o, t, "c", 4) for o, t in (("1", "x"), ("1", "y"), ("2", "x"), ("3", None), (None, "x"),
                                          ("4", "z"), ("9", "x"))],
        "user_id string, order_id string, payment_type string, callback_time string, ts long")
    got = trade.payment_columns(trade.join_few_orders(
        od, paid, "order_id", F.col("od.order_id") == F.col("pi.order_id"), "od", "pi"))
    want = trade.join_paid_details(od, paid)
    assert got.schema == want.schema
    rows = sorted(map(repr, got.collect()))
    assert rows == sorted(map(repr, want.collect())) and len(rows) == 7


def test_readers_leave_out_details_before_they_deal_them_out(spark):
    for name, key in READERS.items():
        lines = plan_of(spark, name).splitlines()
        join = next(i for i, line in enumerate(lines)
                    if re.search(rf"SortMergeJoin \[order_id#\d+\], \[{key}#", line))
        left = lines[join + 1:join + 8]
        at = [next(i for i, line in enumerate(left) if word in line)
              for word in ("Exchange hashpartitioning(order_id#", "_packed", "Filter ((getbit")]
        assert at == sorted(at), (name, left)


def test_step_per_key_of_a_topic_needs_no_sort(spark):
    """Rows joined by id are still in its sequence when read from the topic."""
    for name in ("upsert_latest_by_key", "trade_pay_detail_suc"):
        lines = plan_of(spark, name).splitlines()
        first = next(i for i, line in enumerate(lines) if "partial_max_by" in line)
        below = "\n".join(lines[first:first + 14])
        down = below[:below.index("SortMergeJoin")]
        assert "Sort [" not in down and "Generate" not in down, down
