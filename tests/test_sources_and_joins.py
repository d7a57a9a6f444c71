"""Landing/reading the change log, dictionary readers, broadcast bounds, E1."""

import os

import pytest
from pyspark.sql import functions as F

from quayside.operators import trade
from quayside.operators.lookup import bounded_broadcast, lookup
from quayside.plans import queries as Q
from quayside.plans.compare import duck, same
from quayside.sources import replay
from quayside.sources.dictionary import base_dic, read_base_dic_parquet
from quayside.sources.jdbc import filled, snake_to_camel
from quayside.sources.ods import read_landed_ods_db
from quayside.sources.sinks import land_ods_db
from tests.conftest import SF_SMALL


def test_landed_change_log_prunes_partitions(spark, scratch):
    path = os.path.join(scratch, "ods_db")
    raw = replay.ods_db(spark, SF_SMALL).drop("_table")   # landing derives it
    land_ods_db(raw, path)
    ods = read_landed_ods_db(spark, path)
    got = trade.trade_cart_add(ods, base_dic(spark))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_table" in plan and "cart_info" in plan
    assert got.count() == Q.trade_cart_add(spark, SF_SMALL).count()


def test_dictionary_parquet_roundtrip(spark, scratch):
    path = os.path.join(scratch, "base_dic")
    base_dic(spark).write.parquet(path)
    assert sorted(read_base_dic_parquet(spark, path).collect()) == sorted(base_dic(spark).collect())


def test_lookup_without_broadcast_past_bound(spark):
    od = trade.order_details(Q.ods(spark, SF_SMALL))
    small = lookup(od, base_dic(spark), "source_type", "n")
    large = lookup(od, base_dic(spark), "source_type", "n", max_rows=3)
    assert small.count() == large.count() > 0
    # past the bound no broadcast hint is added
    assert "broadcast" not in str(bounded_broadcast(base_dic(spark), 3)._jdf.queryExecution()
                                  .logical()).lower()


def test_few_but_wide_rows_are_not_broadcast(spark):
    wide = spark.range(20).selectExpr("cast(id as string) AS dic_code", "repeat('x', 3000000) AS dic_name")
    assert "ResolvedHint" not in bounded_broadcast(wide)._jdf.queryExecution().analyzed().toString()
    narrow = wide.withColumn("dic_name", F.substring("dic_name", 1, 9))
    assert "ResolvedHint" in bounded_broadcast(narrow)._jdf.queryExecution().analyzed().toString()


def test_jdbc_arguments_are_filled_or_refused():
    sql = "select * from t where a = ? and b = '?' and c = ? and d = ? and e = ? and f = ?"
    assert filled(sql, [1, "x?y", None, True, 2.5]) == (
        "select * from t where a = 1 and b = '?' and c = 'x?y' and d = NULL and e = TRUE and f = 2.5")
    for bad in ("a'b", "a\\", 'a"', "a\nb", float("nan"), object()):
        with pytest.raises(ValueError):
            filled("select ?", [bad])
    for args in ([], [1, 2]):
        with pytest.raises(ValueError):
            filled("select ?", args)


def test_snake_to_camel():
    assert snake_to_camel("sink_columns") == "sinkColumns"
    assert snake_to_camel("source_table") == "sourceTable"


def test_refund_streams_equal_batch(spark, scratch):
    from tests.test_streaming import rows_of, shuffled_chunks, write_files
    from quayside.streaming import jobs, launcher
    tables = ["order_refund_info", "order_info", "refund_payment"]
    raw = replay.ods_db(spark, SF_SMALL).filter(F.col("_table").isin(tables))
    texts = [r[0] for r in raw.select("value").collect()]
    folder = write_files(f"{scratch}/ods", shuffled_chunks(texts, 3))
    s1 = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(folder)
    launcher.run_available(jobs.order_refund(s1, base_dic(spark)).drop("row_op_ts"),
                           "refund_t", checkpoint=f"{scratch}/ck1")
    assert rows_of(spark.table("refund_t")) == rows_of(Q.trade_order_refund(spark, SF_SMALL))
    s2 = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(folder)
    launcher.run_available(jobs.refund_pay_suc(s2, base_dic(spark)).drop("row_op_ts"),
                           "refund_pay_t", checkpoint=f"{scratch}/ck2")
    assert rows_of(spark.table("refund_pay_t")) == \
        rows_of(Q.trade_refund_pay_suc(spark, SF_SMALL))


def test_fan_out_routes_rows_by_topic(spark):
    from quayside.sources.sinks import fan_out
    a = spark.createDataFrame([("1", 2)], "id string, n long")
    b = spark.createDataFrame([({"k": "v"},), ({"k": "w"},)], "m map<string,string>")
    out = fan_out({"t_a": a, "t_b": b}).collect()
    assert sorted((r["topic"], r["value"]) for r in out) == [
        ("t_a", '{"id":"1","n":2}'), ("t_b", '{"k":"v"}'), ("t_b", '{"k":"w"}')]
