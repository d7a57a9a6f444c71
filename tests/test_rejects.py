"""Side outputs of cleaning in one pass, and topics read without repeats."""

import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from quayside.operators import rejects
from quayside.operators.cdc import clean_ods
from quayside.schemas import DWD_TRADE_CART_ADD
from quayside.sources import replay, sinks
from quayside.sources.logs import clean_log
from quayside.sources.ods import parse_ods_db
from quayside.streaming import launcher
from tests.conftest import SF_SMALL
from tests.test_streaming import rows_of, write_files


def rec(**changed):
    r = {"database": "shop", "table": "t", "type": "insert", "ts": 1, "data": {"id": "1"}}
    return json.dumps({k: v for k, v in (r | changed).items() if v is not ...})


CHANGES = {
    rec(): None, rec(type="bootstrap-insert"): None, rec(type="update", old={"id": "0"}): None,
    "": "not_a_record", "{bad": "not_a_record", "7": "not_a_record", "{}": "not_a_record",
    rec(database="x"): "other_database", rec(database=...): "other_database",
    rec(type="delete"): "other_operation", rec(type=...): "other_operation",
    rec(data={}): "no_data", rec(data=...): "no_data"}


def test_change_reasons(spark):
    raw = spark.createDataFrame([(t,) for t in CHANGES] + [(None,)], "value string")
    got = {r["value"]: r["reason"] for r in rejects.tagged_changes(raw).collect()}
    assert got == CHANGES | {None: "not_a_record"}
    kept = rejects.accepted(rejects.tagged_changes(raw))
    assert rows_of(kept, kept.columns) == rows_of(clean_ods(parse_ods_db(raw)), kept.columns)


def test_log_reasons(spark):
    texts = {'{"common":{"mid":"m"},"ts":1}': None, "not json": "not_a_record",
             "[1]": "not_a_record", '{"ts":1}': "no_device", '{"common":{"uid":"u"}}': "no_device"}
    raw = spark.createDataFrame([(t,) for t in texts], "value string")
    tagged = rejects.tagged_log(raw)
    assert {r["value"]: r["reason"] for r in tagged.collect()} == texts
    assert rejects.accepted(tagged).count() == clean_log(raw).count() == 1


def test_empty_topic(spark):
    raw = spark.createDataFrame([], "value string")
    assert rejects.by_reason(rejects.tagged_changes(raw)).count() == 0
    assert rejects.split(rejects.tagged_log(raw), "t").count() == 0


def test_main_and_side_output_and_counts_from_one_scan(spark, scratch):
    folder = write_files(f"{scratch}/raw", [list(CHANGES)])
    tagged = rejects.tagged_changes(spark.read.text(folder))
    seen = Observation("changes")
    counted = tagged.observe(seen, F.count("*").alias("all"),
                             F.count(F.when(F.col("reason").isNull(), 1)).alias("ok"))
    out = rejects.split(counted, "clean")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan text") == 1
    rows = out.collect()
    assert seen.get == {"all": len(CHANGES), "ok": 3}
    assert sorted(r["value"] for r in rows if r["topic"] == "clean") == sorted(
        t for t, why in CHANGES.items() if why is None)
    side = [json.loads(r["value"]) for r in rows if r["topic"] == "clean_rejected"]
    assert {(s["value"], s["reason"]) for s in side} == {
        (t, why) for t, why in CHANGES.items() if why}


def test_stream_counts_reasons(spark, scratch):
    folder = write_files(f"{scratch}/raw", [list(CHANGES)])
    tagged = rejects.tagged_changes(spark.readStream.text(folder))
    counted = rejects.counted(tagged, "changes", rejects.CHANGE_REASONS)
    q = launcher.run_available(rejects.split(counted, "clean"), "rejects_t",
                               checkpoint=f"{scratch}/ck")
    seen = [p["observedMetrics"]["changes"].asDict() for p in q.recentProgress
            if p["observedMetrics"]]
    assert {"accepted": 3, "not_a_record": 4, "other_database": 2, "other_operation": 2,
            "no_data": 2} in seen
    assert spark.table("rejects_t").groupBy("topic").count().collect()


def records(spark, rows):
    return spark.createDataFrame(rows, "key string, value string, offset long")


def test_repeats_go_and_versions_stay(spark):
    topic = records(spark, [("a", "1", 0), ("a", "1", 5), ("a", "2", 1), ("b", "1", 2),
                            (None, "1", 3), (None, "1", 4), ("b", None, 6), ("b", None, 7)])
    got = sinks.unique_records(topic).select("key", "value").collect()
    assert sorted((r["key"] or "", r["value"] or "") for r in got) == [
        ("", "1"), ("", "1"), ("a", "1"), ("a", "2"), ("b", ""), ("b", "1")]


def test_stream_written_twice_reads_once(spark, scratch):
    """Every micro-batch of the topic is written again by a later one."""
    from quayside.plans import queries as Q
    written = sinks.upsert_records(Q.trade_cart_add(spark, SF_SMALL))
    lines = [json.dumps({"key": r["key"], "value": r["value"], "at": 1_000_000 + i})
             for i, r in enumerate(written.collect())]
    half = len(lines) // 2
    folder = write_files(f"{scratch}/topic", [lines[:half], lines[half:], lines[:half], lines[half:]])
    stream = (spark.readStream.schema("key string, value string, at long")
              .option("maxFilesPerTrigger", 1).json(folder)
              .withColumn("timestamp", F.timestamp_seconds("at")))
    with pytest.raises(ValueError, match="watermark"):
        sinks.unique_records(stream)
    unique = sinks.unique_records(stream, "1 hour")
    launcher.run_available(sinks.read_json_records(unique, DWD_TRADE_CART_ADD).drop("timestamp"),
                           "unique_t", checkpoint=f"{scratch}/ck")
    assert rows_of(spark.table("unique_t")) == rows_of(Q.trade_cart_add(spark, SF_SMALL))


def test_replayed_topics_are_counted_whole(spark):
    raw = replay.ods_log(spark, SF_SMALL)
    assert sum(r["n"] for r in rejects.by_reason(rejects.tagged_log(raw)).collect()) == raw.count()
