"""Batch/stream parity and replay: the same transforms over file streams
(one file per micro-batch, in arrival order) give the batch results."""

import json
import os

import pytest
from pyspark.sql import functions as F

from quayside.operators import dims, trade, traffic, wordcount
from quayside.plans import queries as Q
from quayside.sources import replay
from quayside.sources.dictionary import base_dic
from quayside.sources.logs import clean_log
from quayside.sources.rules import parse_rule_changes, rule_change_texts
from quayside.streaming import jobs, launcher, merge
from tests.conftest import SF_SMALL


def write_files(folder, chunks, fmt="text"):
    """One JSON-lines file per chunk, modification times one second apart."""
    os.makedirs(folder, exist_ok=True)
    for i, chunk in enumerate(chunks):
        p = os.path.join(folder, f"part-{i:04d}.json")
        with open(p, "w") as f:
            for row in chunk:
                f.write((row if fmt == "text" else json.dumps(row)) + "\n")
        os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))
    return folder


def closing_records(tables, ts=4_000_000_000):
    """One far-future record per input table: every watermark passes, and
    the keys match nothing, so no result row comes from them."""
    out = []
    for t in tables:
        data = {"id": f"closing-{t}", "order_id": f"closing-{t}",
                "order_detail_id": f"closing-{t}", "payment_status": "1602"}
        old = {"payment_status": "1601"} if t == "payment_info" else None
        r = {"database": "shop", "table": t, "type": "update" if old else "insert",
             "ts": ts, "data": data}
        if old:
            r["old"] = old
        out.append(json.dumps(r))
    return out


def rows_of(df, cols=None):
    cols = cols or sorted(df.columns)
    rows = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


def table_rows(spark, name, cols):
    return rows_of(spark.table(name), cols)


def test_cart_add_stream_equals_batch(spark, scratch):
    raw = replay.ods_db(spark, SF_SMALL).filter(F.col("_table") == "cart_info")
    texts = [r[0] for r in raw.select("value").collect()]
    folder = write_files(f"{scratch}/ods", [texts[i::3] for i in range(3)])
    stream = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(folder)
    out = jobs.cart_add(stream, base_dic(spark))
    launcher.run_available(out, "cart_add_t", checkpoint=f"{scratch}/ck")
    got = spark.table("cart_add_t").select(
        F.from_json("value", "id string, sku_num string, ts long").alias("r")).select("r.*")
    want = Q.trade_cart_add(spark, SF_SMALL).select("id", "sku_num", "ts")
    assert rows_of(got) == rows_of(want) and got.count() > 0


def _log_chunks(spark, n):
    raw = replay.ods_log(spark, SF_SMALL)
    ts = F.get_json_object("value", "$.ts").cast("long")
    pdf = raw.select("value", "offset", ts.alias("t")).toPandas()
    pdf["t"] = pdf["t"].fillna(-1)
    pdf = pdf.sort_values(["t", "offset"])
    recs = [{"value": v, "offset": int(o)} for v, o in zip(pdf["value"], pdf["offset"])]
    size = (len(recs) + n - 1) // n
    return [recs[i:i + size] for i in range(0, len(recs), size)]


def test_is_new_repair_stream_equals_batch(spark, scratch):
    folder = write_files(f"{scratch}/log", _log_chunks(spark, 3), fmt="json")
    stream = (spark.readStream.schema("value string, offset long")
              .option("maxFilesPerTrigger", 1).json(folder))
    from quayside.streaming import state
    fixed = state.repair_is_new_stream(state.key_columns(stream))
    launcher.run_available(fixed.select("offset", "is_new"), "is_new_t",
                           checkpoint=f"{scratch}/ck")
    got = table_rows(spark, "is_new_t", ["offset", "is_new"])
    batch = traffic.repair_is_new(clean_log(replay.ods_log(spark, SF_SMALL)))
    want = rows_of(batch.select("offset", F.col("common")["is_new"].alias("is_new")),
                   ["offset", "is_new"])
    assert got == want
    assert len({r[1] for r in got}) == 2


def test_traffic_topics_stream_counts(spark, scratch):
    folder = write_files(f"{scratch}/log", _log_chunks(spark, 2), fmt="json")
    stream = spark.readStream.schema("value string, offset long").json(folder)
    launcher.run_available(jobs.traffic_topics(stream), "traffic_t", checkpoint=f"{scratch}/ck")
    got = dict(spark.table("traffic_t").groupBy("topic").count().collect())
    want = dict(Q.traffic_topic_counts(spark, SF_SMALL).collect())
    assert got == want


def test_word_count_update_mode(spark, scratch):
    names = [r[0] for r in replay.word_lines(spark, SF_SMALL).collect()]
    folder = write_files(f"{scratch}/words", [names[i::2] for i in range(2)])
    stream = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(folder)
    launcher.run_available(jobs.word_count(stream), "wc_t", output_mode="update",
                           checkpoint=f"{scratch}/ck")
    updates = spark.table("wc_t")
    final = updates.groupBy("word").agg(F.max("n").alias("n"))
    want = wordcount.word_counts(replay.word_lines(spark, SF_SMALL))
    assert rows_of(final) == rows_of(want)
    # a word seen in both batches was emitted twice (running totals)
    assert updates.count() > final.count()


def shuffled_chunks(texts, n, seed=5):
    """The records in random order over n micro-batches: a match may come many
    micro-batches, and in event time days, before or after its other side."""
    import random
    texts = list(texts)
    random.Random(seed).shuffle(texts)
    return [texts[i::n] for i in range(n)]


def last_by(df, key, order="row_op_ts"):
    from quayside.operators.upsert import latest_by_key
    return latest_by_key(df, key, [order]).drop(order)


def test_order_detail_stream_equals_batch_in_any_order(spark, scratch):
    tables = ["order_detail", "order_info", "order_detail_activity", "order_detail_coupon"]
    raw = replay.ods_db(spark, SF_SMALL).filter(F.col("_table").isin(tables))
    texts = [r[0] for r in raw.select("value").collect()]
    folder = write_files(f"{scratch}/ods", shuffled_chunks(texts, 4))
    stream = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(folder)
    launcher.run_available(jobs.order_detail(stream, base_dic(spark)), "od_t",
                           checkpoint=f"{scratch}/ck")
    got = spark.table("od_t")
    want = Q.trade_order_detail(spark, SF_SMALL)
    assert rows_of(last_by(got, "id")) == rows_of(want)
    # some details came out before their activity or coupon was known
    assert got.count() > want.count()


def test_late_matches_join_without_a_bound(spark, scratch):
    """A refund is paid an hour after its request, an order arrives behind
    the others: both are kept; with a bound they would be lost."""
    def rec(table, kind, ts, data, old=None):
        r = {"database": "shop", "table": table, "type": kind, "ts": ts, "data": data}
        return json.dumps(r | ({"old": old} if old else {}))
    line = {"id": "r1", "order_id": "9", "sku_id": "5", "refund_num": "1", "refund_status": "0705"}
    paid = {"id": "p1", "order_id": "9", "sku_id": "5", "payment_type": "1101",
            "callback_time": "2020-01-01 00:00:00", "total_amount": "1.00", "refund_status": "0702"}
    order = {"id": "9", "user_id": "1", "province_id": "2", "order_status": "1006"}
    chunks = [[rec("order_refund_info", "insert", 1000, line)],
              [rec("refund_payment", "insert", 4600, paid)],
              [rec("order_info", "update", 4600, order, {"order_status": "1001"})],
              [rec("order_refund_info", "insert", 900, line | {"id": "r2", "refund_num": "3"})]]
    folder = write_files(f"{scratch}/ods", chunks)
    stream = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(folder)
    launcher.run_available(jobs.refund_pay_suc(stream, base_dic(spark)), "late_t",
                           checkpoint=f"{scratch}/ck")
    assert sorted(r.refund_num for r in spark.table("late_t").collect()) == ["1", "3"]
    with pytest.raises(ValueError):
        jobs.refund_pay_suc(stream, base_dic(spark), bound=60)


def test_dimension_merge_is_idempotent(spark, scratch):
    rules = dims.active_rules(parse_rule_changes(rule_change_texts(spark)))
    topic = replay.ods_db(spark, SF_SMALL).filter(
        F.col("_table").isin("user_info", "sku_info", "base_province", "supplier_info"))
    kind = F.get_json_object("value", "$.type")
    inserts = topic.filter(kind != "update").select("value")
    updates = topic.filter(kind == "update").select("value")
    db = "dim_merge_t"
    merge.upsert_dims(inserts, 0, rules, target_database=db)
    merge.upsert_dims(updates, 1, rules, target_database=db)
    merge.upsert_dims(updates, 1, rules, target_database=db)   # replayed batch
    got = merge.read_dim(spark, "dim_user_info", database=db)
    want = Q.dim_upsert_user(spark, SF_SMALL)
    assert rows_of(got) == rows_of(want)
    assert rows_of(merge.read_dim(spark, "dim_sku_info", database=db)) == \
        rows_of(Q.dim_upsert_sku(spark, SF_SMALL))
    assert not spark.catalog.tableExists(f"{db}.dim_base_province")


def test_dimension_stream_with_foreach_batch(spark, scratch):
    topic = replay.ods_db(spark, SF_SMALL).filter(F.col("_table").isin("user_info", "sku_info"))
    texts = [r[0] for r in topic.select("value").collect()]
    ins = [t for t in texts if '"type":"update"' not in t]
    upd = [t for t in texts if '"type":"update"' in t]
    folder = write_files(f"{scratch}/ods", [ins, upd])
    stream = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(folder)

    def load_changes(s):
        return parse_rule_changes(rule_change_texts(s))

    def load_rules(s):
        return dims.active_rules(load_changes(s))

    db = "dim_stream_t"
    launcher.run_available(stream, "dim_stream", checkpoint=f"{scratch}/ck",
                           foreach_batch=jobs.dim_upsert_batch(load_rules, target_database=db,
                                                               changes_loader=load_changes))
    got = merge.read_dim(spark, "dim_user_info", database=db)
    assert rows_of(got) == rows_of(Q.dim_upsert_user(spark, SF_SMALL))
    # tables come from the rule DDL (run once, before the first merge)
    props = {r["key"]: r["value"] for r in
             spark.sql(f"SHOW TBLPROPERTIES {db}.dim_sku_info").collect()}
    assert props["extend"] == "SALT_BUCKETS=3"
    assert spark.table(f"{db}._rule_ddl_applied").count() == 5


def test_stream_restart_resumes_from_checkpoint(spark, scratch):
    raw = replay.ods_db(spark, SF_SMALL).filter(F.col("_table") == "cart_info")
    texts = [r[0] for r in raw.select("value").collect()]
    folder = write_files(f"{scratch}/ods", [texts[:len(texts) // 2]])
    out_dir = f"{scratch}/out"
    ck = f"{scratch}/ck"

    def run():
        s = spark.readStream.format("text").load(folder)
        launcher.run_available(jobs.cart_add(s, base_dic(spark)), "restart_t", sink="text",
                               path=out_dir, checkpoint=ck)

    run()
    first = spark.read.text(out_dir).count()
    run()   # nothing new: no duplicates
    assert spark.read.text(out_dir).count() == first
    write_files(f"{scratch}/ods2", [texts[len(texts) // 2:]])
    os.rename(f"{scratch}/ods2/part-0000.json", f"{folder}/part-0001.json")
    run()
    assert spark.read.text(out_dir).count() == Q.trade_cart_add(spark, SF_SMALL).count()


@pytest.mark.parametrize("bound", [trade.PAYMENT_BOUND_SECONDS])
def test_pay_detail_stream_matches_bounded_batch(spark, scratch, bound):
    tables = ["order_detail", "order_info", "order_detail_activity", "order_detail_coupon",
              "payment_info"]
    raw = replay.ods_db(spark, SF_SMALL).filter(F.col("_table").isin(tables))
    od_topic = jobs.order_detail_topic(Q.order_detail_topic(spark, SF_SMALL))
    od_texts = [r[0] for r in od_topic.select("value").collect()]
    ods_texts = [r[0] for r in raw.select("value").collect()]
    closing = closing_records(["payment_info"])
    od_dir = write_files(f"{scratch}/od", [od_texts])
    ods_dir = write_files(f"{scratch}/ods", [ods_texts, closing])
    od_s = spark.readStream.format("text").load(od_dir)
    ods_s = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(ods_dir)
    pay = jobs.pay_detail_suc(od_s, ods_s, base_dic(spark), bound=bound,
                              watermark="5 seconds").drop("row_op_ts")
    launcher.run_available(pay, "pay_t", checkpoint=f"{scratch}/ck")
    got = spark.table("pay_t")
    want = Q.pay_within_ttl(spark, SF_SMALL)
    assert rows_of(got) == rows_of(want)


def test_pay_and_cancel_streams_equal_batch_in_any_order(spark, scratch):
    raw = replay.ods_db(spark, SF_SMALL).filter(F.col("_table").isin("payment_info", "order_info"))
    od_topic = jobs.order_detail_topic(Q.order_detail_topic(spark, SF_SMALL))
    od_dir = write_files(f"{scratch}/od", shuffled_chunks(
        [r[0] for r in od_topic.select("value").collect()], 2))
    ods_dir = write_files(f"{scratch}/ods", shuffled_chunks(
        [r[0] for r in raw.select("value").collect()], 3))

    def src(folder):
        return spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(folder)
    dic = base_dic(spark)
    launcher.run_available(jobs.pay_detail_suc(src(od_dir), src(ods_dir), dic), "pay_any",
                           checkpoint=f"{scratch}/ck1")
    assert rows_of(spark.table("pay_any").drop("row_op_ts")) == rows_of(
        Q.trade_pay_detail_suc(spark, SF_SMALL))
    launcher.run_available(jobs.cancel_detail(src(od_dir), src(ods_dir), "1002"), "cancel_any",
                           checkpoint=f"{scratch}/ck2")
    assert rows_of(spark.table("cancel_any").drop("row_op_ts")) == rows_of(
        Q.trade_cancel_detail(spark, SF_SMALL))


def test_every_kafka_job_builds_and_runs_on_files(spark, scratch):
    """Each runnable job, with its Kafka source swapped for landed files,
    produces a streaming frame that a query can start and drain."""
    from quayside.streaming import apps
    raw = replay.ods_db(spark, SF_SMALL).filter(F.col("_table").isin(
        "cart_info", "order_detail", "order_info", "payment_info", "order_refund_info",
        "refund_payment"))
    folders = {
        apps.TOPIC_ODS_DB: write_files(f"{scratch}/ods", [[r[0] for r in
                                                           raw.select("value").collect()]]),
        apps.TOPIC_ODS_LOG: write_files(f"{scratch}/log", _log_chunks(spark, 1), fmt="json"),
        apps.TOPIC_WORDS_IN: write_files(f"{scratch}/w", [["a b a"]]),
        apps.TOPIC_DWD_TRADE_ORDER_DETAIL: write_files(f"{scratch}/od", [[r[0] for r in
            jobs.order_detail_topic(Q.order_detail_topic(spark, SF_SMALL)).select("value")
            .limit(50).collect()]]),
    }

    def src(topic):
        if topic == apps.TOPIC_ODS_LOG:
            return spark.readStream.schema("value string, offset long").json(folders[topic])
        return spark.readStream.text(folders[topic])

    rules = dims.active_rules(parse_rule_changes(rule_change_texts(spark)))
    for job in apps.KAFKA_JOBS:
        df, topic, mode = apps.build(job, src, base_dic(spark), rules=rules,
                                     cancel_code="1002")
        assert "value" in df.columns
        if job not in ("log", "word_count", "dwd_route"):
            assert "key" in df.columns
        launcher.run_available(df, f"app_{job}", sink="noop", output_mode=mode,
                               checkpoint=f"{scratch}/ck/{job}")
    with pytest.raises(ValueError):
        apps.build("nope", src)
    with pytest.raises(ValueError):
        apps.build("cancel_detail", src)


def test_dwd_route_stream_equals_batch(spark, scratch):
    raw = replay.ods_db(spark, SF_SMALL).filter(F.col("_table") == "cart_info")
    folder = write_files(f"{scratch}/ods", [[r[0] for r in raw.select("value").collect()]])
    rules = dims.active_rules(parse_rule_changes(rule_change_texts(spark)))
    out = jobs.dwd_route(spark.readStream.text(folder), rules)
    launcher.run_available(out, "dwd_route_t", checkpoint=f"{scratch}/ck")
    got = spark.table("dwd_route_t").select(
        "topic", F.from_json("value", "id string, user_id string, sku_id string").alias("d"))
    got = got.select(F.col("topic").alias("sink_table"), "d.*")
    want = Q.dwd_route(spark, SF_SMALL).select("sink_table", "id", "user_id", "sku_id")
    assert rows_of(got) == rows_of(want)


def test_merge_into_tables_created_by_rule_ddl(spark, scratch):
    """DDL from the rule stream first (bucketed sku table), then merges."""
    db = "dim_ddl_merge_t"
    changes = parse_rule_changes(rule_change_texts(spark))
    dims.apply_ddl(spark, changes, database=db)
    rules = dims.active_rules(changes)
    topic = replay.ods_db(spark, SF_SMALL).filter(F.col("_table").isin("user_info", "sku_info"))
    merge.upsert_dims(topic.select("value"), 0, rules, target_database=db)
    merge.upsert_dims(topic.select("value"), 0, rules, target_database=db)  # replay
    merge.upsert_dims(topic.select("value"), 1, rules, target_database=db, compact_every=1)
    assert rows_of(merge.read_dim(spark, "dim_sku_info", database=db)) == \
        rows_of(Q.dim_upsert_sku(spark, SF_SMALL))
    # older partitions stay for running readers until the next compaction
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {db}.dim_sku_info").collect()] == \
        ["_batch=0", "_batch=2", "_batch=3"]
    assert rows_of(merge.read_dim(spark, "dim_user_info", database=db)) == \
        rows_of(Q.dim_upsert_user(spark, SF_SMALL))


def test_compaction_keeps_last_rows_and_few_partitions(spark, scratch):
    rules = dims.active_rules(parse_rule_changes(rule_change_texts(spark)))
    topic = replay.ods_db(spark, SF_SMALL).filter(F.col("_table") == "user_info")
    kind = F.get_json_object("value", "$.type")
    inserts = topic.filter(kind != "update").select("value")
    updates = topic.filter(kind == "update").select("value")
    db = "dim_compact_t"
    batches = [inserts, updates, inserts.limit(0), updates, inserts.limit(0)]
    for b, frame in enumerate(batches):
        merge.upsert_dims(frame, b, rules, target_database=db, compact_every=2)
    want = rows_of(Q.dim_upsert_user(spark, SF_SMALL))
    assert rows_of(merge.read_dim(spark, "dim_user_info", database=db)) == want
    parts = [r[0] for r in spark.sql(f"SHOW PARTITIONS {db}.dim_user_info").collect()]
    # compacted at batches 1 and 3; batches 2 and 4 had no rows and wrote nothing
    assert parts == ["_batch=3", "_batch=6", "_batch=7"]
    # replaying an old batch after compaction changes nothing
    merge.upsert_dims(inserts, 0, rules, target_database=db, compact_every=2)
    assert rows_of(merge.read_dim(spark, "dim_user_info", database=db)) == want
    # replaying the compacting batch compacts again, still correct
    merge.upsert_dims(updates, 3, rules, target_database=db, compact_every=2)
    assert rows_of(merge.read_dim(spark, "dim_user_info", database=db)) == want


def _change(table, kind, ts, data, offset, partition=0):
    return (json.dumps({"database": "shop", "table": table, "type": kind, "ts": ts, "data": data}),
            partition, offset)


def _rule(spark, columns, pk, table="sku_attr"):
    return spark.createDataFrame(
        [(table, "ALL", "dim_" + table, "dim", columns, pk, None, 1)],
        "source_table string, source_type string, sink_table string, sink_type string, "
        "sink_columns string, sink_pk string, sink_extend string, seq long")


def test_dimension_rows_win_by_arrival_and_by_whole_key(spark, scratch):
    rules = _rule(spark, "sku_id, attr_id ,name", "sku_id, attr_id")
    rows = [_change("sku_attr", "update", 5, {"sku_id": "1", "attr_id": "a", "name": "old"}, 0),
            _change("sku_attr", "insert", 5, {"sku_id": "1", "attr_id": "a", "name": "new"}, 1),
            _change("sku_attr", "insert", 5, {"sku_id": "1", "attr_id": "b", "name": "x"}, 2),
            _change("sku_attr", "insert", 5, {"sku_id": "2", "attr_id": "a", "name": "y"}, 3),
            _change("sku_attr", "insert", 5, {"sku_id": "3", "name": "no key"}, 4)]
    batch = spark.createDataFrame(rows, "value string, partition int, offset long")
    db = "dim_composite_t"
    assert merge.upsert_dims(batch, 0, rules, target_database=db) == 1
    assert merge.upsert_dims(batch, 0, rules, target_database=db) == 1     # replayed
    got = merge.read_dim(spark, "dim_sku_attr", "sku_id,attr_id", db)
    assert rows_of(got, ["sku_id", "attr_id", "name"]) == [
        ("1", "a", "new"), ("1", "b", "x"), ("2", "a", "y")]
    rejected = spark.table(f"{db}._rejected").collect()
    assert [(r.sink_table, json.loads(r.data)["sku_id"]) for r in rejected] == [("dim_sku_attr", "3")]
    # a batch without rows of a table leaves that table alone
    other = spark.createDataFrame([_change("nobody", "insert", 9, {"id": "1"}, 9)], batch.schema)
    assert merge.upsert_dims(other, 1, rules, target_database=db) == 0


def test_a_new_checkpoint_starts_a_new_generation(spark, scratch):
    rules = _rule(spark, "id,name", None, "gen")
    db = "dim_generation_t"

    def run(name, values, checkpoint):
        folder = write_files(f"{scratch}/{name}", [
            [_change("gen", "insert", 1, {"id": "1", "name": v}, 0)[0]] for v in values])
        s = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(folder)
        launcher.run_available(s, name, checkpoint=f"{scratch}/{checkpoint}",
                               foreach_batch=jobs.dim_upsert_batch(lambda _: rules,
                                                                   target_database=db))
    run("gen_a", ["v0", "v1", "v2"], "ck_a")
    assert rows_of(merge.read_dim(spark, "dim_gen", database=db)) == [("1", "v2")]
    run("gen_b", ["after reset"], "ck_b")
    assert rows_of(merge.read_dim(spark, "dim_gen", database=db)) == [("1", "after reset")]
    assert spark.table(f"{db}._generations").count() == 2


def test_upsert_rows_with_equal_times_keep_the_last_arrival(spark):
    rows = spark.createDataFrame([("1", "zzz", 7, 0), ("1", "aaa", 7, 1)],
                                 "id string, v string, ts long, offset long")
    merge.upsert_rows(rows, 0, "ties", "id", ["ts"], database="dwd_ties_t")
    assert rows_of(merge.read_dim(spark, "ties", database="dwd_ties_t"), ["id", "v"]) == [("1", "aaa")]


def test_landing_stream_partitions_by_table(spark, scratch):
    from quayside.sources.ods import read_landed_ods_db
    raw = replay.ods_db(spark, SF_SMALL).filter(F.col("_table").isin("cart_info", "order_info"))
    folder = write_files(f"{scratch}/ods", [[r[0] for r in raw.select("value").collect()]])
    q = jobs.start_landing(spark.readStream.text(folder), f"{scratch}/landed",
                           checkpoint=f"{scratch}/ck", available_now=True)
    q.awaitTermination()
    assert sorted(os.listdir(f"{scratch}/landed")) == \
        ["_spark_metadata", "_table=cart_info", "_table=order_info"]
    landed = read_landed_ods_db(spark, f"{scratch}/landed")
    got = trade.trade_cart_add(landed, base_dic(spark))
    assert rows_of(got) == rows_of(Q.trade_cart_add(spark, SF_SMALL))


def test_upsert_topic_kept_as_table(spark, scratch):
    """A2 stream form: two versions of each order detail arrive in two
    micro-batches; the table keeps the later one per id (and compacts)."""
    from quayside.schemas import DWD_TRADE_ORDER_DETAIL
    od = trade.trade_order_detail(Q.ods(spark, SF_SMALL), base_dic(spark),
                                  row_op_ts=F.timestamp_seconds(F.col("ts")))
    later = (od.withColumn("coupon_id", F.coalesce("coupon_id", F.lit("x")))
               .withColumn("row_op_ts", F.col("row_op_ts") + F.expr("INTERVAL 1 SECOND")))
    texts = [[r[0] for r in jobs.order_detail_topic(v).select("value").collect()]
             for v in (od, later)]
    folder = write_files(f"{scratch}/od", texts)
    stream = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(folder)
    launcher.run_available(stream, "od_upsert", checkpoint=f"{scratch}/ck",
                           foreach_batch=jobs.upsert_table_batch(
                               "trade_order_detail", DWD_TRADE_ORDER_DETAIL,
                               database="dwd_upsert_t", compact_every=2))
    got = merge.read_dim(spark, "trade_order_detail", "id", "dwd_upsert_t").drop("row_op_ts")
    assert rows_of(got) == rows_of(Q.upsert_latest_by_key(spark, SF_SMALL))
    parts = [r[0] for r in spark.sql("SHOW PARTITIONS dwd_upsert_t.trade_order_detail").collect()]
    # the query's first generation: two merges and the compaction after them
    assert [divmod(int(p.split("=")[1]), 1 << 40) for p in parts] == [(1, 0), (1, 2), (1, 3)]


def test_rule_ddl_stream_and_text_source(spark, scratch):
    """Rule changes as their own stream: each micro-batch's DDL in order;
    a replayed batch changes nothing."""
    from quayside.sources.kafka import text_stream
    texts = [r[0] for r in rule_change_texts(spark).collect()]
    folder = write_files(f"{scratch}/rules", [texts[:3], texts[3:]])
    db = "dim_rule_stream_t"
    launcher.run_available(text_stream(spark, folder, max_files_per_trigger=1), "rule_ddl",
                           checkpoint=f"{scratch}/ck", foreach_batch=jobs.rule_ddl_batch(db))
    names = {t.name for t in spark.catalog.listTables(db) if not t.isTemporary}
    assert names == {"dim_user_info", "dim_sku_info", "_rule_ddl_applied"}
    cols = [c.name for c in spark.catalog.listColumns(f"{db}.dim_user_info")]
    assert cols == ["id", "name", "province_id", "_batch"]
    jobs.rule_ddl_batch(db)(spark.createDataFrame([(t,) for t in texts], "value string"), 0)
    assert spark.table(f"{db}._rule_ddl_applied").count() == 5


def test_dimension_stream_restart_from_checkpoint(spark, scratch):
    """Run the DIM stream, stop, land more changes, restart from the same
    checkpoint, then restart once more with nothing new: the tables match
    the batch result and do not change on the idle restart."""
    topic = replay.ods_db(spark, SF_SMALL).filter(F.col("_table").isin("user_info", "sku_info"))
    texts = [r[0] for r in topic.select("value").collect()]
    ins = [t for t in texts if '"type":"update"' not in t]
    upd = [t for t in texts if '"type":"update"' in t]
    folder = f"{scratch}/ods"
    write_files(folder, [ins])
    db = "dim_restart_t"

    def load_changes(s):
        return parse_rule_changes(rule_change_texts(s))

    def run():
        stream = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(folder)
        launcher.run_available(stream, "dim_restart", checkpoint=f"{scratch}/ck",
                               foreach_batch=jobs.dim_upsert_batch(
                                   lambda s: dims.active_rules(load_changes(s)),
                                   target_database=db, changes_loader=load_changes))

    run()
    first = rows_of(merge.read_dim(spark, "dim_user_info", database=db))
    assert len(first) == spark.read.parquet(f"{SF_SMALL}/customer.parquet").count()
    write_files(f"{scratch}/more", [upd])
    os.rename(f"{scratch}/more/part-0000.json", f"{folder}/part-0001.json")
    run()
    want = rows_of(Q.dim_upsert_user(spark, SF_SMALL))
    assert rows_of(merge.read_dim(spark, "dim_user_info", database=db)) == want
    parts = [r[0] for r in spark.sql(f"SHOW PARTITIONS {db}.dim_user_info").collect()]
    run()   # nothing new: no batch, no change
    assert rows_of(merge.read_dim(spark, "dim_user_info", database=db)) == want
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {db}.dim_user_info").collect()] == parts


def test_rules_and_dictionary_rows_added_while_running(spark, scratch):
    """Both are read anew in every micro-batch: the second one sees a rule and
    a dictionary row that were landed after the first."""
    def cart(i):
        return _change("cart_info", "insert", 1, {"id": str(i), "user_id": "u", "sku_id": "s",
                                                 "source_type": "2405", "sku_num": "1"}, 0)[0]
    folder = write_files(f"{scratch}/ods", [[cart(1)], [cart(2)]])
    dic_path, rules_path = f"{scratch}/dic", f"{scratch}/rules"
    base_dic(spark).write.parquet(dic_path)
    spark.createDataFrame([("{}",)], "value string").write.text(rules_path)
    seen = {"cart": [], "dwd": []}

    def land_more(kind, batch_id):
        if batch_id == 0 and kind == "cart":
            spark.sql("SELECT '2405' AS dic_code, 'late' AS dic_name").write.mode(
                "append").parquet(dic_path)
        if batch_id == 0 and kind == "dwd":
            rule_change_texts(spark).write.mode("append").text(rules_path)

    def collect(kind):
        def write(frame, batch_id):
            seen[kind].append([r.value for r in frame.collect()])
            land_more(kind, batch_id)
        return write

    from quayside.sources.dictionary import read_base_dic_parquet
    from quayside.streaming import apps

    def run(kind, transform):
        s = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(folder)
        launcher.run_available(s, f"live_{kind}", checkpoint=f"{scratch}/ck_{kind}",
                               foreach_batch=jobs.per_batch(transform, collect(kind)))
    run("cart", lambda b: apps.cart_add_records(b, read_base_dic_parquet(spark, dic_path), "shop"))
    run("dwd", lambda b: jobs.dwd_route(b, dims.active_rules(parse_rule_changes(
        spark.read.text(rules_path)))))
    assert [len(x) for x in seen["cart"]] == [0, 1] and "late" in seen["cart"][1][0]
    assert [len(x) for x in seen["dwd"]] == [0, 1]
