"""Change-log parsing and filters on small hand-made records."""

import json

from pyspark.sql import functions as F

from quayside.operators import trade, traffic
from quayside.operators.cdc import changes, clean_ods, transitioned
from quayside.sources.dictionary import base_dic
from quayside.sources.logs import clean_log, rejected_log
from quayside.sources.ods import parse_ods_db


def _raw(spark, records):
    texts = [r if isinstance(r, str) else json.dumps(r) for r in records]
    return spark.createDataFrame([(t,) for t in texts], "value string")


def rec(table, typ, data, old=None, db="shop", ts=1):
    r = {"database": db, "table": table, "type": typ, "ts": ts, "data": data}
    if old is not None:
        r["old"] = old
    return r


def test_clean_drops_dirty_records_and_strips_prefix(spark):
    raw = _raw(spark, [
        "{bad",
        rec("t", "insert", {"id": 1}, db="other"),
        rec("t", "delete", {"id": 2}),
        rec("t", "insert", {}),
        rec("t", "bootstrap-insert", {"id": 3, "note": "bootstrap-insert"}),
        rec("t", "update", {"id": 4}, {"x": "1"}),
        rec("t", "bootstrap-start", {"id": 5}),
    ])
    got = clean_ods(parse_ods_db(raw)).select(F.col("data")["id"], "type",
                                              F.col("data")["note"]).collect()
    # prefix removed from the type only; values keep their text
    assert sorted(map(tuple, got)) == [("3", "insert", "bootstrap-insert"), ("4", "update", None)]


def test_numbers_in_maps_become_text(spark):
    raw = _raw(spark, [rec("t", "insert", {"id": 7, "price": 12.50, "n": None})])
    d = parse_ods_db(raw).first()["data"]
    assert d == {"id": "7", "price": "12.5", "n": None}


def test_transitioned_needs_changed_field(spark):
    raw = _raw(spark, [
        rec("payment_info", "update", {"order_id": 1, "payment_status": "1602"},
            {"payment_status": "1601"}),
        rec("payment_info", "update", {"order_id": 2, "payment_status": "1602"},
            {"callback_time": "x"}),
        rec("payment_info", "insert", {"order_id": 3, "payment_status": "1602"}),
        rec("payment_info", "update", {"order_id": 4, "payment_status": "1601"},
            {"payment_status": "1600"}),
    ])
    got = transitioned(parse_ods_db(raw), "payment_info", "payment_status", "1602").collect()
    assert [r["data"]["order_id"] for r in got] == ["1"]


def test_cart_add_growth_and_bad_numbers(spark):
    raw = _raw(spark, [
        rec("cart_info", "insert", {"id": 1, "source_type": "2401", "sku_num": "3"}),
        rec("cart_info", "update", {"id": 2, "source_type": "2401", "sku_num": "5"},
            {"sku_num": "2"}),
        rec("cart_info", "update", {"id": 3, "source_type": "2401", "sku_num": "1"},
            {"sku_num": "2"}),
        rec("cart_info", "update", {"id": 4, "source_type": "2401", "sku_num": "abc"},
            {"sku_num": "2"}),
        rec("cart_info", "update", {"id": 5, "source_type": "2401", "sku_num": "9"},
            {"source_type": "0"}),
        rec("cart_info", "insert", {"id": 6, "source_type": "2405", "sku_num": "1"}),
    ])
    got = trade.trade_cart_add(parse_ods_db(raw), base_dic(spark)).select("id", "sku_num",
                                                                           "source_type_name")
    assert sorted(map(tuple, got.collect())) == [("1", "3", "n2401"), ("2", "3", "n2401")]


def test_changes_respects_landing_partition(spark):
    raw = spark.createDataFrame(
        [(json.dumps(rec("a", "insert", {"id": 1})), "a"),
         (json.dumps(rec("b", "insert", {"id": 2})), "b")], "value string, _table string")
    assert changes(parse_ods_db(raw), "a").count() == 1


def test_log_rejects(spark):
    raw = spark.createDataFrame(
        [("not json", 1), ("[1]", 2), ('{"ts":1}', 3), ('{"common":{"mid":"m1"},"ts":5}', 4)],
        "value string, offset long")
    assert [r["common"]["mid"] for r in clean_log(raw).collect()] == ["m1"]
    assert rejected_log(raw).count() == 3


def test_refund_paid_strict_filters(spark):
    """The status filters the reference left commented out."""
    def both(tbl, status, key):
        return [rec(tbl, "insert", {**key, "refund_status": status}),
                rec(tbl, "update", {**key, "refund_status": status}, {"refund_status": "x"})]
    key = {"id": "r1", "order_id": "9", "sku_id": "5", "payment_type": "1101",
           "callback_time": "2024-01-02 03:04:05", "total_amount": "1.00", "refund_num": "2"}
    raw = _raw(spark, both("refund_payment", "0702", key)
               + both("order_refund_info", "0705", key)
               + [rec("order_info", "update", {"id": "9", "user_id": "u", "province_id": "p",
                                               "order_status": "1006"},
                      {"order_status": "1001"})])
    ods = parse_ods_db(raw)
    relaxed = trade.trade_refund_pay_suc(ods, base_dic(spark))
    strict = trade.trade_refund_pay_suc(ods, base_dic(spark), strict=True)
    assert relaxed.count() == 4          # every type, 2 payments x 2 lines
    assert strict.count() == 1
    r = strict.first()
    assert (r["date_id"], r["payment_type_name"], r["refund_num"]) == ("2024-01-02", "n1101", "2")


def test_split_merge_rules(spark):
    """Common wins on equal keys; displays get the record ts, actions
    keep theirs; error keeps `err`, page drops it; start is whole."""
    from quayside.operators import traffic
    recs = [
        {"common": {"mid": "m1", "is_new": "1"}, "page": {"page_id": "home"},
         "displays": [{"item": "7", "mid": "child"}], "actions": [{"action_id": "a", "ts": "5"}],
         "err": {"code": "1"}, "ts": 100},
        {"common": {"mid": "m2"}, "start": {"entry": "icon"}, "displays": [{"item": "1"}],
         "ts": 200},
    ]
    raw = spark.createDataFrame([(json.dumps(r), i) for i, r in enumerate(recs)],
                                "value string, offset long")
    out = traffic.split_log(clean_log(raw))
    d = out[traffic.TOPIC_DISPLAY].first()["display"]
    assert d == {"item": "7", "mid": "m1", "is_new": "1", "ts": "100"}
    a = out[traffic.TOPIC_ACTION].first()["action"]
    assert a == {"action_id": "a", "ts": "5", "mid": "m1", "is_new": "1"}
    e = out[traffic.TOPIC_ERR].first()
    assert e["err"] == {"code": "1"} and "displays" not in out[traffic.TOPIC_ERR].columns
    p = out[traffic.TOPIC_PAGE]
    assert p.count() == 1 and "err" not in p.columns
    s = out[traffic.TOPIC_START].first()
    assert s["start"] == {"entry": "icon"} and s["displays"] == [{"item": "1"}]
    topics = dict(traffic.split_as_topics(clean_log(raw)).groupBy("topic").count().collect())
    assert topics == {traffic.TOPIC_DISPLAY: 1, traffic.TOPIC_ACTION: 1, traffic.TOPIC_ERR: 1,
                      traffic.TOPIC_PAGE: 1, traffic.TOPIC_START: 1}


def test_open_records_keep_unknown_fields_and_types(spark):
    rec = {"common": {"mid": "m", "is_new": "1", "n": 7}, "page": {"id": 3}, "ts": 5, "x": [1, "a"],
           "displays": [{"item": 2, "n": 0}], "actions": [{"action_id": 1, "ts": 9}], "err": {"code": 1}}
    start = {"common": {"mid": "m", "is_new": 1}, "start": {"e": True}, "ts": 6, "deep": {"a": {"b": 1.5}}}
    raw = spark.createDataFrame([(json.dumps(rec), 0, 4), (json.dumps(start), 0, 5)],
                                "value string, partition int, offset long")
    log = clean_log(raw, record=True)
    repaired = log.withColumn("common", F.expr(
        "map_concat(map_filter(common, (k, v) -> k != 'is_new'), map('is_new', '0'))"))
    out = {r.key: (r.topic, json.loads(r.value)) for r in traffic.split_as_topics(repaired).collect()}
    common = rec["common"] | {"is_new": "0"}
    page = {k: v for k, v in rec.items() if k not in ("displays", "actions", "err")} | {"common": common}
    assert out["0-4-0"] == ("dwd_traffic_display", {"item": 2, "ts": 5} | common)
    assert out["0-4-1"] == ("dwd_traffic_action", {"action_id": 1, "ts": 9} | common)
    assert out["0-4-2"] == ("dwd_traffic_err", page | {"err": {"code": 1}})
    assert out["0-4-3"] == ("dwd_traffic_page", page)
    assert out["0-5-0"] == ("dwd_traffic_start", start | {"common": {"mid": "m", "is_new": "0"}})
    same = {r.key: json.loads(r.value) for r in traffic.split_as_topics(log).collect()}
    assert same["0-5-0"] == start        # nothing repaired: the number stays a number


def test_records_without_a_time_fix_no_day(spark):
    day = 86_400_000
    raw = spark.createDataFrame([(json.dumps({"common": {"mid": "a", "is_new": "1"}} | t), i) for i, t in
                                 enumerate([{}, {"ts": 3 * day}, {"ts": 5 * day}])]
                                + [(json.dumps({"common": {"mid": "b", "is_new": "1"}}), 9)],
                                "value string, offset long")
    fixed = traffic.repair_is_new(clean_log(raw))
    assert {(r.offset, r.common["is_new"]) for r in fixed.collect()} == {
        (0, "1"), (1, "1"), (2, "0"), (9, "1")}
