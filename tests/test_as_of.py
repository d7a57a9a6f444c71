"""Rules, names and table epochs as of a record's arrival."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.operators import as_of, dims
from quayside.operators.cdc import clean_ods
from quayside.schemas import RULE_FIELDS
from quayside.sources.dictionary import base_dic, read_base_dic_parquet
from quayside.sources.ods import parse_ods_db
from quayside.sources.rules import parse_rule_changes
from quayside.streaming import apps, jobs, launcher, merge
from tests.test_streaming import write_files

COLUMNS = ["id", "id,a", "id,a,b"]


def rule(table, columns):
    return dict(zip(RULE_FIELDS, [table, "ALL", f"dim_{table}", "dim", columns, "id", None]))


def rule_text(op, table, at, columns="id", seq=None):
    r = rule(table, columns)
    return json.dumps({"op": op, "before": r if op in "du" else None,
                       "after": None if op == "d" else r, "ts_ms": at, "seq": seq})


def record(table, kind, key, **data):
    return json.dumps({"database": "shop", "table": table, "type": kind, "ts": 1,
                       "data": {"id": key, **data}})


def fold(changes, records):
    """Rules, tables and their rows by handling one record at a time."""
    rules, tables, routed = {}, {}, []
    merged = sorted([(at, 0, i, c) for i, (at, *c) in enumerate(changes)]
                    + [(at, 1, i, c) for i, (at, *c) in enumerate(records)], key=lambda x: x[:3])
    for at, kind, _, what in merged:
        if kind == 0:
            op, table, columns = what
            if op == "d":
                rules.pop(table, None)
                tables.pop(table, None)
            else:
                rules[table] = columns
                if op == "u":
                    tables.pop(table, None)
        elif what[0] in rules:
            table, key = what
            names = rules[table].split(",")
            routed.append((f"dim_{table}", key, at, len(names)))
            tables.setdefault(table, {})[key] = (at, len(names))
    rows = [(f"dim_{t}", k, *v) for t, held in tables.items() for k, v in held.items()]
    return sorted(routed), sorted(rows)


def frames(spark, changes, records):
    log = parse_rule_changes(spark.createDataFrame(
        [(rule_text(op, t, at, cols, seq),) for seq, (at, op, t, cols) in enumerate(changes)],
        "value string"), timed=True)
    raw = spark.createDataFrame([(record(t, "insert", k, a="1", b="2"), at) for at, t, k in records],
                                "value string, at long")
    clean = clean_ods(parse_ods_db(raw.select("value", F.timestamp_millis("at").alias("timestamp"))))
    return log, as_of.arrival_millis(clean)


TABLE = st.sampled_from(["s", "t"])


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 12), st.sampled_from("crud"), TABLE,
                          st.sampled_from(COLUMNS)), min_size=1, max_size=8),
       st.lists(st.tuples(st.integers(-1, 14), TABLE, st.sampled_from("xyz")), min_size=1,
                max_size=10, unique_by=lambda r: (r[0], r[1], r[2])))
def test_equals_the_fold_of_one_record_at_a_time(spark, changes, records):
    changes = sorted(changes, key=lambda c: c[0])
    log, clean = frames(spark, changes, records)
    routed = as_of.route_as_of(clean, as_of.rule_versions(log))
    want_routed, want_rows = fold(changes, records)
    got = [(r["sink_table"], r["pk"], r["arrival"], len(r["data"])) for r in routed.collect()]
    assert sorted(got) == want_routed
    left = as_of.surviving_rows(routed, as_of.table_epochs(log))
    last = dims.latest_by_key(left.select("sink_table", "pk", "arrival", F.size("data").alias("n")),
                              ["sink_table", "pk"], ["arrival"])
    assert sorted(tuple(r) for r in last.select("sink_table", "pk", "arrival", "n").collect()) \
        == want_rows


def test_no_changes_and_no_records(spark):
    log, clean = frames(spark, [(5, "c", "t", "id")], [(1, "t", "x")])
    none = as_of.rule_versions(log.limit(0))
    assert as_of.route_as_of(clean, none).count() == 0
    assert as_of.route_as_of(clean.limit(0), as_of.rule_versions(log)).count() == 0
    assert as_of.table_epochs(log).count() == 0


def test_preloaded_rules_hold_from_the_beginning(spark):
    from quayside.sources.rules import preload_rules
    log, clean = frames(spark, [(5, "u", "t", "id,a")], [(1, "t", "x"), (6, "t", "y")])
    preload = preload_rules(spark.createDataFrame([tuple(rule("t", "id").values())],
                                                  ", ".join(f"{f} string" for f in RULE_FIELDS)))
    rows = as_of.route_as_of(clean, as_of.rule_versions(log, preload)).collect()
    assert sorted((r["pk"], len(r["data"])) for r in rows) == [("x", 1), ("y", 2)]


def test_epochs_are_counted(spark):
    log, clean = frames(spark, [(0, "c", "t", "id"), (5, "u", "t", "id"), (8, "d", "t", "id"),
                                (9, "c", "t", "id")],
                        [(at, "t", str(at)) for at in (1, 5, 7, 10)])
    routed = as_of.in_epochs(as_of.route_as_of(clean, as_of.rule_versions(log)),
                             as_of.table_epochs(log))
    assert sorted((r["arrival"], r["epoch"], r["last"]) for r in routed.collect()) == [
        (1, 0, False), (5, 1, False), (7, 1, False), (10, 2, True)]


def test_dictionary_by_time(spark):
    def entry(kind, code, name, ts):
        return (json.dumps({"database": "shop", "table": "base_dic", "type": kind, "ts": ts,
                            "data": {"dic_code": code, "dic_name": name}}),)
    log = spark.createDataFrame([
        entry("bootstrap-insert", "1", "one", 10), entry("update", "1", "uno", 20),
        entry("delete", "1", "uno", 30), entry("insert", "1", "eins", 40),
        entry("insert", None, "x", 1), entry("insert", "2", None, 5), ("{bad",)], "value string")
    versions = as_of.dictionary_versions(parse_ods_db(log))
    facts = spark.createDataFrame([(str(ts), "1", ts) for ts in (9, 10, 19, 20, 30, 39, 40, 99)]
                                  + [("n", None, 50), ("t", "1", None), ("2", "2", 6)],
                                  "id string, code string, ts long")
    got = {r["id"]: r["name"] for r in as_of.lookup_as_of(facts, versions, "code", "name").collect()}
    assert got == {"10": "one", "19": "one", "20": "uno", "40": "eins", "99": "eins", "2": None}


def test_versions_beyond_the_broadcast_bound(spark, monkeypatch):
    log, clean = frames(spark, [(0, "c", "t", "id"), (3, "u", "t", "id,a")],
                        [(1, "t", "x"), (4, "t", "y")])
    rows = as_of.route_as_of(clean, as_of.rule_versions(log), max_rules=0)
    assert "BroadcastHashJoin" not in rows._jdf.queryExecution().sparkPlan().toString()
    assert sorted(len(r["data"]) for r in rows.collect()) == [1, 2]


def test_dim_stream_routes_by_arrival(spark, scratch):
    """A rule is replaced while records are under way: rows of before are lost,
    rows of after have the new column, and a repeated batch changes nothing."""
    changes = [(0, "c", "as_of_t", "id"), (50, "u", "as_of_t", "id,a")]
    lines = [[json.dumps({"value": record("as_of_t", "insert", k, a=k * 2), "offset": i, "at": at})
              for i, (k, at) in enumerate(rows)]
             for rows in ([("x", 10), ("y", 60)], [("z", 40), ("w", 70)])]
    folder = write_files(f"{scratch}/ods", lines)
    stream = (spark.readStream.schema("value string, offset long, at long")
              .option("maxFilesPerTrigger", 1).json(folder)
              .select("value", "offset", F.timestamp_millis("at").alias("timestamp")))

    def load(timed):
        texts = [(rule_text(op, t, at, c, i),) for i, (at, op, t, c) in enumerate(changes)]
        return lambda s: parse_rule_changes(s.createDataFrame(texts, "value string"), timed=timed)

    fn = jobs.dim_upsert_batch(lambda s: dims.active_rules(load(False)(s)),
                               target_database="dim_as_of_t", changes_loader=load(False),
                               log_loader=load(True))

    def twice(batch, batch_id):
        fn(batch, batch_id)
        fn(batch, batch_id)

    launcher.run_available(stream, "dim_as_of", checkpoint=f"{scratch}/ck", foreach_batch=twice)
    got = merge.read_dim(spark, "dim_as_of_t", "id", "dim_as_of_t")
    assert sorted((r["id"], r["a"]) for r in got.collect()) == [("w", "ww"), ("y", "yy")]


def change(table, kind, data, old=None, ts=1):
    r = {"database": "shop", "table": table, "type": kind, "ts": ts, "data": data}
    return json.dumps(r | ({"old": old} if old else {}))


def detail(i):
    return {"id": f"d{i}", "order_id": str(i), "sku_id": "5", "sku_name": "s", "sku_num": "1",
            "create_time": "2020-01-01 00:00:00", "source_id": "1", "source_type": "2405",
            "order_price": "1.00", "split_total_amount": "1.00"}


def order(i, status):
    return change("order_info", "update", {"id": str(i), "user_id": "1", "province_id": "2",
                                           "order_status": status}, {"order_status": "1001"})


def job_records(job, i):
    """Change-log and detail-topic records that give one joined row."""
    if job == "order_detail":
        return [change("order_detail", "insert", detail(i)),
                change("order_info", "insert", {"id": str(i), "user_id": "1"})], []
    if job == "pay_detail_suc":
        return [change("payment_info", "update",
                       {"user_id": "1", "order_id": str(i), "payment_type": "1104",
                        "payment_status": "1602"}, {"payment_status": "1601"})], \
            [json.dumps({"id": f"d{i}", "order_id": str(i), "ts": 1})]
    line = {"id": f"d{i}", "order_id": str(i), "sku_id": "5", "refund_num": "1",
            "refund_type": "1501", "refund_reason_type": "1304"}
    if job == "order_refund":
        return [change("order_refund_info", "insert", line), order(i, "1005")], []
    return [change("order_refund_info", "insert", line), order(i, "1006"),
            change("refund_payment", "insert", {"id": f"d{i}", "order_id": str(i), "sku_id": "5",
                                                "payment_type": "1104"})], []


@pytest.mark.parametrize("job", apps.NAMED_JOBS)
def test_a_code_added_mid_stream_names_later_rows(spark, scratch, job):
    dic_path = f"{scratch}/dic"
    base_dic(spark).write.parquet(dic_path)
    both = [job_records(job, i) for i in (1, 2)]
    folders = {apps.TOPIC_ODS_DB: write_files(f"{scratch}/ods", [b[0] for b in both])}
    if both[0][1]:
        folders[apps.TOPIC_DWD_TRADE_ORDER_DETAIL] = write_files(
            f"{scratch}/od", [b[1] for b in both])

    def src(topic):
        return spark.readStream.option("maxFilesPerTrigger", 1).text(folders[topic])

    seen = {}

    def write(frame, batch_id):
        seen[batch_id] = [r["value"] for r in frame.collect()]
        if batch_id == 0:
            spark.sql("SELECT * FROM VALUES ('2405', 'late'), ('1104', 'late'), ('1304', 'late')"
                      " AS t(dic_code, dic_name)").write.mode("append").parquet(dic_path)

    joined, named, _ = apps.named_job(job, src)
    launcher.run_available(joined, f"fresh_{job}", checkpoint=f"{scratch}/ck",
                           foreach_batch=jobs.named_per_batch(
                               named, lambda s: read_base_dic_parquet(s, dic_path), write))
    assert seen[0] == []
    later = [json.loads(v) for k, rows in seen.items() if k for v in rows]
    assert {r.get("id", r.get("order_detail_id")) for r in later} == {"d2"}
    assert all("late" in r.values() for r in later)
