"""Rules: fold, routing, pruning, DDL."""

import json

from quayside.operators import dims
from quayside.operators.cdc import clean_ods
from quayside.sources.ods import parse_ods_db
from quayside.sources.rules import (
    RULE_CHANGES, parse_rule_changes, preload_rules, rule_change_texts,
)


def _rules(spark):
    return parse_rule_changes(rule_change_texts(spark))


def test_debezium_image_pick(spark):
    r = {row["seq"]: row for row in _rules(spark).collect()}
    assert r[5]["op"] == "d" and r[5]["source_table"] == "base_province"
    assert r[4]["sink_columns"] == "id,name,province_id"
    assert r[2]["sink_pk"] is None and r[3]["sink_pk"] == ""


def test_fold_drops_deleted_rules(spark):
    act = dims.active_rules(_rules(spark))
    got = {(r["source_table"], r["source_type"]): r["sink_columns"] for r in act.collect()}
    assert got == {("user_info", "ALL"): "id,name,province_id",
                   ("sku_info", "ALL"): "id,sku_name,brand",
                   ("cart_info", "insert"): "id,user_id,sku_id"}
    assert dims.rules_of(act, "dwd").count() == 1


def test_preload_is_overridden_by_changes(spark):
    pre = preload_rules(spark.createDataFrame(
        [("user_info", "ALL", "dim_user_info", "dim", "id", "id", None),
         ("supplier_info", "ALL", "dim_supplier_info", "dim", "id,name", None, None)],
        "source_table string, source_type string, sink_table string, sink_type string, "
        "sink_columns string, sink_pk string, sink_extend string"))
    act = dims.active_rules(_rules(spark), pre)
    got = {r["source_table"]: r["sink_columns"] for r in act.collect()}
    assert got["user_info"] == "id,name,province_id"
    assert got["supplier_info"] == "id,name"


def test_route_prunes_columns_and_keys_blank_pk(spark):
    rules = spark.createDataFrame(
        [("t", "ALL", "dim_t", "dim", "id,name", "  ", None)],
        "source_table string, source_type string, sink_table string, sink_type string, "
        "sink_columns string, sink_pk string, sink_extend string")
    recs = [{"database": "shop", "table": "t", "type": "insert", "ts": 1,
             "data": {"id": "1", "name": "a", "secret": "s"}},
            {"database": "shop", "table": "u", "type": "insert", "ts": 1, "data": {"id": "2"}}]
    raw = spark.createDataFrame([(json.dumps(r),) for r in recs], "value string")
    out = dims.route(clean_ods(parse_ods_db(raw)), rules).collect()
    assert len(out) == 1
    assert out[0]["data"] == {"id": "1", "name": "a"}
    assert (out[0]["pk"], out[0]["sink_pk"], out[0]["op_type"]) == ("1", "id", "insert")


def test_ddl_statements_follow_ops(spark):
    stmts = dims.ddl_statements(_rules(spark)).orderBy("seq", "step").collect()
    by = [(r["seq"], r["sql"]) for r in stmts]
    assert by[0][1].startswith("CREATE TABLE IF NOT EXISTS dim.dim_user_info (id STRING,"
                               "name STRING, _batch BIGINT)")
    assert "CLUSTERED BY (id) INTO 3 BUCKETS" in by[1][1]
    assert [s for q, s in by if q == 4][0] == "DROP TABLE IF EXISTS dim.dim_user_info"
    assert [s for q, s in by if q == 4][1].startswith(
        "CREATE TABLE IF NOT EXISTS dim.dim_user_info (id STRING,name STRING,"
        "province_id STRING")
    assert [s for q, s in by if q == 5] == ["DROP TABLE IF EXISTS dim.dim_base_province"]
    assert all(q != 6 for q, _ in by)  # dwd rule: no dimension table


def test_apply_ddl_creates_and_drops(spark):
    dims.apply_ddl(spark, _rules(spark), database="dim_ddl_t")
    names = {t.name for t in spark.catalog.listTables("dim_ddl_t") if not t.isTemporary}
    assert names == {"dim_user_info", "dim_sku_info", "_rule_ddl_applied"}
    cols = [c.name for c in spark.catalog.listColumns("dim_ddl_t.dim_user_info")]
    assert cols == ["id", "name", "province_id", "_batch"]
    props = {r["key"]: r["value"] for r in
             spark.sql("SHOW TBLPROPERTIES dim_ddl_t.dim_sku_info").collect()}
    assert props["pk"] == "id" and props["extend"] == "SALT_BUCKETS=3"


def test_fixture_rule_count():
    assert len(RULE_CHANGES) == 6


def test_apply_ddl_is_safe_to_repeat(spark):
    db = "dim_ddl_repeat_t"
    first = dims.apply_ddl(spark, _rules(spark), database=db)
    spark.sql(f"INSERT INTO {db}.dim_user_info VALUES ('1', 'a', '2', 0)")
    again = dims.apply_ddl(spark, _rules(spark), database=db)
    assert again == []                     # nothing re-run, rows kept
    assert spark.table(f"{db}.dim_user_info").count() == 1
    assert any("DROP TABLE IF EXISTS" in s for s in first)
    # a new update of the user rule replaces the table (rows are lost)
    from quayside.sources.rules import change_text
    more = spark.createDataFrame([(change_text(7, "u", {
        "source_table": "user_info", "source_type": "ALL", "sink_table": "dim_user_info",
        "sink_type": "dim", "sink_columns": "id,name", "sink_pk": "id",
        "sink_extend": None}),)], "value string")
    ran = dims.apply_ddl(spark, _rules(spark).unionByName(parse_rule_changes(more)), database=db)
    assert len(ran) == 2 and spark.table(f"{db}.dim_user_info").count() == 0
    assert [c.name for c in spark.catalog.listColumns(f"{db}.dim_user_info")] == \
        ["id", "name", "_batch"]


def test_connector_changes_are_ordered_by_binlog_position(spark):
    import json
    rule = {"source_table": "t", "source_type": "ALL", "sink_table": "dim_t", "sink_type": "dim",
            "sink_columns": "id, name", "sink_pk": None, "sink_extend": None}

    def text(op, file, pos, columns):
        return json.dumps({"op": op, "before": None, "after": rule | {"sink_columns": columns},
                           "source": {"file": file, "pos": pos}, "ts_ms": 5})
    texts = [text("u", "mysql-bin.000010", 4, "id,c"), text("r", "mysql-bin.000009", 999, "id,a"),
             text("u", "mysql-bin.000009", 1000, "id,b")]
    changes = parse_rule_changes(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert [r.sink_columns for r in changes.orderBy("seq").collect()] == ["id,a", "id,b", "id,c"]
    assert dims.active_rules(changes).first().sink_columns == "id,c"
    bare = parse_rule_changes(spark.createDataFrame([(json.dumps(
        {"op": "c", "before": None, "after": rule}),)], "value string"))
    assert dims.active_rules(bare).first().sink_table == "dim_t"


def test_ddl_backlog_is_run_in_chunks(spark):
    db = "dim_ddl_chunks_t"
    ran = dims.apply_ddl(spark, _rules(spark), database=db, chunk=2)
    assert len(ran) == 6 and dims.apply_ddl(spark, _rules(spark), database=db, chunk=2) == []


def test_blanks_in_the_column_list(spark):
    rows = spark.createDataFrame([("shop", "t", "insert", 1, {"id": "1", "name": "n", "x": "y"})],
                                 "database string, table string, type string, ts long, "
                                 "data map<string,string>")
    rules = spark.createDataFrame([("t", "ALL", "dim_t", "dim", " id , name,", " ", None)],
                                  "source_table string, source_type string, sink_table string, "
                                  "sink_type string, sink_columns string, sink_pk string, "
                                  "sink_extend string")
    row = dims.route(rows, rules).first()
    assert row.data == {"id": "1", "name": "n"} and row.pk == "1"
