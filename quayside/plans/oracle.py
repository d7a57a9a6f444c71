"""DuckDB SQL oracles, written directly against the given tables.

Each oracle recomputes a query's answer from the parquet tables without the
JSON round trip, following the replay rules in `FIXTURES.md`. Shared pieces
are CTEs; DuckDB drops the ones a query does not use.
"""

from __future__ import annotations

# The dictionary of FIXTURES.md, stated here on its own so that
# a wrong one in the library shows. 2405, 1104 and 1304 have no entry.
DICTIONARY = ("2401 2402 2403 2404 1101 1102 1103 1501 1502 1503 1301 1302 1303 "
              "1001 1002 1005 1006 1601 1602 0702 0705").split()


def _dic_values() -> str:
    return ", ".join(f"('{c}', 'n{c}')" for c in DICTIONARY)


# Replayed source rows, one CTE per change-log table, fields as text.
CTES = {
    "dic": f"SELECT * FROM (VALUES {_dic_values()}) AS t(dic_code, dic_name)",
    "cart": """
        SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id,
               json_extract_string(props, '$.k') AS sku_id,
               CAST(event_id AS VARCHAR) AS source_id,
               '240' || CAST(1 + event_id % 5 AS VARCHAR) AS source_type,
               CAST(CAST(floor(value) AS INTEGER) AS VARCHAR) AS sku_num,
               CASE event_type WHEN 'signup' THEN 'insert' WHEN 'click' THEN 'update'
                    WHEN 'view' THEN 'update' WHEN 'purchase' THEN 'delete'
                    WHEN 'error' THEN 'bootstrap-insert' END AS type,
               CASE WHEN event_type = 'click' THEN json_extract_string(props, '$.k') END
                   AS old_sku_num,
               CAST(epoch_us(ts) // 1000000 AS BIGINT) AS ts
        FROM events""",
    "li": """
        SELECT l.*, o.o_custkey, o.o_orderdate, o.o_orderstatus,
               concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                         CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
                         strftime(l_shipdate, '%Y%m%d')) AS lid,
               CAST(epoch_us(o.o_orderdate) // 1000000 AS BIGINT) AS ots
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "od": """
        SELECT lid AS id, CAST(l_orderkey AS VARCHAR) AS order_id,
               CAST(l_partkey AS VARCHAR) AS sku_id, p_name AS sku_name,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time,
               CAST(l_suppkey AS VARCHAR) AS source_id,
               '240' || CAST(1 + l_linenumber % 5 AS VARCHAR) AS source_type,
               CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS sku_num,
               CAST(CAST(p_retailprice AS DECIMAL(16,2)) AS VARCHAR) AS order_price,
               CAST(CAST(CAST(l_quantity AS INTEGER) AS DECIMAL(16,2))
                    * CAST(p_retailprice AS DECIMAL(16,2)) AS VARCHAR) AS split_original_amount,
               CAST(CAST(l_extendedprice AS DECIMAL(16,2)) AS VARCHAR) AS split_total_amount,
               '0.00' AS split_activity_amount, '0.00' AS split_coupon_amount,
               ots AS ts
        FROM li JOIN part p ON li.l_partkey = p.p_partkey""",
    "oi": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
               CAST(c_nationkey AS VARCHAR) AS province_id, o_orderstatus,
               CASE o_orderstatus WHEN 'P' THEN '1005' WHEN 'F' THEN '1006'
                    WHEN 'O' THEN '1002' END AS new_status,
               CAST(epoch_us(o_orderdate) // 1000000 AS BIGINT) AS ts
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "act": """
        SELECT lid AS order_detail_id, CAST(l_suppkey AS VARCHAR) AS activity_id,
               CAST(l_linenumber AS VARCHAR) AS activity_rule_id
        FROM li WHERE l_returnflag = 'A'""",
    "cou": """
        SELECT lid AS order_detail_id, CAST(l_partkey % 7 AS VARCHAR) AS coupon_id
        FROM li WHERE l_linestatus = 'F'""",
    "pay": """
        SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(o_orderkey AS VARCHAR) AS order_id,
               '110' || CAST(1 + o_orderkey % 4 AS VARCHAR) AS payment_type,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS callback_time,
               CAST(epoch_us(o_orderdate) // 1000000 AS BIGINT) + 60 * (o_orderkey % 60) AS ts,
               o_orderkey % 2 = 0 AS status_changed
        FROM orders WHERE o_orderstatus = 'F'""",
    "ri": """
        SELECT lid AS id, CAST(o_custkey AS VARCHAR) AS user_id,
               CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS sku_id,
               '150' || CAST(1 + l_linenumber % 3 AS VARCHAR) AS refund_type,
               CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS refund_num,
               CAST(CAST(l_extendedprice AS DECIMAL(16,2)) AS VARCHAR) AS refund_amount,
               '130' || CAST(1 + l_suppkey % 4 AS VARCHAR) AS refund_reason_type,
               'r' || CAST(l_suppkey AS VARCHAR) AS refund_reason_txt,
               strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS create_time,
               ots AS ts
        FROM li WHERE l_returnflag = 'R'""",
    "rp": """
        SELECT lid AS id, CAST(l_orderkey AS VARCHAR) AS order_id,
               CAST(l_partkey AS VARCHAR) AS sku_id,
               '110' || CAST(1 + l_orderkey % 4 AS VARCHAR) AS payment_type,
               strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS callback_time,
               CAST(CAST(l_extendedprice AS DECIMAL(16,2)) AS VARCHAR) AS total_amount,
               ots AS ts
        FROM li WHERE l_returnflag = 'R' AND l_linestatus = 'F'""",
    # Status updates of refunds, and all changes of a table.
    "ri_up": """
        SELECT * REPLACE (ts + 3600 AS ts) FROM ri WHERE CAST(order_id AS BIGINT) % 3 = 0""",
    "rp_up": """
        SELECT * REPLACE (ts + 86400 AS ts) FROM rp WHERE CAST(order_id AS BIGINT) % 2 = 0""",
    "ri_all": "SELECT * FROM ri UNION ALL SELECT * FROM ri_up",
    "rp_all": "SELECT * FROM rp UNION ALL SELECT * FROM rp_up",
}


def with_ctes(body: str) -> str:
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in CTES.items())
    return f"WITH {ctes}\n{body}"


ORACLES: dict[str, str] = {}


def oracle(name: str, body: str) -> None:
    ORACLES[name] = with_ctes(body)


CART_ADD = """
SELECT c.id, c.user_id, c.sku_id, c.source_id, c.source_type AS source_type_code,
       d.dic_name AS source_type_name,
       CASE WHEN c.type = 'insert' THEN c.sku_num
            ELSE CAST(TRY_CAST(c.sku_num AS INTEGER) - TRY_CAST(c.old_sku_num AS INTEGER) AS VARCHAR)
       END AS sku_num,
       c.ts
FROM cart c JOIN dic d ON c.source_type = d.dic_code
WHERE c.type = 'insert'
   OR (c.type = 'update' AND c.old_sku_num IS NOT NULL
       AND TRY_CAST(c.sku_num AS INTEGER) > TRY_CAST(c.old_sku_num AS INTEGER))"""
oracle("trade_cart_add", CART_ADD)

# order detail ⋈ order ⟕ activity ⟕ coupon ⋈ dictionary
ORDER_DETAIL_SELECT = """
SELECT od.id, od.order_id, oi.user_id, od.sku_id, od.sku_name, oi.province_id,
       act.activity_id, act.activity_rule_id, cou.coupon_id,
       strftime(CAST(od.create_time AS TIMESTAMP), '%Y-%m-%d') AS date_id,
       od.create_time, od.source_id, od.source_type AS source_type_code,
       d.dic_name AS source_type_name, od.sku_num, od.split_original_amount,
       od.split_activity_amount, od.split_coupon_amount, od.split_total_amount, od.ts
FROM od
JOIN oi ON od.order_id = oi.id
LEFT JOIN act ON od.id = act.order_detail_id
LEFT JOIN cou ON od.id = cou.order_detail_id
JOIN dic d ON od.source_type = d.dic_code"""
CTES["tod"] = ORDER_DETAIL_SELECT

oracle("trade_order_detail", "SELECT * FROM tod")

# Every record of the replayed change log: database, table, type, ts, whether
# `old` is present, and the number of `data` fields (NULL: text not JSON).
CTES["topic"] = """
SELECT 'shop' AS database, 'cart_info' AS "table", type, ts,
       type = 'update' AS has_old, 6 AS n_fields FROM cart
UNION ALL SELECT NULL, NULL, NULL, NULL, false, NULL FROM events WHERE event_id % 97 = 0
UNION ALL SELECT 'other_shop', 'cart_info', 'insert', CAST(epoch_us(ts) // 1000000 AS BIGINT),
       false, 2 FROM events WHERE event_id % 97 <> 0 AND event_id % 101 = 0
UNION ALL SELECT 'shop', 'cart_info', 'insert', CAST(epoch_us(ts) // 1000000 AS BIGINT),
       false, 0 FROM events
       WHERE event_id % 97 <> 0 AND event_id % 101 <> 0 AND event_id % 103 = 0
UNION ALL SELECT 'shop', 'order_info', 'insert', ts, false, 4 FROM oi
UNION ALL SELECT 'shop', 'order_info', 'update', ts, true, 4 FROM oi WHERE new_status IS NOT NULL
UNION ALL SELECT 'shop', 'order_detail', 'insert', ts, false, 12 FROM od
UNION ALL SELECT 'shop', 'order_detail_activity', 'insert', ots, false, 3
       FROM li WHERE l_returnflag = 'A'
UNION ALL SELECT 'shop', 'order_detail_coupon', 'insert', ots, false, 2
       FROM li WHERE l_linestatus = 'F'
UNION ALL SELECT 'shop', 'payment_info', 'update', ts, true, 5 FROM pay
UNION ALL SELECT 'shop', 'order_refund_info', 'insert', ts, false, 11 FROM ri
UNION ALL SELECT 'shop', 'refund_payment', 'insert', ts, false, 7 FROM rp
UNION ALL SELECT 'shop', 'order_refund_info', 'update', ts, true, 11 FROM ri_up
UNION ALL SELECT 'shop', 'refund_payment', 'update', ts, true, 7 FROM rp_up
UNION ALL SELECT 'shop', 'user_info', 'insert', 0, false, 4 FROM customer
UNION ALL SELECT 'shop', 'user_info', 'update', 1, true, 4 FROM customer WHERE c_custkey % 10 = 0
UNION ALL SELECT 'shop', 'sku_info', 'bootstrap-insert', 0, false, 4 FROM part
UNION ALL SELECT 'shop', 'base_province', 'insert', 0, false, 3 FROM nation
UNION ALL SELECT 'shop', 'supplier_info', 'insert', 0, false, 2 FROM supplier"""

oracle("ods_envelope_parse", """
SELECT database, "table", type, count(*) AS n, CAST(COALESCE(sum(ts), 0) AS BIGINT) AS sum_ts,
       CAST(count(*) FILTER (WHERE has_old) AS BIGINT) AS n_old,
       CAST(sum(COALESCE(n_fields, 0)) AS BIGINT) AS n_fields
FROM topic GROUP BY ALL""")

oracle("ods_clean", """
SELECT "table", regexp_replace(type, '^bootstrap-', '') AS type, count(*) AS n,
       CAST(sum(ts) AS BIGINT) AS sum_ts, CAST(sum(n_fields) AS BIGINT) AS n_fields
FROM topic
WHERE database = 'shop' AND regexp_replace(type, '^bootstrap-', '') IN ('insert', 'update')
  AND n_fields > 0
GROUP BY ALL""")

oracle("order_info_inserts", "SELECT id, user_id, province_id, ts FROM oi")

oracle("payment_success", """
SELECT user_id, order_id, payment_type, callback_time, ts FROM pay WHERE status_changed""")

oracle("order_status_1005", """
SELECT id, user_id, province_id, ts FROM oi WHERE new_status = '1005'""")

oracle("order_status_1006", """
SELECT id, user_id, province_id, ts FROM oi WHERE new_status = '1006'""")

oracle("order_detail_amount", "SELECT id, sku_num, split_original_amount FROM od")

oracle("order_detail_date_id", """
SELECT id, create_time, strftime(CAST(create_time AS TIMESTAMP), '%Y-%m-%d') AS date_id FROM od""")

oracle("lookup_join_dic", """
SELECT od.id, od.source_type AS source_type_code, d.dic_name AS source_type_name
FROM od JOIN dic d ON od.source_type = d.dic_code""")

oracle("order_detail_join_info", """
SELECT od.id, od.order_id, oi.user_id, oi.province_id FROM od JOIN oi ON od.order_id = oi.id""")

oracle("order_detail_left_joins", """
SELECT od.id, act.activity_id, act.activity_rule_id, cou.coupon_id
FROM od LEFT JOIN act ON od.id = act.order_detail_id
LEFT JOIN cou ON od.id = cou.order_detail_id""")

oracle("refund_pay_join_refund", """
SELECT rp.id, rp.order_id, rp.sku_id, ri.refund_num, rp.total_amount
FROM rp_all rp JOIN ri_all ri ON rp.order_id = ri.order_id AND rp.sku_id = ri.sku_id""")

PAY_SELECT = """
SELECT tod.id AS order_detail_id, tod.order_id, tod.user_id, tod.sku_id, tod.sku_name,
       tod.province_id, tod.activity_id, tod.activity_rule_id, tod.coupon_id,
       p.payment_type AS payment_type_code, d.dic_name AS payment_type_name, p.callback_time,
       tod.source_id, tod.source_type_code, tod.source_type_name, tod.sku_num,
       tod.split_original_amount, tod.split_activity_amount, tod.split_coupon_amount,
       tod.split_total_amount AS split_payment_amount, p.ts
FROM tod JOIN pay p ON tod.order_id = p.order_id AND p.status_changed {bound}
JOIN dic d ON p.payment_type = d.dic_code"""

oracle("trade_pay_detail_suc", PAY_SELECT.format(bound=""))
oracle("pay_within_ttl", PAY_SELECT.format(
    bound="AND p.ts BETWEEN tod.ts - 1805 AND tod.ts + 1805"))

# Two versions of every detail, the second 1,200 s after the first (`ts` stays
# the first's); each meets payments while it is kept, or comes while they are.
CTES["tod_versions"] = """
SELECT *, 1 AS version FROM tod
UNION ALL SELECT * REPLACE (coalesce(coupon_id, 'x') AS coupon_id), 2 AS version FROM tod"""
oracle("pay_within_idle_ttl", PAY_SELECT.replace("FROM tod JOIN", "FROM tod_versions tod JOIN").format(
    bound="""AND CASE version WHEN 1 THEN p.ts - tod.ts BETWEEN -1805 AND 1199
                              ELSE p.ts - tod.ts BETWEEN -605 AND 3005 END"""))

oracle("trade_order_refund", """
SELECT ri.id, ri.user_id, ri.order_id, ri.sku_id, o.province_id,
       strftime(CAST(ri.create_time AS TIMESTAMP), '%Y-%m-%d') AS date_id, ri.create_time,
       ri.refund_type AS refund_type_code, d1.dic_name AS refund_type_name,
       ri.refund_reason_type AS refund_reason_type_code, d2.dic_name AS refund_reason_type_name,
       ri.refund_reason_txt, ri.refund_num, ri.refund_amount, ri.ts
FROM ri JOIN oi o ON ri.order_id = o.id AND o.new_status = '1005'
JOIN dic d1 ON ri.refund_type = d1.dic_code
JOIN dic d2 ON ri.refund_reason_type = d2.dic_code""")

REFUND_PAID_SELECT = """
SELECT rp.id, o.user_id, rp.order_id, rp.sku_id, o.province_id,
       rp.payment_type AS payment_type_code, d.dic_name AS payment_type_name,
       strftime(CAST(rp.callback_time AS TIMESTAMP), '%Y-%m-%d') AS date_id, rp.callback_time,
       r.refund_num, rp.total_amount AS refund_amount, rp.ts
FROM rp_{kind} rp JOIN ri_{kind} r ON rp.order_id = r.order_id AND rp.sku_id = r.sku_id
JOIN oi o ON rp.order_id = o.id AND o.new_status = '1006'
JOIN dic d ON rp.payment_type = d.dic_code"""

oracle("trade_refund_pay_suc", REFUND_PAID_SELECT.format(kind="all"))
oracle("trade_refund_pay_suc_strict", REFUND_PAID_SELECT.format(kind="up"))

oracle("trade_cancel_detail", """
SELECT tod.* REPLACE (oi.ts AS ts) FROM tod
JOIN oi ON tod.order_id = oi.id AND oi.new_status = '1002'""")

oracle("upsert_latest_by_key", """
SELECT * REPLACE (COALESCE(coupon_id, 'x') AS coupon_id) FROM tod""")

oracle("dwd_json_sink_roundtrip", CART_ADD)

# Tracking log: one record per event; `is_new` repaired per device by its
# first record in arrival order (ts millis, then event id).
CTES["lg"] = """
SELECT event_id, event_type, 'm' || CAST(user_id AS VARCHAR) AS mid,
       CAST(user_id AS VARCHAR) AS uid,
       CASE WHEN event_id % 3 = 0 THEN '0' ELSE '1' END AS is_new0,
       CAST(epoch_us(ts) // 1000 AS BIGINT) AS ms,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       strftime(ts, '%Y-%m-%d') AS day
FROM events"""
CTES["lgr"] = """
SELECT *, CASE WHEN is_new0 = '1' AND day <> first_day THEN '0' ELSE is_new0 END AS is_new
FROM (SELECT *, first_value(CASE WHEN is_new0 = '1' THEN day
                 ELSE strftime(CAST(day AS DATE) - INTERVAL 1 DAY, '%Y-%m-%d') END)
             OVER (PARTITION BY mid ORDER BY ms, event_id) AS first_day
      FROM lg)"""

oracle("log_etl_clean", """
SELECT mid, uid, is_new0 AS is_new, CASE WHEN event_type <> 'signup' THEN event_type END AS page_id,
       ms AS ts FROM lg""")
oracle("is_new_repair", "SELECT mid, uid, is_new, ms AS ts FROM lgr")
oracle("traffic_start", """
SELECT mid, uid, is_new, CAST(k AS VARCHAR) AS entry, ms AS ts FROM lgr WHERE event_type = 'signup'""")
CTES["disp"] = """
SELECT mid, uid, is_new, CAST(k + i AS VARCHAR) AS item, CAST(i AS VARCHAR) AS "order", ms AS ts
FROM lgr, LATERAL (SELECT unnest(generate_series(1, CASE WHEN event_type = 'view'
                                                      THEN 1 + k % 3 ELSE 1 END)) AS i)
WHERE event_type IN ('view', 'error')"""
CTES["acts"] = """
SELECT mid, uid, is_new, CAST(i AS VARCHAR) AS action_id, ms + i AS ts
FROM lgr, LATERAL (SELECT unnest(generate_series(1, 1 + k % 2)) AS i)
WHERE event_type = 'click'"""
oracle("traffic_display", "SELECT * FROM disp")
oracle("traffic_action", "SELECT * FROM acts")
oracle("traffic_error", """
SELECT mid, uid, is_new, event_type AS page_id, CAST(k AS VARCHAR) AS err_code, ms AS ts
FROM lgr WHERE event_type = 'error'""")
oracle("traffic_page", """
SELECT mid, uid, is_new, event_type AS page_id, ms AS ts FROM lgr WHERE event_type <> 'signup'""")
oracle("traffic_topic_counts", """
SELECT 'dwd_traffic_start' AS topic, count(*) AS n FROM lgr WHERE event_type = 'signup'
UNION ALL SELECT 'dwd_traffic_display', count(*) FROM disp
UNION ALL SELECT 'dwd_traffic_action', count(*) FROM acts
UNION ALL SELECT 'dwd_traffic_err', count(*) FROM lgr WHERE event_type = 'error'
UNION ALL SELECT 'dwd_traffic_page', count(*) FROM lgr WHERE event_type <> 'signup'""")

oracle("traffic_open_fields", """
SELECT topic, CAST(event_id AS VARCHAR) AS seq_no,
       '{"even":' || CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END
       || ',"k":' || CAST(k AS VARCHAR) || '}' AS ext, is_new, ms AS ts
FROM (SELECT *, CASE event_type WHEN 'signup' THEN 'dwd_traffic_start' ELSE 'dwd_traffic_page'
                END AS topic FROM lgr
      UNION ALL SELECT *, 'dwd_traffic_err' FROM lgr WHERE event_type = 'error')""")

# Dimension rows after routing by the current rules (user_info: id, name,
# province_id; sku_info: id, sku_name, brand; provinces and suppliers have
# no rule).
CTES["dimrows"] = """
SELECT 'dim_user_info' AS sink_table, 'insert' AS op_type, CAST(c_custkey AS VARCHAR) AS id,
       CAST(0 AS BIGINT) AS ts, c_name AS name, CAST(c_nationkey AS VARCHAR) AS province_id,
       NULL AS sku_name, NULL AS brand
FROM customer
UNION ALL
SELECT 'dim_user_info', 'update', CAST(c_custkey AS VARCHAR), CAST(1 AS BIGINT), c_name || '-v2',
       CAST(c_nationkey AS VARCHAR), NULL, NULL
FROM customer WHERE c_custkey % 10 = 0
UNION ALL
SELECT 'dim_sku_info', 'insert', CAST(p_partkey AS VARCHAR), CAST(0 AS BIGINT), NULL, NULL,
       p_name, p_brand
FROM part"""

oracle("dim_route", "SELECT sink_table, op_type, id, ts FROM dimrows")
oracle("dim_column_prune", """
SELECT sink_table, id, op_type, ts, "column", value FROM (
  SELECT sink_table, id, op_type, ts, 'id' AS "column", id AS value FROM dimrows
  UNION ALL SELECT sink_table, id, op_type, ts, 'name', name FROM dimrows
            WHERE sink_table = 'dim_user_info'
  UNION ALL SELECT sink_table, id, op_type, ts, 'province_id', province_id FROM dimrows
            WHERE sink_table = 'dim_user_info'
  UNION ALL SELECT sink_table, id, op_type, ts, 'sku_name', sku_name FROM dimrows
            WHERE sink_table = 'dim_sku_info'
  UNION ALL SELECT sink_table, id, op_type, ts, 'brand', brand FROM dimrows
            WHERE sink_table = 'dim_sku_info')""")
oracle("dim_upsert_user", """
SELECT id, arg_max(name, ts) AS name, arg_max(province_id, ts) AS province_id
FROM dimrows WHERE sink_table = 'dim_user_info' GROUP BY id""")
oracle("dim_upsert_sku", """
SELECT id, sku_name, brand FROM dimrows WHERE sink_table = 'dim_sku_info'""")
oracle("dwd_route", """
SELECT 'dwd_cart_info' AS sink_table, 'insert' AS op_type, id, user_id, sku_id,
       3 AS n_columns, ts
FROM cart WHERE type IN ('insert', 'bootstrap-insert')""")

oracle("word_count", """
SELECT word, count(*) AS n, word || '_' || CAST(count(*) AS VARCHAR) AS text
FROM (SELECT unnest(string_split(regexp_replace(p_name, ' +$', ''), ' ')) AS word FROM part)
GROUP BY word""")

oracle("date_to_epoch", """
SELECT o_orderkey AS order_id, strftime(o_orderdate, '%Y-%m-%d') AS day,
       CAST(epoch_us(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)) // 1000 AS BIGINT)
           - 8 * 3600 * 1000 AS day_ms,
       CAST(epoch_us(o_orderdate) // 1000 AS BIGINT) - 8 * 3600 * 1000 AS full_ms
FROM orders""")

oracle("epoch_to_date", """
SELECT event_id, CAST(epoch_us(ts) // 1000 AS BIGINT) AS ms, strftime(ts, '%Y-%m-%d') AS day,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS ymd_hms
FROM events""")

# -- configuration as of a record's arrival: each record meets the last change
# of its key before or at it.
CTES["last_key"] = "SELECT max(c_custkey) AS last FROM customer"
CTES["timed_dims"] = """
SELECT 'user_info' AS src, 'insert' AS op_type, CAST(c_custkey AS VARCHAR) AS id,
       CAST(25 * c_custkey AS BIGINT) AS arrival, c_name AS label FROM customer
UNION ALL
SELECT 'user_info', 'update', CAST(c_custkey AS VARCHAR),
       CAST(25 * c_custkey + 25 * last AS BIGINT), c_name || '-v2'
FROM customer, last_key WHERE c_custkey % 10 = 0
UNION ALL
SELECT 'sku_info', 'insert', CAST(p_partkey AS VARCHAR),
       CAST(p_partkey * 9973 % (50 * last + 1) AS BIGINT), p_name FROM part, last_key
UNION ALL
SELECT 'base_province', 'insert', CAST(n_nationkey AS VARCHAR),
       CAST(2 * n_nationkey * last + 1 AS BIGINT), n_name FROM nation, last_key"""
CTES["timed_rules"] = """
SELECT CASE n_nationkey % 3 WHEN 0 THEN 'user_info' WHEN 1 THEN 'sku_info'
            ELSE 'base_province' END AS src,
       substr('cudr', CAST(n_nationkey // 3 % 4 + 1 AS INTEGER), 1) AS op,
       n_nationkey // 3 % 2 = 1 AS wide, CAST(2 * n_nationkey * last AS BIGINT) AS since
FROM nation, last_key"""
CTES["routed_as_of"] = """
SELECT 'dim_' || d.src AS sink_table, d.src, d.op_type, d.id, d.arrival, d.label, r.wide
FROM timed_dims d ASOF JOIN timed_rules r ON d.src = r.src AND d.arrival >= r.since
WHERE r.op <> 'd'"""
oracle("dim_route_as_of", """
SELECT sink_table, op_type, id, arrival,
       CASE src WHEN 'user_info' THEN CASE WHEN wide THEN 'id,name,province_id' ELSE 'id,name' END
                WHEN 'sku_info' THEN CASE WHEN wide THEN 'brand,id,sku_name' ELSE 'id,sku_name' END
                ELSE CASE WHEN wide THEN 'id,name,region_id' ELSE 'id,name' END END AS columns
FROM routed_as_of""")
oracle("dim_rows_after_replace", """
SELECT sink_table, id, max(arrival) AS arrival, arg_max(op_type, arrival) AS op_type,
       arg_max(label, arrival) AS label,
       CAST(arg_max(CASE WHEN wide THEN 3 ELSE 2 END, arrival) AS INTEGER) AS n_columns
FROM routed_as_of a
WHERE arrival >= (SELECT max(since) FROM timed_rules r WHERE r.src = a.src AND r.op IN ('d', 'u'))
GROUP BY sink_table, id""")
CTES["dic_log"] = """
SELECT '240' || CAST(r_regionkey + 1 AS VARCHAR) AS code,
       'n240' || CAST(r_regionkey + 1 AS VARCHAR) || 'v' || CAST(step AS VARCHAR) AS name,
       step = 2 AND r_regionkey % 2 = 1 AS deleted,
       CAST(t0 + floor((step * 5 + r_regionkey) * (t1 - t0) / 20) AS BIGINT) AS since
FROM region, (SELECT unnest(range(4)) AS step),
     (SELECT min(epoch_us(ts) // 1000000) AS t0, max(epoch_us(ts) // 1000000) AS t1 FROM events)
WHERE r_regionkey <> 4 OR step > 0"""
oracle("lookup_as_of", """
SELECT c.id, c.source_type AS source_type_code, l.name AS source_type_name, c.ts
FROM (SELECT * FROM cart WHERE type = 'insert'
      OR (type = 'update' AND old_sku_num IS NOT NULL
          AND TRY_CAST(sku_num AS INTEGER) > TRY_CAST(old_sku_num AS INTEGER))) c
ASOF JOIN dic_log l ON c.source_type = l.code AND c.ts >= l.since
WHERE NOT l.deleted""")

oracle("topic_without_repeats", CART_ADD)
oracle("rejects_by_reason", """
SELECT 'ods_db' AS topic,
       CASE WHEN database IS NULL THEN 'not_a_record'
            WHEN database <> 'shop' THEN 'other_database'
            WHEN regexp_replace(type, '^bootstrap-', '') NOT IN ('insert', 'update')
                THEN 'other_operation'
            WHEN n_fields = 0 THEN 'no_data' ELSE 'accepted' END AS reason, count(*) AS n
FROM topic GROUP BY ALL
UNION ALL
SELECT 'ods_log', 'accepted', count(*) FROM lg
UNION ALL
SELECT 'ods_log', CASE WHEN event_id % 97 = 0 OR event_id % 101 = 0 THEN 'not_a_record'
                       ELSE 'no_device' END AS reason, count(*)
FROM events WHERE event_id % 97 = 0 OR event_id % 101 = 0 OR event_id % 103 = 0 GROUP BY reason""")
