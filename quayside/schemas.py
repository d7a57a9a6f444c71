"""Declared record shapes (no schema inference anywhere)."""

from __future__ import annotations

from pyspark.sql import types as T

DEFAULT_DATABASE = "shop"

S = T.StringType()
L = T.LongType()
SMAP = T.MapType(S, S)

# Change-log envelope of the `ods_db` topic. `ts` is epoch seconds.
ODS_ENVELOPE = T.StructType([
    T.StructField("database", S),
    T.StructField("table", S),
    T.StructField("type", S),
    T.StructField("ts", L),
    T.StructField("data", SMAP),
    T.StructField("old", SMAP),
])

# Tracking-log record of the `ods_log` topic. `ts` is epoch millis. The open
# parts are string maps; `displays` / `actions` are arrays of string maps.
ODS_LOG = T.StructType([
    T.StructField("common", SMAP),
    T.StructField("page", SMAP),
    T.StructField("start", SMAP),
    T.StructField("displays", T.ArrayType(SMAP)),
    T.StructField("actions", T.ArrayType(SMAP)),
    T.StructField("err", SMAP),
    T.StructField("ts", L),
])

# One routing rule (config table `table_process`), snake_case.
RULE_FIELDS = ["source_table", "source_type", "sink_table", "sink_type",
               "sink_columns", "sink_pk", "sink_extend"]
RULE = T.StructType([T.StructField(f, S) for f in RULE_FIELDS])

# Debezium change of a rule. The binlog position (`source.file`, `source.pos`)
# orders the changes; `seq`, where a landing job adds one, comes before it.
RULE_CHANGE = T.StructType([
    T.StructField("op", S),
    T.StructField("before", RULE),
    T.StructField("after", RULE),
    T.StructField("source", T.StructType([T.StructField("file", S), T.StructField("pos", L)])),
    T.StructField("ts_ms", L),
    T.StructField("seq", L),
])

BASE_DIC = T.StructType([T.StructField("dic_code", S), T.StructField("dic_name", S)])


def _strings(names: str) -> list[T.StructField]:
    return [T.StructField(n, S) for n in names.split()]


DWD_TRADE_CART_ADD = T.StructType(
    _strings("id user_id sku_id source_id source_type_code source_type_name sku_num")
    + [T.StructField("ts", L)])

DWD_TRADE_ORDER_DETAIL = T.StructType(
    _strings("id order_id user_id sku_id sku_name province_id activity_id "
             "activity_rule_id coupon_id date_id create_time source_id "
             "source_type_code source_type_name sku_num split_original_amount "
             "split_activity_amount split_coupon_amount split_total_amount")
    + [T.StructField("ts", L), T.StructField("row_op_ts", T.TimestampType())])

DWD_TRADE_PAY_DETAIL_SUC = T.StructType(
    _strings("order_detail_id order_id user_id sku_id sku_name province_id "
             "activity_id activity_rule_id coupon_id payment_type_code "
             "payment_type_name callback_time source_id source_type_code "
             "source_type_name sku_num split_original_amount split_activity_amount "
             "split_coupon_amount split_payment_amount")
    + [T.StructField("ts", L), T.StructField("row_op_ts", T.TimestampType())])

DWD_TRADE_ORDER_REFUND = T.StructType(
    _strings("id user_id order_id sku_id province_id date_id create_time "
             "refund_type_code refund_type_name refund_reason_type_code "
             "refund_reason_type_name refund_reason_txt refund_num refund_amount")
    + [T.StructField("ts", L), T.StructField("row_op_ts", T.TimestampType())])

DWD_TRADE_REFUND_PAY_SUC = T.StructType(
    _strings("id user_id order_id sku_id province_id payment_type_code "
             "payment_type_name date_id callback_time refund_num refund_amount")
    + [T.StructField("ts", L), T.StructField("row_op_ts", T.TimestampType())])
