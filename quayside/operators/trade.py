"""Trade fact streams: cart additions, order details, payments, refunds.

Each job is a composition of change-log filters (`cdc`), equi-joins and
dictionary lookups. Functions take the parsed `ods_db` frame, batch or
streaming. On a streaming frame `bound` (seconds) is optional: the
stream-stream joins then also require the two sides' `event_time` columns to
be within `bound` of each other, which together with a watermark lets Spark
drop old join state, and loses matches that are further apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.packed import PACKED, pack, unpack
from quayside.functions.times import day_of_text
from quayside.operators import retention
from quayside.operators.cdc import changes, fields, transitioned
from quayside.operators.digest import may_meet
from quayside.operators.lookup import lookup, prepared
from quayside.schemas import DEFAULT_DATABASE
from quayside.sources.replay import (
    PAYMENT_SUCCESS, REFUND_APPROVED, REFUND_PAID,
)

# Order status codes that mark an approved / a paid refund.
ORDER_REFUND_APPROVED = "1005"
ORDER_REFUND_PAID = "1006"

EVENT_TIME = "event_time"

# Columns of an order detail that no join of it reads, mostly digits: keys, codes, amounts.
DETAIL_FIGURES = ["sku_id", "source_id", "source_type", "sku_num", "split_original_amount",
                  "split_total_amount", "split_activity_amount", "split_coupon_amount"]

# The same of a row of the order-detail topic.
TOPIC_FIGURES = ["id", "user_id", "sku_id", "province_id", "activity_id", "activity_rule_id",
                 "date_id", "source_id", "source_type_code", "sku_num", "split_original_amount",
                 "split_activity_amount", "split_coupon_amount", "split_total_amount"]

# Idle-state retention of the reference, used as event-time join bounds.
PAYMENT_BOUND_SECONDS = 30 * 60 + 5
REFUND_BOUND_SECONDS = 5


def _carry_time(df: DataFrame) -> list[str]:
    return [EVENT_TIME] if EVENT_TIME in df.columns else []


def _within(left: str, right: str, bound: int | None) -> Column | None:
    if bound is None:
        return None
    lt, rt = F.col(f"{left}.{EVENT_TIME}"), F.col(f"{right}.{EVENT_TIME}")
    return ((lt >= rt - F.expr(f"INTERVAL {bound} SECONDS"))
            & (lt <= rt + F.expr(f"INTERVAL {bound} SECONDS")))


def join_few_orders(order_detail: DataFrame, orders: DataFrame, key: str, on: Column,
                    left: str, right: str) -> DataFrame:
    """Inner join of topic rows (alias `left`, their figures packed or not) with
    `orders` (alias `right`) on `on`, which names equal order ids: `key` is that
    of `orders`. In batch, rows that no order can meet are left out before, and
    the others are dealt out with their figures packed; `left` and `right` are
    structs of the result then."""
    if order_detail.isStreaming or orders.isStreaming:
        return order_detail.alias(left).join(orders.alias(right), on, "inner")
    od = may_meet(order_detail, "order_id", orders, key)
    if PACKED not in od.columns:
        od = pack(od, TOPIC_FIGURES)
    j = od.alias(left).join(orders.alias(right), on, "inner")
    j = unpack(j.select(f"{left}.*", F.struct(f"{right}.*").alias("_other")), TOPIC_FIGURES)
    return j.select(F.struct(*[c for c in j.columns if c != "_other"]).alias(left),
                    F.col("_other").alias(right))


def _on(cond: Column, extra: Column | None) -> Column:
    return cond if extra is None else cond & extra


def _int(c: Column) -> Column:
    return c.try_cast("int")


# -- cart additions -------------------------------------------------------------

def cart_adds(ods: DataFrame, database: str = DEFAULT_DATABASE) -> DataFrame:
    """Cart rows that add items (P7, R2): every insert, and updates whose
    `sku_num` changed and grew; `sku_num` becomes the number added."""
    d, o = F.col("data"), F.col("old")
    grew = ((F.col("type") == "update") & o["sku_num"].isNotNull()
            & (_int(d["sku_num"]) > _int(o["sku_num"])))
    ci = changes(ods, "cart_info", ("insert", "update"), database).filter(
        (F.col("type") == "insert") | grew)
    added = F.when(F.col("type") == "insert", d["sku_num"]).otherwise(
        (_int(d["sku_num"]) - _int(o["sku_num"])).cast("string"))
    return ci.select(*fields("id", "user_id", "sku_id", "source_id", "source_type"),
                     added.alias("sku_num"), "ts")


def trade_cart_add(ods: DataFrame, dic: DataFrame,
                   database: str = DEFAULT_DATABASE) -> DataFrame:
    """`dwd_trade_cart_add`: cart additions with the source-type name."""
    ca = lookup(cart_adds(ods, database), dic, "source_type", "source_type_name")
    return ca.select("id", "user_id", "sku_id", "source_id",
                     F.col("source_type").alias("source_type_code"),
                     "source_type_name", "sku_num", "ts")


# -- order detail ---------------------------------------------------------------

def order_details(ods: DataFrame, database: str = DEFAULT_DATABASE) -> DataFrame:
    """Inserted order-detail rows with the original amount."""
    d = F.col("data")
    original = (d["sku_num"].try_cast("decimal(16,2)")
                * d["order_price"].try_cast("decimal(16,2)")).cast("string")
    od = changes(ods, "order_detail", ("insert",), database)
    return od.select(*fields("id", "order_id", "sku_id", "sku_name", "create_time",
                             "source_id", "source_type", "sku_num"),
                     original.alias("split_original_amount"),
                     *fields("split_total_amount", "split_activity_amount",
                             "split_coupon_amount"),
                     "ts", *_carry_time(ods))


def order_infos(ods: DataFrame, database: str = DEFAULT_DATABASE) -> DataFrame:
    """Inserted orders: id, user and province."""
    return changes(ods, "order_info", ("insert",), database).select(
        *fields("id", "user_id", "province_id"), *_carry_time(ods))


def detail_activities(ods: DataFrame, database: str = DEFAULT_DATABASE) -> DataFrame:
    return changes(ods, "order_detail_activity", ("insert",), database).select(
        *fields("order_detail_id", "activity_id", "activity_rule_id"), *_carry_time(ods))


def detail_coupons(ods: DataFrame, database: str = DEFAULT_DATABASE) -> DataFrame:
    return changes(ods, "order_detail_coupon", ("insert",), database).select(
        *fields("order_detail_id", "coupon_id"), *_carry_time(ods))


def join_order_info(od: DataFrame, oi: DataFrame) -> DataFrame:
    """Order details joined inner to their order."""
    od, oi = od.alias("od"), oi.alias("oi")
    return od.join(oi, F.col("od.order_id") == F.col("oi.id"), "inner").select(
        "od.*", F.col("oi.user_id").alias("user_id"), F.col("oi.province_id").alias("province_id"))


def join_activity_coupon(od: DataFrame, act: DataFrame, cou: DataFrame) -> DataFrame:
    """Order details left-joined to their activity and coupon rows (J5; batch
    form, the stream form is `streaming.state.merge_parts`)."""
    od, act, cou = od.alias("od"), act.alias("act"), cou.alias("cou")
    j = od.join(act, F.col("od.id") == F.col("act.order_detail_id"), "left")
    j = j.join(cou, F.col("od.id") == F.col("cou.order_detail_id"), "left")
    return j.select("od.*", "act.activity_id", "act.activity_rule_id", "cou.coupon_id")


def order_detail_base(ods: DataFrame, database: str = DEFAULT_DATABASE) -> DataFrame:
    """Order details with their order, before activity, coupon and source-type
    name are known (the first part of J6)."""
    return join_order_info(order_details(ods, database), order_infos(ods, database))


def order_detail_columns(j: DataFrame, row_op_ts: Column | None = None) -> DataFrame:
    """The output columns of J6 from joined rows."""
    return j.select(
        "id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id",
        "activity_rule_id", "coupon_id", day_of_text(F.col("create_time")).alias("date_id"),
        "create_time", "source_id", F.col("source_type").alias("source_type_code"),
        "source_type_name", "sku_num", "split_original_amount", "split_activity_amount",
        "split_coupon_amount", "split_total_amount", "ts",
        (row_op_ts if row_op_ts is not None else F.current_timestamp()).alias("row_op_ts"))


def name_order_details(joined: DataFrame, dic: DataFrame,
                       row_op_ts: Column | None = None) -> DataFrame:
    """The output rows of J6 from joined details."""
    return order_detail_columns(lookup(joined, dic, "source_type", "source_type_name"), row_op_ts)


def trade_order_detail(ods: DataFrame, dic: DataFrame, database: str = DEFAULT_DATABASE,
                       row_op_ts: Column | None = None) -> DataFrame:
    """`dwd_trade_order_detail` (J6): detail ⋈ order, ⟕ activity, ⟕ coupon,
    ⋈ dictionary. Keyed by `id`; `row_op_ts` marks the version of a row. The
    dictionary comes first: details whose source type has no name are dropped
    before the joins deal them out by order and by id, with their figures packed."""
    od = lookup(order_details(ods, database), dic, "source_type", "source_type_name")
    j = join_order_info(pack(od, DETAIL_FIGURES), order_infos(ods, database))
    j = join_activity_coupon(j, detail_activities(ods, database), detail_coupons(ods, database))
    return order_detail_columns(unpack(j, DETAIL_FIGURES), row_op_ts)


# -- payment success ------------------------------------------------------------

def payment_successes(ods: DataFrame, database: str = DEFAULT_DATABASE) -> DataFrame:
    """Payments that turned successful."""
    return transitioned(ods, "payment_info", "payment_status", PAYMENT_SUCCESS, database).select(
        *fields("user_id", "order_id", "payment_type", "callback_time"), "ts",
        *_carry_time(ods))


def join_payments(order_detail: DataFrame, ods: DataFrame, database: str = DEFAULT_DATABASE,
                  bound: int | None = None, idle: int | None = None) -> DataFrame:
    """Order details joined to successful payments of the order, before the
    payment type has a name. With `idle` (seconds, batch only), `order_detail`
    holds all versions (`retention.with_replacement`), and a version meets the
    payments that come while it is kept."""
    payments = payment_successes(ods, database)
    return payment_columns(join_few_orders(order_detail, payments, "order_id",
                                           _paid(bound, idle), "od", "pi"))


def _paid(bound: int | None, idle: int | None) -> Column:
    cond = _on(F.col("od.order_id") == F.col("pi.order_id"), _within("od", "pi", bound))
    return cond if idle is None else cond & retention.meet("od", "pi", "ts", idle)


def join_paid_details(order_detail: DataFrame, payments: DataFrame, bound: int | None = None,
                      idle: int | None = None) -> DataFrame:
    """`join_payments` of given payments."""
    od, pi = order_detail.alias("od"), payments.alias("pi")
    return payment_columns(od.join(pi, _paid(bound, idle), "inner"))


def payment_columns(j: DataFrame) -> DataFrame:
    """The columns of `join_payments` from a detail `od` and a payment `pi`."""
    return j.select(
        F.col("od.id").alias("order_detail_id"), "od.order_id", "od.user_id", "od.sku_id",
        "od.sku_name", "od.province_id", "od.activity_id", "od.activity_rule_id",
        "od.coupon_id", F.col("pi.payment_type").alias("payment_type_code"),
        "pi.callback_time", "od.source_id", "od.source_type_code", "od.source_type_name",
        "od.sku_num", "od.split_original_amount", "od.split_activity_amount",
        "od.split_coupon_amount", F.col("od.split_total_amount").alias("split_payment_amount"),
        F.col("pi.ts").alias("ts"), F.col("od.row_op_ts").alias("row_op_ts"))


def name_payments(joined: DataFrame, dic: DataFrame) -> DataFrame:
    """The output rows of J7 from `join_payments`."""
    j = lookup(joined, dic, "payment_type_code", "payment_type_name")
    return j.select(
        "order_detail_id", "order_id", "user_id", "sku_id", "sku_name", "province_id",
        "activity_id", "activity_rule_id", "coupon_id", "payment_type_code",
        "payment_type_name", "callback_time", "source_id", "source_type_code",
        "source_type_name", "sku_num", "split_original_amount", "split_activity_amount",
        "split_coupon_amount", "split_payment_amount", "ts", "row_op_ts")


def trade_pay_detail_suc(order_detail: DataFrame, ods: DataFrame, dic: DataFrame,
                         database: str = DEFAULT_DATABASE, bound: int | None = None) -> DataFrame:
    """`dwd_trade_pay_detail_suc` (J7): the (de-duplicated) order-detail
    stream joined to successful payments of the order, with the payment-type
    name. `bound` (seconds) limits how far apart the two may be."""
    return name_payments(join_payments(order_detail, ods, database, bound), dic)


# -- refunds --------------------------------------------------------------------

def order_refunds(ods: DataFrame, database: str = DEFAULT_DATABASE) -> DataFrame:
    """Inserted refund requests."""
    return changes(ods, "order_refund_info", ("insert",), database).select(
        *fields("id", "user_id", "order_id", "sku_id", "refund_type", "refund_num",
                "refund_amount", "refund_reason_type", "refund_reason_txt", "create_time"),
        "ts", *_carry_time(ods))


def orders_in_status(ods: DataFrame, status: str, database: str = DEFAULT_DATABASE) -> DataFrame:
    """Orders whose status changed to `status`."""
    return transitioned(ods, "order_info", "order_status", status, database).select(
        *fields("id", "user_id", "province_id"), *_carry_time(ods))


def join_refund_orders(ods: DataFrame, database: str = DEFAULT_DATABASE,
                       bound: int | None = None) -> DataFrame:
    """Refund requests ⋈ orders that turned refund-approved."""
    return join_approved_orders(order_refunds(ods, database),
                                orders_in_status(ods, ORDER_REFUND_APPROVED, database), bound)


def join_approved_orders(ri: DataFrame, oi: DataFrame, bound: int | None = None) -> DataFrame:
    """`join_refund_orders` of given requests and orders."""
    ri, oi = ri.alias("ri"), oi.alias("oi")
    j = ri.join(oi, _on(F.col("ri.order_id") == F.col("oi.id"), _within("ri", "oi", bound)))
    return refund_columns(j)


def refund_columns(j: DataFrame) -> DataFrame:
    """The columns of `join_refund_orders` from a request `ri` and an order `oi`."""
    return j.select("ri.*", F.col("oi.province_id").alias("province_id"))


def name_refunds(joined: DataFrame, dic: DataFrame, row_op_ts: Column | None = None) -> DataFrame:
    """The output rows of J8 from `join_refund_orders`."""
    d = prepared(dic)
    j = lookup(joined, d, "refund_type", "refund_type_name", checked=True)
    j = lookup(j, d, "refund_reason_type", "refund_reason_type_name", checked=True)
    return j.select(
        "id", "user_id", "order_id", "sku_id", "province_id",
        day_of_text(F.col("create_time")).alias("date_id"), "create_time",
        F.col("refund_type").alias("refund_type_code"), "refund_type_name",
        F.col("refund_reason_type").alias("refund_reason_type_code"),
        "refund_reason_type_name", "refund_reason_txt", "refund_num", "refund_amount", "ts",
        (row_op_ts if row_op_ts is not None else F.current_timestamp()).alias("row_op_ts"))


def trade_order_refund(ods: DataFrame, dic: DataFrame, database: str = DEFAULT_DATABASE,
                       bound: int | None = None, row_op_ts: Column | None = None) -> DataFrame:
    """`dwd_trade_order_refund` (J8): refund requests ⋈ orders that turned
    refund-approved, with refund-type and refund-reason names (J2)."""
    return name_refunds(join_refund_orders(ods, database, bound), dic, row_op_ts)


def refund_payments(ods: DataFrame, database: str = DEFAULT_DATABASE,
                    strict: bool = False) -> DataFrame:
    """Refund payments; `strict` keeps only those that turned paid (0702)."""
    rp = (transitioned(ods, "refund_payment", "refund_status", REFUND_PAID, database) if strict
          else changes(ods, "refund_payment", None, database))
    return rp.select(*fields("id", "order_id", "sku_id", "payment_type", "callback_time",
                             "total_amount"), "ts", *_carry_time(ods))


def refund_lines(ods: DataFrame, database: str = DEFAULT_DATABASE,
                 strict: bool = False) -> DataFrame:
    """Refund lines; `strict` keeps only those that turned approved (0705)."""
    ri = (transitioned(ods, "order_refund_info", "refund_status", REFUND_APPROVED, database)
          if strict else changes(ods, "order_refund_info", None, database))
    return ri.select(*fields("order_id", "sku_id", "refund_num"), *_carry_time(ods))


def join_refund_lines(rp: DataFrame, ri: DataFrame, bound: int | None = None) -> DataFrame:
    """Refund payments ⋈ refund lines on (order_id, sku_id)."""
    rp, ri = rp.alias("rp"), ri.alias("ri")
    cond = ((F.col("rp.order_id") == F.col("ri.order_id"))
            & (F.col("rp.sku_id") == F.col("ri.sku_id")))
    return rp.join(ri, _on(cond, _within("rp", "ri", bound))).select(
        "rp.*", F.col("ri.refund_num").alias("refund_num"))


def join_paid_refunds(ods: DataFrame, database: str = DEFAULT_DATABASE, strict: bool = False,
                      bound: int | None = None) -> DataFrame:
    """Refund payments ⋈ refund lines ⋈ orders that turned refund-paid."""
    return join_paid_orders(refund_payments(ods, database, strict),
                            refund_lines(ods, database, strict),
                            orders_in_status(ods, ORDER_REFUND_PAID, database), bound)


def join_paid_orders(rp: DataFrame, ri: DataFrame, oi: DataFrame,
                     bound: int | None = None) -> DataFrame:
    """`join_paid_refunds` of given payments, lines and orders."""
    j, oi = join_refund_lines(rp, ri, bound).alias("rp"), oi.alias("oi")
    j = j.join(oi, _on(F.col("rp.order_id") == F.col("oi.id"), _within("rp", "oi", bound)))
    return j.select("rp.*", F.col("oi.user_id").alias("user_id"),
                    F.col("oi.province_id").alias("province_id"))


def name_paid_refunds(joined: DataFrame, dic: DataFrame,
                      row_op_ts: Column | None = None) -> DataFrame:
    """The output rows of J9 from `join_paid_refunds`."""
    j = lookup(joined, dic, "payment_type", "payment_type_name")
    return j.select(
        "id", "user_id", "order_id", "sku_id", "province_id",
        F.col("payment_type").alias("payment_type_code"), "payment_type_name",
        day_of_text(F.col("callback_time")).alias("date_id"), "callback_time", "refund_num",
        F.col("total_amount").alias("refund_amount"), "ts",
        (row_op_ts if row_op_ts is not None else F.current_timestamp()).alias("row_op_ts"))


def trade_refund_pay_suc(ods: DataFrame, dic: DataFrame, database: str = DEFAULT_DATABASE,
                         strict: bool = False, bound: int | None = None,
                         row_op_ts: Column | None = None) -> DataFrame:
    """`dwd_trade_refund_pay_suc` (J9): refund payments ⋈ refund lines ⋈
    orders that turned refund-paid, with the payment-type name."""
    return name_paid_refunds(join_paid_refunds(ods, database, strict, bound), dic, row_op_ts)


# -- order cancel (declared, unfinished in the reference) -------------------------

def trade_cancel_detail(order_detail: DataFrame, ods: DataFrame, cancel_code: str,
                        database: str = DEFAULT_DATABASE, bound: int | None = None) -> DataFrame:
    """Order details of orders whose status changed to `cancel_code`.

    The cancel status code is not defined by the reference, so it is a
    required argument. `ts` is the cancel time.
    """
    oc = transitioned(ods, "order_info", "order_status", cancel_code, database).select(
        F.col("data")["id"].alias("id"), "ts", *_carry_time(ods))
    same = _on(F.col("od.order_id") == F.col("oc.id"), _within("od", "oc", bound))
    j = join_few_orders(order_detail, oc, "id", same, "od", "oc")
    cols = [c for c in order_detail.columns if c not in ("ts", EVENT_TIME)]
    return j.select(*[F.col(f"od.{c}") for c in cols], F.col("oc.ts").alias("ts"))
