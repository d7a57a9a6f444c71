"""Replay the warehouse tables as the two raw topics the jobs consume.

The given parquet tables (orders, lineitem, customer, part, nation, supplier,
events) are turned into the records a change-log tool and an app tracker
would have produced: one JSON text per record in a `value` column, exactly as
read from Kafka. Everything is a Spark projection or join of the tables, so
the replayed topics grow with the data. No clock, no randomness.

Frames returned here carry, next to `value`, the landing partition column
`_table` (for `ods_db`) or the arrival `offset` (for `ods_log`), the columns
a landed Kafka topic has. Operators filter on `_table` when present so that
Catalyst prunes the branches (partitions) a query does not need.
"""

from __future__ import annotations

import json
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.schemas import DEFAULT_DATABASE


# Status codes of the change log (order, payment, refund).
ORDER_CREATED = "1001"
ORDER_STATUS_BY_FLAG = {"P": "1005", "F": "1006", "O": "1002"}
PAYMENT_WAITING = "1601"
PAYMENT_SUCCESS = "1602"
REFUND_ASKED = "0701"
REFUND_APPROVED = "0705"
REFUND_PAID = "0702"


# (application id, path) -> (schema, scan splits). The given tables do not
# change while an application runs, so their footers are read and their
# splits planned once, not once per topic branch.
_TABLE_META: dict[tuple[str, str], tuple[object, int | None]] = {}


class Tables:
    """Lazy access to the parquet tables of one scale directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        try:
            self._app = spark.sparkContext.applicationId
        except Exception:   # sessions without SparkContext access (Spark Connect)
            self._app = None

    def _meta(self, name: str):
        return _TABLE_META.get((self._app, self._path(name))) if self._app else None

    def _path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        meta = self._meta(name)
        if meta is not None:
            return self.spark.read.schema(meta[0]).parquet(self._path(name))
        df = self.spark.read.parquet(self._path(name))
        if self._app:
            _TABLE_META[(self._app, self._path(name))] = (df.schema, None)
        return df

    def spread(self, name: str) -> DataFrame:
        """The table that drives a topic's records, spread over all cores.

        A topic has many partitions; a table file that scans as fewer splits
        than there are cores (one row group, say) is spread round-robin
        first, so the per-record JSON work runs everywhere. Filters and
        column pruning still reach the scan below the repartition. Inputs
        with enough splits are read as they are (no extra shuffle). Lookup
        sides (joined by broadcast) are read plainly.
        """
        df = getattr(self, name)
        meta = self._meta(name)
        try:
            cores = self.spark.sparkContext.defaultParallelism
            splits = meta[1] if meta is not None and meta[1] is not None else \
                df.rdd.getNumPartitions()
        except Exception:   # sessions without RDD access (Spark Connect)
            return df
        if self._app:
            _TABLE_META[(self._app, self._path(name))] = (df.schema, splits)
        return df.repartition(cores) if splits < cores else df


def _str(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _seconds(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def _millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def _day_time(ts: Column) -> Column:
    return F.date_format(ts.cast("timestamp"), "yyyy-MM-dd HH:mm:ss")


MONEY = "decimal(16,2)"


def _smap(pairs: list[tuple[str, Column]]) -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), _str(v)) for k, v in pairs))


def change(table: str, kind, data: list[tuple[str, Column]], ts: Column,
           old: Column | None = None, database: str = DEFAULT_DATABASE) -> Column:
    """JSON text of one change-log envelope; null columns of `data` are written
    as null, an envelope field that is null is left out. `data` is written from
    a struct and joined to the envelope's text: a map of the same columns takes
    about twice the time to build and write. `kind` is a plain word."""
    def field(name: str, text: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f',"{name}":'), text), F.lit(""))

    named = json.dumps({"database": database, "table": table}, ensure_ascii=False,
                       separators=(",", ":"))
    kind = F.lit(kind) if isinstance(kind, str) else kind
    columns = F.to_json(F.struct(*[_str(v).alias(k) for k, v in data]),
                        {"ignoreNullFields": "false"})
    return F.concat(F.lit(named[:-1]), field("type", F.concat(F.lit('"'), kind, F.lit('"'))),
                    field("ts", ts.cast("bigint").cast("string")), F.lit(',"data":'), columns,
                    field("old", F.to_json(old)) if old is not None else F.lit(""), F.lit("}"))


def _topic(df: DataFrame, table: str | Column, value: Column) -> DataFrame:
    t = F.lit(table) if isinstance(table, str) else table
    return df.select(value.alias("value"), t.alias("_table"))


def _topic_of_all(df: DataFrame, table: str, *values: Column) -> DataFrame:
    """Several records per row (NULL: none) from one pass over the rows. The
    table is named outside the generator, so that a filter on it leaves out
    the whole branch."""
    rows = F.array(*[F.struct(v.alias("value")) for v in values])
    return _topic(df.select(F.inline(rows)).filter(F.col("value").isNotNull()), table,
                  F.col("value"))


def _topic_of_tables(df: DataFrame, records: list[tuple[str, Column]]) -> DataFrame:
    """`_topic_of_all` with a table per record, which no filter leaves out. Records that are NULL are left
    out after the generator: a lambda over the array would have every text
    built outside generated code."""
    rows = F.array(*[F.struct(v.alias("value"), F.lit(t).alias("_table")) for t, v in records])
    return df.select(F.inline(rows)).filter(F.col("value").isNotNull())


def lineitem_id() -> Column:
    """Unique order-detail id of a lineitem row (shorter keys repeat), from the
    columns of `_short_lines`."""
    return F.concat_ws("-", _str("l_orderkey"), _str("l_linenumber"), _str("l_partkey"),
                       _str("l_suppkey"), F.date_format(F.col("_day").cast("timestamp"), "yyyyMMdd"))


def _short(c: str, kind: str) -> dict[str, Column]:
    """A number in the short form that records are written from, for joins to deal
    out. What has none stays in its column, for `_long` to cast (and fail on)."""
    form = F.col(c).try_cast(kind)
    return {c: F.when(form.isNull(), F.col(c)), f"_short_{c}": form}


def _long(c: str, kind: str) -> Column:
    return _str(F.coalesce(f"_short_{c}", F.col(c).cast(kind)))


def _short_lines(t: Tables) -> DataFrame:
    """lineitem with its number, price and day in short forms."""
    return t.spread("lineitem").withColumns({
        "_day": F.col("l_shipdate").cast("date"), **_short("l_quantity", "int"),
        **_short("l_extendedprice", MONEY)})


def _parts(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", "p_name", "p_retailprice").withColumns(
        _short("p_retailprice", MONEY))


def _with_order(t: Tables, lines: DataFrame) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(o, F.col("l_orderkey") == F.col("o_orderkey"))


def _lines(t: Tables) -> DataFrame:
    """lineitem with its order's customer and date (one join on orderkey)."""
    return _with_order(t, _short_lines(t))


def _line_texts(li: DataFrame) -> DataFrame:
    """Joined lines with the texts that several of their records hold, built
    once. The shipping time is that of refunded lines, which alone write it."""
    return li.withColumns({
        "_id": lineitem_id(), "_order": _str("l_orderkey"), "_part": _str("l_partkey"),
        "_supplier": _str("l_suppkey"), "_line": _str("l_linenumber"), "_customer": _str("o_custkey"),
        "_ordered": _day_time(F.col("o_orderdate")),
        "_shipped": F.when(_refunded(), _day_time(F.col("l_shipdate"))),
        "_number": _long("l_quantity", "int"), "_price": _long("l_extendedprice", MONEY),
        "_ts": _seconds(F.col("o_orderdate"))})


# -- ods_db ------------------------------------------------------------------

def cart_info(t: Tables, db: str = DEFAULT_DATABASE) -> DataFrame:
    e = t.spread("events")
    k = F.get_json_object("props", "$.k")
    et = F.col("event_type")
    kind = (F.when(et == "signup", "insert").when(et.isin("click", "view"), "update")
             .when(et == "purchase", "delete").when(et == "error", "bootstrap-insert"))
    old = (F.when(et == "click", _smap([("sku_num", k)]))
            .when(et == "view", _smap([("source_type", F.lit("0"))])))
    data = [("id", F.col("event_id")), ("user_id", F.col("user_id")), ("sku_id", k),
            ("source_id", F.col("event_id")),
            ("source_type", F.concat(F.lit("240"), _str(1 + F.col("event_id") % 5))),
            ("sku_num", F.floor("value").cast("int"))]
    return _topic(e, "cart_info", change("cart_info", kind, data, _seconds(F.col("ts")), old, db))


def _orders_with_customer(t: Tables) -> DataFrame:
    c = t.customer.select("c_custkey", "c_nationkey")
    return t.spread("orders").join(c, F.col("o_custkey") == F.col("c_custkey"))


def order_info(t: Tables, db: str = DEFAULT_DATABASE) -> DataFrame:
    o = _orders_with_customer(t)
    base = [("id", F.col("o_orderkey")), ("user_id", F.col("o_custkey")),
            ("province_id", F.col("c_nationkey"))]
    ts = _seconds(F.col("o_orderdate"))
    insert = change("order_info", "insert", base + [("order_status", F.lit(ORDER_CREATED))], ts,
                    None, db)
    status = F.col("o_orderstatus")
    new_status = None
    for flag, code in ORDER_STATUS_BY_FLAG.items():
        new_status = (F.when if new_status is None else new_status.when)(status == flag, code)
    update = change("order_info", "update", base + [("order_status", new_status)], ts,
                    _smap([("order_status", F.lit(ORDER_CREATED))]), db)
    return _topic_of_all(o, "order_info", insert,
                         F.when(status.isin(*ORDER_STATUS_BY_FLAG), update))


def _order_detail(db: str) -> Column:
    data = [("id", F.col("_id")), ("order_id", F.col("_order")),
            ("sku_id", F.col("_part")), ("sku_name", F.col("p_name")),
            ("create_time", F.col("_ordered")),
            ("source_id", F.col("_supplier")),
            ("source_type", F.concat(F.lit("240"), _str(1 + F.col("l_linenumber") % 5))),
            ("sku_num", F.col("_number")),
            ("order_price", _long("p_retailprice", MONEY)),
            ("split_total_amount", F.col("_price")),
            ("split_activity_amount", F.lit("0.00")),
            ("split_coupon_amount", F.lit("0.00"))]
    return change("order_detail", "insert", data, F.col("_ts"), None, db)


def order_detail(t: Tables, db: str = DEFAULT_DATABASE) -> DataFrame:
    # Parts first: the lines then lie in the sequence of their orders, and what
    # the lines of an order share takes little room where they are dealt out next.
    li = _with_order(t, _short_lines(t).join(_parts(t), F.col("l_partkey") == F.col("p_partkey")))
    return _topic(_line_texts(li), "order_detail", _order_detail(db))


def _with_activity() -> Column:
    return F.col("l_returnflag") == "A"


def _order_detail_activity(db: str) -> Column:
    data = [("order_detail_id", F.col("_id")), ("activity_id", F.col("_supplier")),
            ("activity_rule_id", F.col("_line"))]
    return change("order_detail_activity", "insert", data, F.col("_ts"), None, db)


def order_detail_activity(t: Tables, db: str = DEFAULT_DATABASE) -> DataFrame:
    li = _line_texts(_lines(t)).filter(_with_activity())
    return _topic(li, "order_detail_activity", _order_detail_activity(db))


def _with_coupon() -> Column:
    return F.col("l_linestatus") == "F"


def _order_detail_coupon(db: str) -> Column:
    data = [("order_detail_id", F.col("_id")), ("coupon_id", F.col("l_partkey") % 7)]
    return change("order_detail_coupon", "insert", data, F.col("_ts"), None, db)


def order_detail_coupon(t: Tables, db: str = DEFAULT_DATABASE) -> DataFrame:
    li = _line_texts(_lines(t)).filter(_with_coupon())
    return _topic(li, "order_detail_coupon", _order_detail_coupon(db))


def _payment_type(key: str) -> Column:
    return F.concat(F.lit("110"), _str(1 + F.col(key) % 4))


def payment_info(t: Tables, db: str = DEFAULT_DATABASE) -> DataFrame:
    o = t.spread("orders").filter(F.col("o_orderstatus") == "F")
    even = F.col("o_orderkey") % 2 == 0
    old = (F.when(even, _smap([("payment_status", F.lit(PAYMENT_WAITING))]))
            .otherwise(_smap([("callback_time", F.lit("x"))])))
    data = [("user_id", F.col("o_custkey")), ("order_id", F.col("o_orderkey")),
            ("payment_type", _payment_type("o_orderkey")),
            ("callback_time", _day_time(F.col("o_orderdate"))),
            ("payment_status", F.lit(PAYMENT_SUCCESS))]
    ts = _seconds(F.col("o_orderdate")) + 60 * (F.col("o_orderkey") % 60)
    return _topic(o, "payment_info", change("payment_info", "update", data, ts, old, db))


def _refunded() -> Column:
    return F.col("l_returnflag") == "R"


def _order_refund_info(db: str) -> list[Column]:
    data = [("id", F.col("_id")), ("user_id", F.col("_customer")),
            ("order_id", F.col("_order")), ("sku_id", F.col("_part")),
            ("refund_type", F.concat(F.lit("150"), _str(1 + F.col("l_linenumber") % 3))),
            ("refund_num", F.col("_number")),
            ("refund_amount", F.col("_price")),
            ("refund_reason_type", F.concat(F.lit("130"), _str(1 + F.col("l_suppkey") % 4))),
            ("refund_reason_txt", F.concat(F.lit("r"), F.col("_supplier"))),
            ("create_time", F.col("_shipped")),
            ("refund_status", F.lit(REFUND_APPROVED))]
    ts = F.col("_ts")
    # Every third order's lines are approved by an update an hour later.
    approved = change("order_refund_info", "update", data, ts + 3600,
                      _smap([("refund_status", F.lit(REFUND_ASKED))]), db)
    return [change("order_refund_info", "insert", data, ts, None, db),
            F.when(F.col("l_orderkey") % 3 == 0, approved)]


def order_refund_info(t: Tables, db: str = DEFAULT_DATABASE) -> DataFrame:
    li = _line_texts(_lines(t)).filter(_refunded())
    return _topic_of_all(li, "order_refund_info", *_order_refund_info(db))


def _refund_paid() -> Column:
    return _refunded() & (F.col("l_linestatus") == "F")


def _refund_payment(db: str) -> list[Column]:
    data = [("id", F.col("_id")), ("order_id", F.col("_order")),
            ("sku_id", F.col("_part")), ("payment_type", _payment_type("l_orderkey")),
            ("callback_time", F.col("_shipped")),
            ("total_amount", F.col("_price")),
            ("refund_status", F.lit(REFUND_PAID))]
    ts = F.col("_ts")
    # Every other order's refunds turn paid by an update a day later.
    paid = change("refund_payment", "update", data, ts + 86400,
                  _smap([("refund_status", F.lit(REFUND_APPROVED))]), db)
    return [change("refund_payment", "insert", data, ts, None, db),
            F.when(F.col("l_orderkey") % 2 == 0, paid)]


def refund_payment(t: Tables, db: str = DEFAULT_DATABASE) -> DataFrame:
    li = _line_texts(_lines(t)).filter(_refund_paid())
    return _topic_of_all(li, "refund_payment", *_refund_payment(db))


def line_changes(t: Tables, db: str = DEFAULT_DATABASE) -> DataFrame:
    """The changes of all five tables that are made of order lines, from one
    join of the lines with their orders and parts. A line without a part has
    no detail; where a part key repeats, a line has a detail per part and its
    other changes once (beside the first)."""
    same_key = Window.partitionBy("p_partkey").orderBy("p_partkey")
    p = _parts(t).withColumn("_nth", F.row_number().over(same_key))
    li = _lines(t).join(p, F.col("l_partkey") == F.col("p_partkey"), "left")
    once = F.coalesce(F.col("_nth"), F.lit(1)) == 1
    records = [("order_detail", F.col("_nth").isNotNull(), [_order_detail(db)]),
               ("order_detail_activity", once & _with_activity(), [_order_detail_activity(db)]),
               ("order_detail_coupon", once & _with_coupon(), [_order_detail_coupon(db)]),
               ("order_refund_info", once & _refunded(), _order_refund_info(db)),
               ("refund_payment", once & _refund_paid(), _refund_payment(db))]
    return _topic_of_tables(_line_texts(li), [
        (table, F.when(has, text)) for table, has, texts in records for text in texts])


def dim_sources(t: Tables, db: str = DEFAULT_DATABASE) -> DataFrame:
    """Dimension source rows: users (with a rename update for every tenth),
    skus (snapshot rows, type `bootstrap-insert`), provinces, suppliers."""
    c = t.spread("customer")
    user = [("id", F.col("c_custkey")), ("name", F.col("c_name")),
            ("province_id", F.col("c_nationkey")), ("segment", F.col("c_mktsegment"))]
    renamed = [("id", F.col("c_custkey")), ("name", F.concat(F.col("c_name"), F.lit("-v2"))),
               ("province_id", F.col("c_nationkey")), ("segment", F.col("c_mktsegment"))]
    users = _topic_of_all(c, "user_info",
                          change("user_info", "insert", user, F.lit(0), None, db),
                          F.when(F.col("c_custkey") % 10 == 0, change(
                              "user_info", "update", renamed, F.lit(1),
                              _smap([("name", F.col("c_name"))]), db)))
    p = t.spread("part")
    sku = [("id", F.col("p_partkey")), ("sku_name", F.col("p_name")),
           ("brand", F.col("p_brand")), ("type", F.col("p_type"))]
    skus = _topic(p, "sku_info", change("sku_info", "bootstrap-insert", sku, F.lit(0), None, db))
    n = t.nation
    prov = [("id", F.col("n_nationkey")), ("name", F.col("n_name")), ("region_id", F.col("n_regionkey"))]
    provinces = _topic(n, "base_province", change("base_province", "insert", prov, F.lit(0), None, db))
    s = t.supplier
    sup = [("id", F.col("s_suppkey")), ("name", F.col("s_name"))]
    suppliers = _topic(s, "supplier_info", change("supplier_info", "insert", sup, F.lit(0), None, db))
    return reduce(DataFrame.unionByName, [users, skus, provinces, suppliers])


def _last_key(t: Tables) -> Column:
    return t.customer.agg(F.max("c_custkey")).scalar()


def dim_sources_in_time(t: Tables, db: str = DEFAULT_DATABASE) -> DataFrame:
    """Dimension source rows with a `timestamp` of arrival, in millis from 0 to
    50 times the largest customer key: users by key, renames after them, skus
    and provinces spread over the whole time."""
    last = _last_key(t)
    at = {"user_info": lambda k: 25 * k, "sku_info": lambda k: k * 9973 % (50 * last + 1),
          "base_province": lambda k: 2 * k * last + 1}
    rows = dim_sources(t, db).filter(F.col("_table").isin(*at))
    key = F.get_json_object("value", "$.data.id").cast("bigint")
    renamed = F.get_json_object("value", "$.type") == "update"
    arrival = F.coalesce(*[F.when(F.col("_table") == k, f(key)) for k, f in at.items()])
    arrival = arrival + F.when(renamed, 25 * last).otherwise(0)
    return rows.select(
        "value", "_table", F.timestamp_millis(arrival).alias("timestamp"))


# Columns of a source table before and after a rule update.
RULE_COLUMNS = {"user_info": ("id,name", "id,name,province_id"),
                "sku_info": ("id,sku_name", "id,sku_name,brand"),
                "base_province": ("id,name", "id,name,region_id")}


def rule_changes_in_time(t: Tables) -> DataFrame:
    """Debezium text of one rule change per nation, twice the largest customer
    key apart: the three dimension sources take turns, each created, updated,
    deleted and read again, with its columns changing in between."""
    n = F.col("n_nationkey")
    tables = list(RULE_COLUMNS)
    table = F.element_at(F.array(*map(F.lit, tables)), (n % 3 + 1).cast("int"))
    turn = F.floor(n / 3)
    op = F.element_at(F.array(*map(F.lit, "cudr")), (turn % 4 + 1).cast("int"))
    columns = F.coalesce(*[F.when(table == k, F.when(turn % 2 == 0, a).otherwise(b))
                           for k, (a, b) in RULE_COLUMNS.items()])
    rule = F.struct(table.alias("source_table"), F.lit("ALL").alias("source_type"),
                    F.concat(F.lit("dim_"), table).alias("sink_table"),
                    F.lit("dim").alias("sink_type"), columns.alias("sink_columns"),
                    F.lit("id").alias("sink_pk"))
    record = F.struct(op.alias("op"), F.when(op.isin("d", "u"), rule).alias("before"),
                      F.when(op != "d", rule).alias("after"),
                      (2 * n * _last_key(t)).cast("bigint").alias("ts_ms"))
    return t.nation.select(F.to_json(record).alias("value"))


def base_dic(t: Tables, db: str = DEFAULT_DATABASE) -> DataFrame:
    """Changes of the dictionary table over the time of the events: a source
    type code per region, named, renamed, deleted (odd regions) and named again;
    the last region's code has no first name."""
    first, last = (t.events.agg(f(_seconds(F.col("ts")))).scalar() for f in (F.min, F.max))
    r = F.col("r_regionkey")
    rows = t.region.withColumn(
        "step", F.explode(F.sequence(F.lit(0), F.lit(3)))).filter((r != 4) | (F.col("step") > 0))
    at = first + F.floor((F.col("step") * 5 + r) * (last - first) / 20)
    kind = (F.when(F.col("step") == 0, "bootstrap-insert").when(F.col("step") == 1, "update")
             .when((F.col("step") == 2) & (r % 2 == 1), "delete").otherwise("insert"))
    code = F.concat(F.lit("240"), _str(r + 1))
    data = [("dic_code", code), ("dic_name", F.concat(F.lit("n"), code, F.lit("v"), _str("step")))]
    return _topic(rows, "base_dic", change("base_dic", kind, data, at, None, db))


def bad_changes(t: Tables, db: str = DEFAULT_DATABASE) -> DataFrame:
    """Dirty change records that every cleaning step must drop."""
    e = t.events
    eid = F.col("event_id")
    data = [("id", eid), ("user_id", F.col("user_id"))]
    ts = _seconds(F.col("ts"))
    bad = e.filter(eid % 97 == 0).select(F.lit("{bad").alias("value"),
                                        F.lit(None).cast("string").alias("_table"))
    other_db = e.filter((eid % 97 != 0) & (eid % 101 == 0)).select(
        change("cart_info", "insert", data, ts, None, "other_" + db).alias("value"),
        F.lit("cart_info").alias("_table"))
    empty = e.filter((eid % 97 != 0) & (eid % 101 != 0) & (eid % 103 == 0)).select(
        F.to_json(F.struct(F.lit(db).alias("database"), F.lit("cart_info").alias("table"),
                           F.lit("insert").alias("type"), ts.alias("ts"),
                           F.create_map().cast("map<string,string>").alias("data"))).alias("value"),
        F.lit("cart_info").alias("_table"))
    return reduce(DataFrame.unionByName, [bad, other_db, empty])


ODS_TABLES = {
    "cart_info": cart_info,
    "order_info": order_info,
    "order_detail": order_detail,
    "order_detail_activity": order_detail_activity,
    "order_detail_coupon": order_detail_coupon,
    "payment_info": payment_info,
    "order_refund_info": order_refund_info,
    "refund_payment": refund_payment,
    "dims": dim_sources,
    "bad": bad_changes,
}


# The tables made of order lines: `line_changes` writes them all in one pass.
LINE_TABLES = ("order_detail", "order_detail_activity", "order_detail_coupon",
               "order_refund_info", "refund_payment")


# Built topic plans (plans only, no data) per session, directory and zone.
_TOPICS: dict[tuple, DataFrame] = {}


def _memo(spark: SparkSession, key: tuple, build) -> DataFrame:
    """Build a replayed topic's plan once per application: the tables are
    read-only, and building the expression trees costs seconds of driver
    time per query otherwise."""
    try:
        app = spark.sparkContext.applicationId
        session = spark._jsparkSession.hashCode()
    except Exception:   # no SparkContext access (Spark Connect): no memo
        return build()
    k = (app, session, spark.conf.get("spark.sql.session.timeZone")) + key
    if k not in _TOPICS:
        _TOPICS[k] = build()
    return _TOPICS[k]


def ods_db(spark: SparkSession, sf_dir: str, db: str = DEFAULT_DATABASE,
           whole: bool = False) -> DataFrame:
    """The whole `ods_db` topic: every table's changes plus dirty records. The
    rows are the same with `whole`, for readers of every table: lines and orders
    are then joined once, where else each table has a branch of its own that a
    filter on `_table` can leave out."""
    def build():
        t = Tables(spark, sf_dir)
        parts = [f(t, db) for name, f in ODS_TABLES.items()
                 if not (whole and name in LINE_TABLES)]
        return reduce(DataFrame.unionByName, parts + ([line_changes(t, db)] if whole else []))
    return _memo(spark, ("ods_db", sf_dir.rstrip("/"), db, whole), build)


# -- ods_log -------------------------------------------------------------------

BAD_LOG_OFFSET = 1 << 40


def ods_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The `ods_log` topic: one tracking record per event, plus bad text.

    `offset` is the arrival position (the event id; bad records after all).
    """
    return _memo(spark, ("ods_log", sf_dir.rstrip("/")), lambda: _ods_log(spark, sf_dir))


def _ods_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Tables(spark, sf_dir).spread("events")
    eid, et = F.col("event_id"), F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("bigint")
    ms = _millis(F.col("ts"))
    common = _smap([("mid", F.concat(F.lit("m"), _str("user_id"))), ("uid", F.col("user_id")),
                    ("is_new", F.when(eid % 3 == 0, "0").otherwise("1"))])
    page = F.when(et != "signup", _smap([("page_id", et)]))
    start = F.when(et == "signup", _smap([("entry", k)]))

    def displays(n: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), n),
                           lambda i: _smap([("item", k + i), ("order", i)]))

    disp = (F.when(et == "view", displays((1 + k % 3).cast("int")))
             .when(et == "error", displays(F.lit(1))))
    acts = F.when(et == "click", F.transform(
        F.sequence(F.lit(1), (1 + k % 2).cast("int")),
        lambda i: _smap([("action_id", i), ("ts", ms + i)])))
    err = F.when(et == "error", _smap([("code", k)]))
    record = F.to_json(F.struct(common.alias("common"), page.alias("page"), start.alias("start"),
                                disp.alias("displays"), acts.alias("actions"), err.alias("err"),
                                ms.alias("ts"), eid.alias("seq_no"),
                                F.struct(k.alias("k"), (eid % 2 == 0).alias("even")).alias("ext")))
    good = e.select(record.alias("value"), eid.alias("offset"))
    bad_text = (F.when(eid % 97 == 0, "not json").when(eid % 101 == 0, "[1]")
                 .when(eid % 103 == 0, '{"ts":1}'))
    bad = e.filter((eid % 97 == 0) | (eid % 101 == 0) | (eid % 103 == 0)).select(
        bad_text.alias("value"), (eid + F.lit(BAD_LOG_OFFSET)).alias("offset"))
    return good.unionByName(bad)


# -- word lines, rule changes -----------------------------------------------

def word_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines for the word-count job: one product name per line."""
    return Tables(spark, sf_dir).part.select(F.col("p_name").alias("value"))
