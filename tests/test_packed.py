"""Rows that are dealt out with their figures packed."""

import re

from pyspark.sql import functions as F

from quayside.functions.packed import PACKED, pack, unpack
from quayside.plans.queries import QUERIES
from quayside.sources import replay
from tests.conftest import SF_SMALL

COLUMNS = ["a", "b", "c"]


def test_unpacked_rows_are_the_packed_ones(spark):
    texts = ["", None, "0", "7", "-1.50", "007", "1-2-3-20240301", "e", "f", "abc", "AB", "1.", "٣",
             "é", "1e5", "2024-03-01 07:08:09", "F", "x", " ", "..", "12F4", "\x00"]
    rows = [(n, x, y, z) for n, (x, y, z) in enumerate(
        [(x, y, z) for x in texts for y in texts for z in (None, "", "5")])]
    df = spark.createDataFrame(rows, "n int, a string, b string, c string")
    packed = pack(df, COLUMNS)
    out = unpack(packed, COLUMNS)
    assert out.columns == ["n", "a", "b", "c"]
    assert sorted(map(tuple, out.collect())) == rows
    plain = {n for n, x, y, z in rows if re.search(r"[^0-9.-]", "".join(filter(None, (x, y, z))))}
    assert {r.n for r in packed.filter(F.col(PACKED).isNull()).collect()} == plain
    assert {r.n for r in packed.filter(F.col("_plain").isNotNull()).collect()} == plain


def test_packed_figures_take_half_the_room(spark):
    row = spark.createDataFrame([("123456", "1999.50", None)], "a string, b string, c string")
    assert row.transform(pack, COLUMNS).select(F.octet_length(PACKED)).first()[0] <= 9


def test_order_details_are_dealt_out_packed(spark):
    """By order and by id, rows hold no amount of their own."""
    plan = QUERIES["trade_order_detail"](spark, SF_SMALL)._jdf.queryExecution().executedPlan()
    lines = plan.toString().splitlines()
    dealt = [lines[i + 1] for i, line in enumerate(lines) if re.search(
        r"Exchange hashpartitioning\((order_id|id)#", line)]
    wide = [line for line in dealt if PACKED in line]
    assert len(wide) == 2
    assert not any("AS split_" in line or re.search(r", split_total_amount#\d+, ", line)
                   for line in wide if "CASE" not in line)


def test_numbers_without_a_short_form_stay(spark):
    big, nan = 1e15, float("nan")
    df = spark.createDataFrame([(2.75,), (None,), (big,), (nan,), (-0.004,)], "v double")
    money = df.withColumns({"money": F.col("v"), "number": F.col("v")})
    short = money.withColumns({**replay._short("money", replay.MONEY), **replay._short("number", "int")})
    rows = short.orderBy(F.col("v").isNull(), "v").collect()
    assert [(str(r._short_money), r._short_number) for r in rows] == [
        ("0.00", 0), ("2.75", 2), ("None", None), ("None", None), ("None", None)]
    assert rows[2].money == big and rows[2].number == big and rows[3].money != rows[3].money
    kept = short.filter("v < 1e9").select(replay._long("money", replay.MONEY), replay._long("number", "int"))
    want = money.filter("v < 1e9").select(F.col("v").cast("decimal(16,2)").cast("string"),
                                         F.col("v").cast("int").cast("string"))
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, want.collect()))
