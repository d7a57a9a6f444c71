"""Column helpers: Java-style split, map merge, dates."""

from pyspark.sql import functions as F

from quayside.functions.maps import keep_keys, merge_maps, put_entry
from quayside.functions.text import java_split
from quayside.functions.times import (
    day_of_millis, epoch_millis_of_text, minus_one_day, ymd_hms_of_millis,
)


def test_java_split_drops_trailing_empties(spark):
    rows = [("a b",), ("a  b",), (" a",), ("a  ",), ("   ",), ("",), (None,)]
    df = spark.createDataFrame(rows, "s string")
    got = [r[0] for r in df.select(java_split(F.col("s"))).collect()]
    assert got == [["a", "b"], ["a", "", "b"], ["", "a"], ["a"], [], [""], None]


def test_merge_maps_second_wins(spark):
    df = spark.createDataFrame([({"a": "1", "mid": "child"}, {"mid": "m1", "x": "2"})],
                               "c map<string,string>, common map<string,string>")
    r = df.select(merge_maps("c", "common").alias("m")).first()["m"]
    assert r == {"a": "1", "mid": "m1", "x": "2"}


def test_merge_maps_null_is_empty(spark):
    df = spark.createDataFrame([(None, {"k": "v"})], "a map<string,string>, b map<string,string>")
    assert df.select(merge_maps("a", "b")).first()[0] == {"k": "v"}


def test_put_entry_and_keep_keys(spark):
    df = spark.createDataFrame([({"id": "1", "name": "x", "extra": "y"},)],
                               "d map<string,string>")
    r = df.select(put_entry(F.col("d"), "name", F.lit("z")).alias("p"),
                  keep_keys(F.col("d"), F.array(F.lit("id"), F.lit("name"))).alias("k")).first()
    assert r["p"] == {"id": "1", "name": "z", "extra": "y"}
    assert r["k"] == {"id": "1", "name": "x"}


def test_date_text_to_epoch_at_plus_eight(spark):
    df = spark.createDataFrame([("2022-12-29 14:31:59", "2022-12-29"), ("bad", "x")],
                               "full string, day string")
    r = df.select(epoch_millis_of_text(F.col("full")).alias("f"),
                  epoch_millis_of_text(F.col("day"), full=False).alias("d")).collect()
    assert r[0]["f"] == 1672295519000
    assert r[0]["d"] == 1672243200000
    assert r[1]["f"] is None and r[1]["d"] is None


def test_epoch_to_text_and_previous_day(spark):
    df = spark.createDataFrame([(1672295519000,)], "ms long")
    r = df.select(day_of_millis(F.col("ms")).alias("d"), ymd_hms_of_millis(F.col("ms")).alias("t"),
                  minus_one_day(F.lit("2024-03-01")).alias("p")).first()
    assert (r["d"], r["t"], r["p"]) == ("2022-12-29", "2022-12-29 06:31:59", "2024-02-29")
