"""Brute-force checks on small generated inputs (with a hot key)."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.functions.text import java_split
from quayside.operators.upsert import latest_by_key

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def java_split_ref(s: str) -> list[str]:
    """Java's String.split(" ") on a plain one-char separator."""
    if s == "":
        return [""]
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@SETTINGS
@given(st.lists(st.text(alphabet="ab ", max_size=8), min_size=1, max_size=20))
def test_java_split_matches_reference_semantics(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(java_split(F.col("s"))).collect()]
    assert got == [java_split_ref(t) for t in texts]


rows = st.lists(st.tuples(st.sampled_from(["hot"] * 6 + ["k1", "k2", "k3"]),
                          st.integers(0, 5), st.integers(0, 3),
                          st.text(alphabet="xyz", max_size=3)),
                min_size=1, max_size=60)


@SETTINGS
@given(rows)
def test_latest_by_key_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, "k string, t int, s int, v string").repartition(4)
    got = sorted(tuple(r) for r in latest_by_key(df, "k", ["t", "s"]).collect())
    want = {}
    for k, t, s, v in data:
        best = want.get(k)
        if best is None or (t, s, v) > (best[1], best[2], best[3]):
            want[k] = (k, t, s, v)
    assert got == sorted(want.values())


def test_regex_separator_is_escaped(spark):
    df = spark.createDataFrame([("a.b..",)], "s string")
    assert df.select(java_split(F.col("s"), ".")).first()[0] == \
        [p for p in re.split(r"\.", "a.b")]
