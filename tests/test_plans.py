"""Plan properties that matter at scale, checked on every registered query."""

import re

import pytest

import __spark_entry__ as E
from quayside.plans.queries import QUERIES
from tests.conftest import SF_SMALL

KEYS = sorted(QUERIES)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _broadcast_subtrees(plan: str) -> list[str]:
    """Text of each BroadcastExchange subtree (by indentation)."""
    lines = plan.splitlines()
    out = []
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            indent = len(line) - len(line.lstrip(" :+-"))
            sub = [line]
            for nxt in lines[i + 1:]:
                if len(nxt) - len(nxt.lstrip(" :+-")) <= indent:
                    break
                sub.append(nxt)
            out.append("\n".join(sub))
    return out


@pytest.mark.parametrize("key", KEYS)
def test_plan_properties(spark, key):
    """Only configuration (dictionary, rules) is broadcast, never data read
    from the tables, whose size grows with them; and no `from_json` is
    copied into a filter predicate (one parse per record)."""
    plan = _plan(E.queries()[key](spark, SF_SMALL))
    for sub in _broadcast_subtrees(plan):
        assert "FileScan" not in sub, sub[:300]
    for line in plan.splitlines():
        if re.search(r"\bFilter\b", line):
            assert "from_json" not in line, line[:300]


def test_cart_add_reads_only_its_sources(spark):
    plan = _plan(E.queries()["trade_cart_add"](spark, SF_SMALL))
    scanned = set(re.findall(r"/(\w+)\.parquet", plan))
    assert scanned == {"events"}
