import zlib

import numpy as np
import pytest

from quayside.llm.queries import QUERIES
from quayside.llm.slot_shards import (SLOTS, first_map, grown, read_map, rebalanced,
                                      shard_documents, slot_sums, slotted, store_map)
from tests.conftest import SF_SMALL


def _check(rows, texts, shards=8):
    assert len(rows) == len(texts)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
    for s in range(shards):
        inside = sorted(r.slot for r in rows if r.shard == s)
        assert inside == list(range(len(inside)))
    return [sum(r.size for r in rows if r.shard == s) for s in range(shards)]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whole_table_gives_near_equal_gapless_shards(spark, sf):
    path = SF_SMALL.replace("sf0.001", sf)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    load = _check(QUERIES["op1_slot_shards"](spark, path).collect(), docs)
    largest = max(len((t or "").encode()) + 1 for t in docs.values())
    assert max(load) <= max(largest, 1.002 * sum(load) / 8)


def test_many_slots_are_balanced_and_stored(spark, scratch):
    slots = 65536
    weight = np.random.default_rng(3).lognormal(8, 2, slots).astype(np.int64)
    owner = rebalanced(first_map(8, slots), weight, 8)
    load = np.bincount(owner, weight, 8)
    assert load.max() - load.min() <= 1 or load.max() <= 1.0001 * load.mean()
    store_map(spark, f"{scratch}/map", 3, owner, weight, weight)
    back = sorted(map(tuple, read_map(spark, f"{scratch}/map", 3).collect()))
    assert back == [(3, k, o, w, w) for k, (o, w) in
                    enumerate(zip(owner.tolist(), weight.tolist(), strict=True))]


def test_nulls_repeats_clashing_names_and_empty(make_docs):
    docs = make_docs([(i % 40 if i % 50 else None, None if i % 3 == 0 else "x" * (i % 7))
                      for i in range(200)])
    docs = docs.selectExpr("*", "1 AS shard", "2 AS slot", "3 AS vslot")
    rows = shard_documents(docs, shards=3).collect()
    assert len(rows) == 200 and {r.shard for r in rows} == {0, 1, 2}
    for s in range(3):
        inside = sorted(r.slot for r in rows if r.shard == s)
        assert inside == list(range(len(inside)))
    assert {r.text_crc32 for r in rows if r.size == 1} == {0}
    assert shard_documents(docs.limit(0)).collect() == []


def test_map_is_versioned_and_growth_moves_only_into_the_new_shard(spark, scratch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    shard_documents(docs, map_path=scratch)
    one, two = (read_map(spark, scratch, v).orderBy("vslot").collect() for v in (1, 2))
    assert [r.shard for r in one] == list(first_map(8)) and len(two) == SLOTS
    weight = np.array([r.bytes for r in two])
    sums = {r.vslot: r.bytes for r in slot_sums(slotted(docs)).collect()}
    assert {s: w for s, w in enumerate(weight) if w} == sums
    owner = np.array([r.shard for r in two])
    bigger = grown(owner, weight, 8)
    moved = bigger != owner
    assert moved.any() and set(bigger[moved]) == {8}
    assert (rebalanced(owner, weight, 8) == owner).all()      # nothing left to even out


def test_slot_map_is_written_without_python_rows(make_docs, spark, scratch, monkeypatch):
    docs = make_docs([(i, "text " * i) for i in range(50)])

    def refused(*args, **kwargs):
        raise AssertionError("createDataFrame")

    monkeypatch.setattr(type(spark), "createDataFrame", refused)
    placed = shard_documents(docs, map_path=scratch).collect()
    assert sorted(r.doc_id for r in placed) == list(range(50))
    stored = {r.vslot: r for r in read_map(spark, scratch, 2).collect()}
    assert sorted(stored) == list(range(SLOTS))
    assert sum(r.bytes for r in stored.values()) == sum(r["size"] for r in placed)
    assert all(stored[r.vslot].shard == r.shard for r in placed)
