import json

from pyspark.sql import functions as F

from quayside.operators import traffic
from quayside.plans import queries as Q
from quayside.sources import replay
from quayside.sources.logs import clean_log
from quayside.streaming import jobs, launcher, visits
from tests.conftest import SF_SMALL
from tests.test_streaming import _log_chunks, rows_of, write_files

DAY = 86_400_000


def _is_new(log):
    return rows_of(log.select("offset", F.col("common")["is_new"].alias("is_new")),
                   ["offset", "is_new"])


def _text(spark, records, partitions=1):
    rows = [(i, json.dumps({"common": {"mid": m, "is_new": n}, "ts": t, "page": {"page_id": "p"}}))
            for i, (m, n, t) in records]
    return spark.createDataFrame(rows, "offset long, value string").repartition(partitions)


def test_stream_equals_batch_with_compaction(spark, scratch):
    folder = write_files(f"{scratch}/log", _log_chunks(spark, 5), fmt="json")
    stream = (spark.readStream.schema("value string, offset long")
              .option("maxFilesPerTrigger", 1).json(folder))

    def write(batch, batch_id):
        visits.repair(batch, batch_id, f"{scratch}/days", compact_every=2).write.mode(
            "overwrite").parquet(f"{scratch}/out/{batch_id}")

    launcher.run_available(stream, "visits_t", foreach_batch=write, checkpoint=f"{scratch}/ck")
    got = spark.read.option("recursiveFileLookup", "true").parquet(f"{scratch}/out")
    want = traffic.repair_is_new(clean_log(replay.ods_log(spark, SF_SMALL)))
    assert _is_new(got) == _is_new(want)
    assert len({r[1] for r in _is_new(got)}) == 2      # both kinds of visitor
    # every device has one row in the last compaction and the batch after it
    days = visits.known_days(spark, f"{scratch}/days", 5, 2)
    assert days.count() == days.select("_mid").distinct().count() == traffic.first_visit_days(
        clean_log(replay.ods_log(spark, SF_SMALL))).count()


def test_topics_of_the_log_job(spark, scratch):
    folder = write_files(f"{scratch}/log", _log_chunks(spark, 2), fmt="json")
    stream = spark.readStream.schema("value string, offset long").json(folder)

    def write(frame, batch_id):
        frame.write.mode("overwrite").parquet(f"{scratch}/out/{batch_id}")

    launcher.run_available(stream, "visits_topics_t", checkpoint=f"{scratch}/ck",
                           foreach_batch=jobs.traffic_topics_batch(f"{scratch}/days", write))
    got = spark.read.option("recursiveFileLookup", "true").parquet(f"{scratch}/out")
    assert dict(got.groupBy("topic").count().collect()) == dict(
        Q.traffic_topic_counts(spark, SF_SMALL).collect())


def test_a_batch_that_runs_again_gives_the_same_rows(spark, scratch):
    path = f"{scratch}/days"
    first = _text(spark, enumerate([("a", "1", 0), ("b", "0", DAY), ("c", "1", None)]))
    second = _text(spark, enumerate([("a", "1", DAY), ("a", "1", 0), ("b", "1", 0), ("c", "1", DAY),
                                     ("d", "1", DAY), ("d", "1", 2 * DAY), ("a", "0", None)]))
    assert [r[1] for r in _is_new(visits.repair(first, 0, path, 2))] == ["1", "0", "1"]
    once = _is_new(visits.repair(second, 1, path, 2))
    # b came first with "0" on day 1, so its first day is day 0
    assert [r[1] for r in once] == ["0", "1", "1", "1", "1", "0", "0"]
    days = rows_of(visits.known_days(spark, path, 2, 2))
    assert len(days) == 4
    assert _is_new(visits.repair(second, 1, path, 2)) == once
    assert rows_of(visits.known_days(spark, path, 2, 2)) == days
    assert _is_new(visits.repair(first.limit(0), 2, path, 2)) == []
    assert rows_of(visits.known_days(spark, path, 3, 2)) == days


def test_a_hot_device_is_spread_over_tasks(spark, scratch):
    """Half of the rows are of one device; the skew join splits its partition."""
    small = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
             "spark.sql.adaptive.coalescePartitions.enabled": "false",
             "spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    records = [(i, ("hot" if i % 2 else f"m{i % 97}", str(i % 3 % 2), (i * 7 % 5) * DAY))
               for i in range(8000)]
    raw = _text(spark, records, 8)
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        out = visits.repair(raw, 0, f"{scratch}/days")
        out.select("offset", F.col("common")["is_new"].alias("is_new"),
                   F.col("common")["mid"].alias("mid"),
                   F.spark_partition_id().alias("task")).write.parquet(f"{scratch}/out")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    got = spark.read.parquet(f"{scratch}/out")
    assert rows_of(got, ["offset", "is_new"]) == _is_new(traffic.repair_is_new(clean_log(raw)))
    hot = got.where("mid = 'hot'").groupBy("task").count().collect()
    assert len(hot) >= 4 and max(r["count"] for r in hot) < 2000
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
