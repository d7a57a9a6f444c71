"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins at run time (coalescing
# small shuffle partitions, splitting skewed ones, and turning a join into a
# broadcast only once the *measured* side is below the threshold). Broadcasts
# from plan-time estimates are off: an estimate taken from file sizes misses
# JSON expansion and explodes. Explicit, size-checked hints (dictionary,
# rules) still apply.
BASE_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "quayside", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the warehouse defaults.

    ``shuffle_partitions`` should be sized for the cluster (at 100 TB: a few
    thousand, AQE coalesces the rest); local tests use the core count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Folders chosen by `checkpoint_root(default=...)` for sessions that name
# none (the core setting cannot be changed once the context runs).
_FALLBACK_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession, default: str | None = None) -> str:
    """The shared folder named by `spark.checkpoint.dir`.

    On a cluster this must be a shared file system (HDFS, object store) so a
    lost executor's work can be recomputed from it. A default is only applied
    where the session leaves it unset (tests): it becomes the context's
    checkpoint directory for `DataFrame.checkpoint()`.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    app = None
    try:
        sc = spark.sparkContext
        app = sc.applicationId
        root = root or sc.getConf().get("spark.checkpoint.dir", None)
    except Exception:   # no SparkContext access (Spark Connect)
        pass
    root = root or _FALLBACK_ROOTS.get(app)
    if not root:
        if default is None:
            raise RuntimeError("spark.checkpoint.dir is not set for this session")
        root = default
        try:
            spark.sparkContext.setCheckpointDir(root)
        except Exception:
            pass
        _FALLBACK_ROOTS[app] = root
    return root.rstrip("/")


def checkpoint_path(spark: SparkSession, *parts: str) -> str:
    return os.path.join(checkpoint_root(spark), *parts)
