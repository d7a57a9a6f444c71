"""Configuration as of a record's arrival: rules, dictionary, table epochs.

A change log of a small table becomes *versions* with a validity interval
[`valid_from`, `valid_to`), found by `lead` over each key's changes. A record
meets the version that is valid at its arrival: an equality join on the key
with the interval as a residual condition. So a replayed record takes the rule
and the name it took the first time, whatever has changed since, as a
record-at-a-time fold over the merged logs would give it.

Versions are configuration: broadcast behind the size check of
`lookup.bounded_broadcast`, else a shuffle join on the key, whose hot keys
adaptive execution splits. A change and a record of the same instant: the
change comes first. Changes of one key at the same instant are ordered by their
sequence number and then by content; all but the last have an empty interval.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.operators import dims
from quayside.operators.cdc import BOOTSTRAP, changes
from quayside.operators.lookup import bounded_broadcast
from quayside.schemas import DEFAULT_DATABASE, RULE_FIELDS

VALID = ("valid_from", "valid_to")
BEFORE_ALL, AFTER_ALL = -(1 << 63), (1 << 63) - 1
ARRIVAL = "arrival"
DICTIONARY_TABLE = "base_dic"


def validity(log: DataFrame, keys: list[str], at: str, ties: list[str]) -> DataFrame:
    """Each change with the interval until the key's next change."""
    following = Window.partitionBy(*keys).orderBy(at, *ties)
    return log.withColumns({
        "valid_from": F.col(at),
        "valid_to": F.coalesce(F.lead(at).over(following), F.lit(AFTER_ALL))})


def valid_at(arrival: Column) -> Column:
    return (arrival >= F.col("valid_from")) & (arrival < F.col("valid_to"))


def arrival_millis(df: DataFrame) -> DataFrame:
    """`arrival` in epoch millis from a topic's `timestamp`."""
    return df.withColumn(ARRIVAL, F.unix_millis("timestamp"))


# -- rules (J10, A3) --------------------------------------------------------------

def with_preload(log: DataFrame, preload: DataFrame) -> DataFrame:
    """Timed changes behind preloaded rules (`rules.preload_rules`)."""
    return preload.withColumn("at", F.lit(BEFORE_ALL)).unionByName(log)


def rule_versions(log: DataFrame, preload: DataFrame | None = None) -> DataFrame:
    """Rule versions with their intervals from timed changes
    (`rules.parse_rule_changes(timed=True)`); preloaded rules hold from the
    beginning. A deleted rule has no version until it is created again."""
    if preload is not None:
        log = with_preload(log, preload)
    log = log.filter(F.col("at").isNotNull())
    versions = validity(log, ["source_table", "source_type"], "at",
                        ["seq", "op", *RULE_FIELDS])
    return versions.filter((F.col("op") != "d") & (F.col("valid_from") < F.col("valid_to")))


def route_as_of(clean: DataFrame, versions: DataFrame, by_type: bool = False,
                arrival: str = ARRIVAL, max_rules: int = dims.MAX_RULES) -> DataFrame:
    """`dims.route` with the rule valid at each row's `arrival`; rows that
    arrive while their table has no rule are dropped."""
    return dims.route(clean, versions, by_type, max_rules, arrival)


# -- table epochs (D-b, D-c) ------------------------------------------------------

def table_epochs(log: DataFrame) -> DataFrame:
    """(sink_table, epoch, valid_from, valid_to, last) of every dimension table
    that was ever dropped or replaced. An epoch is the number of its drops and
    replacements so far; epoch 0 ends with the first."""
    resets = dims.rules_of(log, "dim").filter(~F.col("op").isin("r", "c")).select(
        "sink_table", F.coalesce("at", F.lit(0)).alias("at"), "seq", "op")
    order = Window.partitionBy("sink_table").orderBy("at", "seq", "op")
    later = validity(resets, ["sink_table"], "at", ["seq", "op"]).withColumn(
        "epoch", F.row_number().over(order))
    first = resets.groupBy("sink_table").agg(F.min("at").alias("valid_to")).select(
        "sink_table", F.lit(0).alias("epoch"), F.lit(BEFORE_ALL).alias("valid_from"), "valid_to",
        F.lit(False).alias("last"))
    return first.unionByName(later.select(
        "sink_table", "epoch", *VALID, (F.col("valid_to") == AFTER_ALL).alias("last")))


def in_epochs(routed: DataFrame, epochs: DataFrame, arrival: str = ARRIVAL) -> DataFrame:
    """Routed rows with the `epoch` of their table that they fall in, and
    whether it is the `last`; tables that were never reset are in epoch 0."""
    e = bounded_broadcast(epochs.filter(F.col("valid_from") < F.col("valid_to"))
                          .withColumnRenamed("sink_table", "_reset"), dims.MAX_RULES)
    on = (F.col("sink_table") == F.col("_reset")) & valid_at(F.col(arrival))
    return routed.join(e, on, "left").withColumns({
        "epoch": F.coalesce("epoch", F.lit(0)), "last": F.coalesce("last", F.lit(True)),
    }).drop("_reset", *VALID)


def surviving_rows(routed: DataFrame, epochs: DataFrame, arrival: str = ARRIVAL) -> DataFrame:
    """Routed rows that are still in their table: those of its last epoch. A
    drop or a replacement loses the rows that came before it."""
    return in_epochs(routed, epochs, arrival).filter("last").drop("epoch", "last")


# -- dictionary (J1, J2, S4) --------------------------------------------------------

def dictionary_versions(ods: DataFrame, database: str = DEFAULT_DATABASE,
                        table: str = DICTIONARY_TABLE) -> DataFrame:
    """Dictionary entries with their intervals (seconds) from the change log of
    the dictionary table."""
    log = changes(ods, table, None, database).select(
        F.col("data")["dic_code"].alias("dic_code"), F.col("data")["dic_name"].alias("dic_name"),
        F.regexp_replace("type", "^" + BOOTSTRAP, "").alias("op"), F.col("ts").alias("at"))
    log = log.filter(F.col("dic_code").isNotNull() & F.col("at").isNotNull()
                     & F.col("op").isin("insert", "update", "delete"))
    versions = validity(log, ["dic_code"], "at", ["op", "dic_name"])
    return versions.filter((F.col("op") != "delete") & (F.col("valid_from") < F.col("valid_to")))


def lookup_as_of(df: DataFrame, versions: DataFrame, code_col: str, name_col: str,
                 arrival: str = "ts") -> DataFrame:
    """Inner join of `df[code_col]` to the dictionary entry valid at `arrival`,
    adding its name as `name_col`."""
    side = bounded_broadcast(versions.select("dic_code", "dic_name", *VALID)).select(
        F.col("dic_code").alias("_code"), F.col("dic_name").alias(name_col), *VALID)
    on = (F.col(code_col) == F.col("_code")) & valid_at(F.col(arrival))
    return df.join(side, on, "inner").drop("_code", *VALID)
