"""Dimension routing driven by the rule table (DIM layer and dynamic DWD).

Rules are configuration: a bounded table (one row per source table and
operation), size-checked and broadcast. Change rows are cleaned records of
`ods_db` (`cdc.clean_ods`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.maps import keep_keys
from quayside.operators.lookup import bounded_broadcast
from quayside.operators.upsert import latest_by_key
from quayside.schemas import RULE_FIELDS

# Rules are few; this bound keeps the broadcast small on every executor.
MAX_RULES = 100_000
ALL_TYPES = "ALL"
DEFAULT_PK = "id"


def active_rules(changes: DataFrame, preload: DataFrame | None = None) -> DataFrame:
    """Current rule per `source_table:source_type` (A3).

    Preloaded rules (seq -1) come first, streamed changes override them; a
    key whose last change is a delete has no rule.
    """
    allc = changes if preload is None else preload.unionByName(changes)
    last = allc.groupBy("source_table", "source_type").agg(
        F.max_by(F.struct(*[F.col(c) for c in RULE_FIELDS], "op"), F.col("seq")).alias("_r"),
        F.max("seq").alias("seq"))
    out = last.select(*[F.col("_r")[c].alias(c) for c in RULE_FIELDS],
                      F.col("_r.op").alias("op"), "seq")
    return out.filter(F.col("op") != "d")


def rules_of(rules: DataFrame, sink_type: str) -> DataFrame:
    """Rules with the given sink type, `dim` or `dwd` (P5)."""
    return rules.filter(F.col("sink_type") == sink_type)


def key_columns(sink_pk: Column) -> Column:
    """The key columns of a rule as an array: `sink_pk` split at commas and
    trimmed, or `id` when missing or blank."""
    parts = column_list(F.coalesce(sink_pk, F.lit("")))
    return F.when(F.size(parts) > 0, parts).otherwise(F.array(F.lit(DEFAULT_PK)))


def pk_of(sink_pk: Column) -> Column:
    """The key columns of a rule as comma-joined text."""
    return F.array_join(key_columns(sink_pk), ",")


def column_list(text: Column) -> Column:
    """Comma-separated names -> array of names (trimmed, empty ones dropped)."""
    return F.filter(F.transform(F.split(text, ","), lambda c: F.trim(c)), lambda c: c != "")


def key_value(data: Column, sink_pk: Column) -> Column:
    """A row's key: the value of its key column; of several, their JSON array.
    NULL if any part is missing."""
    values = F.transform(key_columns(sink_pk), lambda c: data[c])
    whole = F.when(F.size(values) == 1, values[0]).otherwise(F.to_json(values))
    return F.when(~F.exists(values, F.isnull), whole)


def route(clean: DataFrame, rules: DataFrame, by_type: bool = False,
          max_rules: int = MAX_RULES, arrival: str | None = None) -> DataFrame:
    """Attach the matching rule to each clean change row.

    DIM routing matches `table` to a rule of source type `ALL`; DWD routing
    (`by_type`) matches `table` and the row's operation exactly. Rows with no
    rule are not dimension rows and are dropped. The row keeps only the
    rule's columns (`data` pruned), its operation as `op_type`, and its key.
    With `arrival`, `rules` are versions, and a row takes the one valid at
    that column (`as_of.route_as_of`).
    """
    interval = [] if arrival is None else ["valid_from", "valid_to"]
    r = bounded_broadcast(rules.select(*RULE_FIELDS, *interval), max_rules)
    if "_table" in clean.columns:
        # landed log: read only the partitions of tables that have a rule
        tables = [row[0] for row in rules.select("source_table").distinct()
                  .limit(max_rules + 1).collect()]
        if len(tables) <= max_rules:
            clean = clean.filter(F.col("_table").isin(tables))
    cond = F.col("table") == F.col("source_table")
    cond = cond & (F.col("source_type") == (F.col("type") if by_type else F.lit(ALL_TYPES)))
    if arrival is not None:
        cond = cond & (F.col(arrival) >= F.col("valid_from")) & (F.col(arrival) < F.col("valid_to"))
    j = clean.join(r, cond, "inner")
    keep = [c for c in ("_table", "partition", "offset", arrival) if c in clean.columns]
    # Names of their own first: inside a lambda, Spark takes a column for a
    # sibling alias of the same name.
    j = j.withColumns({
        "_key_columns": pk_of(F.col("sink_pk")), "_key": key_value(F.col("data"), F.col("sink_pk")),
        "_kept": keep_keys(F.col("data"), column_list(F.col("sink_columns")))})
    return j.select(
        "sink_table", "sink_columns", F.col("_key_columns").alias("sink_pk"), "sink_extend",
        F.col("type").alias("op_type"), F.col("_key").alias("pk"), F.col("_kept").alias("data"),
        "ts", *keep)


def latest_rows(routed: DataFrame) -> DataFrame:
    """Last change per (sink table, key), the row a keyed upsert leaves: by
    `ts`, then by arrival (`partition`, `offset`) where the log has it. Rows
    without a whole key are left out (`rejected_rows`)."""
    arrival = [c for c in ("partition", "offset") if c in routed.columns]
    return latest_by_key(routed.filter(F.col("pk").isNotNull()), ["sink_table", "pk"],
                         ["ts", *arrival])


def rejected_rows(routed: DataFrame) -> DataFrame:
    """Routed rows that lack a part of their key, and so cannot be upserted."""
    return routed.filter(F.col("pk").isNull())


def long_form(routed: DataFrame) -> DataFrame:
    """One row per (routed row, kept column): `column`, `value`."""
    return routed.select("sink_table", "pk", "op_type", "ts",
                         F.explode("data").alias("column", "value"))


# -- DDL driven by rule changes (D-a .. D-c) ------------------------------------

def _bucket_clause(extend: Column, pk: Column) -> Column:
    n = F.regexp_extract(extend, r"SALT_BUCKETS\s*=\s*(\d+)", 1)
    return F.when(F.coalesce(n, F.lit("")) != "",
                  F.concat(F.lit(" CLUSTERED BY ("), pk, F.lit(") INTO "), n, F.lit(" BUCKETS")))


def ddl_statements(rule_changes: DataFrame, database: str = "dim") -> DataFrame:
    """DDL text per dimension rule change, in change order.

    `r`/`c` create the table when missing; `d` drops it; any other op (an
    update) drops and re-creates it, losing its rows as the reference does.
    Columns are all STRING; a `SALT_BUCKETS=n` extension becomes bucketing
    by the key, and the rule's key and extension are kept as properties.
    """
    dims = rules_of(rule_changes, "dim")
    name = F.concat(F.lit(database + "."), F.col("sink_table"))
    pk = pk_of(F.col("sink_pk"))
    cols = F.array_join(F.transform(column_list(F.col("sink_columns")),
                                    lambda c: F.concat(c, F.lit(" STRING"))), ",")
    create = F.concat(
        F.lit("CREATE TABLE IF NOT EXISTS "), name, F.lit(" ("), cols,
        F.lit(", _batch BIGINT) USING parquet PARTITIONED BY (_batch)"),
        F.coalesce(_bucket_clause(F.col("sink_extend"), pk), F.lit("")),
        F.lit(" TBLPROPERTIES ('pk' = '"), pk, F.lit("', 'extend' = '"),
        F.coalesce(F.regexp_replace(F.col("sink_extend"), "'", ""), F.lit("")), F.lit("')"))
    drop = F.concat(F.lit("DROP TABLE IF EXISTS "), name)
    op = F.col("op")
    stmts = (F.when(op.isin("r", "c"), F.array(create))
              .when(op == "d", F.array(drop))
              .otherwise(F.array(drop, create)))
    return dims.select("seq", "op", "sink_table", F.posexplode(stmts).alias("step", "sql"))


APPLIED_LOG = "_rule_ddl_applied"
# DDL rows read by the driver at a time.
DDL_CHUNK = 1000


def apply_ddl(spark: SparkSession, rule_changes: DataFrame, database: str = "dim",
              chunk: int = DDL_CHUNK) -> list[str]:
    """Run the DDL of a set of rule changes, in order, on the driver; returns
    the statements run.

    Safe to call again with the same or a longer change log: the database
    keeps a small log of applied changes (`_rule_ddl_applied`: `seq` and
    table), which are skipped, so an update (drop + re-create) is not repeated
    when a micro-batch runs again. A long backlog is read in chunks.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    log = f"{database}.{APPLIED_LOG}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {log} (seq BIGINT, sink_table STRING) USING parquet")
    statements = ddl_statements(rule_changes, database)
    ran: list[str] = []
    while True:
        todo = statements.join(spark.table(log), ["seq", "sink_table"], "left_anti")
        rows = todo.orderBy("seq", "sink_table", "step").limit(chunk).collect()
        changes = sorted({(r["seq"], r["sink_table"]) for r in rows})
        if len(rows) == chunk and len(changes) > 1:
            changes.pop()                       # its later steps may be in the next chunk
        for change in changes:
            for r in rows:
                if (r["seq"], r["sink_table"]) == change:
                    spark.sql(r["sql"])
                    ran.append(r["sql"])
        if changes:
            values = ", ".join(f"({int(q)}, '{t}')" for q, t in changes)
            spark.sql(f"INSERT INTO {log} VALUES {values}")
        if len(rows) < chunk:
            return ran
