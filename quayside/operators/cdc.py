"""Change-log filters and projections over the parsed `ods_db` envelope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.schemas import DEFAULT_DATABASE

BOOTSTRAP = "bootstrap-"


def _in_table(ods: DataFrame, table: str) -> Column:
    cond = F.col("table") == table
    if "_table" in ods.columns:
        # landing partition of the record: lets Catalyst prune other tables
        cond = (F.col("_table") == table) & cond
    return cond


def changes(ods: DataFrame, table: str, types=("insert",),
            database: str | None = DEFAULT_DATABASE) -> DataFrame:
    """Records of one table and operation type (P3). `types=None`: any type."""
    cond = _in_table(ods, table)
    if database is not None:
        cond = cond & (F.col("database") == database)
    if types is not None:
        cond = cond & F.col("type").isin(*types)
    return ods.filter(cond)


def transitioned(ods: DataFrame, table: str, field: str, value: str,
                 database: str | None = DEFAULT_DATABASE) -> DataFrame:
    """Updates that changed `field` to `value` (P6): the field is among the
    changed ones (`old[field]` present) and now equals `value`."""
    return changes(ods, table, ("update",), database).filter(
        F.col("old")[field].isNotNull() & (F.col("data")[field] == value))


def fields(*names: str, **renamed: str) -> list[Column]:
    """`data[k] AS k` for each name, and `data[v] AS k` for each rename."""
    cols = [F.col("data")[n].alias(n) for n in names]
    cols += [F.col("data")[src].alias(dst) for dst, src in renamed.items()]
    return cols


def clean_ods(ods: DataFrame, database: str = DEFAULT_DATABASE,
              types=("insert", "update")) -> DataFrame:
    """Drop dirty change records.

    Keeps parsed objects of `database` whose operation (with a leading
    `bootstrap-` removed, so snapshot rows count as inserts) is in `types`
    and whose `data` is a non-empty object.
    """
    typ = F.regexp_replace(F.col("type"), "^" + BOOTSTRAP, "")
    return (ods.withColumn("type", typ)
               .filter((F.col("database") == database) & F.col("type").isin(*types)
                       & (F.size("data") > 0)))
