"""Bounded JDBC reads of configuration tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession


def snake_to_camel(name: str) -> str:
    head, *rest = name.lower().split("_")
    return head + "".join(p[:1].upper() + p[1:] for p in rest)


def _literal(arg) -> str:
    """An SQL literal that reads the same under every quoting rule.

    JDBC reads take SQL text, not bound values. Numbers, booleans and None
    have one spelling; text is refused if it holds a quote, a backslash or a
    control character, which databases escape in different ways. Filter such
    values on the returned frame instead: Spark pushes the filter down.
    """
    if arg is None:
        return "NULL"
    if isinstance(arg, bool):
        return "TRUE" if arg else "FALSE"
    if isinstance(arg, int) or isinstance(arg, float) and math.isfinite(arg):
        return repr(arg)
    if isinstance(arg, str) and not any(c in "'\"\\`" or ord(c) < 32 for c in arg):
        return f"'{arg}'"
    raise ValueError(f"cannot put {arg!r} into SQL text safely; filter the frame instead")


def filled(sql: str, args: list) -> str:
    """`sql` with its `?` placeholders filled; a `?` inside quotes stays."""
    out, left, quote = [], list(args), ""
    for c in sql:
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"`":
            quote = c
        elif c == "?":
            if not left:
                raise ValueError("placeholder count does not match the arguments")
            c = _literal(left.pop(0))
        out.append(c)
    if left:
        raise ValueError("placeholder count does not match the arguments")
    return "".join(out)


def query_list(spark: SparkSession, url: str, sql: str, properties: dict | None = None,
               args: list | None = None, camel_case: bool = False) -> DataFrame:
    """Run one query on a database and return its rows as a DataFrame.

    `args` fill `?` placeholders (`filled`). With `camel_case`, snake_case
    column names become camelCase.
    """
    if args:
        sql = filled(sql, args)
    reader = spark.read.format("jdbc").option("url", url).option("query", sql)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    df = reader.load()
    if camel_case:
        df = df.toDF(*[snake_to_camel(c) for c in df.columns])
    return df
