"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    """A DuckDB connection with the scale directory's tables as views."""
    import os

    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer():
            v = int(v)
    return str(v)


def rows(pdf):
    """Sorted column names and sorted rows of text values."""
    cols = sorted(pdf.columns)
    pdf = pdf[cols]
    out = [tuple(norm(x) for x in r) for r in pdf.itertuples(index=False, name=None)]
    return cols, sorted(out, key=lambda r: tuple("" if x is None else x for x in r))


def same(spark_pdf, oracle_pdf) -> tuple[bool, str]:
    sc, sr = rows(spark_pdf)
    oc, orr = rows(oracle_pdf)
    if sc != oc:
        return False, f"columns differ: {sc} vs {oc}"
    if len(sr) != len(orr):
        return False, f"row counts differ: {len(sr)} vs {len(orr)}"
    if sr != orr:
        diff = sorted(set(sr) ^ set(orr))[:3]
        return False, f"values differ, e.g. {diff}"
    return True, ""
