"""String helpers with the semantics of the reference's string handling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def java_split(s: Column, sep: str = " ") -> Column:
    """Split on a literal one-character separator, dropping trailing empties.

    Matches ``String.split`` with a plain separator: empty pieces at the end
    are dropped (Spark's ``split`` keeps them); an input made only of
    separators gives an empty array; an empty input gives ``[""]``.
    """
    esc = "\\" + sep if sep in ".$|()[{^?*+\\" else sep
    trimmed = F.regexp_replace(s, f"(?:{esc})+$", "")
    return (F.when(s.isNull(), F.lit(None))
             .when((trimmed == "") & (s != ""), F.array().cast("array<string>"))
             .otherwise(F.split(trimmed, esc)))
