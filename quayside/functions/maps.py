"""Operations on the open (MAP<STRING,STRING>) parts of a JSON record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def merge_maps(base: Column, winner: Column) -> Column:
    """All entries of ``base`` and ``winner``; ``winner`` wins on equal keys.

    Keys of ``winner`` are removed from ``base`` first, so no session-wide
    ``mapKeyDedupPolicy`` is needed. A null map counts as empty.
    """
    base = F.coalesce(base, F.create_map().cast("map<string,string>"))
    winner = F.coalesce(winner, F.create_map().cast("map<string,string>"))
    keys = F.map_keys(winner)
    return F.map_concat(F.map_filter(base, lambda k, v: ~F.array_contains(keys, k)), winner)


def put_entry(m: Column, key: str, value: Column) -> Column:
    """``m`` with ``key`` set to ``value`` (replacing an existing entry)."""
    return merge_maps(m, F.create_map(F.lit(key), value.cast("string")))


def keep_keys(m: Column, names: Column, also: tuple[str, ...] = ()) -> Column:
    """Entries of ``m`` whose key is in the array ``names`` or in ``also``."""
    extra = F.array(*[F.lit(a) for a in also]) if also else None

    def keep(k, v):
        cond = F.array_contains(names, k)
        if extra is not None:
            cond = cond | F.array_contains(extra, k)
        return cond

    return F.map_filter(m, keep)
