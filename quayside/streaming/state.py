"""Keyed state for the streaming new-visitor repair.

Each device (`mid`) keeps one value: its first-visit day, fixed by the first
record ever seen for it (its own day when it says `is_new = '1'`, else the
day before). Once the state exists every row is corrected on its own, so a
device's rows stream through chunk by chunk (Arrow batches) without being
held together. Only in the micro-batch where a device first appears are its
rows held, to find its earliest record by arrival (`ts`, then the source
`partition` and `offset`, as in the batch form); that batch is bounded by
the source's trigger limit (`maxOffsetsPerTrigger` / `maxFilesPerTrigger`).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT_SCHEMA = "value string, partition int, offset long, is_new string"
STATE_SCHEMA = "first_day string"


def _days(ts: pd.Series, tz_name: str) -> pd.Series:
    t = pd.to_datetime(ts, unit="ms", utc=True)   # NaN -> NaT -> no day
    if tz_name != "UTC":
        t = t.dt.tz_convert(tz_name)
    return t.dt.strftime("%Y-%m-%d")


def _repaired(pdf: pd.DataFrame, first_day: str, tz_name: str) -> pd.DataFrame:
    late_new = ((pdf["is_new"] == "1") & pdf["ts"].notna()
                & (_days(pdf["ts"], tz_name) != first_day))
    is_new = pdf["is_new"].where(~late_new, "0")
    return pdf[["value", "partition", "offset"]].assign(is_new=is_new)


def repair_group(tz_name: str = "UTC"):
    """The per-device function for `applyInPandasWithState`."""

    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.exists:
            first_day = state.get[0]
            for pdf in pdfs:
                yield _repaired(pdf, first_day, tz_name)
            return
        pdf = pd.concat(list(pdfs), ignore_index=True)
        timed = pdf[pdf["ts"].notna()]
        if timed.empty:                 # a record without `ts` fixes no day
            yield pdf[["value", "partition", "offset", "is_new"]]
            return
        earliest = timed.sort_values(["ts", "partition", "offset"], kind="stable").iloc[0]
        day = _days(pd.Series([earliest["ts"]]), tz_name).iloc[0]
        if earliest["is_new"] != "1":
            day = (pd.Timestamp(day) - pd.Timedelta(days=1)).strftime("%Y-%m-%d")
        state.update((day,))
        yield _repaired(pdf, day, tz_name)

    return fn


def repair_is_new_stream(keys: DataFrame, tz_name: str = "UTC") -> DataFrame:
    """`keys`: streaming rows with `value`, `mid`, `ts`, `partition`,
    `offset`, `is_new` (`key_columns`).
    Returns `value`, `partition`, `offset` and the corrected `is_new` per row."""
    return keys.groupBy("mid").applyInPandasWithState(
        repair_group(tz_name), OUTPUT_SCHEMA, STATE_SCHEMA, "append",
        GroupStateTimeout.NoTimeout)


def key_columns(raw: DataFrame) -> DataFrame:
    """Device id, time and flag of each valid log record, with its text and
    offset (others dropped). Only `common` and `ts` are parsed here; the full
    record is parsed once more after the repair."""
    from quayside.sources.logs import KEY_SCHEMA
    from quayside.sources.ods import parse_once
    part = F.col("partition") if "partition" in raw.columns else F.lit(0)
    keep = raw.select("value", "offset", part.cast("int").alias("partition"),
                      parse_once(F.from_json(F.col("value"), KEY_SCHEMA)))
    return keep.select("value", "offset", "partition", F.col("common")["mid"].alias("mid"), "ts",
                       F.col("common")["is_new"].alias("is_new")).filter(F.col("mid").isNotNull())


# -- joins with idle-time retention (T2) --------------------------------------------

class IdleJoin(StatefulProcessor):
    """Left rows (the last version per row id) and right rows of one join key,
    each kept for a time after its last write. A pair comes out when the later
    of the two comes, if the other is still kept."""

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.left = handle.getMapState("left", "id string", "body string", self.idle_ms)
        self.right = handle.getMapState("right", "id string", "body string", self.idle_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pairs = []
        for pdf in rows:
            for is_left, row_id, body in zip(pdf["is_left"], pdf["row_id"], pdf["body"],
                                             strict=True):
                mine, other = (self.left, self.right) if is_left else (self.right, self.left)
                mine.updateValue((row_id,), (body,))
                pairs += [(body, o[0]) if is_left else (o[0], body) for o in other.values()]
        if pairs:
            yield pd.DataFrame(pairs, columns=["l", "r"])

    def close(self) -> None:
        pass


def idle_join(left: DataFrame, right: DataFrame, key: str, left_id: str, idle_seconds: float,
              left_name: str, right_name: str) -> DataFrame:
    """Inner join of two streams on `key`, as the struct columns `left_name` and
    `right_name`. A row's state goes `idle_seconds` (processing time) after its
    last write: rows of one `left_id` replace each other, a repeated right row
    counts as written again. State is bounded by what is written in that time.
    Such a query runs batches without data too, so `availableNow` never ends it."""
    def side(df: DataFrame, is_left: bool) -> DataFrame:
        body = F.to_json(F.struct(*df.columns))
        return df.filter(F.col(key).isNotNull()).select(
            F.col(key).alias("k"), F.lit(is_left).alias("is_left"),
            (F.col(left_id) if is_left else body).cast("string").alias("row_id"),
            body.alias("body"))

    met = side(left, True).unionByName(side(right, False)).groupBy("k").transformWithStateInPandas(
        IdleJoin(int(idle_seconds * 1000)), "l string, r string", "Append", "ProcessingTime")
    return met.select(F.from_json("l", left.schema).alias(left_name),
                      F.from_json("r", right.schema).alias(right_name))


# -- order detail from parts (J5, J6) ---------------------------------------------

PART_SCHEMA = "id string, base string, activity string, coupon string"
PARTS_STATE = "parts string"


def _merge_group(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """One order detail: its distinct base, activity and coupon rows so far.
    All combinations come out whenever one of them is new and a base is known."""
    parts = json.loads(state.get[0]) if state.exists else {"base": [], "activity": [], "coupon": []}
    new = False
    for pdf in pdfs:
        for kind, body in zip(pdf["kind"], pdf["body"]):
            if body not in parts[kind]:
                parts[kind].append(body)
                new = True
    if not new:
        return
    state.update((json.dumps(parts),))
    rows = [(key[0], b, a, c) for b in parts["base"] for a in parts["activity"] or [None]
            for c in parts["coupon"] or [None]]
    if rows:
        yield pd.DataFrame(rows, columns=["id", "base", "activity", "coupon"])


def merge_parts(base: DataFrame, activities: DataFrame, coupons: DataFrame) -> DataFrame:
    """Joined order-detail rows (`trade.name_order_details` names them) from
    streams of detail rows, activity rows and coupon rows, merged by detail id
    in whatever order they come.

    The state of a detail is kept for good: its activity may come at any
    time. A detail has few parts, so a key's rows stay small."""
    def part(df: DataFrame, key: str, kind: str) -> DataFrame:
        return df.select(F.col(key).alias("id"), F.lit(kind).alias("kind"),
                         F.to_json(F.struct(*df.columns)).alias("body"))

    parts = (part(base, "id", "base").unionByName(part(activities, "order_detail_id", "activity"))
             .unionByName(part(coupons, "order_detail_id", "coupon"))
             .filter(F.col("id").isNotNull()))
    merged = parts.groupBy("id").applyInPandasWithState(
        _merge_group, PART_SCHEMA, PARTS_STATE, "append", GroupStateTimeout.NoTimeout)
    j = merged.select(F.from_json("base", base.schema).alias("b"),
                      F.from_json("activity", activities.schema).alias("a"),
                      F.from_json("coupon", coupons.schema).alias("c"))
    return j.select("b.*", "a.activity_id", "a.activity_rule_id", "c.coupon_id")
