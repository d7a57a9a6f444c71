"""Tracking-log steps: new-visitor repair (T1) and the five-way split.

Input is the cleaned, parsed log (`sources.logs.clean_log`): `common`,
`page`, `start`, `err` string maps, `displays` / `actions` arrays of string
maps, `ts` epoch millis, and the arrival `offset`.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.maps import merge_maps, put_entry
from quayside.functions.times import day_of_millis, minus_one_day

# Topic names of the five traffic outputs.
TOPIC_START = "dwd_traffic_start"
TOPIC_DISPLAY = "dwd_traffic_display"
TOPIC_ACTION = "dwd_traffic_action"
TOPIC_ERR = "dwd_traffic_err"
TOPIC_PAGE = "dwd_traffic_page"

LOG_COLUMNS = ["common", "page", "start", "displays", "actions", "err", "ts"]


def arrival_order(df: DataFrame) -> list[str]:
    """Columns giving the arrival order of log records."""
    return ["ts"] + [c for c in ("partition", "offset") if c in df.columns]


def first_visit_days(log: DataFrame) -> DataFrame:
    """Per device (`mid`): the first-visit day the repair keeps in state.

    The first record of a device fixes it: its own day when it says
    `is_new = '1'`, else the day before (a record without `ts` fixes no day
    and is not repaired). One `min_by` aggregation, partially
    aggregated before the shuffle, so a device with a huge share of records
    costs one row per task, not all its records in one task. `log` is either
    the parsed log or its keys (`sources.logs.log_keys`: `mid`, `is_new`).
    """
    if "common" in log.columns:
        mid, is_new = F.col("common")["mid"], F.col("common")["is_new"]
    else:
        mid, is_new = F.col("mid"), F.col("is_new")
    day = day_of_millis(F.col("ts"))
    first = F.when(is_new == "1", day).otherwise(minus_one_day(day)).cast("date")
    firsts = log.filter(F.col("ts").isNotNull()).groupBy(mid.alias("_mid")).agg(
        F.min_by(first, arrival_number(log)).alias("_first"))
    return firsts.select("_mid", F.col("_first").cast("string").alias("_first_day"))


def arrival_number(log: DataFrame) -> Column:
    """`arrival_order` as one DECIMAL(38,0): time, then partition (6 digits),
    then offset (15 digits). Fixed-width values let the aggregate hash its
    keys instead of sorting its input."""
    digits = {"ts": 21, "partition": 15, "offset": 0}
    largest = {"ts": 10**16, "partition": 10**6 - 1, "offset": 10**15 - 1}
    number = F.lit(0).cast("decimal(38,0)")
    for c in arrival_order(log):
        value = F.least(F.greatest(F.col(c), F.lit(-largest[c])), F.lit(largest[c]))
        scaled = value.cast("decimal(17,0)") * F.lit(Decimal(10 ** digits[c])).cast("decimal(22,0)")
        number = (number + scaled.cast("decimal(38,0)")).cast("decimal(38,0)")
    return number


def repaired_is_new(is_new: Column, day: Column, first_day: Column) -> Column:
    """A record claiming a new visitor on a later day than the first visit
    is an old visitor."""
    return F.when((is_new == "1") & (day != first_day), F.lit("0")).otherwise(is_new)


def repair_is_new(log: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Batch new-visitor repair (T1): `common.is_new` corrected per device.

    Exact for any arrival order because the state is written once (by the
    device's first record). The join back to the records is a shuffle join
    on `mid`; AQE splits a skewed device partition, the per-device side has
    one row per device. Pass `keys` (`sources.logs.log_keys` of the same
    raw log) to compute the per-device days from a narrower parse.
    """
    return repair_with(log, first_visit_days(log if keys is None else keys))


def repair_with(log: DataFrame, days: DataFrame) -> DataFrame:
    """`log` corrected by known first-visit days (`_mid`, `_first_day`, one row
    per device); records of other devices stay as they are."""
    c = F.col("common")
    j = log.join(days, c["mid"] == F.col("_mid"), "left")
    fixed = repaired_is_new(c["is_new"], day_of_millis(F.col("ts")), F.col("_first_day"))
    changed = F.coalesce(fixed != c["is_new"], F.lit(False))
    return (j.withColumn("common", F.when(changed, put_entry(c, "is_new", fixed)).otherwise(c))
             .drop("_mid", "_first_day"))


def _record(df: DataFrame, drop: tuple[str, ...]) -> DataFrame:
    return df.select(*[c for c in LOG_COLUMNS if c not in drop])


def split_log(log: DataFrame) -> dict[str, DataFrame]:
    """The five traffic outputs of one (repaired) log.

    * start:   records with `start`, whole, and nothing else from them;
    * display: one row per `displays[i]`, merged with `common` (common wins)
               and the record's `ts`;
    * action:  one row per `actions[i]`, merged with `common` (keeps its ts);
    * error:   records with `err`, without displays and actions;
    * page:    every non-start record without displays, actions and err.
    """
    is_start = F.col("start").isNotNull()
    rest = log.filter(~is_start)
    start = _record(log.filter(is_start), ())
    display = rest.select(F.explode("displays").alias("d"), "common", "ts").select(
        merge_maps(merge_maps(F.col("d"), F.col("common")),
                   F.create_map(F.lit("ts"), F.col("ts").cast("string"))).alias("display"))
    action = rest.select(F.explode("actions").alias("a"), "common").select(
        merge_maps(F.col("a"), F.col("common")).alias("action"))
    error = _record(rest.filter(F.col("err").isNotNull()), ("displays", "actions"))
    page = _record(rest, ("displays", "actions", "err"))
    return {TOPIC_START: start, TOPIC_DISPLAY: display, TOPIC_ACTION: action,
            TOPIC_ERR: error, TOPIC_PAGE: page}


def _declared(log: DataFrame) -> DataFrame:
    """`start`, `err` flags and the pieces of the outputs from the declared
    columns (string maps)."""
    ts = F.create_map(F.lit("ts"), F.col("ts").cast("string"))
    maps = "array<map<string,string>>"

    def rec(*drop: str) -> Column:
        return F.to_json(F.struct(*[F.col(c) for c in LOG_COLUMNS if c not in drop]))

    return log.withColumns({
        "_whole": rec(), "_page": rec("displays", "actions", "err"),
        "_err": F.when(F.col("err").isNotNull(), rec("displays", "actions")),
        "_displays": F.transform(F.coalesce("displays", F.array().cast(maps)), lambda d: F.to_json(
            merge_maps(merge_maps(d, F.col("common")), ts))),
        "_actions": F.transform(F.coalesce("actions", F.array().cast(maps)), lambda a: F.to_json(
            merge_maps(a, F.col("common"))))})


def _open(log: DataFrame) -> DataFrame:
    """The same pieces from the whole `record` (`sources.logs.clean_log` with
    `record=True`): unknown fields and value types stay. The repaired flag
    replaces the record's own."""
    log = log.withColumn("_common", F.expr(
        "try_variant_get(record['common'], '$', 'map<string,variant>')"))
    log = log.withColumn("_flag", F.expr("try_variant_get(record['common'], '$.is_new', 'string')"))
    log = log.withColumn("_common", F.expr("""
        CASE WHEN common['is_new'] IS DISTINCT FROM _flag THEN map_concat(
               map_filter(_common, (k, v) -> k != 'is_new'),
               map('is_new', CAST(common['is_new'] AS VARIANT)))
             ELSE _common END"""))
    log = log.withColumn("_record", F.expr("""
        CASE WHEN common['is_new'] IS DISTINCT FROM _flag THEN map_concat(
               map_filter(record, (k, v) -> k != 'common'),
               map('common', to_variant_object(_common)))
             ELSE record END"""))

    def rec(*drop: str) -> Column:
        names = ", ".join(f"'{d}'" for d in drop)
        return F.expr(f"to_json(map_filter(_record, (k, v) -> k NOT IN ({names})))")

    def children(field: str, winner: str) -> Column:
        """Each child map merged with `winner`, whose entries win."""
        return F.expr(f"""
            transform(coalesce(try_variant_get(record['{field}'], '$', 'array<map<string,variant>>'),
                               CAST(array() AS array<map<string,variant>>)),
                      c -> to_json(map_concat(
                          map_filter(coalesce(c, CAST(map() AS map<string,variant>)),
                                     (k, v) -> NOT array_contains(map_keys({winner}), k)), {winner})))""")

    log = log.withColumn("_timed", F.expr("""
        map_concat(map_filter(_common, (k, v) -> k != 'ts'), map('ts', CAST(ts AS VARIANT)))"""))
    return log.withColumns({
        "_whole": F.to_json("_record"), "_page": rec("displays", "actions", "err"),
        "_err": F.when(F.col("err").isNotNull(), rec("displays", "actions")),
        "_displays": children("displays", "_timed"), "_actions": children("actions", "_common")})


def split_as_topics(log: DataFrame) -> DataFrame:
    """All five outputs as one `key`, `topic`, `value` frame (K5) in a single pass.

    Each record yields an array of (topic, JSON text) pairs that one
    `explode` turns into rows: no union of five branches, so the log (and
    any keyed state before it) is read once and a Kafka sink routes every
    row by its `topic`. With a `record` column the outputs are made from the
    whole record, and keep fields that the schema does not name.
    """
    log = _open(log) if "record" in log.columns else _declared(log)

    def pair(topic: str, value: Column) -> Column:
        return F.struct(F.lit(topic).alias("topic"), value.alias("value"))

    empty = F.array().cast("array<struct<topic:string,value:string>>")
    error = F.when(F.col("_err").isNotNull(), F.array(pair(TOPIC_ERR, F.col("_err")))
                   ).otherwise(empty)
    pairs = F.when(F.col("start").isNotNull(), F.array(pair(TOPIC_START, F.col("_whole")))
                   ).otherwise(F.concat(
                       F.transform("_displays", lambda d: pair(TOPIC_DISPLAY, d)),
                       F.transform("_actions", lambda a: pair(TOPIC_ACTION, a)),
                       error, F.array(pair(TOPIC_PAGE, F.col("_page")))))
    place = [c for c in ("partition", "offset") if c in log.columns]
    out = log.select(F.posexplode(pairs).alias("pos", "p"), *place)
    return out.select(source_key(out, "pos"), "p.topic", "p.value")


def source_key(df: DataFrame, *inside: str) -> Column:
    """`key` of an output row that has no id of its own: the source partition
    and offset and its place in the record. A retried micro-batch writes the
    same keys again, so readers can drop what they have seen."""
    parts = [c for c in ("partition", "offset") if c in df.columns]
    return F.concat_ws("-", *[F.col(c).cast("string") for c in (*parts, *inside)]).alias("key")
