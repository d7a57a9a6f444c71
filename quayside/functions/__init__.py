"""Column-level helpers; all are built-in Spark expressions (codegen, no UDFs)."""

from quayside.functions.maps import keep_keys, merge_maps, put_entry
from quayside.functions.text import java_split
from quayside.functions.times import (
    day_of_millis, epoch_millis_of_text, minus_one_day, ymd_hms_of_millis,
)

__all__ = [
    "keep_keys", "merge_maps", "put_entry", "java_split", "day_of_millis",
    "epoch_millis_of_text", "minus_one_day", "ymd_hms_of_millis",
]
