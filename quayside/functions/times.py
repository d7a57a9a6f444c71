"""Date/time helpers. Day strings are `yyyy-MM-dd`, date-times
`yyyy-MM-dd HH:mm:ss`; epoch values are millis unless named otherwise.

Formatting follows the session time zone (pin `spark.sql.session.timeZone`,
UTC in tests); parsing takes an explicit zone offset.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = "yyyy-MM-dd"
DAY_TIME = "yyyy-MM-dd HH:mm:ss"


def day_of_millis(ms: Column) -> Column:
    """Epoch millis -> `yyyy-MM-dd` in the session zone."""
    return F.date_format(F.timestamp_millis(ms), DAY)


def ymd_hms_of_millis(ms: Column) -> Column:
    """Epoch millis -> `yyyy-MM-dd HH:mm:ss` in the session zone."""
    return F.date_format(F.timestamp_millis(ms), DAY_TIME)


def minus_one_day(day: Column) -> Column:
    """`yyyy-MM-dd` of the previous calendar day."""
    return F.date_format(F.date_sub(F.to_date(day, DAY), 1), DAY)


def epoch_millis_of_text(text: Column, full: bool = True, offset: str = "+08:00") -> Column:
    """Date (`full=False`) or date-time text read at a fixed zone offset ->
    epoch millis; NULL for text that does not parse."""
    full_text = text if full else F.concat(text, F.lit(" 00:00:00"))
    ts = F.try_to_timestamp(F.concat(full_text, F.lit(offset)), F.lit(DAY_TIME + "XXX"))
    return F.unix_millis(ts)


def day_of_text(text: Column) -> Column:
    """`date_format(<date-time text>, 'yyyy-MM-dd')`; NULL for bad text."""
    return F.date_format(F.try_to_timestamp(text), DAY)
