"""Time columns: text-to-timestamp parsing (P8) and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the ridership feed's timestamp text format.
RIDERSHIP_TS_FORMAT = "MM/dd/yyyy hh:mm:ss a"

# Calendar parts, in the order the hourly tables carry them.
CALENDAR_PARTS = ("year", "month", "dayofmonth", "dayofweek", "hour")


def parse_ts(c: Column | str, fmt: str = RIDERSHIP_TS_FORMAT) -> Column:
    """Text -> timestamp_ntz; malformed text gives NULL instead of raising
    (ANSI mode would raise on `to_timestamp`)."""
    return F.try_to_timestamp(F.col(c) if isinstance(c, str) else c,
                              F.lit(fmt)).cast("timestamp_ntz")


def convert_time(df: DataFrame, time_col: str,
                 fmt: str = RIDERSHIP_TS_FORMAT) -> DataFrame:
    """Replace a text time column by its parsed timestamp, in place."""
    return df.withColumn(time_col, parse_ts(time_col, fmt))


def calendar_columns(ts: Column | str) -> dict[str, Column]:
    """P9 expressions: year, month, dayofmonth, dayofweek (1 = Sunday), hour."""
    t = F.col(ts) if isinstance(ts, str) else ts
    return {
        "year": F.year(t),
        "month": F.month(t),
        "dayofmonth": F.dayofmonth(t),
        "dayofweek": F.dayofweek(t),
        "hour": F.hour(t),
    }


def with_calendar(df: DataFrame, ts: str) -> DataFrame:
    """Add the five calendar parts of `ts` in one projection."""
    return df.withColumns(calendar_columns(ts))


def hour_start(ts: Column | str) -> Column:
    """The hour a timestamp_ntz falls in, built from its wall-clock fields.
    (`date_trunc` on timestamp_ntz goes through the session time zone, which
    shifts hours inside a daylight-saving gap; this does not.)"""
    t = F.col(ts) if isinstance(ts, str) else ts
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t),
                                F.lit(0), F.lit(0))
