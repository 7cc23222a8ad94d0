"""Date and time-zone expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from martloom.schema import LOCAL_ZONE


def zoneless(stamp: Column | dt.datetime) -> Column:
    """A zone-less timestamp literal; comparing with it leaves the column uncast, so filters are pushed down."""
    if isinstance(stamp, Column):
        return stamp.cast("timestamp_ntz")
    return F.lit(stamp.isoformat(sep=" ")).cast("timestamp_ntz")


def parse_date(text: Column) -> Column:
    """Text to date; anything that is not a date becomes null, also under ANSI mode."""
    return text.try_cast("date")


def calendar_parts(date: Column) -> list[Column]:
    """day, month, quarter, year and is_weekend of a date (Monday is weekday 0)."""
    return [
        F.dayofmonth(date).alias("day"),
        F.month(date).alias("month"),
        F.quarter(date).alias("quarter"),
        F.year(date).alias("year"),
        (F.weekday(date) >= 5).alias("is_weekend"),
    ]


def local_to_utc(stamp: Column, zone: str = LOCAL_ZONE) -> Column:
    """Zone-less local time to zone-less UTC, whatever the session zone is."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), stamp)


def utc_to_local(stamp: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), stamp)


def stamp_text(stamp: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS``."""
    return F.date_format(stamp, "yyyy-MM-dd HH:mm:ss")
