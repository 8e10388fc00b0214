"""Date keys, calendar parts and business-day dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import BUSINESS_ZONE

DATE_KEY_FORMAT = "yyyyMMdd"


def date_key(date: Column | str) -> Column:
    """2016-01-09 -> '20160109'."""
    return F.date_format(date, DATE_KEY_FORMAT)


def key_to_date(key: Column | str) -> Column:
    """'20160109' -> 2016-01-09."""
    return F.to_date(key, DATE_KEY_FORMAT)


def parse_date(text: Column | str) -> Column:
    """A text date as a date; text that is no date gives NULL."""
    return F.try_to_date(text) if isinstance(text, Column) else F.try_to_date(F.col(text))


def calendar_parts(date: str) -> list[Column]:
    """The columns of the date dimension. The week is the ISO week, the year the calendar year."""
    return [
        date_key(date).alias("date_key"),
        F.col(date).alias("date"),
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        F.dayofmonth(date).alias("day"),
        F.quarter(date).alias("quarter"),
        F.date_format(date, "EEEE").alias("day_of_week"),
        F.date_format(date, "MMMM").alias("month_name"),
        F.weekofyear(date).alias("week_of_year"),
    ]


def business_date(utc_timestamp: Column | str, zone: str = BUSINESS_ZONE) -> Column:
    """The calendar date in the business time zone of a moment given in UTC."""
    return F.to_date(F.from_utc_timestamp(utc_timestamp, zone))
