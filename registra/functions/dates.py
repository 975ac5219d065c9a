"""Days and instants, independent of the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType

DAY_MICROS = 86_400_000_000


def utc_day(c: Column, kind: DataType | None = None) -> Column:
    """Days since 1970-01-01 (UTC) of a timestamp, or of a date or zone-less timestamp if ``kind`` says so."""
    if isinstance(kind, (DateType, TimestampNTZType)):
        return F.unix_date(c.cast("date"))
    return F.floor(F.unix_micros(c) / F.lit(DAY_MICROS)).cast("int")


def ymd(day: Column) -> Column:
    """YYYYMMDD as bigint of a day number."""
    d = F.date_from_unix_date(day)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint")


def iso_day(day: Column) -> Column:
    """YYYY-MM-DD text of a day number."""
    return F.date_from_unix_date(day).cast("string")


def iso_instant(c: Column) -> Column:
    """Timestamp of an ISO 8601 text with ``T`` and zone or of a plain ISO date (then midnight UTC); else null."""
    text = F.trim(c)
    dated = text.rlike(r"^\d{4}-\d{2}-\d{2}$")
    zoned = text.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})$")
    zone = F.regexp_replace(text, r"([+-]\d{2})(\d{2})$", "$1:$2")
    return F.when(dated, F.concat(text, F.lit("T00:00:00Z")).try_cast("timestamp")).when(zoned, F.when(text.endswith("Z"), text).otherwise(zone).try_cast("timestamp"))


def floor_days(later: Column, earlier: Column) -> Column:
    """Whole days between two timestamps, rounded down (minus ten hours is -1)."""
    return F.floor((F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(DAY_MICROS)).cast("bigint")


def century(c: Column) -> Column:
    """A year of two digits as four (up to 79: 2000s, else 1900s); years from 100 stay as they are."""
    return F.when(c < 80, c + 2000).when(c < 100, c + 1900).otherwise(c)
