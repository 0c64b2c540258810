"""Dates, hours and epochs as column expressions. None of them depends on the session time zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from atmolake.fixed_values import (
    COMPACT_DATE_FORMAT,
    LAST_EPOCH_SECOND,
    LOCAL_TIME_ZONE,
    READING_TIME_FORMAT,
)

_EPOCH = "1970-01-01 00:00:00"


def epoch_to_local(epoch: Column, tz: str = LOCAL_TIME_ZONE) -> Column:
    """Epoch seconds, or milliseconds if too large for seconds, to the wall-clock time of `tz`."""
    seconds = epoch.cast("decimal(20,6)")
    seconds = F.when(epoch > LAST_EPOCH_SECOND, seconds / 1000).otherwise(seconds).cast("decimal(18,6)")
    utc = F.lit(_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def legacy_hour_to_datetime(request_date: Column, label: Column) -> Column:
    """Hour label of a 24-hour matrix to its time.

    A matrix ends at midnight of its request date: `12:00AM` is that midnight, every other hour
    is of the day before.
    """
    day = F.when(label == "12:00AM", request_date).otherwise(F.date_sub(request_date, 1))
    return F.to_timestamp_ntz(
        F.concat_ws(" ", F.date_format(day, "yyyy-MM-dd"), label), F.lit("yyyy-MM-dd h:mma")
    )


def ceil_to_hour_hhmm(hhmm: Column, strict: bool = False) -> Column:
    """`HHMM` to the next full hour; 23:01 and later wrap to 0000 of the same date.

    Text that is not four digits gives NULL, or an error if `strict`.
    """
    hour = F.substring(hhmm, 1, 2).try_cast("int")
    minute = F.substring(hhmm, 3, 2).try_cast("int")
    rounded = F.concat(F.lpad(F.pmod(hour + (minute > 0).cast("int"), F.lit(24)).cast("string"), 2, "0"), F.lit("00"))
    bad = F.raise_error(F.concat(F.lit("not in HHMM format: "), hhmm)).cast("string") if strict else None
    return F.when(hhmm.rlike("^[0-9]{4}$"), rounded).otherwise(bad)


def yyyymmdd_to_iso(text: Column) -> Column:
    return F.date_format(F.to_date(text, COMPACT_DATE_FORMAT), "yyyy-MM-dd")


def parse_iso_datetime(text: Column, strict: bool = True) -> Column:
    """Exactly `yyyy-MM-ddTHH:mm:ss`; other text raises under ANSI mode, or gives NULL without `strict`."""
    if strict:
        return F.to_timestamp_ntz(text, F.lit(READING_TIME_FORMAT))
    # Text that has the look of a time may still be none, such as a 30th of February.
    return F.when(text.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d$"), text.try_cast("timestamp_ntz"))


def parse_yyyymmdd(text: Column) -> Column:
    """Strict `yyyyMMdd`; bad text raises under ANSI mode."""
    return F.to_date(text, COMPACT_DATE_FORMAT)


def local_day(now_utc: datetime, days_prior: int = 1, tz: str = LOCAL_TIME_ZONE) -> Column:
    """The local date `days_prior` days before an instant given in UTC."""
    now = F.lit(now_utc.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return F.date_sub(F.convert_timezone(F.lit("UTC"), F.lit(tz), now).cast("date"), days_prior)
