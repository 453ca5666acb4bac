"""Wall-clock arithmetic on whole seconds and calendar parts.

Batch operators work on TIMESTAMP_NTZ wall-clock times.  Arithmetic is done on
bigint seconds since 1970-01-01 00:00:00 *of that wall clock*, so nothing
depends on the session time zone or on daylight-saving gaps.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 86_400
HOUR_SECONDS = 3_600


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def wall_seconds(ts: Column | str) -> Column:
    """Whole seconds since the epoch of an NTZ wall-clock time."""
    return F.unix_timestamp(ts)


def wall_timestamp(seconds: Column | str) -> Column:
    """Inverse of :func:`wall_seconds`."""
    return F.timestamp_add("SECOND", _col(seconds), _epoch_ntz())


def utc_wall_time(instant: Column | str) -> Column:
    """UTC wall-clock time (NTZ, microseconds kept) of a TIMESTAMP instant."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(instant)), _epoch_ntz())


def instant_from_utc_wall(ts: Column | str) -> Column:
    """TIMESTAMP instant (whole seconds) of an NTZ time that is read as UTC."""
    return F.timestamp_seconds(wall_seconds(ts))


def day_number(seconds: Column | str) -> Column:
    """Days since 1970-01-01 holding the given wall-clock second."""
    return bucket_number(seconds, DAY_SECONDS).cast("int")


def bucket_number(seconds: Column | str, width: int) -> Column:
    """Index of the fixed-width time bucket holding the given second."""
    return F.floor(_col(seconds) / F.lit(width))


def day_to_date(day: Column | str) -> Column:
    return F.date_from_unix_date(_col(day).cast("int"))


def iso_weekday(ts: Column | str) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return ((F.dayofweek(ts) + 5) % 7) + 1


def meteorological_season(month: Column) -> Column:
    return (
        F.when(month.isin(12, 1, 2), "DJF")
        .when(month.isin(3, 4, 5), "MAM")
        .when(month.isin(6, 7, 8), "JJA")
        .otherwise("SON")
    )


def night_hours(hour: Column) -> Column:
    """Before 06:00 or from 20:00 on."""
    return (hour < 6) | (hour >= 20)


def season_year(ts: Column | str) -> Column:
    """Calendar year, except that December counts to the winter of the next year."""
    return F.year(ts) + (F.month(ts) == 12).cast("int")


def month_index(year: Column, month: Column) -> Column:
    """Months on one running axis, so neighbours differ by exactly 1."""
    return year * 12 + month


def cyclic_day_shift(current: Column, previous: Column) -> Column:
    """Difference of two days of the year, taken the short way round a 365-day year."""
    diff = current - previous
    return F.when(diff > 180, diff - 365).when(diff < -180, diff + 365).otherwise(diff)


def usable_zone(zone: Column) -> Column:
    """The trimmed zone id, or UTC when it is missing, blank or unknown.

    The parser trims all white space and control characters around an id, the
    conversion does not, so both get the id without them.  Whether an id is known is asked of the timestamp parser, which yields NULL
    under ``try_cast`` instead of raising; no list of zone ids is needed.
    """
    name = F.regexp_replace(zone, r"^[\x00-\x20\x7F]+|[\x00-\x20\x7F]+$", "")
    probe = F.concat(F.lit("2000-01-01 00:00:00 "), name).try_cast("timestamp")
    return F.when((F.length(name) > 0) & probe.isNotNull(), name).otherwise(F.lit("UTC"))


def in_zone(utc_ntz: Column | str, known_zone: Column) -> Column:
    """Wall-clock time in a valid zone of a UTC wall-clock time."""
    return F.convert_timezone(F.lit("UTC"), known_zone, _col(utc_ntz))


def to_local(utc_ntz: Column | str, zone: Column) -> Column:
    """Local wall-clock time of a UTC wall-clock time; UTC when the zone is unusable."""
    return in_zone(utc_ntz, usable_zone(zone))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
