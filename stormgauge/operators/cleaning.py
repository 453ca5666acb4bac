"""Raw event rows to the typed, enriched ``events_clean`` table."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormgauge.functions import calendar as cal
from stormgauge.operators.ranking import keep_first
from stormgauge.sources.schemas import CORRUPT


def normalise_headers(raw: DataFrame) -> DataFrame:
    """Lower-case trimmed names with blanks and parentheses turned into ``_``."""
    return raw.toDF(*[re.sub(r"[ ()]", "_", name.strip().lower()) for name in raw.columns])


def typed_events(raw: DataFrame) -> DataFrame:
    """Cast every raw row; unparseable values become NULL."""
    return normalise_headers(raw).select(
        F.col("eventid").alias("event_id"),
        F.upper(F.trim("type")).alias("type"),
        F.initcap(F.trim("severity")).alias("severity"),
        F.col("starttime_utc_").try_cast("timestamp_ntz").alias("start_time_utc"),
        F.col("endtime_utc_").try_cast("timestamp_ntz").alias("end_time_utc"),
        "timezone",
        F.col("airportcode").alias("airport_code"),
        "state",
        "county",
        "city",
        F.col("zipcode").cast("string").alias("zip_code"),
        F.col("locationlat").try_cast("double").alias("location_lat"),
        F.col("locationlng").try_cast("double").alias("location_lng"),
        F.col("precipitation_in_").try_cast("double").alias("precipitation_in"),
    )


def enrich_events(typed: DataFrame) -> DataFrame:
    """Duration, calendar parts and local times of typed events."""
    start, end, zone = F.col("start_time_utc"), F.col("end_time_utc"), F.col("known_zone")
    return typed.withColumn("known_zone", cal.usable_zone(F.col("timezone"))).select(
        *typed.columns[:5],
        ((cal.wall_seconds(end) - cal.wall_seconds(start)) / 60.0).alias("duration_min"),
        *typed.columns[5:],
        F.to_date(start).alias("event_date"),
        F.dayofmonth(start).alias("event_day"),
        F.hour(start).alias("hour_of_day"),
        cal.iso_weekday(start).alias("dow"),
        F.when(start.isNotNull(), cal.meteorological_season(F.month(start))).alias("season"),
        cal.night_hours(F.hour(start)).alias("is_night"),
        cal.in_zone(start, zone).alias("local_start_ts"),
        cal.in_zone(end, zone).alias("local_end_ts"),
        F.year(start).alias("event_year"),
        F.month(start).alias("event_month"),
    )


def _with_reason(raw: DataFrame) -> DataFrame:
    """Rows with normalised headers and ``reason``, why one cannot be used (NULL: it can)."""
    rows = normalise_headers(raw)
    if CORRUPT not in rows.columns:
        rows = rows.withColumn(CORRUPT, F.lit(None).cast("string"))
    nameless = F.col("eventid").isNull() | (F.trim("eventid") == "")
    return rows.withColumn(
        "reason",
        F.when(F.col(CORRUPT).isNotNull(), "malformed line").when(nameless, "no event id"),
    )


def rejected_events(raw: DataFrame) -> DataFrame:
    """Raw rows that cannot become events: ``reason``, the id if any, and the line's text.

    The line is what the reader kept of a malformed one, or the fields put together.
    """
    rows = _with_reason(raw).where(F.col("reason").isNotNull())
    fields = [c for c in rows.columns if c not in (CORRUPT, "reason")]
    line = F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*fields)))
    return rows.select("reason", F.col("eventid").alias("event_id"), line.alias("line"))


def order_of_copies(typed: DataFrame) -> Column:
    """What the copies of an event id are ordered by; the first one stays."""
    rest = [c for c in typed.columns if c not in ("event_id", "start_time_utc")]
    return F.struct("start_time_utc", *rest)


def first_events(rows: DataFrame, typed: bool = False) -> DataFrame:
    """One typed row per event id of raw rows, or of rows that are ``typed`` already."""
    if not typed:
        usable = _with_reason(rows).where(F.col("reason").isNull())
        rows = typed_events(usable.drop(CORRUPT, "reason"))
    return keep_first(rows, ["event_id"], ["start_time_utc"])


def clean_events(raw: DataFrame) -> DataFrame:
    """Typed, enriched events, one row per event id: the one that starts first.

    Malformed lines and rows without an id are left out; see :func:`rejected_events`.

    As NULL sorts first, a row whose start cannot be parsed wins over its copies.
    Copies are dropped before enrichment, so only the typed source columns are
    shuffled, and of each id at most one row per map task.
    """
    return enrich_events(first_events(raw))
