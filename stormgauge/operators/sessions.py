"""Answers built on episodes: the longest per place and type, winter burstiness."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stormgauge.functions.calendar import HOUR_SECONDS, season_year
from stormgauge.functions.weather import (
    RISK_SEVERITIES,
    RISK_TYPES,
    WINTER_TYPES,
    severity_in,
    type_in,
)
from stormgauge.operators.intervals import episodes, with_wall_times
from stormgauge.operators.ranking import top_per_group
from stormgauge.operators.seasons import winter_only


def risk_episodes(
    events: DataFrame,
    types: Iterable[str] = RISK_TYPES,
    severities: Iterable[str] = RISK_SEVERITIES,
    gap_minutes: int = 60,
    gap_rule: str = "max_end",
) -> DataFrame:
    """Episodes per (airport, type) of events risky by type *and* severity."""
    risky = events.where(type_in("type", types) & severity_in("severity", severities))
    found = episodes(risky, ["airport_code", "type"], gap_minutes * 60, gap_rule)
    return found.withColumns(
        {
            "seconds": F.col("end_s") - F.col("start_s"),
            "events_in_session": F.col("events").cast("int"),
        }
    ).drop("events")


def longest_episodes(
    events: DataFrame,
    types: Iterable[str] = RISK_TYPES,
    severities: Iterable[str] = RISK_SEVERITIES,
    gap_minutes: int = 60,
    gap_rule: str = "max_end",
) -> DataFrame:
    """The longest episode per (airport, type); the earliest of equals."""
    found = risk_episodes(events, types, severities, gap_minutes, gap_rule)
    best = top_per_group(
        found, ["airport_code", "type"], [F.col("seconds").desc(), F.col("start_s").asc()]
    )
    return with_wall_times(best, "session_start", "session_end").select(
        "airport_code",
        "type",
        "session_start",
        "session_end",
        F.round(F.col("seconds") / 3600.0, 2).alias("session_duration_hours"),
        "events_in_session",
    )


def winter_burstiness(
    events: DataFrame,
    gap_hours: float = 6.0,
    long_hours: float = 12.0,
    winter_types: Iterable[str] = WINTER_TYPES,
    gap_rule: str = "max_end",
    clock: str = "utc",
) -> DataFrame:
    """How winter events cluster per (state, county, winter season).

    Episodes are separated by pauses of more than ``gap_hours``; the gap of an
    episode runs from the previous episode's end and is unknown for the first.
    """
    keys = ["state", "county", "season_year"]
    winter = winter_only(events, winter_types, clock).withColumn(
        "season_year", season_year("local_start_ts")
    )
    found = episodes(winter, keys, int(gap_hours * HOUR_SECONDS), gap_rule)
    in_season = Window.partitionBy(*keys).orderBy("start_s")
    timed = found.select(
        *keys,
        (F.col("end_s") - F.col("start_s")).alias("duration"),
        (F.col("start_s") - F.lag("end_s").over(in_season)).alias("gap"),
    )
    return timed.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("int").alias("total_episodes"),
        F.count_if(F.col("duration") > long_hours * HOUR_SECONDS)
        .cast("int")
        .alias("episodes_over_threshold"),
        _mean_hours("gap").alias("avg_interepisode_gap_h"),
        _mean_hours("duration").alias("avg_episode_duration_h"),
        F.round(F.max("duration") / 3600.0, 2).alias("max_episode_duration_h"),
    )


def _mean_hours(column: str):
    mean = F.try_divide(F.sum(column) / 3600.0, F.count(column))
    return F.round(mean, 2)
