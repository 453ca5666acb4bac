"""Monthly and seasonal measures: trends, workload, night storms, winter phenology."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stormgauge.functions import calendar as cal
from stormgauge.functions.weather import (
    SEVERITY_WEIGHTS,
    STORM_TYPES,
    WINTER_TYPE_WEIGHTS,
    WINTER_TYPES,
    severity_weight,
    type_in,
    winter_type_weight,
)
from stormgauge.operators.intervals import valid_interval


def known_ends(events: DataFrame) -> DataFrame:
    """Events whose start and end are both known.

    The measures of this module leave out the others: they have no length, and a
    group of them alone would have a row without one.
    """
    return events.where(F.col("local_start_ts").isNotNull() & F.col("local_end_ts").isNotNull())


def local_month(df: DataFrame) -> DataFrame:
    """Adds the local calendar ``year`` and ``month`` of the start; drops unknown starts."""
    return df.where(F.col("local_start_ts").isNotNull()).withColumns(
        {"year": F.year("local_start_ts"), "month": F.month("local_start_ts")}
    )


def winter_only(
    events: DataFrame, winter_types: Iterable[str] = WINTER_TYPES, clock: str = "utc"
) -> DataFrame:
    """Winter-type events of December to February, by UTC or local month.

    The UTC season follows from the partition column ``event_month``, so where
    that column exists the scan is pruned to the winter partitions.
    """
    picked = events.where(type_in("type", winter_types))
    if clock == "local":
        return picked.where(F.month("local_start_ts").isin(12, 1, 2))
    if clock != "utc":
        raise ValueError(f"unknown clock {clock!r}")
    if "event_month" in events.columns:
        picked = picked.where(F.col("event_month").isin(12, 1, 2))
    return picked.where(F.col("season") == "DJF")


def change_pct(current: Column, previous: Column) -> Column:
    """Percent change to two digits; NULL when the previous value is 0 or unknown."""
    return F.round(F.try_divide(current - previous, previous) * 100.0, 2)


def moving_average(column: str, keys: list[str], order: list[str], rows: int = 3) -> Column:
    """Mean of the last ``rows`` rows, by row and not by calendar."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(1 - rows, 0)
    return F.avg(column).over(w)


def monthly_trend_by_type(events: DataFrame, min_previous: float = 5.0) -> DataFrame:
    """Mean duration and count per (airport, month, type) with month-over-month change.

    The change is given only against the directly preceding calendar month, and
    only if that month's mean reached ``min_previous`` minutes.
    """
    seconds = cal.wall_seconds("local_end_ts") - cal.wall_seconds("local_start_ts")
    mean_min = F.try_divide(F.sum("seconds") / 60.0, F.count("seconds"))
    monthly = (
        local_month(known_ends(events))
        .withColumn("seconds", seconds)
        .groupBy("airport_code", "year", "month", "type")
        .agg(
            F.round(mean_min, 2).alias("avg_duration_min"),
            F.count(F.lit(1)).alias("total_events"),
        )
    )
    w = Window.partitionBy("airport_code", "type").orderBy("year", "month")
    now = cal.month_index(F.col("year"), F.col("month"))
    before = F.lag("avg_duration_min").over(w)
    adjacent = now - F.lag(now).over(w) == 1
    return monthly.withColumn(
        "mom_change_pct",
        F.when(adjacent & (before >= min_previous), change_pct(F.col("avg_duration_min"), before)),
    ).select(
        "airport_code", "year", "month", "type", "avg_duration_min", "total_events", "mom_change_pct"
    )


def winter_workload_index(
    events: DataFrame,
    severity_weights: Mapping[str, int] = SEVERITY_WEIGHTS,
    type_weights: Mapping[str, int] = WINTER_TYPE_WEIGHTS,
) -> DataFrame:
    """Weighted winter hours per (state, county, month), with change, trend and rank.

    Months without winter events stay as rows of 0.0.  Change and moving average
    go by row; the rank is dense within (state, month), highest index first.
    """
    # whole seconds keep the sum exact and independent of the order of rows
    seconds = F.round(F.col("duration_min") * 60).cast("bigint")
    score = seconds * severity_weight("severity", severity_weights) * winter_type_weight(
        "type", type_weights
    )
    monthly = (
        local_month(known_ends(events).where(F.col("duration_min").isNotNull()))
        .groupBy("state", "county", "year", "month")
        .agg(F.round(F.sum(score) / 3600.0, 2).alias("workload_index"))
    )
    keys, order = ["state", "county"], ["year", "month"]
    previous = F.lag("workload_index").over(Window.partitionBy(*keys).orderBy(*order))
    in_state = Window.partitionBy("state", "year", "month").orderBy(F.desc("workload_index"))
    return monthly.withColumns(
        {
            "mom_change_pct": change_pct(F.col("workload_index"), previous),
            "rolling_3m_avg": moving_average("workload_index", keys, order),
            "rank_in_state": F.dense_rank().over(in_state),
        }
    )


def night_storm_risk(
    events: DataFrame, storm_types: Iterable[str] = STORM_TYPES, clock: str = "utc"
) -> DataFrame:
    """Storm counts per (state, county, month) and how long and severe the night ones are.

    ``clock="utc"`` uses the table's ``is_night`` flag, ``"local"`` the local hour.
    """
    night = {
        "utc": F.col("is_night"),
        "local": cal.night_hours(F.hour("local_start_ts")),
    }[clock]
    storms = local_month(
        events.where(type_in("type", storm_types) & valid_interval())
    ).select(
        "state",
        "county",
        "year",
        "month",
        night.alias("night"),
        (cal.wall_seconds("local_end_ts") - cal.wall_seconds("local_start_ts")).alias("seconds"),
        severity_weight("severity").alias("score"),
    )
    n_night = F.count_if("night")
    monthly = storms.groupBy("state", "county", "year", "month").agg(
        F.count(F.lit(1)).cast("int").alias("count_events"),
        n_night.cast("int").alias("count_night_events"),
        F.round(n_night / F.count(F.lit(1)), 2).alias("night_event_ratio"),
        F.round(
            F.try_divide(F.sum(F.when(F.col("night"), F.col("seconds"))) / 3600.0, n_night), 2
        ).alias("avg_duration_h"),
        F.round(F.avg(F.when(F.col("night"), F.col("score"))), 2).alias("avg_severity_score"),
    )
    return monthly.withColumn(
        "rolling_3m_avg_duration",
        F.round(moving_average("avg_duration_h", ["state", "county"], ["year", "month"]), 2),
    )


def winter_phenology(
    events: DataFrame, winter_types: Iterable[str] = WINTER_TYPES, clock: str = "utc"
) -> DataFrame:
    """First and last winter event per (state, county, season) and how they shift.

    Shifts compare with the previous available season; days of the year are
    compared the short way round the year.
    """
    keys = ["state", "county", "season_year"]
    seasons = (
        known_ends(winter_only(events, winter_types, clock))
        .withColumn("season_year", cal.season_year("local_start_ts"))
        .groupBy(*keys)
        .agg(
            F.min("local_start_ts").alias("first_event_ts"),
            F.max("local_end_ts").alias("last_event_ts"),
        )
    )
    length = cal.wall_seconds("last_event_ts") - cal.wall_seconds("first_event_ts")
    seasons = seasons.withColumn("season_length_days", F.round(length / 86400.0, 2))
    w = Window.partitionBy("state", "county").orderBy("season_year")

    def shift(column: str) -> Column:
        day = F.dayofyear(column)
        return cal.cyclic_day_shift(day, F.lag(day).over(w)).cast("double")

    return seasons.withColumns(
        {
            "start_shift_days": shift("first_event_ts"),
            "end_shift_days": shift("last_event_ts"),
            "yoy_length_change_days": F.round(
                F.col("season_length_days") - F.lag("season_length_days").over(w), 2
            ),
            "rolling_3y_length_avg_days": F.round(
                moving_average("season_length_days", ["state", "county"], ["season_year"]), 2
            ),
        }
    )
