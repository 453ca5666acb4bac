"""Daily hours of exposure to risky weather with trailing calendar sums."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stormgauge.functions.calendar import DAY_SECONDS, day_number, day_to_date
from stormgauge.functions.weather import RISK_SEVERITIES, RISK_TYPES, severity_in, type_in
from stormgauge.operators.intervals import as_seconds


def exposure_hours_daily(
    events: DataFrame,
    risk_types: Iterable[str] = RISK_TYPES,
    risk_severities: Iterable[str] = RISK_SEVERITIES,
    trailing_days: Sequence[int] = (30, 90),
) -> DataFrame:
    """Hours per (airport, day) of events that are risky by type *or* severity.

    Overlapping events add up, so a day may exceed 24 hours.  A day counts as
    touched if an event covers any of it or ends exactly as it begins.
    """
    risky = events.where(type_in("type", risk_types) | severity_in("severity", risk_severities))
    daily = seconds_per_day(as_seconds(risky, ["airport_code"]), ["airport_code"])
    by_day = Window.partitionBy("airport_code").orderBy("day")
    trailing = {
        f"exposure_hours_{n}d": _hours(F.sum("seconds").over(by_day.rangeBetween(1 - n, 0)))
        for n in trailing_days
    }
    return daily.select(
        "airport_code",
        day_to_date("day").alias("event_date"),
        _hours(F.col("seconds")).alias("exposure_hours_day"),
        *[expr.alias(name) for name, expr in trailing.items()],
    )


def seconds_per_day(spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Summed span seconds per (keys, ``day``) for every touched day.

    A span gives at most three rows, however long it lasts: what it covers of its
    first and last day, and that it runs *through* the days between.  These rows
    are summed map-side; the days in between are filled in afterwards, from the
    number of spans running through, on one row per (key, day).
    """

    def part(day: Column, seconds: Column, through: int) -> Column:
        return F.struct(
            day.alias("day"),
            seconds.cast("bigint").alias("seconds"),
            F.lit(through).alias("through"),
        )

    first, last = F.col("first_day"), F.col("last_day")
    start_s, end_s = F.col("start_s"), F.col("end_s")
    head = part(first, (first.cast("bigint") + 1) * DAY_SECONDS - start_s, 0)
    tail = end_s - last.cast("bigint") * DAY_SECONDS
    parts = (
        F.when(first == last, F.array(part(first, end_s - start_s, 0)))
        .when(first + 1 == last, F.array(head, part(last, tail, 0)))
        .otherwise(F.array(head, part(first + 1, F.lit(0), 1), part(last, tail, -1)))
    )
    touched = (
        spans.withColumns({"first_day": day_number("start_s"), "last_day": day_number("end_s")})
        .select(*keys, F.inline(parts))
        .groupBy(*keys, "day")
        .agg(F.sum("seconds").alias("partial"), F.sum("through").alias("through"))
    )
    w = Window.partitionBy(*keys).orderBy("day")
    running = F.sum("through").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # while spans run through, every day up to the next listed one is covered
    upto = F.when(F.col("running") > 0, F.col("next_day") - 1).otherwise(F.col("day"))
    own = F.when(F.col("on_day") == F.col("day"), F.col("partial")).otherwise(0)
    return (
        touched.withColumns({"running": running, "next_day": F.lead("day").over(w)})
        .withColumn("on_day", F.explode(F.sequence(F.col("day"), upto)))
        .select(
            *keys,
            F.col("on_day").alias("day"),
            (own + F.col("running") * DAY_SECONDS).alias("seconds"),
        )
    )


def _hours(seconds: Column) -> Column:
    return F.round(seconds / 3600.0, 2)
