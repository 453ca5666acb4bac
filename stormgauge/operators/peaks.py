"""The worst few hours of risk per airport and day."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stormgauge.functions.calendar import (
    DAY_SECONDS,
    HOUR_SECONDS,
    day_to_date,
    wall_timestamp,
)
from stormgauge.functions.weather import RISK_SEVERITIES, RISK_TYPES, severity_in, type_in
from stormgauge.operators.intervals import as_seconds, day_islands
from stormgauge.operators.ranking import top_per_group
from stormgauge.operators.timeline import running_counts

PLACE = ["airport_code", "day"]


def _risk_spans(events: DataFrame, types: Iterable[str], severities: Iterable[str]) -> DataFrame:
    risky = events.where(type_in("type", types) & severity_in("severity", severities))
    return as_seconds(risky, ["airport_code"])


def peak_exposure_daily(
    events: DataFrame,
    hours: int = 3,
    types: Iterable[str] = RISK_TYPES,
    severities: Iterable[str] = RISK_SEVERITIES,
) -> DataFrame:
    """The window of ``hours`` within each day that holds most risk minutes.

    Covered time is piecewise linear in the window's start, so a maximum lies
    where the window starts with an island or ends with one.  With
    ``F(x)`` = covered seconds of the day before ``x``, the window from ``t``
    holds ``F(t + hours) - F(t)``.  ``F`` at all candidates comes from two running
    sums in one ordered pass: linear work per airport day, no candidate-by-island
    pairs.  The earliest of equal windows wins.
    """
    width = hours * HOUR_SECONDS
    islands = day_islands(_risk_spans(events, types, severities), ["airport_code"], place=PLACE)
    day_start = F.col("day").cast("bigint") * DAY_SECONDS
    s, e = F.col("s"), F.col("e")
    with_start = F.least(s, day_start + (DAY_SECONDS - width))
    with_end = F.greatest(e - width, day_start)

    def point(at, delta, candidate=None, role=None):
        return F.struct(
            at.alias("x"),
            F.lit(delta).cast("bigint").alias("delta"),
            (F.lit(None).cast("bigint") if candidate is None else candidate).alias("t"),
            F.lit(role).cast("string").alias("role"),
        )

    points = islands.select(
        *PLACE,
        F.inline(
            F.array(
                point(s, 1),
                point(e, -1),
                point(with_start, 0, with_start, "from"),
                point(with_start + width, 0, with_start, "to"),
                point(with_end, 0, with_end, "from"),
                point(with_end + width, 0, with_end, "to"),
            )
        ),
    )
    upto = Window.partitionBy(*PLACE).orderBy("x")  # range frame: ties included
    running = points.withColumn(
        "covered",
        F.col("x") * F.sum("delta").over(upto) - F.sum(F.col("delta") * F.col("x")).over(upto),
    )
    windows = (
        running.where(F.col("t").isNotNull())
        .groupBy(*PLACE, "t")
        .agg(
            (
                F.max(F.when(F.col("role") == "to", F.col("covered")))
                - F.max(F.when(F.col("role") == "from", F.col("covered")))
            ).alias("seconds")
        )
    )
    best = top_per_group(windows, PLACE, [F.col("seconds").desc(), F.col("t").asc()])
    return best.select(
        "airport_code",
        day_to_date("day").alias("event_date"),
        (F.col("seconds") / 60.0).alias("p3h_minutes"),
        wall_timestamp("t").alias("window_start"),
        wall_timestamp(F.col("t") + width).alias("window_end"),
    )


def peak_exposure_segments(
    events: DataFrame,
    hours: int = 3,
    types: Iterable[str] = RISK_TYPES,
    severities: Iterable[str] = RISK_SEVERITIES,
) -> DataFrame:
    """The marker whose trailing sum of whole risk segments is largest, per day.

    Event starts and ends (*markers*) cut an airport's time into segments; a
    segment is risky while an event is active and counts whole to the day it
    starts on.  For each marker the segments starting within the ``hours`` before
    it, both ends included, are summed.  The result may exceed the window.

    Ordered steps run per airport day; only a day's last segment reaches into a
    later day, and it is closed from one summary row per airport day.
    """
    width = hours * HOUR_SECONDS
    spans = _risk_spans(events, types, severities)
    counts = running_counts(spans, ["airport_code"])
    w = Window.partitionBy(*PLACE).orderBy("ts_s")
    segments = counts.where("real").withColumn("next_s", F.lead("ts_s").over(w))
    risk = F.when(F.col("active") > 0, F.col("next_s") - F.col("ts_s"))
    # trailing sum = sum up to the marker - sum up to just before its window
    points = segments.select(
        *PLACE,
        "ts_s",
        F.inline(
            F.array(
                F.struct(
                    F.col("ts_s").alias("x"),
                    F.coalesce(risk, F.lit(0)).alias("risk"),
                    F.col("next_s"),
                    (F.col("active") > 0).alias("runs"),
                ),
                F.struct(
                    (F.col("ts_s") - (width + 1)).alias("x"),
                    F.lit(0).cast("bigint").alias("risk"),
                    F.lit(None).cast("bigint").alias("next_s"),
                    F.lit(None).cast("boolean").alias("runs"),
                ),
            )
        ),
    )
    upto = Window.partitionBy(*PLACE).orderBy("x")  # range frame: ties included
    at_marker = F.col("runs").isNotNull()
    segments = (
        points.withColumn("total", F.sum("risk").over(upto))
        .groupBy(*PLACE, "ts_s")
        .agg(
            (
                F.max(F.when(at_marker, F.col("total")))
                - F.max(F.when(~at_marker, F.col("total")))
            ).alias("rolling"),
            F.max("next_s").alias("next_s"),
            F.bool_or("runs").alias("active"),
        )
    )
    is_last = F.col("next_s").isNull()
    candidate = F.struct("rolling", (-F.col("ts_s")).alias("neg_ts"))
    days = segments.groupBy(*PLACE).agg(
        F.max(F.when(~is_last, candidate)).alias("inner"),
        F.max(F.when(is_last, candidate)).alias("last"),
        F.bool_or(is_last & F.col("active")).alias("runs_on"),
        F.min("ts_s").alias("first_s"),
    )
    next_first = F.lead("first_s").over(Window.partitionBy("airport_code").orderBy("day"))
    last_ts = -F.col("last.neg_ts")
    closed = days.withColumn("next_first", next_first).withColumn(
        "closing",
        F.when(
            F.col("next_first").isNotNull(),
            F.struct(
                (
                    F.col("last.rolling")
                    + F.when(F.col("runs_on"), F.col("next_first") - last_ts).otherwise(0)
                ).alias("rolling"),
                F.col("last.neg_ts").alias("neg_ts"),
            ),
        ),
    )
    best = closed.withColumn("best", F.greatest("inner", "closing")).where("best IS NOT NULL")
    start_s = -F.col("best.neg_ts")
    return best.select(
        "airport_code",
        day_to_date("day").alias("event_date"),
        (F.col("best.rolling") / 60.0).alias("p3h_minutes"),
        wall_timestamp(start_s).alias("window_start"),
        wall_timestamp(start_s + width).alias("window_end"),
    )
