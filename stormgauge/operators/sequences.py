"""Ordered patterns of event types within a county and a time limit."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stormgauge.functions.calendar import (
    HOUR_SECONDS,
    bucket_number,
    day_number,
    wall_seconds,
    wall_timestamp,
)
from stormgauge.functions.weather import FREEZE_LABEL, FREEZE_PATTERN, type_in
from stormgauge.operators.intervals import EDGE, as_seconds

COUNTY = ("state", "county")


def risky_sequences(
    events: DataFrame,
    pattern: Sequence[str] = FREEZE_PATTERN,
    hours: int = 48,
    label: str = FREEZE_LABEL,
    keys: Sequence[str] = COUNTY,
) -> DataFrame:
    """Directly consecutive rows of a county whose types spell ``pattern``.

    Rows are ordered by (start, type, end); the last end must lie within ``hours``
    of the first start.  Events with an unknown start or end are left out first, so
    one means the same alone and beside a copy whose end is known.

    Equal (county, start second, type) rows stand next to each other in this
    order, so they are first reduced map-side to one row with a count.  The
    ordered step then runs per county day, on a bounded number of rows.  Only the
    first and last ``len(pattern) - 1`` rows of a day are ordered again along the
    county, to find the matches that run over midnight.
    """
    steps = len(pattern) - 1
    if steps < 1:
        raise ValueError("a pattern has at least two types")
    known = F.col("local_start_ts").isNotNull() & F.col("local_end_ts").isNotNull()
    rows = events.where(known).select(
        *keys,
        "type",
        wall_seconds("local_start_ts").alias("start_s"),
        wall_seconds("local_end_ts").alias("end_s"),
    )
    if any(a == b for a, b in zip(pattern, pattern[1:])):
        rows = rows.withColumn("copies", F.lit(1))  # copies can match among themselves
    else:
        rows = rows.groupBy(*keys, "type", "start_s").agg(
            F.min("end_s").alias("end_s"), F.count(F.lit(1)).alias("copies")
        )
    rows = rows.withColumn("day", day_number("start_s"))

    def looked_ahead(df: DataFrame, group: str) -> DataFrame:
        w = Window.partitionBy(*keys, group).orderBy("start_s", "type", "end_s")
        follows = [F.lead("type", i).over(w) == pattern[i] for i in range(1, steps + 1)]
        # between the ends of the pattern a row must stand alone
        single = [F.lead("copies", i).over(w) == 1 for i in range(1, steps)]
        return df.withColumns(
            {
                "spelled": reduce(and_, [F.col("type") == pattern[0], *follows, *single]),
                "last_end": F.lead("end_s", steps).over(w),
                "complete": F.lead("start_s", steps).over(w).isNotNull(),
                "position": F.row_number().over(w),
            }
        )

    local = looked_ahead(rows, "day").select(
        *rows.columns,
        F.col("complete").alias("decided"),
        (F.col("complete") & F.col("spelled")).alias("matched"),
        F.col("last_end").alias("matched_end"),
        (~F.col("complete") | (F.col("position") <= steps)).alias("edge"),
    )
    chain = F.when(F.col("edge"), F.lit(EDGE)).otherwise(F.col("day"))
    chained = looked_ahead(
        local.where(F.col("edge") | F.col("matched")).withColumn("chain", chain), "chain"
    )
    found = chained.select(
        *keys,
        "start_s",
        F.when(F.col("decided"), F.col("matched")).otherwise(F.col("spelled")).alias("is_match"),
        F.when(F.col("decided"), F.col("matched_end"))
        .otherwise(F.col("last_end"))
        .alias("final_end"),
    ).where(F.col("is_match") & (F.col("final_end") - F.col("start_s") <= hours * HOUR_SECONDS))
    return _labelled(found, keys, "final_end", label)


def sequence_within(
    events: DataFrame,
    pattern: Sequence[str] = FREEZE_PATTERN,
    hours: int = 48,
    label: str = FREEZE_LABEL,
    keys: Sequence[str] = COUNTY,
) -> DataFrame:
    """Types in order within ``hours``, other events allowed in between.

    Starts follow each other strictly.  Of all ways to go on from a start of the
    first type, the one whose last event ends first counts, so a start has a row
    if any way lies within ``hours``.  One row per distinct start.

    Looking further than ``hours`` ahead is never needed, so rows go to their own
    time bucket of that width and, as look-ahead, to the one before it.  Each
    bucket holds at most one row per type and second.
    """
    width = hours * HOUR_SECONDS
    firsts = (
        as_seconds(events.where(type_in("type", pattern)), [*keys, "type"], allow_empty=True)
        .groupBy(*keys, "type", "start_s")
        .agg(F.min("end_s").alias("end_s"))
        .withColumn("own", bucket_number("start_s", width))
        .withColumn("bucket", F.explode(F.array(F.col("own"), F.col("own") - 1)))
    )
    # latest first, so that the frame holds what starts later
    later = (
        Window.partitionBy(*keys, "bucket")
        .orderBy(-F.col("start_s"))
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    chained = firsts.withColumn("final_end", F.col("end_s"))
    for name in reversed(pattern[1:]):
        first_end = F.min(F.when(F.col("type") == name, F.col("final_end")))
        chained = chained.withColumn("final_end", first_end.over(later))
    found = chained.where(
        (F.col("bucket") == F.col("own"))
        & (F.col("type") == pattern[0])
        & (F.col("final_end") - F.col("start_s") <= width)
    )
    return _labelled(found, keys, "final_end", label)


def _labelled(found: DataFrame, keys: Sequence[str], end: str, label: str) -> DataFrame:
    return found.select(
        *keys,
        wall_timestamp("start_s").alias("seq_start_ts"),
        wall_timestamp(end).alias("seq_end_ts"),
        F.round((F.col(end) - F.col("start_s")) / 3600.0, 2).alias("duration_h"),
        F.lit(label).alias("sequence"),
    )
