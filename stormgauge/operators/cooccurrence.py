"""Minutes during which two event types are active together, per airport and day.

No pairs of events are formed.  Each type becomes disjoint islands per day,
every island is copied once per *other type present that day*, and one ordered
pass per pair of types counts how many of the two are active.  For a vocabulary
of a bounded size, which :func:`stormgauge.functions.weather.require_vocabulary`
checks, the work is linear in islands, also for a day on which one airport saw a
very large number of events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stormgauge.functions.calendar import day_number, day_to_date
from stormgauge.operators.intervals import (
    as_seconds,
    collapse,
    cut_at_midnight,
    day_islands,
    day_pieces,
    double_cover,
    merge_sorted,
)

PLACE = ["airport_code", "day"]  # everything below is co-located by airport day


def _pair_up(islands: DataFrame, explode=F.explode) -> DataFrame:
    """One copy of each island per pair its type forms on that airport day."""
    present = F.collect_set("type").over(Window.partitionBy(*PLACE))
    partner = F.col("partner")
    return (
        islands.withColumn("present", present)
        .withColumn("partner", explode(F.array_remove("present", F.col("type"))))
        .withColumns(
            {
                "type_i": F.when(partner.isNotNull(), F.least("type", partner)),
                "type_j": F.when(partner.isNotNull(), F.greatest("type", partner)),
            }
        )
        .drop("present", "partner", "type")
    )


def cooccurrence_minutes_daily(events: DataFrame) -> DataFrame:
    """Shared minutes per (airport, day, type_i < type_j), split at midnight."""
    islands = day_islands(
        as_seconds(events, ["airport_code", "type"]), ["airport_code", "type"], place=PLACE
    )
    covered = double_cover(_pair_up(islands), [*PLACE, "type_i", "type_j"])
    return covered.where(F.col("seconds") > 0).select(
        "airport_code",
        day_to_date("day").alias("event_date"),
        "type_i",
        "type_j",
        (F.col("seconds") / 60.0).alias("overlap_minutes"),
    )


def cooccurrence_sweep(events: DataFrame) -> DataFrame:
    """As above, but a stretch counts to the day of the last marker at or before it.

    A marker is any event start or end at the airport.  Time before a day's
    first marker therefore counts to the latest earlier day that had a marker,
    which is what an unsplit sweep over the airport's whole timeline yields.
    """
    spans = as_seconds(events, ["airport_code", "type"]).withColumns(
        {"last_day": day_number("end_s"), "own_end": F.col("end_s")}
    )
    # the first end on a day is kept by collapsing per last day
    keys = ["airport_code", "type", "last_day"]
    reduced = collapse(
        cut_at_midnight(spans, [*keys, "own_end"]),
        [*keys, "opened"],
        extra=[F.min("own_end").alias("first_end")],
    )
    starts_here = F.col("opened") & (F.col("day") == day_number("start_s"))
    own_marker = F.least(  # NULLs are skipped
        F.when(starts_here, F.col("start_s")),
        F.when(F.col("day") == F.col("last_day"), F.col("first_end")),
    )
    pieces = (
        day_pieces(reduced)
        .select("airport_code", "type", "day", "s", "e", own_marker.alias("marker"))
        .repartition(*PLACE)
        .withColumn("first_marker", F.min("marker").over(Window.partitionBy(*PLACE)))
        .drop("marker")
    )
    islands = merge_sorted(pieces, ["airport_code", "type", "day", "first_marker"])
    # a day on which only one type shows up keeps its row: its marker is needed
    pairs = _pair_up(islands, F.explode_outer)
    early = F.least(F.col("seg_end"), F.col("first_marker")) - F.col("seg_start")
    covered = double_cover(
        pairs,
        [*PLACE, "type_i", "type_j"],
        extra=[
            F.max("first_marker").alias("first_marker"),
            F.sum(F.when((F.col("active") == 2) & (early > 0), early)).alias("early"),
        ],
    )
    marked_day = F.when(F.col("first_marker").isNotNull(), F.col("day"))
    earlier = (
        Window.partitionBy("airport_code")
        .orderBy("day")
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    early_seconds = F.coalesce("early", F.lit(0))
    return (
        covered.withColumn("previous_day", F.max(marked_day).over(earlier))
        .where(F.col("seconds") > 0)
        .select(
            "airport_code",
            "type_i",
            "type_j",
            F.inline(
                F.array(
                    F.struct(
                        F.col("day").alias("on_day"),
                        (F.col("seconds") - early_seconds).alias("part"),
                    ),
                    F.struct(F.col("previous_day").alias("on_day"), early_seconds.alias("part")),
                )
            ),
        )
        .where(F.col("part") > 0)
        .groupBy("airport_code", "on_day", "type_i", "type_j")
        .agg((F.sum("part") / 60.0).alias("overlap_minutes"))
        .select(
            "airport_code",
            day_to_date("on_day").alias("event_date"),
            "type_i",
            "type_j",
            "overlap_minutes",
        )
    )

