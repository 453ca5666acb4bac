"""Segments of a place's timeline and the state that holds on them.

A *marker* is an event start or end.  The distinct marker seconds of a place cut
its time into segments; on each segment the number of active events of a kind is
constant.  All counting happens per day: events running on from an earlier day
are counted in at 00:00, so no day waits for the one before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stormgauge.functions.calendar import day_number
from stormgauge.operators.intervals import EDGE, day_markers, marker_rows


def _chain(edge: Column) -> Column:
    """Group for the step along the whole history: all edges, or the row's own day."""
    return F.when(edge, F.lit(EDGE)).otherwise(F.col("day"))


def segments(markers: DataFrame, place: Sequence[str], time: str = "ts_s") -> DataFrame:
    """Stretches [time, next_s) between the distinct markers of each place.

    Neighbours are found per (place, day).  The first and last marker of each day
    are ordered along the place, to close the last stretch of a day.
    """
    by_day = Window.partitionBy(*place, "day").orderBy(time)
    along = Window.partitionBy(*place, "chain").orderBy(time)
    edge = F.col("next_s").isNull() | (F.col("position") == 1)
    return (
        markers.select(*place, time)
        .distinct()
        .withColumn("day", day_number(time))
        .withColumns({"next_s": F.lead(time).over(by_day), "position": F.row_number().over(by_day)})
        .withColumn("chain", _chain(edge))
        .withColumn("next_s", F.coalesce("next_s", F.lead(time).over(along)))
        .where(F.col("next_s").isNotNull())
        .select(*place, time, "next_s")
    )


def running_counts(
    spans: DataFrame, keys: Sequence[str], place: Sequence[str] | None = None
) -> DataFrame:
    """Active events per key after each marker: keys, ``day``, ``ts_s``, ``real``, ``active``.

    Rows that are not ``real`` carry the count into a day at 00:00.
    """
    w = Window.partitionBy(*keys, "day").orderBy("ts_s")
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = day_markers(spans, keys).repartition(*(place or [*keys, "day"]))
    return placed.withColumn("active", F.sum("net").over(so_far)).drop("net")


def states_on_segments(spans: DataFrame, place: Sequence[str], kind: str) -> DataFrame:
    """The active kinds on every segment of a place, where there are any, in one row.

    ``states`` holds structs of the kind and its number of active events, in order of the
    kinds.  A marker is one row with a running count per kind, so the kinds are read first:
    a small vocabulary, which becomes columns.
    """
    found = spans.select(kind).where(F.col(kind).isNotNull()).distinct()
    kinds = sorted(r[0] for r in found.collect()) or [None]
    of_kind = {f"__{n}": F.lit(k).cast(spans.schema[kind].dataType) for n, k in enumerate(kinds)}
    day = [*place, "day"]
    by_day = Window.partitionBy(*day).orderBy("ts_s")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # summed before rows are placed by day, so that a placed row is a distinct second
    counts = marker_rows(spans, [*place, kind]).groupBy(*day, "ts_s").agg(
        F.bool_or("real").alias("real"),
        *[F.sum(F.when(F.col(kind) == k, F.col("delta"))).alias(n) for n, k in of_kind.items()],
    )
    filled = counts.withColumns({n: F.coalesce(F.sum(n).over(so_far), F.lit(0)) for n in of_kind})
    states = [F.struct(k.alias(kind), F.col(n).alias("active")) for n, k in of_kind.items()]
    within = filled.where("real").select(
        *day,
        "ts_s",
        F.filter(F.array(*states), lambda state: state["active"] > 0).alias("states"),
        F.lead("ts_s").over(by_day).alias("next_s"),
        F.row_number().over(by_day).alias("position"),
    )
    edge = F.col("next_s").isNull() | (F.col("position") == 1)
    along = Window.partitionBy(*place, "chain").orderBy("ts_s")
    return (
        within.where(edge | (F.size("states") > 0))
        .withColumn("chain", _chain(edge))
        .withColumn("next_s", F.coalesce("next_s", F.lead("ts_s").over(along)))
        .where((F.size("states") > 0) & F.col("next_s").isNotNull())
        .select(*place, "ts_s", "next_s", "states")
    )


def state_on_segments(spans: DataFrame, place: Sequence[str], kind: str) -> DataFrame:
    """Active events of each kind on every segment of a place, where there are any."""
    found = states_on_segments(spans, place, kind)
    return found.select(*place, "ts_s", "next_s", F.inline("states")).select(
        *place, kind, "ts_s", "next_s", "active"
    )


def sets_on_segments(
    spans: DataFrame, place: Sequence[str], kind: str, at_least: int = 2
) -> DataFrame:
    """Sorted set of active kinds per segment, as :func:`active_sets`, without regrouping."""
    found = states_on_segments(spans, place, kind).where(F.size("states") >= at_least)
    return found.select(*place, "ts_s", "next_s", F.col(f"states.{kind}").alias("kinds"))


def active_sets(
    state: DataFrame, place: Sequence[str], kind: str, at_least: int = 2
) -> DataFrame:
    """Sorted set of active kinds per segment, where there are ``at_least`` so many."""
    return (
        state.groupBy(*place, "ts_s", "next_s")
        .agg(F.array_sort(F.collect_set(kind)).alias("kinds"))
        .where(F.size("kinds") >= at_least)
    )


def unordered_pairs(items: Column) -> Column:
    """All pairs ``(type_i, type_j)`` with ``type_i < type_j`` of a small set."""
    ordered = F.array_sort(F.array_distinct(items))
    return F.flatten(
        F.transform(
            ordered,
            lambda a: F.transform(
                F.filter(ordered, lambda b: b > a),
                lambda b: F.struct(a.alias("type_i"), b.alias("type_j")),
            ),
        )
    )
