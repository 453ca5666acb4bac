"""Interval primitives: validity, day pieces, disjoint islands, episodes, markers.

How they scale
--------------
A busy place may hold a large share of all events, so nothing here orders all
events of a key in one task.

* Before anything is ordered, events that surely belong together are joined by a
  plain aggregate, which Spark combines map-side (:func:`collapse`).  However
  many events there are, a key keeps at most one row per time slot and one per
  second of events that end within their slot.
* Ordered steps run per (key, day), on that bounded number of rows.
* What continues over midnight travels as at most two *edge* rows per (key,
  day).  Only these are ordered along the whole history of a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stormgauge.functions.calendar import (
    DAY_SECONDS,
    bucket_number,
    day_number,
    wall_seconds,
    wall_timestamp,
)

EDGE = -(2**31)  # chain number of the edge rows; no day number comes near it
SLOT_SECONDS = 300  # default width of the slots events are collapsed by


def valid_interval(
    start: str = "local_start_ts", end: str = "local_end_ts", allow_empty: bool = False
) -> Column:
    """Both ends known and the end after the start (or equal, if empty is allowed)."""
    s, e = F.col(start), F.col(end)
    return s.isNotNull() & e.isNotNull() & ((e >= s) if allow_empty else (e > s))


def as_seconds(
    events: DataFrame,
    keep: Sequence[str],
    start: str = "local_start_ts",
    end: str = "local_end_ts",
    allow_empty: bool = False,
) -> DataFrame:
    """Valid intervals as ``keep`` + bigint ``start_s``, ``end_s``."""
    return events.where(valid_interval(start, end, allow_empty)).select(
        *keep, wall_seconds(start).alias("start_s"), wall_seconds(end).alias("end_s")
    )


def day_pieces(spans: DataFrame, start: str = "start_s", end: str = "end_s") -> DataFrame:
    """One row per touched day: adds ``day`` and the clipped span ``s``, ``e``.

    A span ending exactly at midnight also yields an empty piece on the next
    day; callers that want covered time only filter ``e > s``.
    """
    first, last = day_number(start), day_number(end)
    day_start = F.col("day").cast("bigint") * DAY_SECONDS
    return spans.withColumn("day", F.explode(F.sequence(first, last))).withColumns(
        {
            "s": F.greatest(F.col(start), day_start),
            "e": F.least(F.col(end), day_start + DAY_SECONDS),
        }
    )


def collapse(
    spans: DataFrame,
    keys: Sequence[str],
    width: int = SLOT_SECONDS,
    start: str = "start_s",
    end: str = "end_s",
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Fewer spans with the same union per key: ``start``, ``end`` and ``extra``.

    Time is cut into slots.  Spans that start in the same slot and last to its end
    all hold the slot's end, so together they cover one unbroken stretch, and one
    row says as much.  A span ending within its slot only joins spans of the same
    start.  (A short span starting where a slot ends may share the group of that
    slot; both touch there, so their union is unbroken as well.)
    """
    slot_end = (bucket_number(start, width) + 1) * width
    slot = F.when(F.col(end) >= slot_end, slot_end).otherwise(F.col(start))
    return (
        spans.groupBy(*keys, slot.alias("slot"))
        .agg(F.min(start).alias(start), F.max(end).alias(end), *extra)
        .drop("slot")
    )


def cut_at_midnight(spans: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Spans cut once, at the first midnight behind their start.

    Adds ``opened``: whether the part begins where its span does.  The rests of one day
    all begin at its midnight, so collapsing joins them to one row, and long events are
    copied to their days once per day they start on, not once per slot.
    """
    midnight = (day_number("start_s").cast("bigint") + 1) * DAY_SECONDS

    def part(start: Column, end: Column, opened: bool) -> Column:
        return F.struct(start.alias("start_s"), end.alias("end_s"), F.lit(opened).alias("opened"))

    own = part(F.col("start_s"), F.least("end_s", midnight), True)
    rest = part(midnight, F.col("end_s"), False)
    parts = F.when(F.col("end_s") > midnight, F.array(own, rest)).otherwise(F.array(own))
    return spans.select(*keep, F.inline(parts))


def day_islands(
    spans: DataFrame, keys: Sequence[str], place: Sequence[str] | None = None
) -> DataFrame:
    """Disjoint covered spans ``s``, ``e`` per (keys, day); touching spans merge.

    ``place`` names the columns to distribute by (a subset of ``keys`` + day).
    Later windows and aggregates whose keys contain ``place`` then need no
    further shuffle.
    """
    pieces = day_pieces(collapse(cut_at_midnight(spans, keys), keys))
    pieces = pieces.where(F.col("e") > F.col("s"))
    placed = pieces.select(*keys, "day", "s", "e").repartition(*(place or [*keys, "day"]))
    return merge_sorted(placed, [*keys, "day"])


def merge_sorted(
    spans: DataFrame,
    keys: Sequence[str],
    latest: Sequence[str] = (),
    totals: Sequence[str] = (),
) -> DataFrame:
    """Merge spans ``s``, ``e`` that touch or overlap; the groups must be bounded.

    Columns in ``latest`` grow along with the islands and keep their maximum,
    columns in ``totals`` are summed per island; neither may hold NULLs.

    A row opens an island if it starts after everything before it has ended.  What
    an island comes to is then known from the row that opens the next one, or from
    the whole group for the last island, so only opening rows are kept.
    """
    w = Window.partitionBy(*keys).orderBy("s")
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    measures = {c: F.max for c in ("e", *latest)} | {c: F.sum for c in totals}
    known = {f"{c}_before": fold(c).over(earlier) for c, fold in measures.items()}
    known |= {f"{c}_in_all": fold(c).over(whole) for c, fold in measures.items()}
    opening = spans.withColumns(known).where(
        F.col("e_before").isNull() | (F.col("s") > F.col("e_before"))
    )

    def upto_next(c: str) -> Column:
        return F.coalesce(F.lead(f"{c}_before").over(w), F.col(f"{c}_in_all"))

    return opening.select(
        *keys,
        "s",
        *[upto_next(c).alias(c) for c in ("e", *latest)],
        *[(upto_next(c) - F.coalesce(f"{c}_before", F.lit(0))).alias(c) for c in totals],
    )


def episodes(
    events: DataFrame,
    keys: Sequence[str],
    gap_seconds: int = 0,
    gap_rule: str = "max_end",
    start: str = "local_start_ts",
    end: str = "local_end_ts",
) -> DataFrame:
    """Sessions of intervals separated by pauses longer than ``gap_seconds``.

    ``gap_rule="max_end"`` measures the pause from the furthest end seen so far;
    ``"previous"`` from the end of the directly preceding row (by start, then
    end), so a short event nested in a long one may split an episode.

    Output: keys, ``start_s``, ``end_s``, ``events``.
    """
    spans = as_seconds(events, list(keys), start, end, allow_empty=True)
    if gap_rule == "previous":
        local = _local_by_previous(spans, keys, gap_seconds)
        limit = gap_seconds
    elif gap_rule != "max_end":
        raise ValueError(f"unknown gap_rule {gap_rule!r}")
    elif gap_seconds >= SLOT_SECONDS:
        return _by_slots(spans, keys, gap_seconds)
    else:
        local = _local_by_reach(spans, keys, gap_seconds)
        limit = 0

    # Join what continues over midnight.  Inner islands of a day stand alone in
    # the group of their day, edges of all days of a key form one small chain.
    chain = F.when(F.col("edge"), F.lit(EDGE)).otherwise(F.col("day"))
    w = Window.partitionBy(*keys, "chain").orderBy("island")
    return (
        local.withColumn("chain", chain)
        .withColumn("before", F.lag("reach").over(w) + F.lit(limit))
        .withColumn("episode", _running_start("island", w))
        .groupBy(*keys, "chain", "episode")
        .agg(F.max("last_end").alias("end_s"), F.sum("events").alias("events"))
        .select(*keys, F.col("episode").alias("start_s"), "end_s", "events")
    )


def _running_start(order: str, window) -> Column:
    """Start of the run a row belongs to; a run opens where ``before`` lies behind."""
    opens = F.col("before").isNull() | (F.col(order) > F.col("before"))
    return F.max(F.when(opens, F.col(order))).over(
        window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def _stretched(spans: DataFrame, keys: Sequence[str], gap: int) -> DataFrame:
    """Collapsed spans that reach as far as the next event may start."""
    return collapse(
        spans.withColumn("reach", F.col("end_s") + F.lit(gap)),
        keys,
        max(gap, SLOT_SECONDS),
        end="reach",
        extra=[F.max("end_s").alias("last_end"), F.count(F.lit(1)).alias("events")],
    )


def _by_slots(spans: DataFrame, keys: Sequence[str], gap: int) -> DataFrame:
    """Episodes for a pause of at least a slot, merged along the whole history.

    With slots as wide as the pause, all events starting in one slot belong to one
    episode.  So a key has one row per slot, however many events it has: 8,760 a
    year for a pause of an hour.  That many can be ordered in one go.
    """
    reduced = _stretched(spans, keys, gap).select(
        *keys, F.col("start_s").alias("s"), F.col("reach").alias("e"), "last_end", "events"
    )
    return merge_sorted(reduced, keys, latest=["last_end"], totals=["events"]).select(
        *keys, F.col("s").alias("start_s"), F.col("last_end").alias("end_s"), "events"
    )


def _local_by_reach(spans: DataFrame, keys: Sequence[str], gap: int) -> DataFrame:
    """Islands per day of spans stretched by the allowed pause."""
    reduced = _stretched(spans, keys, gap)
    starts_here = F.col("day") == day_number("start_s")
    counted_once = F.when(starts_here, F.col("events")).otherwise(0)
    pieces = day_pieces(reduced, end="reach").select(
        *keys, "day", "s", "e", "last_end", counted_once.alias("events")
    )
    day_start = F.col("day").cast("bigint") * DAY_SECONDS
    return merge_sorted(pieces, [*keys, "day"], latest=["last_end"], totals=["events"]).select(
        *keys,
        "day",
        F.col("s").alias("island"),
        F.col("e").alias("reach"),
        "last_end",
        "events",
        ((F.col("s") == day_start) | (F.col("e") == day_start + DAY_SECONDS)).alias("edge"),
    )


def _local_by_previous(spans: DataFrame, keys: Sequence[str], gap: int) -> DataFrame:
    """Runs per day in which each start follows the previous row's end closely."""
    collapsed = (
        spans.groupBy(*keys, "start_s")
        .agg(F.max("end_s").alias("end_s"), F.count(F.lit(1)).alias("events"))
        .withColumn("day", day_number("start_s"))
    )
    by_day = Window.partitionBy(*keys, "day")
    w = by_day.orderBy("start_s")
    return (
        collapsed.withColumn("before", F.lag("end_s").over(w) + F.lit(gap))
        .withColumn("island", _running_start("start_s", w))
        .groupBy(*keys, "day", "island")
        .agg(
            F.max_by("end_s", "start_s").alias("reach"),
            F.max("end_s").alias("last_end"),
            F.sum("events").alias("events"),
        )
        .withColumn(
            "edge",
            (F.col("island") == F.min("island").over(by_day))
            | (F.col("island") == F.max("island").over(by_day)),
        )
    )


def merge_islands(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Disjoint covered spans per key over the whole history (pause of zero)."""
    return episodes(events, keys, gap_seconds=0)


def net_markers(spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Start (+1) and end (-1) markers, netted per (keys, second ``ts_s``)."""
    return (
        spans.select(
            *keys,
            F.inline(
                F.array(
                    F.struct(F.col("start_s").alias("ts_s"), F.lit(1).alias("delta")),
                    F.struct(F.col("end_s").alias("ts_s"), F.lit(-1).alias("delta")),
                )
            ),
        )
        .groupBy(*keys, "ts_s")
        .agg(F.sum("delta").alias("net"))
    )


def marker_rows(spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every start and end as a row: keys, ``day``, ``ts_s``, ``delta``, ``real``.

    An event running on from an earlier day also counts in at 00:00.  ``real``
    tells whether an event starts or ends at that second, or only runs on.
    """
    first_day, last_day = day_number("start_s"), day_number("end_s")
    day_start = F.col("day").cast("bigint") * DAY_SECONDS
    enter = F.struct(
        F.greatest(F.col("start_s"), day_start).alias("ts_s"),
        F.lit(1).alias("delta"),
        (F.col("day") == first_day).alias("real"),
    )
    leave = F.struct(
        F.col("end_s").alias("ts_s"), F.lit(-1).alias("delta"), F.lit(True).alias("real")
    )
    ends_here = F.col("day") == last_day
    return spans.withColumn("day", F.explode(F.sequence(first_day, last_day))).select(
        *keys, "day", F.inline(F.when(ends_here, F.array(enter, leave)).otherwise(F.array(enter)))
    )


def day_markers(spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Net markers per (keys, ``day``, ``ts_s``), complete within each day; see :func:`marker_rows`."""
    markers = marker_rows(spans, keys).groupBy(*keys, "day", "ts_s")
    return markers.agg(F.sum("delta").alias("net"), F.bool_or("real").alias("real"))


def overlap_seconds_daily(sides: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Seconds per (keys, day) during which both interval sets are active.

    An interval-overlap join for the case where the overlap *length* is wanted:
    both sides become islands, then one ordered pass counts active sides, so no
    pairs of intervals are formed.  ``sides`` carries ``start_s``, ``end_s`` and a
    column ``side`` of two values, so that both sets come from one read.
    """
    islands = day_islands(sides, [*keys, "side"], place=[*keys, "day"])
    return double_cover(islands, [*keys, "day"]).where(F.col("seconds") > 0)


def overlap_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], width: int = DAY_SECONDS
) -> DataFrame:
    """Pairs of rows of both sides whose intervals overlap: an equi-join by time bucket.

    Inputs carry ``start_s``, ``end_s`` (end excluded) and columns that are told apart by
    ``left_`` and ``right_`` in the result.  Every interval goes to the buckets it
    touches; a pair is kept in the bucket of its later start only, so none comes twice.

    The result holds all pairs, so it grows with the overlaps there are.  A key that is
    busy in one bucket makes a large partition, which adaptive execution splits; a
    narrower ``width`` spreads it over more buckets but copies long intervals more often.
    """

    def placed(side: DataFrame, prefix: str) -> DataFrame:
        named = side.select(
            *keys, *[F.col(c).alias(prefix + c) for c in side.columns if c not in keys]
        )
        start, end = F.col(f"{prefix}start_s"), F.col(f"{prefix}end_s")
        buckets = F.sequence(bucket_number(start, width), bucket_number(end - 1, width))
        return named.where(end > start).withColumn("bucket", F.explode(buckets))

    joined = placed(left, "left_").join(placed(right, "right_"), [*keys, "bucket"])
    later = F.greatest("left_start_s", "right_start_s")
    return joined.where(
        (F.col("left_start_s") < F.col("right_end_s"))
        & (F.col("right_start_s") < F.col("left_end_s"))
        & (F.col("bucket") == bucket_number(later, width))
    ).drop("bucket")


def session_windows(
    events: DataFrame,
    keys: Sequence[str],
    gap_seconds: int = 0,
    start: str = "local_start_ts",
    end: str = "local_end_ts",
    late: str | None = None,
) -> DataFrame:
    """:func:`episodes` by Spark's session windows, for static and streaming frames.

    An event keeps its session open until ``gap_seconds`` after its end.  On a streaming
    frame give ``late``, the delay of the watermark on ``start``, which bounds the state.
    """
    source = events.withWatermark(start, late) if late else events
    valid = source.where(valid_interval(start, end, allow_empty=True))
    # times are whole seconds; half a second keeps windows of empty events open
    open_for = wall_seconds(end) - wall_seconds(start) + F.lit(gap_seconds)
    gap = F.concat(open_for.cast("string"), F.lit(" seconds 500 milliseconds"))
    session = F.session_window(start, gap)
    return valid.groupBy(*keys, session).agg(
        F.min(start).alias("session_start"),
        F.max(end).alias("session_end"),
        F.count(F.lit(1)).alias("events"),
    ).drop("session_window")


def double_cover(islands: DataFrame, groups: Sequence[str], extra=()) -> DataFrame:
    """Seconds per group during which two of its disjoint span sets are active.

    ``extra`` adds aggregates over the segments (``seg_start``, ``seg_end``,
    with ``active`` sides).
    """
    w = Window.partitionBy(*groups).orderBy("seg_start")
    return (
        islands.select(
            *[c for c in islands.columns if c not in ("s", "e")],
            F.inline(
                F.array(
                    F.struct(F.col("s").alias("seg_start"), F.lit(1).alias("delta")),
                    F.struct(F.col("e").alias("seg_start"), F.lit(-1).alias("delta")),
                )
            ),
        )
        .withColumns(
            {
                "active": F.sum("delta").over(
                    w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
                ),
                "seg_end": F.lead("seg_start").over(w),
            }
        )
        .groupBy(*groups)
        .agg(
            F.sum(F.when(F.col("active") == 2, F.col("seg_end") - F.col("seg_start"))).alias(
                "seconds"
            ),
            *extra,
        )
    )


def with_wall_times(df: DataFrame, start: str, end: str) -> DataFrame:
    """Replace ``start_s``/``end_s`` by the named NTZ columns."""
    return df.withColumns(
        {start: wall_timestamp("start_s"), end: wall_timestamp("end_s")}
    ).drop("start_s", "end_s")
