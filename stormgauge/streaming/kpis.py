"""Windowed KPIs over readings; every function takes static or streaming frames.

On a streaming frame the watermark bounds the state and drops rows that come too
late; on a static frame it has no effect, so a batch run gives the result the
stream converges to.  Spark sums up map-side before the shuffle, so a busy
airport costs one row per window and task.

On a static frame, sliding windows are built from panes: readings are summed up per pane
of one slide's width, and each pane goes to the windows it lies in, so panes are copied
and not readings.  A streaming frame uses Spark's sliding windows, as a query in
update mode may aggregate only once.

``airports`` (optional) is attached by a left join first.  Its rows are made
unique per airport, so the join cannot multiply readings.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormgauge.functions import weather
from stormgauge.operators.ranking import keep_first

# An airport is one key; of several places read for it one goes along, chosen by value.
AIRPORT = ("airport_code",)
PLACE = ("state", "county")


def attach_airports(readings: DataFrame, airports: DataFrame) -> DataFrame:
    """Left join with one row per airport; the reading wins where names collide.

    Of several rows of an airport the smallest is taken, so that a recomputed task
    picks the same one.  Spark broadcasts the airports while they are below
    its size threshold and sorts both sides otherwise.
    """
    clash = [c for c in airports.columns if c in readings.columns and c != "airport_code"]
    static = airports.drop(*clash)
    rest = [c for c in static.columns if c != "airport_code"]
    static = keep_first(static, ["airport_code"], rest) if rest else static.distinct()
    return readings.join(static, "airport_code", "left")


@dataclass(frozen=True)
class Measure:
    """An aggregate, at once or from parts of disjoint sets of rows.

    ``parts`` are the aggregates a pane keeps; ``merge`` gets a function from a part's name to
    its column and gives the aggregate over panes.
    """

    name: str
    at_once: Column
    parts: dict[str, Column]
    merge: Callable[[Callable[[str], Column]], Column]


def total(column: Column | str, name: str) -> Measure:
    return Measure(name, F.sum(column), {"sum": F.sum(column)}, lambda part: F.sum(part("sum")))


def average(column: Column | str, name: str) -> Measure:
    parts = {"sum": F.sum(column), "n": F.count(column)}
    return Measure(
        name, F.avg(column), parts, lambda part: F.try_divide(F.sum(part("sum")), F.sum(part("n")))
    )


def greatest(column: Column | str, name: str) -> Measure:
    return Measure(name, F.max(column), {"max": F.max(column)}, lambda part: F.max(part("max")))


def least(column: Column | str, name: str) -> Measure:
    return Measure(name, F.min(column), {"min": F.min(column)}, lambda part: F.min(part("min")))


def deviation(column: str, name: str) -> Measure:
    """Sample deviation from counts, means and squared deviations, joined pane by pane.

    The squared distance of two means counts with both sides' rows, so large values lose no
    digits, which they would in sums of squares.
    """
    n = F.count(column)
    state = F.struct(
        n.cast("double").alias("n"), F.avg(column).alias("mean"), (F.var_pop(column) * n).alias("m2")
    )

    def join(a: Column, b: Column) -> Column:
        both, apart = a["n"] + b["n"], b["mean"] - a["mean"]
        return F.struct(
            both.alias("n"),
            (a["mean"] + apart * b["n"] / both).alias("mean"),
            (a["m2"] + b["m2"] + apart * apart * a["n"] * b["n"] / both).alias("m2"),
        )

    def merge(part: Callable[[str], Column]) -> Column:
        # as many states as a window has panes
        states = F.collect_list(F.when(part("state")["n"] > 0, part("state")))
        empty = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
        return F.aggregate(
            states, empty, join, lambda s: F.when(s["n"] > 1, F.sqrt(s["m2"] / (s["n"] - 1)))
        )

    return Measure(name, F.stddev_samp(column), {"state": state}, merge)


def _sliding(
    readings: DataFrame,
    airports: DataFrame | None,
    measures: list[Measure],
    late: str = "15 minutes",
    width: int = 7200,
    slide: int = 1800,
) -> DataFrame:
    """``measures`` per airport in windows of ``width`` seconds, one every ``slide`` seconds."""
    if readings.isStreaming or width % slide:
        columns = [m.at_once.alias(m.name) for m in measures]
        spans = f"{width} seconds", f"{slide} seconds"
        return _windowed(readings, airports, AIRPORT, late, *spans, columns)
    source = readings if airports is None else attach_airports(readings, airports)
    parts = [c.alias(f"{m.name}.{k}") for m in measures for k, c in m.parts.items()]
    panes = (
        source.where(F.col("start_time_utc").isNotNull())
        .groupBy(*AIRPORT, F.window("start_time_utc", f"{slide} seconds").alias("pane"))
        .agg(
            F.min(F.struct(*PLACE)).alias("place"),
            F.count(F.lit(1)).alias("event_count"),
            *parts,
        )
    )
    first = F.unix_seconds("pane.start")
    starts = F.sequence(first - width + slide, first, F.lit(slide).cast("bigint"))
    merged = [
        m.merge(lambda k, m=m: F.col(f"`{m.name}.{k}`")).alias(m.name) for m in measures
    ]
    windows = panes.withColumn("start_s", F.explode(starts)).groupBy(*AIRPORT, "start_s")
    result = windows.agg(
        F.min("place").alias("place"), F.sum("event_count").alias("event_count"), *merged
    )
    return result.select(
        *AIRPORT,
        *[F.col(f"place.{c}").alias(c) for c in PLACE],
        F.timestamp_seconds("start_s").alias("event_window_start"),
        F.timestamp_seconds(F.col("start_s") + width).alias("event_window_end"),
        "event_count",
        *[m.name for m in measures],
    )


def _windowed(
    readings: DataFrame,
    airports: DataFrame | None,
    keys: tuple[str, ...],
    late: str,
    width: str,
    slide: str | None,
    measures: list[Column],
    names: tuple[str, str] = ("event_window_start", "event_window_end"),
) -> DataFrame:
    source = readings if airports is None else attach_airports(readings, airports)
    span = F.window("start_time_utc", width, slide) if slide else F.window("start_time_utc", width)
    grouped = source.withWatermark("start_time_utc", late).groupBy(*keys, span)
    carried = PLACE if keys == AIRPORT else ()
    place = [F.min(F.struct(*carried)).alias("place")] if carried else []
    result = grouped.agg(*place, F.count(F.lit(1)).alias("event_count"), *measures)
    rest = [c for c in result.columns if c not in (*keys, "window", "place")]
    return result.select(
        *keys,
        *[F.col(f"place.{c}").alias(c) for c in carried],
        F.col("window.start").alias(names[0]),
        F.col("window.end").alias(names[1]),
        *rest,
    )


def tumbling_means(readings: DataFrame, airports: DataFrame | None = None) -> DataFrame:
    """Means per airport in 5-hour windows (aligned to the epoch, not to midnight)."""
    fields = {
        "precip_in": "avg_precipitation",
        "temp_c": "avg_temp_c",
        "humidity": "avg_humidity",
        "cloud": "avg_cloud",
        "wind_kph": "avg_wind_kph",
        "vis_km": "avg_vis_km",
        "pressure_mb": "avg_pressure_mb",
    }
    means = [F.avg(c).alias(name) for c, name in fields.items()]
    return _windowed(readings, airports, AIRPORT, "10 minutes", "5 hours", None, means)


def sliding_kpis(readings: DataFrame, airports: DataFrame | None = None) -> DataFrame:
    """Rain, wind, visibility and heat stress in 2-hour windows every 30 minutes."""
    flags = readings.withColumns(
        {"rainy": weather.rainy_flag(), "heat": F.when(weather.heat_stress(), 1.0).otherwise(0.0)}
    )
    measures = [
        total("precip_in", "total_precip_in"),
        average("temp_c", "avg_temp_c"),
        average("humidity", "avg_humidity"),
        greatest("wind_kph", "max_wind_kph"),
        least("vis_km", "min_vis_km"),
        average("rainy", "rainy_rate"),
        average("heat", "heat_stress_rate"),
    ]
    return _sliding(flags, airports, measures)


def state_volatility(readings: DataFrame, airports: DataFrame | None = None) -> DataFrame:
    """Temperature and humidity spread per state in 6-hour windows.

    ``heat_stress_days`` counts readings, as its source column does.  With a
    single reading the deviations, and so the volatility, are NULL.
    """
    measures = [
        F.avg("temp_c").alias("avg_temp_c"),
        F.min("temp_c").alias("min_temp_c"),
        F.max("temp_c").alias("max_temp_c"),
        F.stddev_samp("temp_c").alias("stddev_temp_c"),
        F.avg("humidity").alias("avg_humidity"),
        F.stddev_samp("humidity").alias("stddev_humidity"),
        F.count_if(weather.heat_stress()).alias("heat_stress_days"),
    ]
    result = _windowed(
        readings,
        airports,
        ("state",),
        "1 day",
        "6 hours",
        "6 hours",
        measures,
        ("interval_start", "interval_end"),
    )
    return result.withColumn(
        "weather_volatility", F.col("stddev_temp_c") + F.col("stddev_humidity")
    )


def radiation_kpis(readings: DataFrame, airports: DataFrame | None = None) -> DataFrame:
    """Dew-point spread, UV, gusts and irradiance in 2-hour windows every 30 minutes."""
    source = readings.withColumns(
        {"spread": weather.dewpoint_spread(), "daytime": weather.daytime_flag()}
    )
    measures = [
        average("temp_c", "avg_temp_c"),
        average("humidity", "avg_humidity"),
        least("spread", "min_dewpoint_spread"),
        average("uv", "avg_uv_index"),
        greatest("gust_kph", "max_gust_kph"),
        average("daytime", "daytime_rate"),
        average("gti", "avg_gti"),
    ]
    return _sliding(source, airports, measures)


def instability(readings: DataFrame, airports: DataFrame | None = None) -> DataFrame:
    """Composite instability score in 2-hour windows every 30 minutes.

    The score is NULL if any part is: with one reading, or a spread of -0.1.
    """
    source = readings.withColumns(
        {"spread": weather.dewpoint_spread(), "gust": weather.gust_factor()}
    )
    measures = [
        least("spread", "min_dewpoint_spread"),
        deviation("pressure_mb", "stddev_pressure_mb"),
        greatest("gust", "max_gust_factor"),
        deviation("cloud", "stddev_cloud"),
    ]
    result = _sliding(source, airports, measures)
    score = (
        F.try_divide(F.lit(1.0), F.col("min_dewpoint_spread") + 0.1)
        + F.col("stddev_pressure_mb") / 10.0
        + F.col("max_gust_factor")
        + F.col("stddev_cloud") / 20.0
    )
    return result.withColumn("instability_score", score)
