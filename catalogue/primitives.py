"""Building blocks one by one: scans, sinks, interval steps, windows, scalars."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from stormgauge.contracts import TABLES, Table, conform, violations
from catalogue.batch import RISK
from catalogue.scratch import shared_folder
from catalogue.fixtures import dense, flawed_raw_events, raw_events, readings, sparse
from stormgauge.functions import calendar as cal
from stormgauge.functions import weather
from stormgauge.operators import cleaning, intervals, overlaps, seasons, timeline
from stormgauge.operators.cooccurrence import cooccurrence_minutes_daily
from stormgauge.operators.exposure import exposure_hours_daily
from stormgauge.operators.ranking import keep_first, top_per_group
from stormgauge.operators.sessions import longest_episodes
from stormgauge.sinks.parquet import (
    join_colocated,
    register_external_table,
    write_bucketed,
    write_partitioned,
)
from stormgauge.sources.files import dated_path, read_events, read_raw

AIRPORT_TYPE = ["airport_code", "type"]


def _spans(spark, sf_dir, *keep):
    return intervals.as_seconds(dense(spark, sf_dir), keep)


# scans and sinks


def parquet_scan_pruned(spark, sf_dir):
    """Three of the columns, with a filter that reaches the file statistics."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select(
        "o_orderkey", "o_orderpriority", "o_orderstatus"
    )


def header_normalisation(spark, sf_dir):
    return cleaning.normalise_headers(raw_events(spark, sf_dir)).select(
        "eventid", "type", "starttime_utc_", "precipitation_in_", "zipcode"
    )


def raw_csv_scan(spark, sf_dir):
    """Raw rows written as CSV to a dated landing folder and read back."""
    path = dated_path(shared_folder(spark, "landing"), "2025-09-01")
    raw_events(spark, sf_dir).write.option("header", True).csv(path)
    return cleaning.normalise_headers(read_raw(spark, path)).select(
        "eventid", F.trim("type").alias("type"), "starttime_utc_", "timezone", "zipcode"
    )


def _written_clean(spark, sf_dir):
    path = shared_folder(spark, "events_clean")
    write_partitioned(cleaning.clean_events(flawed_raw_events(spark, sf_dir)), path)
    return path


def partitioned_parquet_sink(spark, sf_dir):
    """The cleaned table written by month and read back for a range of months."""
    path = _written_clean(spark, sf_dir)
    return read_events(
        spark,
        path,
        ["event_id", "type", "local_start_ts", "event_year", "event_month"],
        months=("2023-12", "2024-01"),
    )


def external_table(spark, sf_dir):
    """A catalog table over the written files, partitions discovered."""
    name = f"events_clean_{uuid.uuid4().hex}"
    register_external_table(spark, name, _written_clean(spark, sf_dir))
    return spark.table(name).select("event_id", "severity", "event_date", "event_year")


def contract_conform(spark, sf_dir):
    """Columns in contract order and type, with the generated pair label."""
    return conform(
        cooccurrence_minutes_daily(dense(spark, sf_dir)), TABLES["cooccurrence_minutes_daily"]
    )


def bucketed_table(spark, sf_dir):
    """Exposure stored by its distribution key, then summed per key without a shuffle.

    A key's rows share a bucket; these are one per airport and day, so a bucket is bounded.
    """
    table = TABLES["exposure_hours_daily"]
    name = f"exposure_{uuid.uuid4().hex}"
    rows = conform(exposure_hours_daily(dense(spark, sf_dir)), table)
    path = shared_folder(spark, "bucketed")
    write_bucketed(rows, name, path, table.place, buckets=8, sort_by=["event_date"])
    return spark.table(name).groupBy("airport_code").agg(
        F.count(F.lit(1)).alias("days"),
        F.max("exposure_hours_day").alias("worst_day"),
        F.max("event_date").alias("last_date"),
    )


def colocated_join(spark, sf_dir):
    """Exposure and episodes stored by airport in the same buckets, joined per airport without a shuffle."""
    frames = {
        "exposure_hours_daily": exposure_hours_daily(dense(spark, sf_dir), RISK),
        "longest_episodes": longest_episodes(dense(spark, sf_dir), RISK),
    }
    names = []
    for table, frame in frames.items():
        names.append(f"{table}_{uuid.uuid4().hex}")
        rows = conform(frame, TABLES[table])
        write_bucketed(rows, names[-1], shared_folder(spark, "bucketed"), "airport_code", 8, ["airport_code"])

    def days(rows):
        return rows.groupBy("airport_code").agg(
            F.count(F.lit(1)).alias("days"), F.max("exposure_hours_day").alias("worst_day")
        )

    def spells(rows):
        return rows.groupBy("airport_code").agg(
            F.count(F.lit(1)).alias("episodes"), F.max("session_duration_hours").alias("longest_hours")
        )

    return join_colocated(spark, *names, "full", days, spells)


def contract_violations(spark, sf_dir):
    """Counts of missing values and repeated keys, on rows that do break a contract."""
    table = Table(
        "daily_states",
        "state string not null, county string not null, storm_h double not null",
        ("state", "county"),
        "state",
    )
    rows = sparse(spark, sf_dir).select(
        "state",
        "county",
        F.when(F.col("type") == "STORM", F.col("duration_min") / 60.0).alias("storm_h"),
    )
    return violations(rows, table)


# interval steps


def valid_intervals(spark, sf_dir):
    rows = dense(spark, sf_dir).where(intervals.valid_interval())
    seconds = cal.wall_seconds("local_end_ts") - cal.wall_seconds("local_start_ts")
    return rows.select("event_id", "airport_code", "type", seconds.alias("duration_s"))


def split_by_day(spark, sf_dir):
    pieces = intervals.day_pieces(_spans(spark, sf_dir, "event_id"))
    return pieces.select(
        "event_id",
        cal.day_to_date("day").alias("event_date"),
        (F.col("e") - F.col("s")).alias("covered_s"),
    )


def day_islands(spark, sf_dir):
    islands = intervals.day_islands(_spans(spark, sf_dir, *AIRPORT_TYPE), AIRPORT_TYPE)
    return islands.select(
        *AIRPORT_TYPE,
        cal.day_to_date("day").alias("event_date"),
        cal.wall_timestamp("s").alias("start_ts"),
        cal.wall_timestamp("e").alias("end_ts"),
    )


def merge_islands(spark, sf_dir):
    merged = intervals.merge_islands(dense(spark, sf_dir), AIRPORT_TYPE)
    return intervals.with_wall_times(merged.drop("events"), "start_ts", "end_ts")


def net_delta_markers(spark, sf_dir):
    """On half hours, so that starts and ends do meet and cancel out."""
    spans = _spans(spark, sf_dir, *AIRPORT_TYPE)
    coarse = spans.withColumns({c: F.col(c) - F.col(c) % 1800 for c in ("start_s", "end_s")})
    markers = intervals.net_markers(coarse, AIRPORT_TYPE)
    return markers.select(*AIRPORT_TYPE, cal.wall_timestamp("ts_s").alias("ts"), "net")


def interval_overlap_join(spark, sf_dir):
    """Seconds per airport day during which fog and snow overlap."""
    spans = _spans(spark, sf_dir, *AIRPORT_TYPE)
    sides = spans.where(weather.type_in("type", ["fog", "snow"])).withColumnRenamed("type", "side")
    shared = intervals.overlap_seconds_daily(sides, ["airport_code"])
    return shared.select("airport_code", cal.day_to_date("day").alias("event_date"), "seconds")


def overlapping_pairs(spark, sf_dir):
    """Heavy fog and heavy snow of one airport that overlap, pair by pair."""
    spans = _spans(spark, sf_dir, "airport_code", "event_id", "type", "severity")
    heavy = spans.where(weather.severity_in("severity", ["heavy"])).drop("severity")
    pairs = intervals.overlap_join(
        heavy.where(weather.type_in("type", ["fog"])).drop("type"),
        heavy.where(weather.type_in("type", ["snow"])).drop("type"),
        ["airport_code"],
    )
    end, start = F.least("left_end_s", "right_end_s"), F.greatest("left_start_s", "right_start_s")
    return pairs.select(
        "airport_code", "left_event_id", "right_event_id", (end - start).alias("seconds")
    )


def overlapping_pairs_any_severity(spark, sf_dir):
    """All fog and all snow of one airport that overlap, pair by pair."""
    spans = _spans(spark, sf_dir, "airport_code", "event_id", "type")
    pairs = intervals.overlap_join(
        spans.where(weather.type_in("type", ["fog"])).drop("type"),
        spans.where(weather.type_in("type", ["snow"])).drop("type"),
        ["airport_code"],
    )
    end, start = F.least("left_end_s", "right_end_s"), F.greatest("left_start_s", "right_start_s")
    return pairs.select(
        "airport_code", "left_event_id", "right_event_id", (end - start).alias("seconds")
    )


def overlapping_pairs_nested(spark, sf_dir):
    """All fog and snow of one airport that overlap, one event in forty for up to 300 days.

    Covers of a few blocks per event meet starts, so a long event is not copied to its days.
    """
    spans = _spans(spark, sf_dir, "airport_code", "event_id", "type")
    longer = F.when(F.col("event_id") % 40 == 1, (F.col("event_id") % 301) * 86400).otherwise(0)
    spans = spans.withColumn("end_s", F.col("end_s") + longer)
    pairs = overlaps.nested_overlap_join(
        spans.where(weather.type_in("type", ["fog"])).drop("type"),
        spans.where(weather.type_in("type", ["snow"])).drop("type"),
        ["airport_code"],
        tile_rows=overlaps.TILE_ROWS,
    )
    end, start = F.least("left_end_s", "right_end_s"), F.greatest("left_start_s", "right_start_s")
    return pairs.select(
        "airport_code", "left_event_id", "right_event_id", (end - start).alias("seconds")
    )


def episodes_session_window(spark, sf_dir):
    """Episodes with a pause of at most a minute, by Spark's session windows."""
    return intervals.session_windows(dense(spark, sf_dir), AIRPORT_TYPE, 60)


def rejected_events(spark, sf_dir):
    """Rows that cannot become events, with the reason."""
    return cleaning.rejected_events(flawed_raw_events(spark, sf_dir)).select("reason", "event_id")


def timeline_segments(spark, sf_dir):
    markers = intervals.net_markers(_spans(spark, sf_dir, *AIRPORT_TYPE), AIRPORT_TYPE)
    found = timeline.segments(markers, ["airport_code"])
    return found.select(
        "airport_code",
        cal.wall_timestamp("ts_s").alias("ts"),
        cal.wall_timestamp("next_s").alias("next_ts"),
    )


def running_active_count(spark, sf_dir):
    counts = timeline.running_counts(_spans(spark, sf_dir, *AIRPORT_TYPE), AIRPORT_TYPE)
    return counts.where("real").select(
        *AIRPORT_TYPE, cal.wall_timestamp("ts_s").alias("ts"), F.col("active").alias("total")
    )


def state_forward_fill(spark, sf_dir):
    """Active events of every type on every segment of the airport (as-of lookup)."""
    found = timeline.state_on_segments(_spans(spark, sf_dir, *AIRPORT_TYPE), ["airport_code"], "type")
    return found.select(
        *AIRPORT_TYPE,
        cal.wall_timestamp("ts_s").alias("ts"),
        cal.wall_timestamp("next_s").alias("next_ts"),
        "active",
    )


def active_type_sets(spark, sf_dir):
    found = timeline.sets_on_segments(_spans(spark, sf_dir, *AIRPORT_TYPE), ["airport_code"], "type")
    return found.select(
        "airport_code",
        cal.wall_timestamp("ts_s").alias("ts"),
        F.array_join("kinds", "+").alias("types"),
        F.size("kinds").alias("n_types"),
    )


def active_type_pairs(spark, sf_dir):
    """Seconds per airport and unordered pair of types active together."""
    found = timeline.sets_on_segments(_spans(spark, sf_dir, *AIRPORT_TYPE), ["airport_code"], "type")
    pairs = found.select(
        "airport_code",
        (F.col("next_s") - F.col("ts_s")).alias("seconds"),
        F.inline(timeline.unordered_pairs(F.col("kinds"))),
    )
    label = weather.pair_label(F.col("type_j"), F.col("type_i"))
    return pairs.groupBy("airport_code", label.alias("type_pair")).agg(
        F.sum("seconds").alias("seconds")
    )


# projections, filters, aggregates


def projection_and_rename(spark, sf_dir):
    return (
        dense(spark, sf_dir)
        .drop("user_id", "severity")
        .withColumnRenamed("local_start_ts", "started_at")
        .select("event_id", "type", "started_at")
    )


def risk_filter_any(spark, sf_dir):
    """Risky by type or by severity; lists in any letter case."""
    risky = weather.type_in("type", ["Fog", "snow"]) | weather.severity_in("severity", ["HEAVY"])
    return dense(spark, sf_dir).where(risky).select("event_id", "type", "severity")


def lookup_weights(spark, sf_dir):
    return sparse(spark, sf_dir).select(
        "event_id",
        weather.severity_weight("severity").alias("severity_weight"),
        weather.winter_type_weight("type").alias("type_weight"),
    )


def null_fill(spark, sf_dir):
    """A column with unknown values and its filled form."""
    known = F.when(F.expr("event_id % 3 = 0"), F.col("temp_c"))
    return (
        readings(spark, sf_dir)
        .select("event_id", known.alias("temp_c"), known.alias("filled"))
        .fillna({"filled": 0.0})
    )


def union_markers(spark, sf_dir):
    events = dense(spark, sf_dir)
    starts = events.select("airport_code", F.col("local_start_ts").alias("ts"))
    ends = events.select(F.col("local_end_ts").alias("ts"), "airport_code")
    both = starts.withColumn("delta", F.lit(1)).unionByName(ends.withColumn("delta", F.lit(-1)))
    return both.groupBy("airport_code", "delta").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )


def distinct_rows(spark, sf_dir):
    return dense(spark, sf_dir).select("airport_code", "type", "severity").distinct()


def conditional_aggregates(spark, sf_dir):
    """Conditional count, sum and mean, their ratio, and a NULL-safe division."""
    night = F.col("is_night")
    return sparse(spark, sf_dir).groupBy("state", "type").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(night).alias("n_night"),
        F.sum(F.when(night, F.col("duration_min"))).alias("night_min"),
        F.round(F.avg(F.when(night, F.col("duration_min"))), 2).alias("avg_night_min"),
        F.round(F.try_divide(F.count_if(night), F.count(F.lit(1))), 2).alias("night_ratio"),
        F.try_divide(F.sum("duration_min"), F.count_if(F.col("severity") == "None")).alias(
            "no_such_severity"
        ),
    )


def stddev_by_group(spark, sf_dir):
    return readings(spark, sf_dir).groupBy("airport_code", "is_day").agg(
        F.round(F.stddev_samp("temp_c"), 6).alias("sd_temp"),
        F.round(F.stddev_samp("pressure_mb"), 6).alias("sd_pressure"),
    )


# windows


def dedup_keep_first(spark, sf_dir):
    """The first event per (state, county, type): earliest start, then smallest id."""
    rows = sparse(spark, sf_dir).select("state", "county", "type", "local_start_ts", "event_id")
    return keep_first(rows, ["state", "county", "type"], ["local_start_ts"])


def top_one_per_group(spark, sf_dir):
    rows = dense(spark, sf_dir).select(
        "airport_code",
        "type",
        "event_id",
        (cal.wall_seconds("local_end_ts") - cal.wall_seconds("local_start_ts")).alias("duration_s"),
    )
    return top_per_group(
        rows, AIRPORT_TYPE, [F.col("duration_s").desc(), F.col("event_id").asc()]
    )


def _monthly_counts(spark, sf_dir):
    return (
        seasons.local_month(sparse(spark, sf_dir))
        .groupBy("state", "county", "year", "month")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def dense_rank_in_group(spark, sf_dir):
    w = Window.partitionBy("state", "year", "month").orderBy(F.desc("n"))
    return _monthly_counts(spark, sf_dir).withColumn("rank_in_state", F.dense_rank().over(w))


def moving_average_3(spark, sf_dir):
    average = seasons.moving_average("n", ["state", "county"], ["year", "month"])
    return _monthly_counts(spark, sf_dir).withColumn("average", F.round(average, 6))


def lag_and_lead(spark, sf_dir):
    w = Window.partitionBy("state", "county").orderBy("year", "month")
    return _monthly_counts(spark, sf_dir).withColumns(
        {"before": F.lag("n").over(w), "next": F.lead("n").over(w), "second": F.lead("n", 2).over(w)}
    )


def consecutive_month_change(spark, sf_dir):
    """Change against the previous row, and whether that is the month before."""
    w = Window.partitionBy("state", "type").orderBy("year", "month")
    monthly = (
        seasons.local_month(sparse(spark, sf_dir))
        .groupBy("state", "type", "year", "month")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    step = cal.month_index(F.col("year"), F.col("month"))
    return monthly.select(
        "state",
        "type",
        "year",
        "month",
        "n",
        (step - F.lag(step).over(w) == 1).alias("is_next_month"),
        seasons.change_pct(F.col("n"), F.lag("n").over(w)).alias("change_pct"),
    )


def calendar_range_sum(spark, sf_dir):
    """Trailing 3- and 7-day sums over calendar days, however many rows they hold."""
    return exposure_hours_daily(dense(spark, sf_dir), ["SNOW"], [], trailing_days=(3, 7))


def seconds_range_sum(spark, sf_dir):
    """Events started in the 3 hours up to each start second, both ends included."""
    starts = (
        _spans(spark, sf_dir, "airport_code")
        .withColumn("day", cal.day_number("start_s"))
        .groupBy("airport_code", "day", "start_s")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    w = Window.partitionBy("airport_code", "day").orderBy("start_s")
    return starts.select(
        "airport_code",
        cal.wall_timestamp("start_s").alias("ts"),
        F.sum("n").over(w.rangeBetween(-3 * cal.HOUR_SECONDS, 0)).alias("started_3h"),
    )


def two_key_left_join(spark, sf_dir):
    """Every airport day with its event count and, where known, its storm count."""
    day = F.to_date("local_start_ts").alias("event_date")
    days = dense(spark, sf_dir).groupBy("airport_code", day).agg(F.count(F.lit(1)).alias("n"))
    storms = (
        dense(spark, sf_dir)
        .where(F.col("type").isin("STORM") & F.col("severity").isin("Heavy"))
        .groupBy("airport_code", day)
        .agg(F.count(F.lit(1)).alias("n_storms"))
    )
    return days.join(storms, ["airport_code", "event_date"], "left").select(
        "airport_code", "event_date", "n", F.coalesce("n_storms", F.lit(0)).alias("n_storms")
    )


def first_rows(spark, sf_dir):
    """The twenty longest events."""
    rows = dense(spark, sf_dir).select(
        "event_id",
        "type",
        (cal.wall_seconds("local_end_ts") - cal.wall_seconds("local_start_ts")).alias("duration_s"),
    )
    return rows.orderBy(F.desc("duration_s"), "event_id").limit(20)


# scalars


def calendar_parts(spark, sf_dir):
    ts = F.col("local_start_ts")
    return sparse(spark, sf_dir).select(
        "event_id",
        F.year(ts).alias("y"),
        F.month(ts).alias("m"),
        F.dayofmonth(ts).alias("d"),
        F.hour(ts).alias("h"),
        cal.iso_weekday(ts).alias("dow"),
        F.dayofyear(ts).alias("doy"),
        F.date_add(F.to_date(ts), 1).alias("next_date"),
        (ts + F.expr("INTERVAL 3 HOURS")).alias("plus_3h"),
        cal.season_year(ts).alias("season_year"),
        cal.meteorological_season(F.month(ts)).alias("season"),
        cal.night_hours(F.hour(ts)).alias("is_night"),
    )


def zone_conversion(spark, sf_dir):
    """UTC to local wall-clock time; unknown, blank and missing zones mean UTC."""
    zone = F.expr(
        "case event_id % 6 when 0 then 'America/New_York' when 1 then 'US/Pacific' "
        "when 2 then 'Nowhere/Land' when 3 then '' when 4 then null else 'Asia/Kolkata' end"
    )
    return sparse(spark, sf_dir).select(
        "event_id", cal.to_local(F.col("local_start_ts"), zone).alias("local_ts")
    )


def cyclic_day_shift(spark, sf_dir):
    """Shift of each event's day of the year against that of its own end."""
    start, end = F.dayofyear("local_start_ts"), F.dayofyear("local_end_ts")
    return sparse(spark, sf_dir).select(
        "event_id", cal.cyclic_day_shift(end, start).alias("shift_days")
    )


def text_cleanup(spark, sf_dir):
    raw = raw_events(spark, sf_dir)
    return raw.select(
        F.upper(F.trim("Type")).alias("type"), F.initcap(F.trim("Severity")).alias("severity")
    ).distinct()


def reading_features(spark, sf_dir):
    return readings(spark, sf_dir).select(
        "event_id",
        weather.dewpoint_spread().alias("spread"),
        weather.gust_factor().alias("gust_factor"),
        weather.rainy_flag().alias("rainy"),
        weather.heat_stress().alias("heat_stress"),
        weather.daytime_flag().alias("daytime"),
    )


_ALL = (
    parquet_scan_pruned,
    header_normalisation,
    raw_csv_scan,
    partitioned_parquet_sink,
    external_table,
    contract_conform,
    bucketed_table,
    colocated_join,
    contract_violations,
    valid_intervals,
    split_by_day,
    day_islands,
    merge_islands,
    net_delta_markers,
    interval_overlap_join,
    overlapping_pairs,
    overlapping_pairs_any_severity,
    overlapping_pairs_nested,
    episodes_session_window,
    rejected_events,
    timeline_segments,
    running_active_count,
    state_forward_fill,
    active_type_sets,
    active_type_pairs,
    projection_and_rename,
    risk_filter_any,
    lookup_weights,
    null_fill,
    union_markers,
    distinct_rows,
    conditional_aggregates,
    stddev_by_group,
    dedup_keep_first,
    top_one_per_group,
    dense_rank_in_group,
    moving_average_3,
    lag_and_lead,
    consecutive_month_change,
    calendar_range_sum,
    seconds_range_sum,
    two_key_left_join,
    first_rows,
    calendar_parts,
    zone_conversion,
    cyclic_day_shift,
    text_cleanup,
    reading_features,
)
QUERIES = {f.__name__: f for f in _ALL}
