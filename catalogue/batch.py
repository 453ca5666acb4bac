"""Batch analytics over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.fixtures import dense, flawed_raw_events, sparse
from stormgauge.operators import cleaning, cooccurrence, exposure, intervals, peaks
from stormgauge.operators import seasons, sequences, sessions

# the test events know no THUNDERSTORM
RISK = ("FOG", "SNOW", "STORM")


def clean_events(spark, sf_dir):
    return cleaning.clean_events(flawed_raw_events(spark, sf_dir))


def exposure_hours_daily(spark, sf_dir):
    return exposure.exposure_hours_daily(dense(spark, sf_dir), RISK)


def exposure_hours_severity_only(spark, sf_dir):
    return exposure.exposure_hours_daily(dense(spark, sf_dir), risk_types=())


def longest_episodes(spark, sf_dir):
    return sessions.longest_episodes(dense(spark, sf_dir), RISK)


def longest_episodes_previous_gap(spark, sf_dir):
    return sessions.longest_episodes(dense(spark, sf_dir), RISK, gap_rule="previous")


def episodes(spark, sf_dir):
    found = intervals.episodes(dense(spark, sf_dir), ["airport_code", "type"], 60 * 60)
    return intervals.with_wall_times(
        found.withColumn("duration_s", F.col("end_s") - F.col("start_s")),
        "session_start",
        "session_end",
    )


def episodes_previous_gap(spark, sf_dir):
    found = intervals.episodes(dense(spark, sf_dir), ["airport_code", "type"], 10 * 60, "previous")
    return intervals.with_wall_times(found, "session_start", "session_end")


def cooccurrence_minutes_daily(spark, sf_dir):
    return cooccurrence.cooccurrence_minutes_daily(dense(spark, sf_dir))


def cooccurrence_sweep(spark, sf_dir):
    return cooccurrence.cooccurrence_sweep(dense(spark, sf_dir))


def peak_3h_daily(spark, sf_dir):
    return peaks.peak_exposure_daily(dense(spark, sf_dir), types=RISK)


def peak_3h_segments(spark, sf_dir):
    return peaks.peak_exposure_segments(dense(spark, sf_dir), types=RISK)


def monthly_trend_by_type(spark, sf_dir):
    return seasons.monthly_trend_by_type(sparse(spark, sf_dir))


def winter_workload_index(spark, sf_dir):
    return seasons.winter_workload_index(sparse(spark, sf_dir))


def risky_sequences(spark, sf_dir):
    return sequences.risky_sequences(sparse(spark, sf_dir))


def sequence_within(spark, sf_dir):
    return sequences.sequence_within(sparse(spark, sf_dir))


def winter_burstiness(spark, sf_dir):
    return sessions.winter_burstiness(sparse(spark, sf_dir))


def winter_burstiness_previous_gap(spark, sf_dir):
    return sessions.winter_burstiness(sparse(spark, sf_dir), gap_rule="previous")


def night_storm_risk(spark, sf_dir):
    return seasons.night_storm_risk(sparse(spark, sf_dir))


def winter_phenology(spark, sf_dir):
    return seasons.winter_phenology(sparse(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        clean_events,
        exposure_hours_daily,
        exposure_hours_severity_only,
        longest_episodes,
        longest_episodes_previous_gap,
        episodes,
        episodes_previous_gap,
        cooccurrence_minutes_daily,
        cooccurrence_sweep,
        peak_3h_daily,
        peak_3h_segments,
        monthly_trend_by_type,
        winter_workload_index,
        risky_sequences,
        sequence_within,
        winter_burstiness,
        winter_burstiness_previous_gap,
        night_storm_risk,
        winter_phenology,
    )
}
