"""Hand-made rows at the borders of each rule."""

import pytest

from stormgauge.operators import timeline
from stormgauge.operators.cooccurrence import cooccurrence_minutes_daily, cooccurrence_sweep
from stormgauge.operators.exposure import exposure_hours_daily
from stormgauge.operators.intervals import as_seconds, episodes
from stormgauge.operators.peaks import peak_exposure_daily, peak_exposure_segments
from stormgauge.operators.seasons import (
    monthly_trend_by_type,
    night_storm_risk,
    winter_phenology,
    winter_workload_index,
)
from stormgauge.operators.sequences import risky_sequences, sequence_within
from stormgauge.operators.sessions import longest_episodes, winter_burstiness
from tests.helpers import events, rows


def span(s, e, **more):
    return {"s": f"2024-01-{s}", "e": f"2024-01-{e}", **more}


def test_exposure_is_split_at_midnight(spark):
    found = exposure_hours_daily(events(spark, span("10 23:00", "11 01:30")))
    assert rows(found, "event_date", "exposure_hours_day") == [
        ("2024-01-10", 1.0),
        ("2024-01-11", 1.5),
    ]


def test_exposure_ending_at_midnight_leaves_an_empty_day(spark):
    found = exposure_hours_daily(events(spark, span("10 22:00", "11 00:00")))
    assert rows(found, "event_date", "exposure_hours_day") == [
        ("2024-01-10", 2.0),
        ("2024-01-11", 0.0),
    ]


def test_exposure_of_overlapping_events_adds_up(spark):
    twice = [span("10 00:00", "10 20:00")] * 2
    assert rows(exposure_hours_daily(events(spark, *twice)), "exposure_hours_day") == [(40.0,)]


def test_exposure_of_days_in_between(spark):
    found = exposure_hours_daily(
        events(
            spark,
            span("10 22:00", "14 03:00"),
            span("12 06:00", "12 07:00"),
            span("13 12:00", "16 00:00"),
            span("20 00:00", "20 01:00"),
        )
    )
    assert rows(found, "event_date", "exposure_hours_day") == [
        ("2024-01-10", 2.0),
        ("2024-01-11", 24.0),
        ("2024-01-12", 25.0),
        ("2024-01-13", 36.0),
        ("2024-01-14", 27.0),
        ("2024-01-15", 24.0),
        ("2024-01-16", 0.0),
        ("2024-01-20", 1.0),
    ]


def test_exposure_trailing_30_days(spark):
    found = exposure_hours_daily(
        events(
            spark,
            span("01 00:00", "01 01:00"),
            span("30 00:00", "30 02:00"),
            span("31 00:00", "31 04:00"),
        )
    )
    assert rows(found, "event_date", "exposure_hours_30d", "exposure_hours_90d") == [
        ("2024-01-01", 1.0, 1.0),
        ("2024-01-30", 3.0, 3.0),
        ("2024-01-31", 6.0, 7.0),
    ]


def test_exposure_takes_either_risk(spark):
    found = exposure_hours_daily(
        events(
            spark,
            span("10 00:00", "10 01:00", type="FOG", severity="Light"),
            span("10 02:00", "10 03:00", type="RAIN", severity="Moderate"),
            span("10 04:00", "10 05:00", type="RAIN", severity="Light"),
            span("10 09:00", "10 08:00"),
            {"s": "2024-01-10 09:00", "e": None},
        )
    )
    assert rows(found, "exposure_hours_day") == [(2.0,)]


@pytest.mark.parametrize(("second", "count"), [("10 11:00", 1), ("10 11:00:01", 2)])
@pytest.mark.parametrize("rule", ["max_end", "previous"])
def test_episode_gap_of_60_minutes(spark, second, count, rule):
    found = episodes(
        events(spark, span("10 09:00", "10 10:00"), span(second, "10 12:00")),
        ["airport_code"],
        3600,
        rule,
    )
    assert found.count() == count


def test_nested_event_does_not_split_an_episode(spark):
    nested = events(
        spark,
        span("10 08:00", "10 20:00"),
        span("10 09:00", "10 09:10"),
        span("10 12:00", "10 12:30"),
    )
    assert rows(episodes(nested, ["type"], 3600), "events") == [(3,)]
    assert rows(episodes(nested, ["type"], 3600, "previous"), "events") == [(1,), (2,)]


def test_episode_runs_over_several_midnights(spark):
    chain = events(
        spark,
        span("10 23:30", "11 00:00"),
        span("11 00:00", "11 23:59:59"),
        span("12 00:30", "14 06:00"),
        span("14 08:00", "14 09:00"),
    )
    found = longest_episodes(chain)
    assert rows(found, "session_start", "session_end", "events_in_session") == [
        ("2024-01-10 23:30:00", "2024-01-14 06:00:00", 3)
    ]


def test_longest_episode_prefers_the_earlier_of_equals(spark):
    found = longest_episodes(
        events(spark, span("12 01:00", "12 02:00"), span("10 01:00", "10 02:00"))
    )
    assert rows(found, "session_start", "session_duration_hours") == [("2024-01-10 01:00:00", 1.0)]


def test_cooccurrence_splits_at_midnight_and_sweep_does_not(spark):
    both = events(
        spark,
        span("10 22:00", "11 02:00", type="FOG"),
        span("10 23:00", "11 01:00", type="RAIN"),
    )
    columns = ("event_date", "type_i", "type_j", "overlap_minutes")
    assert rows(cooccurrence_minutes_daily(both), *columns) == [
        ("2024-01-10", "FOG", "RAIN", 60.0),
        ("2024-01-11", "FOG", "RAIN", 60.0),
    ]
    assert rows(cooccurrence_sweep(both), *columns) == [("2024-01-10", "FOG", "RAIN", 120.0)]


def test_sweep_cuts_at_markers_of_other_types(spark):
    three = events(
        spark,
        span("10 22:00", "12 02:00", type="FOG"),
        span("10 23:00", "12 01:00", type="RAIN"),
        span("11 06:00", "11 07:00", type="SNOW"),
    )
    found = [
        r
        for r in rows(
            cooccurrence_sweep(three), "event_date", "type_i", "type_j", "overlap_minutes"
        )
        if r[1:3] == ("FOG", "RAIN")
    ]
    # 23:00 -> 06:00 counts to the 10th, 06:00 -> 01:00 to the 11th
    assert found == [
        ("2024-01-10", "FOG", "RAIN", 7 * 60.0),
        ("2024-01-11", "FOG", "RAIN", 19 * 60.0),
    ]


def test_peak_window_starts_with_a_long_event(spark):
    found = peak_exposure_daily(events(spark, span("10 10:00", "10 16:00")))
    assert rows(found, "p3h_minutes", "window_start", "window_end") == [
        (180.0, "2024-01-10 10:00:00", "2024-01-10 13:00:00")
    ]


def test_peak_window_stays_within_the_day(spark):
    found = peak_exposure_daily(events(spark, span("10 22:30", "11 00:30")))
    assert rows(found, "event_date", "p3h_minutes", "window_start") == [
        ("2024-01-10", 90.0, "2024-01-10 21:00:00"),
        ("2024-01-11", 30.0, "2024-01-11 00:00:00"),
    ]


def test_peak_segments_count_tied_events_once(spark):
    twice = [span("10 10:00", "10 11:00")] * 2
    found = peak_exposure_segments(events(spark, *twice, span("10 15:00", "10 16:00")))
    assert rows(found, "p3h_minutes", "window_start") == [(60.0, "2024-01-10 10:00:00")]


@pytest.mark.parametrize(("end", "count"), [("12 00:00", 1), ("12 00:00:01", 0)])
def test_sequence_limit_of_48_hours(spark, end, count):
    found = events(
        spark,
        span("10 00:00", "10 01:00", type="RAIN"),
        span("10 05:00", "10 06:00", type="COLD"),
        span("11 23:00", end, type="SNOW"),
    )
    assert risky_sequences(found).count() == count
    assert sequence_within(found).count() == count


def test_intervening_event_breaks_only_the_strict_sequence(spark):
    found = events(
        spark,
        span("10 00:00", "10 01:00", type="RAIN"),
        span("10 02:00", "10 03:00", type="FOG"),
        span("10 05:00", "10 06:00", type="COLD"),
        span("10 19:00", "10 20:00", type="SNOW"),
    )
    assert risky_sequences(found).count() == 0
    assert rows(sequence_within(found), "duration_h", "sequence") == [(20.0, "RAIN→FREEZE→SNOW")]


def test_sequence_of_equal_types_keeps_every_copy(spark):
    copies = [span("10 00:00", "10 01:00")] * 3
    assert risky_sequences(events(spark, *copies), ["SNOW", "SNOW"], label="x").count() == 2


def test_copies_between_the_ends_break_a_sequence(spark):
    found = events(
        spark,
        span("10 00:00", "10 01:00", type="RAIN"),
        span("10 05:00", "10 06:00", type="COLD"),
        span("10 05:00", "10 07:00", type="COLD"),
        span("10 19:00", "10 20:00", type="SNOW"),
    )
    assert risky_sequences(found).count() == 0


def test_december_counts_to_the_next_season(spark):
    winter = events(
        spark,
        {"s": "2020-12-31 10:00", "e": "2020-12-31 12:00"},
        {"s": "2021-01-02 10:00", "e": "2021-01-02 23:00"},
    )
    assert rows(winter_burstiness(winter)) == [("S", "C", 2021, 2, 1, 46.0, 7.5, 13.0)]
    assert rows(winter_phenology(winter), "season_year", "season_length_days") == [(2021, 2.54)]


def test_single_episode_has_no_gap(spark):
    found = winter_burstiness(events(spark, span("10 10:00", "10 12:00")))
    assert rows(found, "total_episodes", "avg_interepisode_gap_h") == [(1, None)]


def test_workload_change_from_zero_is_unknown(spark):
    found = winter_workload_index(
        events(
            spark,
            {"s": "2024-03-01 00:00", "e": "2024-03-01 05:00", "type": "RAIN"},
            {"s": "2024-04-01 00:00", "e": "2024-04-01 05:00", "type": "COLD", "severity": "Odd"},
        )
    )
    assert rows(found, "month", "workload_index", "mom_change_pct", "rolling_3m_avg") == [
        (3, 0.0, None, 0.0),
        (4, 5.0, None, 2.5),
    ]


def test_trend_needs_adjacent_months(spark):
    def month(m, minutes):
        return {"s": f"2024-0{m}-01 00:00", "e": f"2024-0{m}-01 00:{minutes}"}

    found = monthly_trend_by_type(
        events(spark, month(1, "04"), month(2, "10"), month(3, "15"), month(5, "20"))
    )
    # February: January's mean is below the minimum; May: April is missing
    assert rows(found, "month", "mom_change_pct") == [
        (1, None),
        (2, None),
        (3, 50.0),
        (5, None),
    ]


def test_night_storms_by_utc_flag_or_local_hour(spark):
    storms = events(
        spark,
        span("10 02:00", "10 04:00", type="STORM", severity="Light", is_night=False),
        span("10 12:00", "10 13:00", type="STORM", is_night=True),
    )
    columns = ("count_events", "count_night_events", "avg_duration_h", "avg_severity_score")
    assert rows(night_storm_risk(storms), *columns) == [(2, 1, 1.0, 3.0)]
    assert rows(night_storm_risk(storms, clock="local"), *columns) == [(2, 1, 2.0, 1.0)]


def test_phenology_shift_wraps_round_the_year(spark):
    winter = events(
        spark,
        {"s": "2018-12-26 00:00", "e": "2018-12-27 00:00"},  # day 360
        {"s": "2020-01-05 00:00", "e": "2020-01-06 00:00"},  # day 5
    )
    assert rows(winter_phenology(winter), "season_year", "start_shift_days") == [
        (2019, None),
        (2020, 10.0),
    ]


def test_invalid_intervals_are_left_out(spark):
    odd = events(
        spark,
        span("10 10:00", "10 09:00"),
        span("10 10:00", "10 10:00"),
        {"s": None, "e": "2024-01-10 10:00"},
    )
    assert as_seconds(odd, []).count() == 0
    assert as_seconds(odd, [], allow_empty=True).count() == 1


def test_states_take_one_row_per_marker_whatever_the_number_of_kinds(spark):
    """crossing markers with kinds multiplied what one task sorted and hashed."""
    day = 86400
    spans = [("K1", k, s, e) for k, s, e in (
        ("A", 0, 50), ("B", 10, 20), (None, 30, 40), ("A", 10, 60), ("C", 3 * day, 3 * day + 5), ("A", day - 5, 2 * day + 7)
    )] + [(None, "B", 5, 9), (None, "A", 7, 8), ("K2", None, 1, 2)] * 2
    frame = spark.createDataFrame(spans, "airport_code string, type string, start_s bigint, end_s bigint")
    expected = []
    for place in {s[0] for s in spans}:
        own = [s for s in spans if s[0] == place]
        marks = sorted({t for s in own for t in s[2:]})
        for t, following in zip(marks, marks[1:]):
            for kind in {s[1] for s in own} - {None}:
                active = sum(s[1] == kind and s[2] <= t < s[3] for s in own)
                if active:
                    expected.append((place, kind, t, following, active))
    found = timeline.state_on_segments(frame, ["airport_code"], "type")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    sets = timeline.sets_on_segments(frame, ["airport_code"], "type")
    grouped = timeline.active_sets(found, ["airport_code"], "type")
    assert sorted(map(tuple, sets.collect()), key=str) == sorted(map(tuple, grouped.collect()), key=str)
    assert "collect_set" not in found._jdf.queryExecution().optimizedPlan().toString()
