"""Operators against brute force on many small random cases.

Each case is an airport of its own, so one Spark job checks all of them.
"""

import random
from collections import defaultdict

import pytest

from pyspark.sql import functions as F

from stormgauge.functions.calendar import wall_timestamp
from stormgauge.operators.cooccurrence import cooccurrence_minutes_daily, cooccurrence_sweep
from stormgauge.operators.exposure import exposure_hours_daily
from stormgauge.operators.intervals import as_seconds, collapse, episodes
from stormgauge.operators.peaks import peak_exposure_daily
from stormgauge.operators.sequences import risky_sequences, sequence_within

DAY = 86_400
TYPES = ["COLD", "RAIN", "SNOW"]


@pytest.fixture(scope="module")
def cases():
    """Case -> (type, start, end) on coarse grids, so that ties and touching are common."""
    rng = random.Random(7)
    found = {}
    for case in range(120):
        step = rng.choice([600, 3600, 7200, 1])
        horizon = rng.choice([DAY, 3 * DAY, 5 * DAY])
        longest = rng.choice([2, 8, 40]) * max(step, 60)
        events = []
        for _ in range(rng.randint(1, 14)):
            start = rng.randrange(0, horizon, step)
            length = rng.randrange(0, longest + 1, step)
            events.append((rng.choice(TYPES), start, start + length))
        found[f"K{case:03d}"] = events
    return found


@pytest.fixture(scope="module")
def frame(spark, cases):
    flat = [
        (key, "S", key, "Heavy", kind, s, e, i)
        for key, events in cases.items()
        for i, (kind, s, e) in enumerate(events)
    ]
    raw = spark.createDataFrame(
        flat,
        "airport_code string, state string, county string, severity string, type string, "
        "s bigint, e bigint, event_id int",
    )
    return raw.withColumns(
        {"local_start_ts": wall_timestamp("s"), "local_end_ts": wall_timestamp("e")}
    ).drop("s", "e").cache()


def sessions(events, gap, rule):
    out = []
    for _, s, e in sorted(events, key=lambda x: (x[1], x[2])):
        mark = out[-1][3 if rule == "previous" else 1] if out else None
        if mark is None or s - mark > gap:
            out.append([s, e, 1, e])
        else:
            out[-1][1] = max(out[-1][1], e)
            out[-1][2] += 1
            out[-1][3] = e
    return [tuple(x[:3]) for x in out]


@pytest.mark.parametrize("gap", [0, 60, 299, 300, 301, 3600, 7 * 3600])
@pytest.mark.parametrize("rule", ["max_end", "previous"])
def test_episodes(frame, cases, gap, rule):
    found = episodes(frame, ["airport_code"], gap, rule).collect()
    got = sorted((r.airport_code, r.start_s, r.end_s, r.events) for r in found)
    want = sorted((k, *x) for k, events in cases.items() for x in sessions(events, gap, rule))
    assert got == want


def cover(events, kind):
    seconds = set()
    for k, s, e in events:
        if k == kind:
            seconds.update(range(s // 60, e // 60))
    return seconds


def minute_cases(cases):
    return {
        k: ev for k, ev in cases.items() if all(s % 60 == 0 and e % 60 == 0 for _, s, e in ev)
    }


def test_cooccurrence(frame, cases):
    want = defaultdict(float)
    usable = minute_cases(cases)
    for key, events in usable.items():
        for i, a in enumerate(TYPES):
            for b in TYPES[i + 1 :]:
                for minute in cover(events, a) & cover(events, b):
                    want[key, minute // 1440, a, b] += 1
    daily = cooccurrence_minutes_daily(frame).withColumn("day", F.unix_date("event_date"))
    got = {
        (r.airport_code, r.day, r.type_i, r.type_j): r.overlap_minutes
        for r in daily.collect()
        if r.airport_code in usable
    }
    assert got == dict(want)
    assert max(got.values()) <= 1440


def test_both_attributions_have_the_same_total(frame):
    def totals(df):
        grouped = df.groupBy("airport_code", "type_i", "type_j").agg(
            F.round(F.sum("overlap_minutes"), 6).alias("m")
        )
        return sorted(tuple(r) for r in grouped.collect())

    assert totals(cooccurrence_minutes_daily(frame)) == totals(cooccurrence_sweep(frame))


def test_peak_is_the_best_of_all_minute_windows(frame, cases):
    found = {
        (r.airport_code, r.day): r.p3h_minutes
        for r in peak_exposure_daily(frame, types=TYPES)
        .withColumn("day", F.unix_date("event_date"))
        .collect()
    }
    assert max(found.values()) <= 180
    for key, events in minute_cases(cases).items():
        minutes = set().union(*[cover(events, t) for t in TYPES])
        for day in {m // 1440 for m in minutes}:
            within = {m - day * 1440 for m in minutes if m // 1440 == day}
            best = max(
                sum(t <= m < t + 180 for m in within) for t in range(0, 1440 - 180 + 1)
            )
            assert found[key, day] == best


def test_exposure_sums_to_the_clipped_durations(frame, cases):
    got = {
        r.airport_code: r.hours
        for r in exposure_hours_daily(frame, TYPES)
        .groupBy("airport_code")
        .agg(F.sum("exposure_hours_day").alias("hours"))
        .collect()
    }
    for key, events in cases.items():
        want = sum(e - s for _, s, e in events if e > s) / 3600
        assert abs(got.get(key, 0) - want) < 0.2  # daily values are rounded


@pytest.mark.parametrize("pattern", [("RAIN", "COLD"), ("RAIN", "COLD", "SNOW"), ("SNOW", "SNOW")])
def test_strict_sequences(frame, cases, pattern):
    want = []
    for key, events in cases.items():
        ordered = sorted(events, key=lambda x: (x[1], x[0], x[2]))
        for i in range(len(ordered) - len(pattern) + 1):
            run = ordered[i : i + len(pattern)]
            if tuple(x[0] for x in run) == pattern and run[-1][2] - run[0][1] <= 12 * 3600:
                want.append((key, run[0][1], run[-1][2]))
    got = risky_sequences(frame, pattern, hours=12, label="x").select(
        "county", F.unix_timestamp("seq_start_ts"), F.unix_timestamp("seq_end_ts")
    )
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_loose_sequences(frame, cases):
    want = []
    for key, events in cases.items():
        for start in {s for kind, s, _ in events if kind == "RAIN"}:
            ends = [
                e
                for kind, s, e in events
                if kind == "SNOW" and any(k == "COLD" and start < c < s for k, c, _ in events)
            ]
            if ends and min(ends) - start <= 24 * 3600:
                want.append((key, start, min(ends)))
    got = sequence_within(frame, hours=24).select(
        "county", F.unix_timestamp("seq_start_ts"), F.unix_timestamp("seq_end_ts")
    )
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


@pytest.mark.parametrize("width", [60, 300, 3600])
def test_collapse_keeps_the_union(frame, cases, width):
    reduced = collapse(as_seconds(frame, ["airport_code"]), ["airport_code"], width).collect()
    got = defaultdict(list)
    for r in reduced:
        got[r.airport_code].append(("any", r.start_s, r.end_s))
    for key, events in cases.items():
        valid = [("any", s, e) for _, s, e in events if e > s]
        want = [x[:2] for x in sessions(valid, 0, "max_end")]
        assert [x[:2] for x in sessions(got[key], 0, "max_end")] == want


def test_busy_airport_is_reduced_before_ordering(spark):
    busy = spark.range(200_000).selectExpr(
        "'K' as airport_code", "id % 7200 as start_s", "id % 7200 + 600 + id % 5000 as end_s"
    )
    # two hours of 5-minute slots, all events outlast theirs
    assert collapse(busy, ["airport_code"], 300).count() == 24
