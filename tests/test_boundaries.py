"""Inputs at the edge of the jobs: periods, unknown ends, bad lines, places and messages."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from stormgauge.contracts import TABLES, violations
from stormgauge.functions.calendar import to_local
from stormgauge.functions.weather import require_vocabulary, severity_weight, winter_type_weight
from stormgauge.operators.cleaning import clean_events, rejected_events
from stormgauge.operators.cooccurrence import cooccurrence_minutes_daily, cooccurrence_sweep
from stormgauge.operators.intervals import collapse, cut_at_midnight, overlap_join
from stormgauge.operators.sequences import risky_sequences, sequence_within
from stormgauge.plans import compact, live
from stormgauge.plans.publish import JOBS, publish
from stormgauge.session import shared_folder
from stormgauge.sinks.changelog import changelog_sink, read_latest
from stormgauge.sources.files import read_raw
from stormgauge.sources.readings import flatten_payload, kafka_options
from tests.helpers import events, rows
from tests.test_jobs import HEADER, raw_line


def long_events(spark):
    return events(
        spark,
        {"s": "2016-01-20 00:00", "e": "2016-01-20 05:00"},
        {"s": "2016-01-31 00:00", "e": "2016-02-02 00:00"},
        {"s": "2016-02-10 00:00", "e": "2016-02-10 01:00"},
        {"s": "2016-03-05 00:00", "e": "2016-03-05 02:00"},
    )


def test_a_published_month_equals_the_full_run(spark, tmp_path):
    job, target = JOBS["exposure_hours_daily"], str(tmp_path / "out")
    full = job.run(long_events(spark))
    publish(job, long_events(spark), shared_folder(spark, "s"), target)
    publish(job, long_events(spark), shared_folder(spark, "s"), target, months=("2016-02", "2016-02"))
    found = spark.read.parquet(target)
    assert rows(found.drop("period")) == rows(full)
    assert {r.period for r in found.select("period").collect()} == {201601, 201602, 201603}


def test_a_month_without_rows_loses_its_folder_only(spark, tmp_path):
    job, target = JOBS["exposure_hours_daily"], str(tmp_path / "out")
    publish(job, long_events(spark), shared_folder(spark, "s"), target)
    without = long_events(spark).where("local_start_ts < timestamp_ntz'2016-03-01'")
    publish(job, without, shared_folder(spark, "s"), target, months=("2016-03", "2016-04"))
    found = spark.read.parquet(target)
    assert {r.period for r in found.select("period").collect()} == {201601, 201602}


def test_staged_results_are_deleted(spark, tmp_path):
    staging = str(tmp_path / "staging")
    publish(JOBS["longest_episodes"], long_events(spark), staging, str(tmp_path / "out"))
    assert not (tmp_path / "staging").exists()
    with pytest.raises(ValueError, match="as a whole"):
        publish(JOBS["longest_episodes"], long_events(spark), staging, "x", months=("2016-01",) * 2)


def test_both_targets_are_written(spark, tmp_path):
    written = []
    publish(
        JOBS["longest_episodes"],
        long_events(spark),
        shared_folder(spark, "s"),
        str(tmp_path / "out"),
        lambda result: written.append(result.count()),
    )
    assert written == [spark.read.parquet(str(tmp_path / "out")).count()]


@pytest.mark.parametrize("name", sorted(JOBS))
def test_events_without_an_end_stop_no_job(spark, tmp_path, name):
    lonely = {"s": "2017-01-05 00:00", "e": None, "state": "T", "airport_code": "K9"}
    frame = long_events(spark).unionByName(events(spark, lonely))
    target = str(tmp_path / "out")
    publish(JOBS[name], frame, shared_folder(spark, "s"), target)
    found = spark.read.schema(TABLES[name].ddl).parquet(target)
    if "airport_code" in found.columns:
        assert found.where("airport_code = 'K9'").count() == 0


def test_a_later_start_may_end_first(spark):
    found = sequence_within(
        events(
            spark,
            {"type": "RAIN", "s": "2024-01-01 00:00", "e": "2024-01-01 01:00"},
            {"type": "COLD", "s": "2024-01-01 01:30", "e": "2024-01-01 01:40"},
            {"type": "SNOW", "s": "2024-01-01 02:00", "e": "2024-01-03 12:00"},
            {"type": "SNOW", "s": "2024-01-01 03:00", "e": "2024-01-01 04:00"},
        )
    )
    assert rows(found, "duration_h") == [(4.0,)]


def test_an_unknown_end_means_the_same_alone_and_beside_a_copy(spark):
    rain = {"type": "RAIN", "s": "2024-01-01 00:00", "e": "2024-01-01 00:30"}
    cold = {"type": "COLD", "s": "2024-01-01 01:00", "e": "2024-01-01 01:30"}
    open_snow = {"type": "SNOW", "s": "2024-01-01 02:00", "e": None}
    snow = {**open_snow, "e": "2024-01-01 03:00"}
    assert rows(risky_sequences(events(spark, rain, cold, open_snow))) == []
    both = rows(risky_sequences(events(spark, rain, cold, open_snow, snow)), "duration_h")
    assert both == rows(risky_sequences(events(spark, rain, cold, snow)), "duration_h") == [(3.0,)]


@pytest.mark.parametrize("zone", ["\tUS/Eastern", "US/Eastern\n", " US/Eastern\r\n", "\x1fUS/Eastern"])
def test_white_space_around_a_zone(spark, zone):
    frame = spark.createDataFrame([(zone,)], "z string").selectExpr(
        "z", "timestamp_ntz'2024-01-07 12:00:00' t"
    )
    assert frame.select(to_local("t", F.col("z"))).first()[0] == dt.datetime(2024, 1, 7, 7, 0)


def test_bad_lines_are_rejected_and_counted(spark, tmp_path):
    lines = [HEADER, raw_line(), "W-2,Snow,Light,2016-01-06 23:14:00", raw_line(EventId="W-3") + ",x"]
    lines += [raw_line(EventId=""), raw_line(EventId=" "), raw_line(EventId="W-6", TimeZone="UTC ")]
    (tmp_path / "raw.csv").write_text("\n".join(lines) + "\n")
    raw = read_raw(spark, str(tmp_path / "raw.csv"))
    assert sorted(r.event_id for r in clean_events(raw).select("event_id").collect()) == ["W-1", "W-6"]
    found = [tuple(r) for r in rejected_events(raw).groupBy("reason").count().collect()]
    assert sorted(found) == [("malformed line", 2), ("no event id", 2)]


def test_weights_fold_case_and_may_be_empty(spark):
    frame = spark.createDataFrame([("SNOW", "Heavy")], "type string, severity string")
    got = frame.select(
        winter_type_weight("type", {"snow ": 3}), winter_type_weight("type", {}),
        severity_weight("severity", {"HEAVY": 7}), severity_weight("severity", {}),
    ).first()
    assert tuple(got) == (3, 0, 7, 1)


def test_vocabulary_is_checked(spark):
    frame = events(spark, *({"type": f"T{i}", "s": "2024-01-01", "e": "2024-01-02"} for i in range(4)))
    require_vocabulary(frame, 4)
    with pytest.raises(ValueError, match="event types"):
        require_vocabulary(frame, 3)


def test_payloads_of_unlisted_and_repeated_airports(spark):
    body = json.dumps({"current": {"temp_c": 1.0}})
    payloads = spark.createDataFrame([("K1", body), ("K2", body)], "airport_code string, body string")
    airports = spark.createDataFrame(
        [("K1", "S", "C", "UTC"), ("K1", "S", "D", "UTC")],
        "airport_code string, state string, county string, timezone string",
    )
    found = flatten_payload(payloads, airports).select("airport_code", "county", "temp_c").collect()
    assert sorted(tuple(r) for r in found) == [("K1", "C", 1.0), ("K2", None, 1.0)]


def message(time, county, **fields):
    base = {"airport_code": "K1", "state": "S", "county": county, "start_time_utc": time}
    return json.dumps({**base, **fields})


def test_live_job_keeps_all_rows_and_bad_messages(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [message(f"2024-01-01T10:0{i}:00", "CD"[i % 2], temp_c=float(i)) for i in range(4)]
    (tmp_path / "in" / "0.json").write_text("\n".join([*lines, '{"airport_code": "K1', "{}"]) + "\n")
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    try:
        live.main(
            ["weather_realtime_sliding", "--available-now", "--folder", str(tmp_path / "in")]
            + ["--changelog", str(tmp_path / "log"), "--checkpoint", str(tmp_path / "cp")]
        )
    finally:
        spark.conf.set(provider, before)
    table = TABLES["weather_realtime_sliding"]
    latest = read_latest(spark, str(tmp_path / "log"), table.key)
    assert {(r.county, r.event_count) for r in latest.collect()} == {("C", 4)}
    assert violations(latest, table).first()["duplicate_keys"] == 0
    assert spark.read.parquet(str(tmp_path / "cp-dead-letters")).count() == 2
    compact.main(
        [table.name, "--changelog", str(tmp_path / "log"), "--target", str(tmp_path / "small")]
    )
    assert spark.read.parquet(str(tmp_path / "small")).count() == latest.count()


def test_second_epoch_updates_some_keys_only(spark, tmp_path):
    sink = changelog_sink(str(tmp_path / "log"))
    sink(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), 0)
    sink(spark.createDataFrame([("b", 2)], "k string, v int"), 1)
    latest = read_latest(spark, str(tmp_path / "log"), ["k"])
    assert rows(latest, "k", "v") == [("a", 1), ("b", 2)]


def test_kafka_batches_are_bounded():
    options = kafka_options("a:1", "t", "earliest", 10)
    assert (options["startingOffsets"], options["maxOffsetsPerTrigger"]) == ("earliest", "10")


def test_long_events_are_copied_once_per_day_they_start_on(spark):
    many = spark.range(20_000).selectExpr(
        "'K' as airport_code", "id % 86400 as start_s", "id % 86400 + 300 * 86400 as end_s"
    )
    reduced = collapse(cut_at_midnight(many, ["airport_code"]), ["airport_code"])
    assert reduced.where("end_s > 86400").count() == 1
    assert reduced.count() <= 86400 / 300 + 1


def test_long_events_give_the_same_shared_time(spark):
    frame = events(
        spark,
        {"type": "FOG", "s": "2024-01-01 10:00", "e": "2024-01-04 02:00"},
        {"type": "FOG", "s": "2024-01-01 11:00", "e": "2024-01-03 00:00"},
        {"type": "SNOW", "s": "2024-01-01 22:00", "e": "2024-01-04 01:00"},
    )
    found = cooccurrence_minutes_daily(frame).select("event_date", "overlap_minutes")
    assert rows(found) == [
        ("2024-01-01", 120.0), ("2024-01-02", 1440.0), ("2024-01-03", 1440.0), ("2024-01-04", 60.0),
    ]
    # stretches count to the day of the marker before them: 22:00 and 00:00 of the third
    assert rows(cooccurrence_sweep(frame).select("event_date", "overlap_minutes")) == [
        ("2024-01-01", 1560.0), ("2024-01-03", 1500.0),
    ]


@pytest.mark.parametrize("width", [3600, 86_400])
def test_overlap_join_finds_each_pair_once(spark, width):
    spans = [(i, (i * 7919) % 300_000, (i * 7919) % 300_000 + (i * 104_729) % 200_000) for i in range(60)]
    frame = spark.createDataFrame([("K", *s) for s in spans], "k string, id int, start_s long, end_s long")
    got = overlap_join(frame, frame, ["k"], width).select("left_id", "right_id").collect()
    want = [(a[0], b[0]) for a in spans for b in spans if a[1] < b[2] and b[1] < a[2] and a[2] > a[1] and b[2] > b[1]]
    assert sorted(tuple(r) for r in got) == sorted(want)
