"""Streams against batch, late rows, replay, routing."""

import json
import os

import pytest

from pyspark.sql import functions as F

from stormgauge.contracts import TABLES, conform, violations
from catalogue.fixtures import readings as fixture_readings
from stormgauge.plans import live
from stormgauge.plans.live import LIVE_JOBS
from stormgauge.sinks.changelog import changelog_sink, compact, dead_letter_sink, read_latest
from stormgauge.sources.readings import (
    file_messages,
    flatten_payload,
    kafka_options,
    parse_readings,
    route_readings,
)
from stormgauge.streaming import kpis
from stormgauge.streaming.runner import start

SMALL = "/root/testdata/sf0.001"
KEY = ["airport_code", "event_window_start"]


def message(time, airport="K1", **fields):
    base = {"airport_code": airport, "state": "S1", "county": "C1", "start_time_utc": time}
    return json.dumps({**base, **fields})


def write_file(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def settled(df):
    doubles = [c for c, t in df.dtypes if t == "double"]
    return sorted(
        tuple(r) for r in df.withColumns({c: F.round(c, 6) for c in doubles}).collect()
    )


@pytest.mark.parametrize("name", sorted(LIVE_JOBS))
def test_stream_ends_where_batch_does(spark, tmp_path, name):
    job = LIVE_JOBS[name]
    source = fixture_readings(spark, SMALL).drop("event_id")
    source.select(F.to_json(F.struct("*")).alias("value")).write.text(str(tmp_path / "in"))
    sink = changelog_sink(str(tmp_path / "log"))
    job.start(
        file_messages(spark, str(tmp_path / "in")),
        None,
        [sink],
        str(tmp_path / "checkpoint"),
        available_now=True,
    ).awaitTermination()
    stream = read_latest(spark, str(tmp_path / "log"), job.table.key).drop("created_at")
    batch = conform(job.build(source), job.table).drop("created_at")
    assert settled(stream.select(*batch.columns)) == settled(batch)
    found = violations(batch, job.table).first()
    assert found["duplicate_keys"] == 0 and found["missing_values"] == 0


def test_late_rows_are_dropped(spark, tmp_path):
    folder = tmp_path / "in"
    for i, time in enumerate(["10:00", "14:00", "14:05", "10:01", "14:10"]):
        write_file(folder, f"{i}.json", message(f"2024-01-01T{time}:00", temp_c=1.0))
        os.utime(folder / f"{i}.json", (1_700_000_000 + i,) * 2)  # files are read oldest first
    start(
        kpis.sliding_kpis(parse_readings(file_messages(spark, str(folder), 1))),
        [changelog_sink(str(tmp_path / "log"))],
        str(tmp_path / "checkpoint"),
        available_now=True,
    ).awaitTermination()
    latest = read_latest(spark, str(tmp_path / "log"), KEY)
    counts = {str(r.event_window_start)[11:16]: r.event_count for r in latest.collect()}
    # 10:01 arrives when the watermark is past 13:45
    assert counts["10:00"] == 1 and counts["09:30"] == 1
    assert counts["14:00"] == 3


def test_updated_window_is_replaced_and_replay_changes_nothing(spark, tmp_path):
    sink = changelog_sink(str(tmp_path / "log"))
    source = fixture_readings(spark, SMALL)
    first = kpis.sliding_kpis(source.where("event_id < 500"))
    for epoch, batch in [(0, first), (0, first), (1, kpis.sliding_kpis(source))]:
        sink(batch, epoch)
    sink(kpis.sliding_kpis(source.where("false")), 2)  # empty batches leave no trace
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.where("epoch_id = 0").count() == first.count()
    assert log.where("epoch_id = 2").count() == 0
    latest = read_latest(spark, str(tmp_path / "log"), KEY)
    assert settled(latest) == settled(kpis.sliding_kpis(source))
    compact(spark, str(tmp_path / "log"), str(tmp_path / "small"), KEY)
    assert spark.read.parquet(str(tmp_path / "small")).count() == latest.count()
    assert settled(read_latest(spark, str(tmp_path / "small"), KEY)) == settled(latest)


def test_one_query_feeds_two_sinks(spark, tmp_path):
    folder = tmp_path / "in"
    write_file(folder, "0.json", message("2024-01-01T10:00:00", temp_c=1.0))
    logs = [str(tmp_path / "a"), str(tmp_path / "b")]
    start(
        kpis.tumbling_means(parse_readings(file_messages(spark, str(folder)))),
        [changelog_sink(log) for log in logs],
        str(tmp_path / "checkpoint"),
        available_now=True,
    ).awaitTermination()
    assert [spark.read.parquet(log).count() for log in logs] == [1, 1]


def test_bad_messages_go_to_the_failed_branch(spark, tmp_path):
    folder = tmp_path / "in"
    write_file(
        folder,
        "0.json",
        message("2024-01-01T10:00:00", temp_c=1.5),
        '{"airport_code": "K1", "temp',
        message(None, temp_c=2.0),
        message("2024-01-01T11:00:00", temp_c="warm"),
    )
    good, failed = str(tmp_path / "good"), str(tmp_path / "failed")
    start(
        route_readings(file_messages(spark, str(folder))),
        [dead_letter_sink(changelog_sink(good), changelog_sink(failed))],
        str(tmp_path / "checkpoint"),
        mode="append",
        available_now=True,
    ).awaitTermination()
    assert [r.temp_c for r in spark.read.parquet(good).collect()] == [1.5]
    assert spark.read.parquet(failed).count() == 3


def test_static_rows_do_not_multiply_readings(spark):
    readings = fixture_readings(spark, SMALL)
    airports = readings.select("airport_code", "state", "event_id").withColumnRenamed(
        "event_id", "note"
    )
    joined = kpis.attach_airports(readings, airports)
    assert joined.count() == readings.count()
    assert "note" in joined.columns and joined.columns.count("state") == 1


def test_single_reading_has_no_deviation(spark):
    one = fixture_readings(spark, SMALL).where("event_id = 7")
    assert {r.instability_score for r in kpis.instability(one).collect()} == {None}
    assert {r.weather_volatility for r in kpis.state_volatility(one).collect()} == {None}


def test_spread_that_would_divide_by_zero(spark):
    two = (
        fixture_readings(spark, SMALL)
        .where("event_id < 2")
        .withColumns(
            {
                "airport_code": F.lit("K"),
                "state": F.lit("S"),
                "county": F.lit("C"),
                "temp_c": F.lit(0.0),
                "dewpoint_c": F.lit(0.1),
            }
        )
    )
    assert {r.instability_score for r in kpis.instability(two).collect()} == {None}


def test_payload_time_defaults_to_now(spark):
    payload = spark.createDataFrame(
        [("K1", '{"location": {}, "current": {"temp_c": 3.5, "is_day": 1}}')],
        "airport_code string, body string",
    )
    airports = spark.createDataFrame(
        [("K1", "S", "C", "US/Eastern", 1.0, 2.0)],
        "airport_code string, state string, county string, timezone string, "
        "location_lat double, location_lng double",
    )
    row = flatten_payload(payload, airports).first()
    assert (row.temp_c, row.is_day, row.timezone, row.uv) == (3.5, 1, "US/Eastern", None)
    assert row.start_time_utc is not None


def test_kafka_options():
    assert kafka_options("a:1", "t")["subscribe"] == "t"


def test_live_tables_have_the_contract_columns(spark):
    for name, job in LIVE_JOBS.items():
        result = conform(job.build(fixture_readings(spark, SMALL)), TABLES[name])
        assert result.columns == [*TABLES[name].schema.fieldNames(), "created_at"]


def test_live_command_line(spark, tmp_path):
    write_file(tmp_path / "in", "0.json", message("2024-01-01T10:00:00", temp_c=1.0))
    lines = ["airport_code,state,county,timezone,location_lat,location_lng", "K1,S,C,UTC,1.0,2.0"]
    (tmp_path / "airports.csv").write_text("\n".join(lines) + "\n")
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    try:
        live.main(
            ["weather_state_analytics", "--available-now", "--folder", str(tmp_path / "in")]
            + ["--airports", str(tmp_path / "airports.csv")]
            + ["--changelog", str(tmp_path / "log"), "--checkpoint", str(tmp_path / "cp")]
        )
    finally:
        spark.conf.set(provider, before)
    latest = read_latest(spark, str(tmp_path / "log"), ["state", "interval_start"])
    assert [(r.state, r.event_count) for r in latest.collect()] == [("S1", 1)]
