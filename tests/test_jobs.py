"""Raw files to curated tables, sinks, contracts, plans and time zones."""

import datetime as dt

import pytest

from __spark_entry__ import queries
from catalogue import batch
from stormgauge.contracts import TABLES, conform, require, violations
from stormgauge.functions.calendar import iso_weekday, to_local
from stormgauge.operators.cleaning import clean_events
from stormgauge.operators.exposure import exposure_hours_daily
from stormgauge.plans import publish, transform
from stormgauge.plans.publish import JOBS
from stormgauge.session import shared_folder
from stormgauge.sinks.jdbc import JdbcTarget, merge_statement, placed, statement_runner
from stormgauge.sinks import versions
from stormgauge.sinks.parquet import buckets_of, join_colocated, write_bucketed, write_partitioned
from stormgauge.sources.files import read_airports, read_events, read_raw
from stormgauge.sources.schemas import EVENTS_CLEAN_SCHEMA, RAW_COLUMNS
from tests.helpers import events, rows

HEADER = ",".join(RAW_COLUMNS)


def raw_line(**over):
    base = {
        "EventId": "W-1",
        "Type": "Snow",
        "Severity": "Light",
        "StartTime(UTC)": "2016-01-06 23:14:00",
        "EndTime(UTC)": "2016-01-07 00:34:00",
        "Precipitation(in)": "0.0",
        "TimeZone": "US/Mountain",
        "AirportCode": "K04V",
        "LocationLat": "38.0972",
        "LocationLng": "-106.1689",
        "City": "Saguache",
        "County": "Saguache",
        "State": "CO",
        "ZipCode": "01149",
    }
    return ",".join({**base, **over}[c] for c in RAW_COLUMNS)


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "raw" / "2025-09-01"
    folder.mkdir(parents=True)
    lines = [
        HEADER,
        raw_line(Type=" snow "),
        raw_line(EventId="W-2", TimeZone="", Severity="hEAVY "),
        raw_line(EventId="W-3", TimeZone="Mars/Phobos", **{"Precipitation(in)": "trace"}),
        raw_line(EventId="W-4", **{"EndTime(UTC)": "soon"}),
        raw_line(EventId="W-1", Type="Fog", **{"StartTime(UTC)": "2016-01-06 23:13:00"}),
        raw_line(EventId="W-5", **{"StartTime(UTC)": "2016-03-13 09:30:00"}),
    ]
    (folder / "WeatherEvents.csv").write_text("\n".join(lines) + "\n")
    return tmp_path


def test_raw_rows_become_typed_events(spark, landing):
    found = {
        r.event_id: r
        for r in clean_events(read_raw(spark, str(landing / "raw" / "2025-09-01"))).collect()
    }
    assert sorted(found) == ["W-1", "W-2", "W-3", "W-4", "W-5"]
    first = found["W-1"]
    assert (first.type, first.severity, first.zip_code) == ("FOG", "Light", "01149")
    assert first.duration_min == 81.0
    assert first.local_start_ts == dt.datetime(2016, 1, 6, 16, 13)
    assert (first.season, first.is_night, first.dow, first.event_month) == ("DJF", True, 3, 1)
    assert found["W-2"].local_start_ts == found["W-2"].start_time_utc
    assert found["W-2"].severity == "Heavy"
    assert found["W-3"].local_start_ts == found["W-3"].start_time_utc
    assert found["W-3"].precipitation_in is None
    assert found["W-4"].end_time_utc is None and found["W-4"].duration_min is None
    # just after the clocks went forward in that zone
    assert found["W-5"].local_start_ts == dt.datetime(2016, 3, 13, 3, 30)


def test_other_header_is_refused(spark, tmp_path):
    (tmp_path / "x.csv").write_text(HEADER.replace("Severity", "Grade") + "\n" + raw_line() + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw(spark, str(tmp_path / "x.csv")).collect()


def test_transform_writes_a_partitioned_table(spark, landing):
    out = str(landing / "clean")
    path = transform.run(
        spark, "2025-09-01", str(landing / "raw"), out, table="events_clean_from_raw"
    )
    table = spark.table("events_clean_from_raw")
    assert table.count() == 5
    assert {c: t for c, t in table.dtypes} == {
        c: t
        for c, t in (f.strip().rsplit(" ", 1) for f in EVENTS_CLEAN_SCHEMA.split(","))
    }
    march = read_events(spark, path, ["event_id"], months=("2016-02", "2016-04"))
    assert rows(march) == [("W-5",)]


def test_rewriting_one_month_keeps_the_others(spark, landing):
    clean = clean_events(read_raw(spark, str(landing / "raw" / "2025-09-01")))
    path = str(landing / "t")
    write_partitioned(clean, path)
    write_partitioned(clean.where("event_id = 'W-5'").limit(1), path)
    write_partitioned(clean.where("event_id = 'W-5'"), path)
    assert read_events(spark, path).count() == 5


def test_scan_reads_only_what_it_needs(spark, landing):
    path = str(landing / "t")
    write_partitioned(clean_events(read_raw(spark, str(landing / "raw" / "2025-09-01"))), path)
    frame = exposure_hours_daily(
        read_events(spark, path, months=("2016-01", "2016-02")), risk_severities=["Heavy"]
    )
    plan = frame._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert "PartitionFilters: [" in scan and "event_year" in scan.split("PartitionFilters")[1]
    assert "In(type" in scan and "IsNotNull(local_start_ts)" in scan
    schema = scan.split("ReadSchema: struct<")[1]
    assert "city" not in schema and "zip_code" not in schema


@pytest.mark.parametrize("name", sorted(JOBS))
def test_publish_job_writes_its_contract(spark, landing, tmp_path, name):
    clean = clean_events(read_raw(spark, str(landing / "raw" / "2025-09-01")))
    path = str(tmp_path / "in")
    write_partitioned(clean, path)
    result = JOBS[name].staged(read_events(spark, path), shared_folder(spark, "stage"))
    assert result.columns == TABLES[name].schema.fieldNames()
    assert [f.dataType for f in result.schema] == [f.dataType for f in TABLES[name].schema]


def test_publish_command_line(spark, landing, tmp_path):
    path = str(tmp_path / "in")
    write_partitioned(clean_events(read_raw(spark, str(landing / "raw" / "2025-09-01"))), path)
    publish.main(
        ["winter_burstiness", "--input", path, "--parquet", str(tmp_path / "out")]
        + ["--gap-threshold-hours", "1", "--min-episode-hours", "0.5"]
    )
    found = spark.read.parquet(str(tmp_path / "out" / "winter_burstiness"))
    assert found.count() == 1


def test_contract_breaches_are_found(spark):
    table = TABLES["exposure_hours_daily"]
    good = conform(exposure_hours_daily(events(spark, {"s": "2024-01-01", "e": "2024-01-02"})), table)
    require(good, table)
    with pytest.raises(ValueError, match="duplicate_keys"):
        require(good.unionAll(good), table)
    with pytest.raises(ValueError, match="missing_values"):
        require(good.selectExpr("airport_code", "event_date", "cast(null as double) "
                                "exposure_hours_day", "exposure_hours_30d",
                                "exposure_hours_90d"), table)
    assert violations(good.where("false"), table).first()["row_count"] == 0


def test_bucketed_table_is_grouped_without_a_shuffle(spark):
    frame = queries()["bucketed_table"](spark, "/root/testdata/sf0.001")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_tables_of_the_same_buckets_are_joined_without_a_shuffle(spark):
    frame = queries()["colocated_join"](spark, "/root/testdata/sf0.001")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert frame.count() > 1


def test_tables_of_other_buckets_are_refused(spark, tmp_path):
    rows = spark.range(10).withColumnRenamed("id", "k")
    for name, buckets in (("two_buckets", 2), ("four_buckets", 4)):
        write_bucketed(rows, name, str(tmp_path / name), "k", buckets)
    rows.write.option("path", str(tmp_path / "plain")).saveAsTable("no_buckets")
    assert buckets_of(spark, "four_buckets") == (4, ["k"]) and buckets_of(spark, "no_buckets") == (0, [])
    for right in ("four_buckets", "no_buckets"):
        with pytest.raises(ValueError, match="buckets"):
            join_colocated(spark, "two_buckets", right)
    with pytest.raises(ValueError, match="buckets"):
        join_colocated(spark, "no_buckets", "no_buckets")
    assert join_colocated(spark, "two_buckets", "two_buckets").count() == 10


def test_there_are_fifteen_tables():
    assert len(TABLES) == 15
    assert {t.place for t in TABLES.values()} == {"airport_code", "state"}


def test_jdbc_settings(spark):
    target = JdbcTarget("jdbc:postgresql://h/db", "curated.t", "u", "secret")
    assert target.options()["truncate"] == "true"
    assert target.options()["batchsize"] == "10000"
    assert "secret" not in repr(target)
    frame = spark.range(10).withColumnRenamed("id", "state")
    assert placed(frame, target, ["state"]).count() == 10
    assert placed(frame, JdbcTarget("x", "t", "u", "p", connections=3), ["state"]).count() == 10


def test_merge_statement():
    text = merge_statement("t", "t_staging", ["k"], ["k", "a", "b"])
    assert text == (
        "MERGE INTO t t USING t_staging s ON t.k = s.k "
        "WHEN MATCHED THEN UPDATE SET a = s.a, b = s.b "
        "WHEN NOT MATCHED THEN INSERT (k, a, b) VALUES (s.k, s.a, s.b)"
    )


def test_statement_runner_commits_and_closes():
    calls = []

    class Connection:
        def cursor(self):
            return self

        def execute(self, statement):
            calls.append(statement)

        def commit(self):
            calls.append("commit")

        def close(self):
            calls.append("close")

    statement_runner(Connection)("MERGE")
    assert calls == ["MERGE", "commit", "close"]


def test_airport_rows_come_in_file_order(spark, tmp_path):
    lines = ["airport_code,state,county,timezone,location_lat,location_lng"]
    lines += [f"K{i},S,C,US/Eastern,{i}.5,-{i}.5" for i in range(9, 0, -1)]
    (tmp_path / "airports.csv").write_text("\n".join(lines) + "\n")
    found = read_airports(spark, str(tmp_path / "airports.csv"), limit=3).collect()
    assert [r.airport_code for r in found] == ["K9", "K8", "K7"]


@pytest.mark.parametrize("zone", ["America/New_York", "Pacific/Apia"])
@pytest.mark.parametrize(
    "name",
    [
        "clean_events",
        "exposure_hours_daily",
        "longest_episodes",
        "cooccurrence_sweep",
        "peak_3h_daily",
        "peak_3h_segments",
        "winter_phenology",
        "risky_sequences",
        "stream_tumbling_5h",
        "calendar_parts",
        "parsed_readings",
    ],
)
def test_results_do_not_depend_on_the_session_zone(spark, in_zone, name, zone):
    sf_dir = "/root/testdata/sf0.001"
    want = rows(queries()[name](spark, sf_dir))
    in_zone(zone)
    assert rows(queries()[name](spark, sf_dir)) == want


def test_weekday_and_zone(spark, in_zone):
    in_zone("America/New_York")
    frame = spark.sql("select timestamp_ntz'2024-01-07 12:00:00' t, ' US/Eastern ' z")
    assert frame.select(iso_weekday("t"), to_local("t", frame.z)).first() == (
        7,
        dt.datetime(2024, 1, 7, 7, 0),
    )


@pytest.mark.parametrize("name", sorted(batch.QUERIES))
def test_plans_form_no_products_and_scan_once(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        frame = batch.QUERIES[name](spark, "/root/testdata/sf0.001")
        plan = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "SinglePartition" not in plan
    for table in ("events.parquet", "orders.parquet"):
        assert plan.count(f"/{table}") <= 1


def test_publish_keeps_versions(spark, landing, tmp_path):
    path = str(tmp_path / "in")
    write_partitioned(clean_events(read_raw(spark, str(landing / "raw" / "2025-09-01"))), path)
    call = ["longest_episodes", "--input", path, "--parquet", str(tmp_path / "out"), "--snapshots"]
    for _ in range(3):
        publish.main(call)
    out = str(tmp_path / "out" / "longest_episodes")
    assert versions.versions(spark, out) == [2, 3]
    assert versions.read_snapshot(spark, out, 2).count() == versions.read_snapshot(spark, out).count() > 0
    with pytest.raises(SystemExit):
        publish.main([*call, "--months", "2016-01", "2016-02"])
