"""Late readings kept aside, and the KPI over those that go on."""

import json
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stormgauge.plans import live
from stormgauge.sinks import versions
from stormgauge.sinks.changelog import read_latest
from stormgauge.sources.schemas import READING_SCHEMA
from stormgauge.streaming import late
from stormgauge.streaming.late import Span, late_rows, late_split_sink, on_time_rows, on_time_stream
from stormgauge.streaming.runner import start

SPAN = Span(delay=600, width=3600, slide=1800)
SCHEMA = "id int, start_time_utc timestamp"


def frame(spark, *given):
    rows = spark.createDataFrame(list(given), "id int, t string")
    return rows.select("id", F.col("t").cast("timestamp").alias("start_time_utc"))


BATCHES = (
    [(1, "2024-01-01 10:00:00"), (2, "2024-01-01 09:00:00"), (3, None)],
    # the bound is 09:50: of id 4 both windows are closed, of 5 one, of 6 none
    [(4, "2024-01-01 08:40:00"), (5, "2024-01-01 09:20:00"), (6, "2024-01-01 09:40:00"), (7, "2024-01-01 12:00:00")],
    # 11:50
    [(8, "2024-01-01 10:10:00"), (9, "2024-01-01 11:59:59"), (10, None)],
)


def ids(rows):
    return sorted(r.id for r in rows.collect())


def test_rows_are_split_by_the_epochs_before(spark, tmp_path):
    sink = late_split_sink(str(tmp_path), SPAN)
    for epoch, batch in enumerate(BATCHES):
        sink(frame(spark, *batch), epoch)
        sink(frame(spark, (99, "2030-01-01 00:00:00")), epoch)  # a replay
    assert {r.id: r.n_closed for r in late_rows(spark, str(tmp_path)).collect()} == {4: 2, 5: 1, 8: 2}
    assert ids(on_time_rows(spark, str(tmp_path))) == [1, 2, 3, 5, 6, 7, 9, 10]


def test_windows_by_the_second(spark):
    times = [f"2024-01-01 {h:02}:{m:02}:{s:02}" for h in range(4) for m in range(0, 60, 7) for s in (0, 59)]
    bound = 1704067200_000 + 2 * 3600_000
    made = frame(spark, *enumerate(times)).select(
        F.unix_seconds("start_time_utc").alias("t"), SPAN.closed(F.col("start_time_utc"), bound).alias("n")
    )
    for t, n in made.collect():
        starts = [t // 1800 * 1800 - 1800 * k for k in range(2)]
        assert n == sum((s + 3600) * 1000 <= bound for s in starts)
    with pytest.raises(ValueError, match="multiple"):
        Span(1, 100, 30)


def test_an_epoch_cut_off_between_its_folders(spark, tmp_path, monkeypatch):
    sink, plain = late_split_sink(str(tmp_path), SPAN), late.move_once
    sink(frame(spark, *BATCHES[0]), 0)

    def once(*args):
        monkeypatch.setattr(late, "move_once", lost)
        return plain(*args)

    def lost(*_):
        raise OSError("driver lost")

    monkeypatch.setattr(late, "move_once", once)
    with pytest.raises(OSError):
        sink(frame(spark, *BATCHES[1]), 1)
    monkeypatch.setattr(late, "move_once", plain)
    sink(frame(spark, *BATCHES[1]), 1)
    assert ids(on_time_rows(spark, str(tmp_path))) == [1, 2, 3, 5, 6, 7]
    assert ids(late_rows(spark, str(tmp_path))) == [4, 5]
    assert versions.version_text(spark, f"{tmp_path}/bound", 1) == "1704110400000"


def test_empty_batches_and_unknown_times(spark, tmp_path):
    sink = late_split_sink(str(tmp_path), SPAN)
    for epoch, batch in enumerate(([], [(1, None)], [(2, "2024-01-01 00:00:00")], [])):
        sink(frame(spark, *batch) if batch else spark.createDataFrame([], SCHEMA), epoch)
    assert ids(on_time_rows(spark, str(tmp_path))) == [1, 2] and ids(late_rows(spark, str(tmp_path))) == []


def test_a_live_count_misses_nothing_that_went_on(spark, tmp_path):
    feed, split, out = (str(tmp_path / n) for n in ("feed", "split", "out"))
    versions.ensure_folder(spark, feed)
    source = spark.readStream.schema(SCHEMA).parquet(feed)
    going = on_time_stream(spark, split, SCHEMA).withWatermark("start_time_utc", "600 seconds")
    counts = going.groupBy(F.window("start_time_utc", "1 hour", "30 minutes")).agg(F.count("id").alias("n"))
    seen = {}

    def keep(batch, epoch):
        seen.update({r["window"].start: r.n for r in batch.collect()})

    for batch in BATCHES:
        frame(spark, *batch).write.mode("append").parquet(feed)
        start(source, [late_split_sink(split, SPAN)], f"{out}-1", "append", True).awaitTermination()
        start(counts, [keep], f"{out}-2", "update", True).awaitTermination()
    open_ones = on_time_rows(spark, split).where("start_time_utc is not null").where("id <> 5")
    windows = open_ones.groupBy(F.window("start_time_utc", "1 hour", "30 minutes").alias("w")).count()
    for w, n in windows.collect():
        # id 5 went on for the one window that was open
        assert seen[w.start] - n in ((0, 1) if str(w.start).endswith(("08:30:00", "09:00:00")) else (0,))


def test_live_job_with_a_folder_for_late_readings(spark, tmp_path):
    feed, out, aside = tmp_path / "feed", str(tmp_path / "out"), str(tmp_path / "aside")
    feed.mkdir()
    call = ["weather_realtime_sliding", "--folder", str(feed), "--changelog", out, "--late", aside]
    call += ["--checkpoint", str(tmp_path / "c"), "--available-now"]
    for n, time in enumerate(("10:10:00", "14:10:00", "10:20:00")):
        line = {"airport_code": "K1", "start_time_utc": f"2024-01-01T{time}", "temp_c": 1.0}
        (feed / f"{n}.txt").write_text(json.dumps(line) + "\n")
        live.main(call)
    kept = late_rows(spark, aside).collect()
    assert [(r.airport_code, r.n_closed) for r in kept] == [("K1", 4)]
    now = read_latest(spark, out, live.LIVE_JOBS["weather_realtime_sliding"].table.key)
    assert now.count() == 8 and {r.event_count for r in now.collect()} == {1}


@pytest.mark.parametrize("name", sorted(live.LIVE_JOBS))
def test_spans_are_those_of_the_kpis(spark, tmp_path, name):
    job = live.LIVE_JOBS[name]
    empty = spark.createDataFrame([], READING_SCHEMA)
    one = empty.union(spark.createDataFrame([{"start_time_utc": datetime(2024, 1, 1)}], READING_SCHEMA))
    made = job.build(one, None)
    first, last = (next(c for c in made.columns if c.endswith(e)) for e in ("_start", "_end"))
    seconds = made.select((F.unix_seconds(last) - F.unix_seconds(first)).alias("width")).distinct()
    assert [r.width for r in seconds.collect()] == [job.span.width] and made.count() == job.span.per_row
    stream = job.build(on_time_stream(spark, str(tmp_path), empty.schema), None)
    plan = stream._jdf.queryExecution().analyzed().toString()
    delay = re.search(r"EventTimeWatermark .*?, start_time_utc#\d+: timestamp, (.*)", plan).group(1)
    amount, unit = delay.split()[:2]
    assert int(amount) * {"minutes": 60, "days": 86400}[unit] == job.span.delay
