"""Messages without a key, and live queries of which one fails."""

import json

import pytest
from pyspark.sql import functions as F

from stormgauge.plans import compact
from stormgauge.plans.live import LIVE_JOBS, start_dead_letters
from stormgauge.sinks.changelog import changelog_sink, read_latest
from stormgauge.sources.readings import file_messages
from stormgauge.streaming.runner import await_all, start

GOOD = {"airport_code": "K1", "state": "S", "county": "C", "start_time_utc": "2024-01-01T00:10:00", "temp_c": 3.5}


def messages(folder):
    folder.mkdir()
    lines = [
        GOOD,
        {k: v for k, v in GOOD.items() if k != "airport_code"},
        {**GOOD, "airport_code": None},
        {k: v for k, v in GOOD.items() if k != "state"},
    ]
    (folder / "a.txt").write_text("\n".join(map(json.dumps, lines)))
    return str(folder)


@pytest.mark.parametrize(
    "name, kept, failed", [("weather_realtime_sliding", 4, 2), ("weather_state_analytics", 1, 1)]
)
def test_messages_without_a_key_go_to_the_dead_letters(spark, tmp_path, name, kept, failed):
    job = LIVE_JOBS[name]
    source = messages(tmp_path / "feed")
    out, dead = str(tmp_path / "out"), str(tmp_path / "dead")
    queries = [
        job.start(file_messages(spark, source), None, [changelog_sink(out)], str(tmp_path / "c1"), True),
        start_dead_letters(file_messages(spark, source), dead, str(tmp_path / "c2"), True, job.required),
    ]
    await_all(queries)
    rows = read_latest(spark, out, job.table.key)
    assert rows.where(F.col(job.table.key[0]).isNull()).isEmpty() and rows.count() == kept
    assert spark.read.parquet(dead).count() == failed


def test_a_failing_query_stops_the_others(spark, tmp_path):
    source = messages(tmp_path / "feed")

    def fails(batch, epoch):
        raise ValueError("no room left")

    going = start(file_messages(spark, source), [lambda batch, epoch: None], str(tmp_path / "c1"), mode="append")
    failing = start(file_messages(spark, source), [fails], str(tmp_path / "c2"), mode="append")
    with pytest.raises(Exception, match="no room left"):
        await_all([going, failing], 1)
    assert not going.isActive and not failing.isActive


def test_a_live_table_merged_on_reading(spark, tmp_path):
    job = LIVE_JOBS["weather_realtime_sliding"]
    feed, path = tmp_path / "feed", str(tmp_path / "table")
    feed.mkdir()
    table = job.merged_table(spark, path)
    for n, minute in enumerate(("10", "20")):
        line = json.dumps({**GOOD, "start_time_utc": f"2024-01-01T00:{minute}:00"})
        (feed / f"{n}.txt").write_text(line)
        job.start(file_messages(spark, str(feed)), None, [table.add_epoch], str(tmp_path / "c"), True).awaitTermination()
    counts = {r.event_count for r in table.read().collect()}
    assert counts == {2} and table.read().count() == 4
    compact.main(["weather_realtime_sliding", "--merged-table", path])
    # windows begin on the last day of the year before as well
    assert {f.kind for f in table.files().collect()} == {"base"} and table.files().count() == 2
    assert {r.event_count for r in table.read({"airport_code": ("K1", "K1")}).collect()} == {2}
    assert table.read({"airport_code": ("K2", None)}).isEmpty()
