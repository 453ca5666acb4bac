"""Run dates merged one by one against all of them cleaned at once."""

import itertools
import os

import pytest

from stormgauge.operators.cleaning import clean_events
from stormgauge.plans import transform
from stormgauge.sinks import merge
from stormgauge.sources.files import read_events
from stormgauge.sources.schemas import RAW_COLUMNS, RAW_SCHEMA

COLUMNS = ["EventId", "Type", "StartTime(UTC)", "EndTime(UTC)", "City"]


def raw(spark, *lines):
    full = [dict(zip(COLUMNS, line)) for line in lines]
    return spark.createDataFrame([tuple(r.get(c) for c in RAW_COLUMNS) for r in full], RAW_SCHEMA)


def event(name, start, city="X"):
    return (name, " rain", start, "2024-06-01 00:00:00", city)


DATES = (
    [
        event("a", "2024-01-05 00:00:00"), event("b", "2024-02-05 00:00:00", "Q"),
        event("c", "not a time"), event("only", "2023-11-01 00:00:00"), (None, "rain", "x", "y", "z"),
    ],
    [
        event("a", "2024-01-04 00:00:00"), event("b", "2024-02-05 00:00:00", "P"),
        event("c", "2024-01-01 00:00:00"), event("moves", "2024-04-05 00:00:00"),
    ],
    [
        event("a", "2024-03-04 00:00:00"), event("b", "2024-02-05 00:00:00", None),
        event("moves", "2024-03-31 23:59:59"), event("moves", "2024-05-01 00:00:00"),
    ],
)


def content(frame):
    return sorted(map(repr, frame.select(sorted(frame.columns)).collect()))


def files(path):
    return {os.path.join(at, f) for at, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


@pytest.mark.parametrize("order", list(itertools.permutations(range(3))))
def test_run_dates_in_any_order_equal_one_run(spark, tmp_path, order):
    target = str(tmp_path / "clean")
    for n, date in enumerate(order):
        merge.merge_events(spark, raw(spark, *DATES[date]), target, str(tmp_path / f"work{n}"))
    assert content(read_events(spark, target)) == content(clean_events(raw(spark, *sum(DATES, []))))
    assert not list(tmp_path.glob("work*"))
    # the only event of April belongs to March by the third date
    assert not (tmp_path / "clean" / "event_year=2024" / "event_month=4").exists()
    before = files(target)
    assert merge.merge_events(spark, raw(spark, *DATES[order[0]]), target, str(tmp_path / "again")) == set()
    assert files(target) == before


def test_other_months_keep_their_files(spark, tmp_path):
    target = str(tmp_path / "clean")
    merge.merge_events(spark, raw(spark, *sum(DATES, [])), target, str(tmp_path / "w1"))
    before = files(target)
    later = [event("a", "2024-01-03 00:00:00"), event("only", "2023-12-01 00:00:00")]
    assert merge.merge_events(spark, raw(spark, *later), target, str(tmp_path / "w2")) == {(2024, 1)}
    changed = before ^ files(target)
    assert changed and all("event_month=1/" in f for f in changed)


def test_nothing_new_leaves_the_table(spark, tmp_path):
    target = str(tmp_path / "clean")
    merge.merge_events(spark, raw(spark, *DATES[0]), target, str(tmp_path / "w1"))
    before = files(target)
    assert merge.merge_events(spark, raw(spark), target, str(tmp_path / "w2")) == set()
    assert files(target) == before


def test_a_run_cut_off_before_the_old_month_is_dropped_is_mended(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "clean")
    merge.merge_events(spark, raw(spark, *DATES[1]), target, str(tmp_path / "w1"))

    def lost(spark, path):
        raise OSError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(merge.session, "remove_folder", lost)
        with pytest.raises(OSError):
            merge.merge_events(spark, raw(spark, *DATES[2]), target, str(tmp_path / "w2"))
    assert read_events(spark, target).where("event_id = 'moves'").count() == 2
    merge.merge_events(spark, raw(spark, *DATES[2]), target, str(tmp_path / "w3"))
    assert content(read_events(spark, target)) == content(clean_events(raw(spark, *DATES[1], *DATES[2])))


def test_job_merges_run_dates(spark, tmp_path):
    for n, date in enumerate(DATES):
        frame = raw(spark, *date).coalesce(1)
        frame.write.option("header", True).csv(str(tmp_path / "raw" / f"2024-09-0{n + 1}"))
    out = str(tmp_path / "out")
    for n in (3, 1, 2):
        transform.run(spark, f"2024-09-0{n}", str(tmp_path / "raw"), out, merge=True)
    assert content(read_events(spark, f"{out}/events_clean")) == content(
        clean_events(raw(spark, *sum(DATES, [])))
    )


def test_changed_months_are_written_once(spark, tmp_path, monkeypatch):
    """merged rows went to the work folder first and were read again to be put in place."""
    target, work, held = str(tmp_path / "clean"), tmp_path / "work", []
    merge.merge_events(spark, raw(spark, *DATES[0]), target, str(work))
    write = merge.write_partitioned

    def put(frame, path):
        held.append(sorted(os.listdir(work)))
        write(frame, path)

    monkeypatch.setattr(merge, "write_partitioned", put)
    merge.merge_events(spark, raw(spark, *DATES[1]), target, str(work))
    assert held == [["accepted", "met", "new"]]
    assert content(read_events(spark, target)) == content(clean_events(raw(spark, *DATES[0], *DATES[1])))
