"""Merge-on-read table, versions and the ledger of epochs."""

import os
import random

import pytest
from pyspark.sql import functions as F

from stormgauge.sinks import ranged, versions
from stormgauge.sinks.ledger import once_per_epoch
from stormgauge.sinks.ranged import RangedTable
from tests.helpers import rows

SCHEMA = "k bigint, name string, v string"


def table_at(spark, path):
    return RangedTable(spark, str(path), ["k", "name"], F.floor(F.col("k") / 10))


def frame(spark, *given):
    return spark.createDataFrame(list(given), SCHEMA)


def opened(df):
    return {f.removeprefix("file:").replace("///", "/") for f in df.inputFiles()}


def test_random_epochs_equal_a_dictionary_of_last_rows(spark, tmp_path):
    rng, table, held = random.Random(3), table_at(spark, tmp_path / "t"), {}
    for epoch in range(6):
        keys = {(rng.choice([None, *range(40)]), rng.choice([None, "a", "b"])) for _ in range(25)}
        held |= {key: f"{epoch}-{n}" for n, key in enumerate(keys, 1)}
        given = [(*key, held[key]) for key in keys]
        table.add_epoch(frame(spark, *given), epoch)
        table.add_epoch(frame(spark, (1, "a", "replayed")), epoch)
        if epoch in (2, 4):
            table.compact(at_least=epoch - 1)
    want = sorted(map(repr, ((*k, v) for k, v in held.items())))
    assert sorted(map(repr, map(tuple, table.read().collect()))) == want
    table.compact(at_least=1)
    assert sorted(map(repr, map(tuple, table.read().collect()))) == want
    asked = table.read({"k": (12, 30), "name": ("b", None)})
    assert {tuple(r) for r in asked.collect()} == {
        (k, n, v) for (k, n), v in held.items() if k is not None and 12 <= k <= 30 and n == "b"
    }


def test_only_files_of_the_asked_keys_are_opened(spark, tmp_path):
    table = table_at(spark, tmp_path / "t")
    table.add_epoch(frame(spark, *[(k, "a", "0") for k in range(100)]), 0)
    table.compact(at_least=1)
    table.add_epoch(frame(spark, (15, "a", "1"), (77, "a", "1")), 1)
    listed = table.files().collect()
    asked = table.read({"k": (11, 18)})
    near = {f.path for f in listed if f.least.k <= 18 and f.greatest.k >= 11}
    assert opened(asked) == {p.removeprefix("file:").replace("///", "/") for p in near}
    assert 2 <= len(near) < len(listed)
    assert rows(asked) == [(k, "a", "1" if k == 15 else "0") for k in range(11, 19)]
    assert table.read({"k": (500, None)}).collect() == []


def test_compaction_leaves_other_places_their_files(spark, tmp_path):
    table = table_at(spark, tmp_path / "t")
    table.add_epoch(frame(spark, (1, "a", "0"), (50, "a", "0")), 0)
    table.add_epoch(frame(spark, (1, "a", "1")), 1)
    before = {f.path for f in table.files().collect() if f.place == 5}
    pinned = table._at(None)[0]
    table.compact()
    after = {(f.place, f.kind): f.path for f in table.files().collect()}
    assert set(after) == {(0, "base"), (5, "delta")} and {after[5, "delta"]} == before
    assert rows(table.read(version=pinned)) == rows(table.read())
    table.expire(keep=1)
    assert rows(table.read()) == [(1, "a", "1"), (50, "a", "0")]
    with pytest.raises(ValueError, match="no version"):
        table.read(version=pinned)
    names = {f for _, _, fs in os.walk(tmp_path / "t") for f in fs if f.startswith("part-")}
    assert {os.path.basename(f) for f in opened(table.read())} <= names


def test_an_epoch_that_comes_during_a_compaction_is_kept(spark, tmp_path, monkeypatch):
    table, other = table_at(spark, tmp_path / "t"), table_at(spark, tmp_path / "t")
    table.add_epoch(frame(spark, (1, "a", "0"), (2, "a", "0")), 0)
    table.add_epoch(frame(spark, (1, "a", "1")), 1)
    plain = ranged.commit

    def late(*args):
        monkeypatch.setattr(ranged, "commit", plain)
        other.add_epoch(frame(spark, (2, "a", "2")), 2)
        return plain(*args)

    monkeypatch.setattr(ranged, "commit", late)
    table.compact()
    assert rows(table.read()) == [(1, "a", "1"), (2, "a", "2")]
    assert table.last_epoch() == 2
    assert sorted(f.kind for f in table.files().collect()) == ["base", "delta"]


def test_two_compactions_of_the_same_files(spark, tmp_path, monkeypatch):
    table, other = table_at(spark, tmp_path / "t"), table_at(spark, tmp_path / "t")
    for epoch in range(2):
        table.add_epoch(frame(spark, (1, "a", str(epoch))), epoch)
    plain = ranged.commit

    def late(*args):
        monkeypatch.setattr(ranged, "commit", plain)
        other.compact()
        return plain(*args)

    monkeypatch.setattr(ranged, "commit", late)
    with pytest.raises(versions.Conflict):
        table.compact()
    assert rows(table.read()) == [(1, "a", "1")]


def test_empty_epochs_other_columns_and_no_table(spark, tmp_path):
    table = table_at(spark, tmp_path / "t")
    with pytest.raises(ValueError, match="no version"):
        table.read()
    table.add_epoch(frame(spark), 0)
    assert table.read().collect() == [] and table.read().columns == ["k", "name", "v"]
    table.compact(at_least=1)
    with pytest.raises(ValueError, match="columns differ"):
        table.add_epoch(frame(spark, (1, "a", "x")).drop("v"), 1)
    with pytest.raises(ValueError, match="key columns"):
        table.read({"v": (None, "x")})
    table.add_epoch(frame(spark, (1, "a", "x"), (1, "a", "y")), 4)
    assert rows(table.read()) == [(1, "a", "x")]


def test_snapshot_of_a_run_cut_off_leaves_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    with pytest.raises(ValueError, match="no version"):
        versions.read_snapshot(spark, path)
    assert versions.write_snapshot(frame(spark, (1, "a", "x")), path) == 1
    pinned = versions.read_snapshot(spark, path, 1)

    def lost(*_):
        raise OSError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(versions, "commit", lost)
        with pytest.raises(OSError):
            versions.write_snapshot(frame(spark, (2, "b", "y")), path)
    assert rows(versions.read_snapshot(spark, path)) == [(1, "a", "x")]
    broken_rows = frame(spark, (2, "b", "y")).withColumn("v", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        versions.write_snapshot(broken_rows, path)
    assert versions.write_snapshot(frame(spark, (3, "c", "z")), path) == 2
    assert rows(versions.read_snapshot(spark, path)) == [(3, "c", "z")]
    assert rows(pinned) == [(1, "a", "x")]
    versions.write_snapshot(frame(spark, (4, "d", "z")), path)
    assert versions.versions(spark, path) == [2, 3]
    with pytest.raises(ValueError, match="no version 1"):
        versions.read_snapshot(spark, path, 1)
    assert len(list((tmp_path / "s").glob("snapshot-*"))) == 2


def test_a_second_writer_of_a_version_is_refused(spark, tmp_path):
    versions.commit(spark, str(tmp_path / "v"), 1, "mine")
    with pytest.raises(versions.Conflict):
        versions.commit(spark, str(tmp_path / "v"), 1, "theirs")
    assert versions.version_text(spark, str(tmp_path / "v"), 1) == "mine"
    assert versions.versions(spark, str(tmp_path / "v")) == [1]


def test_a_replayed_epoch_reaches_each_sink_once(spark, tmp_path):
    done, fails = [], [False, True]

    def append(batch, epoch):
        done.append((epoch, batch.count()))

    def second(batch, epoch):
        if epoch == 7 and fails.pop():
            raise OSError("target away")
        batch.write.mode("append").parquet(str(tmp_path / "out"))

    sinks = [once_per_epoch(s, str(tmp_path / n)) for s, n in ((append, "one"), (second, "two"))]
    batch = frame(spark, (1, "a", "x"))
    for epoch in range(7):
        for sink in sinks:
            sink(batch, epoch)
    with pytest.raises(OSError):
        for sink in sinks:
            sink(batch, 7)
    for sink in sinks:
        sink(batch, 7)
    assert done == [(e, 1) for e in range(8)]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 8
    assert versions.versions(spark, str(tmp_path / "one"))[-1] == 7
