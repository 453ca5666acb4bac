"""Fog and snow that overlap: every severity meets every other."""

import datetime

import pytest
from pyspark.sql import functions as F

from catalogue.primitives import QUERIES
from stormgauge.operators.overlaps import SLICE_ROWS, TILE_ROWS, block_entries, nested_overlap_join

SMALL = "/root/testdata/sf0.01"


def test_all_severities_meet(spark):
    keys = ["airport_code", "left_event_id", "right_event_id", "seconds"]
    heavy, every = (
        {tuple(r) for r in QUERIES[name](spark, SMALL).select(*keys).collect()}
        for name in ("overlapping_pairs", "overlapping_pairs_any_severity")
    )
    print("pairs", len(heavy), len(every))
    # a quarter of each side is heavy
    assert heavy < every and len(every) > 4 * len(heavy)


SCHEMA = "k string, id int, start_s long, end_s long"


@pytest.mark.parametrize("base, fan, levels", [(3600, 2, 1), (900, 4, 3), (10_800, 8, 4), (7, 2, 20)])
def test_nested_join_finds_each_pair_once(spark, base, fan, levels):
    # lengths from nothing to 300 days, times on both sides of 1970, ties and borders of blocks
    spans = [(i, (i * 7919) % 300_000 - 150_000, 10_800 * (i % 5) + 12 ** (i % 8)) for i in range(60)]
    spans = [(i, s - s % 900 if i % 3 else s, s + d - 1) for i, s, d in spans]
    spans += [(60, 0, 300 * 86_400), (61, 0, 300 * 86_400), (62, 0, 0), (63, 10_800, 21_600)]
    frame = spark.createDataFrame(
        [("K", *s) for s in spans] + [("K", 70, None, 5), ("K", 71, 5, None), (None, 72, 0, 10)], SCHEMA
    )
    got = nested_overlap_join(frame, frame, ["k"], base, fan, levels).select("left_id", "right_id")
    want = [
        (a[0], b[0])
        for a in spans for b in spans
        if a[1] < b[2] and b[1] < a[2] and a[2] > a[1] and b[2] > b[1]
    ]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_long_events_cost_few_rows(spark):
    year = spark.createDataFrame([("K", 1, 0, 300 * 86_400), ("K", 2, 0, 3_600)], SCHEMA)
    counts = dict(block_entries(year, True).groupBy("id").count().collect())
    assert counts[1] <= 9 + 4 and counts[2] == 1 + 4


def test_nested_join_of_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert nested_overlap_join(none, none, ["k"]).count() == 0


def test_nested_join_is_one_equi_join(spark):
    frame = spark.createDataFrame([("K", 1, 0, 10)], SCHEMA)
    plan = nested_overlap_join(frame, frame, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Union" not in plan and "Aggregate" not in plan


@pytest.mark.parametrize("tile_rows", [1, 7, SLICE_ROWS + 5, TILE_ROWS])
def test_tiles_find_the_same_pairs(spark, tile_rows):
    # lengths from nothing to 300 days; every third row is there twice
    spans = [(i % 3, i, (i * 7919) % 900_000 - 450_000, 10_800 * (i % 5) + 12 ** (i % 8)) for i in range(500)]
    rows = [(f"K{k}", i, s, s + d - 1) for k, i, s, d in spans for _ in range(1 + (i % 3 == 0))]
    rows += [("K0", 900, 0, 300 * 86_400), ("K0", 901, 0, 0), ("K0", 902, None, 5), ("K0", 903, 5, None)]
    frame = spark.createDataFrame(rows + [(None, 904, 0, 10), (None, 905, 0, 10)], SCHEMA)
    plain = nested_overlap_join(frame, frame, ["k"])
    tiled = nested_overlap_join(frame, frame, ["k"], tile_rows=tile_rows)
    assert tiled.schema == plain.schema
    got, want = (sorted(tuple(r) for r in pairs.collect()) for pairs in (tiled, plain))
    print("pairs", len(want))
    assert got == want and len(want) > 10_000


def test_tiles_of_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert nested_overlap_join(none, none, ["k"], tile_rows=TILE_ROWS).count() == 0


def test_a_busy_block_goes_to_several_tasks_and_small_files(spark, tmp_path):
    # one airport and day: 100 fogs of 100 to 290 days (event_id % 40 = 1), which begin before 9,000 snows
    day = datetime.datetime(2024, 1, 1)
    fog_ids = [i for i in range(1, 1_000_000, 40) if 100 <= i % 301 <= 290][:100]
    fogs = [(i, day, 10, "click", 1.0) for i in fog_ids]
    # their starts and lengths are scattered, as are their ids
    snows = [
        (40 * (i * 7919 % 9001), day + datetime.timedelta(seconds=60 + i * 7), 10, "purchase", 0.1 + i * 31 % 977)
        for i in range(9000)
    ]
    columns = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"
    spark.createDataFrame(fogs + snows, columns).write.parquet(f"{tmp_path}/events.parquet")
    pairs = QUERIES["overlapping_pairs_nested"](spark, str(tmp_path))
    by_task = pairs.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r[1] for r in by_task) == 900_000
    assert len(by_task) > 1 and max(r[1] for r in by_task) < 600_000

    pairs.write.parquet(f"{tmp_path}/pairs")
    size = sum(f.stat().st_size for f in (tmp_path / "pairs").glob("*.parquet"))
    print("bytes a pair", size / 900_000)
    assert size < 900_000
