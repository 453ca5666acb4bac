"""Rows ranked within parts of a group first."""

import time

import numpy as np

from pyspark.sql import functions as F

from stormgauge.llm import common
from stormgauge.llm.common import CLEANUP, first_rows_per, staged


def test_first_rows_are_cut_before_a_group_meets(spark):
    frame = spark.range(20_000).selectExpr("id", "if(id % 8 = 0, 'b', 'a') as label")
    hashed = frame.withColumn("h", F.xxhash64("id")).collect()
    made = first_rows_per(frame, "label", [F.xxhash64("id"), "id"], 1500)
    expected = {
        (r.id, r.label)
        for label in "ab"
        for r in sorted((r for r in hashed if r.label == label), key=lambda r: (r.h, r.id))[:1500]
    }
    rows = [tuple(r) for r in made.collect()]
    assert len(rows) == 3000 and set(rows) == expected
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("row_number()") == 2


def test_bounded_sample_takes_whole_texts_up_to_its_bytes(spark):
    rows = [(i, "a", "x" * 10) for i in range(30)] + [(99, "b", "y" * 5000), (100, "b", None)]
    rows += [(7, "a", "x" * 10), (7, "a", "another text of the same id"), (8, "a", None)]
    frame = spark.createDataFrame(rows, "doc_id long, label string, text string")
    ids = frame.select(*common.text_keys("doc_id", "text"), "label")
    texts = frame.select("doc_id", "text")

    def sample(per_label, label_bytes):
        return common.bounded_sample(ids, texts, per_label, label_bytes).to_pylist()

    everything = sample(100, 10_000)
    assert [r["doc_id"] for r in everything] == [*range(30), 99]
    # the text that reaches the bound is the last one, and is taken whole
    few = sample(100, 45)
    assert sum(r["label"] == "a" for r in few) in (3, 4, 5) and few[-1]["text"] == "y" * 5000
    assert len(sample(4, 10_000)) == 5 and all(r in everything for r in sample(4, 10_000))
    assert sample(4, 10_000) == sample(4, 10_000)
    assert common.bounded_sample(ids.limit(0), texts, 4, 100).num_rows == 0


def test_shuffle_files_of_a_staged_table_are_deleted(spark):
    """op6: the files of every pass stayed on the disk until the driver collected its garbage."""

    def files():
        held = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {held.apply(i).getName() for i in range(held.size()) if held.apply(i).getName().startswith("shuffle_")}

    before, key = files(), spark.conf.get(CLEANUP)
    own = spark.range(1000).repartition(7, "id")
    made = [staged(own.groupBy(F.col("id") % 10).count(), "one"), staged(own, "two")]
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before and spark.conf.get(CLEANUP) == key
    assert [frame.count() for frame in (*made, own)] == [10, 1000, 1000]


def test_all_training_rows_are_dealt_to_shards(spark, monkeypatch):
    """of each class 2,500 rows at most were learned from."""
    monkeypatch.setattr(common, "SHARD_BYTES", 20_000)
    rows = [(i, "a" if i % 10 else "b", f"text {i}") for i in range(9000)]
    rows += [(7, "a", "text 7"), (None, "a", "x"), (8, None, "x"), (9, "a", None)]
    frame = spark.createDataFrame(rows, "doc_id long, label string, text string")
    made = common.training_rows(frame.withColumn("bytes", F.octet_length("text")))
    found = made.collect()
    assert sorted(r.doc_id for r in found) == list(range(9000))
    assert len({r.shard for r in found}) == 4 and 1500 < sum(r.held for r in found) < 2100


def test_mean_of_shards_is_weighted(spark):
    wide = common.SLICE + 3

    def part(table):
        shard = table["id"][0].as_py()
        return common.sliced(shard, shard + 1, np.arange(wide) + 4.0 * shard)

    parts = spark.range(3).groupBy("id").applyInArrow(part, common.PARTS_SCHEMA)
    assert np.allclose(common.averaged(parts), np.arange(wide) + (0 + 8 + 24) / 6)


def test_more_buckets_than_spark_allows(spark):
    key = "spark.sql.sources.bucketing.maxBuckets"
    before = spark.conf.get(key)
    spark.conf.set(key, 2)
    try:
        made = common.staged_buckets(spark.range(20).selectExpr("id", "id % 5 AS k"), "k", 7, "buckets")
    finally:
        spark.conf.set(key, before)
    counted = made.groupBy("k").count()
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in counted.collect()) == [(k, 4) for k in range(5)]
    common.discard(made)
