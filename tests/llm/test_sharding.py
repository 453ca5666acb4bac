"""Extendible hashing against a directory that splits bucket by bucket."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stormgauge.llm.sharding import KEY_BITS, extendible_shards


def split(rows, limit):
    """Shard of each key by the definition: a bucket above the limit takes another bit."""
    bits = {}
    for key, _ in rows:
        digest = hashlib.md5(("" if key is None else str(key)).encode()).hexdigest()
        bits[key] = f"{int(digest[:10], 16):0{KEY_BITS}b}"
    open_buckets, out = [("", rows)], {}
    while open_buckets:
        prefix, held = open_buckets.pop()
        if sum(n or 0 for _, n in held) <= limit or len(held) == 1 or len(prefix) == KEY_BITS:
            out.update({key: prefix for key, _ in held})
            continue
        sides = defaultdict(list)
        for row in held:
            sides[bits[row[0]][len(prefix)]].append(row)
        open_buckets += [(prefix + bit, side) for bit, side in sides.items()]
    return out


def shards(spark, rows, limit):
    frame = spark.createDataFrame([(*r, "mine") for r in rows], "k long, n long, bytes string")
    return extendible_shards(frame, "k", F.col("n"), limit)


@pytest.mark.parametrize("limit", [40, 1000])
def test_shards_equal_the_definition(spark, limit):
    rng = random.Random(limit)
    rows = [(i, rng.choice([0, 1, 5, 30, 200])) for i in range(300)] + [(None, 7), (301, None)]
    found = shards(spark, rows, limit)
    assert found.columns[:3] == ["k", "n", "bytes"]
    found = found.collect()
    assert {r.k: r.shard_id for r in found} == split(rows, limit)
    totals = defaultdict(int)
    for r in found:
        totals[r.shard_id] += r.n or 0
    for r in found:
        assert r.shard_bytes == totals[r.shard_id] and r.shard_depth == len(r.shard_id)
        assert r.oversized == (r.shard_bytes > limit)
        assert not r.oversized or r.shard_rows == 1


def test_equal_rows_spread_over_shards(spark):
    found = shards(spark, [(7, 10)] * 500 + [(i, 10) for i in range(20)], 200).collect()
    assert len(found) == 520
    sizes = defaultdict(int)
    for r in found:
        sizes[r.shard_id] += r.n
    assert max(sizes.values()) <= 200


def test_one_shard_and_no_rows(spark):
    assert {r.shard_id for r in shards(spark, [(1, 5), (2, 5)], 100).collect()} == {""}
    assert shards(spark, [], 100).count() == 0
