"""Ball-tree search against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stormgauge.llm import balltree


def brute(rows, k=5, scale=256):
    best = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        whole = [int(np.floor(scale * x)) for x in v]
        best[i] = max(best.get(i, whole), whole)
    out = []
    for q in sorted(best):
        if q % 50:
            continue
        scored = [
            (-sum(a * b for a, b in zip(best[q], v)), i)
            for i, v in best.items()
            if i != q and len(v) == len(best[q])
        ]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def found(spark, rows, k=5):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return sorted(tuple(r) for r in balltree.top_k(frame, F.col("vec_id") % 50 == 0, k).collect())


@pytest.mark.parametrize("shard", [60, 8192])
def test_results_equal_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(balltree, "SHARD_ROWS", shard)
    monkeypatch.setattr(balltree, "BLOCK_QUERIES", 3)
    rng = np.random.default_rng(shard)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(400)]
    rows += [(500 + i, rows[i % 7][1]) for i in range(120)]  # copies, so many ties
    assert found(spark, rows) == brute(rows)


def test_bad_vectors_take_no_part(spark):
    rng = random.Random(1)
    rows = [(i, [float(rng.randint(-2, 2)), 1.0]) for i in range(101)]
    rows += [(150, None), (151, [None, 1.0]), (200, [float("nan"), 1.0]), (250, [float("inf"), 0.0])]
    rows += [(None, [1.0, 1.0]), (300, [1.0]), (301, [2.0]), (100, [9.0, 9.0]), (100, [9.0, 9.0])]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []
    assert found(spark, [(50, [1.0, 2.0])]) == []
