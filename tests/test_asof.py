"""The as-of join against a search row by row, and its plan."""

import random

import pytest
from pyspark.sql import functions as F

from stormgauge.operators.asof import as_of_join

LEFT = "id int, k string, t long"
RIGHT = "k string, u long, kind string, n int"


def brute(left, right, direction, tolerance, exact):
    out = []
    for row, k, t in left:
        best = None
        for key, u, kind, n in right:
            if None in (k, t, key, u) or k != key:
                continue
            away = t - u if direction == "backward" else u - t
            if away < 0 or (away == 0 and not exact) or (tolerance is not None and away > tolerance):
                continue
            rank = (-away, kind is not None, kind or "", n)
            if best is None or rank > best[0]:
                best = (rank, kind, n, u)
        out.append((row, *(best[1:] if best else (None, None, None))))
    return sorted(out, key=str)


def found(spark, left, right, **parameters):
    made = as_of_join(
        spark.createDataFrame(left, LEFT),
        spark.createDataFrame(right, RIGHT),
        ["k"],
        "t",
        "u",
        ["kind", "n"],
        **parameters,
    )
    return sorted((tuple(r) for r in made.select("id", "kind", "n", "as_of_s").collect()), key=str)


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("tolerance, exact", [(None, True), (None, False), (40, True), (0, True), (40, False)])
def test_equals_search(spark, direction, tolerance, exact):
    rng = random.Random(f"{direction}{tolerance}{exact}")

    def key():
        return rng.choice(["a", "a", "a", "b", "c", None])

    def time():
        return rng.choice([None, *(rng.randint(-300, 300) for _ in range(9))])

    left = [(i, key(), time()) for i in range(150)]
    right = [(key(), time(), rng.choice(["x", "y", None]), rng.randint(0, 3)) for _ in range(60)]
    # small buckets, so that most rows look back over several of them
    parameters = dict(direction=direction, tolerance=tolerance, exact=exact)
    assert found(spark, left, right, bucket=50, **parameters) == brute(left, right, **parameters)
    assert found(spark, left, right, **parameters) == brute(left, right, **parameters)


def test_empty_sides_repeats_and_clashing_names(spark):
    left, right = [(1, "a", 5), (1, "a", 5)], [("a", 4, "x", 1), ("a", 4, "x", 1)]
    assert found(spark, left, right) == [(1, "x", 1, 4)] * 2
    assert found(spark, left, []) == [(1, None, None, None)] * 2
    assert found(spark, [], right) == []
    own = spark.createDataFrame([("a", 5, "own", 7)], "k string, t long, kind string, as_of_s int")
    made = as_of_join(own, spark.createDataFrame(right, RIGHT), ["k"], "t", "u", ["kind"])
    assert [tuple(r) for r in made.collect()] == [("a", 5, "x", 4)]
    with pytest.raises(ValueError):
        as_of_join(own, own, ["k"], "t", "t", ["kind"], direction="nearest")


def test_a_busy_key_is_ordered_by_bucket(spark):
    day = 86_400
    left = spark.range(2000).select(F.col("id").cast("int").alias("id"), F.lit("a").alias("k"), (F.col("id") * 600).alias("t"))
    right = spark.range(50).select(F.lit("a").alias("k"), (F.col("id") * (day // 4)).alias("u"), F.lit("x").alias("kind"), F.col("id").cast("int").alias("n"))
    made = as_of_join(left, right, ["k"], "t", "u", ["kind", "n"])
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan
    windows = [line for line in plan.splitlines() if "Window [" in line]
    # rows of either side by (key, bucket); along a key go only the last rows of buckets
    assert len(windows) == 2
    got = made.groupBy().agg(F.sum(F.col("n").cast("long")).alias("s")).first().s
    assert got == sum(min(i * 600 // (day // 4), 49) for i in range(2000))
