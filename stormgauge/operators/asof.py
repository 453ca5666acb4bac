"""As-of join: the last row of another table at or before a row's time (or the first after).

How it scales
-------------
Time is cut into buckets, and all ordering happens per (key, bucket), so a busy key is
spread over its buckets.  A bucket without an earlier right row takes the last one of the
buckets before.  That one is found on at most one row per (key, bucket), which an aggregate
makes map-side; only these are ordered along a key.  Each row of either side is shuffled
once, and nothing is compared in pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stormgauge.functions.calendar import DAY_SECONDS, bucket_number


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: Column | str,
    right_time: Column | str,
    values: Sequence[str],
    direction: str = "backward",
    tolerance: int | None = None,
    exact: bool = True,
    bucket: int = DAY_SECONDS,
    as_of: str = "as_of_s",
) -> DataFrame:
    """All rows of ``left``, with ``values`` and the time ``as_of`` of the right row found.

    Times are whole seconds.  ``direction`` is ``backward`` (the nearest right row before) or
    ``forward`` (after); ``exact`` lets a right row of the same second count.  Rows further
    than ``tolerance`` seconds away are not found.  Of right rows of one second the one with
    the greatest ``values`` (in their order) is taken.  Rows with a NULL key or time
    find nothing and are not found.  Columns of ``left`` with the names of ``values`` are
    replaced.
    """
    if direction not in ("backward", "forward"):
        raise ValueError("direction is backward or forward")
    sign = 1 if direction == "backward" else -1
    time = {
        side: (F.col(t) if isinstance(t, str) else t).cast("bigint") * sign
        for side, t in (("left", left_time), ("right", right_time))
    }
    key_columns = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    names = [f"_k{i}" for i in range(len(keys))]
    place = [*names, "_bucket"]

    rights = right.select(
        *key_columns, time["right"].alias("_t"), F.struct(*values).alias("_found")
    ).na.drop(subset=[*names, "_t"])
    rights = rights.withColumn("_bucket", bucket_number("_t", bucket))
    lefts = left.select(F.struct("*").alias("_row"), *key_columns, time["left"].alias("_t"))
    known = F.col("_t").isNotNull()
    for name in names:
        known &= F.col(name).isNotNull()
    # rows that find nothing need no common place
    anywhere = F.monotonically_increasing_id()
    lefts = lefts.withColumn("_bucket", F.when(known, bucket_number("_t", bucket)).otherwise(anywhere))

    last = rights.groupBy(*place).agg(F.max(F.struct("_t", "_found")).alias("_last"))
    asked = lefts.where(known).select(*place).distinct()
    chain = last.select(*place, "_last", F.lit(False).alias("_asked")).unionByName(
        asked.withColumns({"_last": F.lit(None).cast(last.schema["_last"].dataType), "_asked": F.lit(True)})
    )
    chain = chain.groupBy(*place).agg(F.max("_last").alias("_last"), F.max("_asked").alias("_asked"))
    before = Window.partitionBy(*names).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = chain.withColumn("_carried", F.last("_last", ignorenulls=True).over(before))
    carried = carried.where(F.col("_asked") & F.col("_carried").isNotNull()).select(
        *place, F.col("_carried._t").alias("_t"), F.col("_carried._found").alias("_found")
    )

    side = F.lit(0 if exact else 2)
    marked = rights.select(*place, "_t", "_found").unionByName(carried).withColumn("_side", side)
    rows = lefts.withColumn("_side", F.lit(1)).unionByName(marked, allowMissingColumns=True)
    so_far = (
        Window.partitionBy(*place)
        .orderBy("_t", "_side", "_found")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    seen = F.when(F.col("_side") != 1, F.struct("_t", "_found"))
    rows = rows.withColumn("_seen", F.last(seen, ignorenulls=True).over(so_far)).where("_side = 1")
    if tolerance is not None:
        near = F.col("_t") - F.col("_seen._t") <= tolerance
        rows = rows.withColumn("_seen", F.when(near, F.col("_seen")))
    kept = [F.col("_row")[c].alias(c) for c in left.columns if c not in (*values, as_of)]
    return rows.select(
        *kept,
        *[F.col("_seen._found")[v].alias(v) for v in values],
        (F.col("_seen._t") * sign).alias(as_of),
    )
