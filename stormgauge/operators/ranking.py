"""Keep-first, top-n and latest-version per group.

All three filter a ``row_number`` directly, which lets Spark limit each group
inside every map task before the shuffle: a key with a huge number of copies
sends at most ``n`` rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__row_number"


def top_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int = 1
) -> DataFrame:
    """The first ``n`` rows of every group in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn(_RANK, F.row_number().over(w)).where(F.col(_RANK) <= n).drop(_RANK)
    )


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``order``, ties broken by all other columns."""
    rest = [c for c in df.columns if c not in set(keys) | set(order)]
    return top_per_group(df, keys, [*order, *rest])


def latest_by_key(changelog: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Upsert view of an append-only log: the row with the highest version per key."""
    return top_per_group(changelog, keys, [F.col(version).desc()])
