"""Keyed upsert without a database: a changelog by epoch and its latest view."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormgauge.operators.ranking import latest_by_key
from stormgauge.sources.readings import failed_messages, good_readings

EPOCH = "epoch_id"


def changelog_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Micro-batch sink writing one folder per epoch.

    Only the epoch's own folder is overwritten, so a replayed epoch replaces
    itself.  An empty batch leaves no folder; testing for one beforehand would
    compute the batch twice.
    """

    def write(batch: DataFrame, epoch_id: int) -> None:
        (
            batch.withColumn(EPOCH, F.lit(epoch_id).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(EPOCH)
            .parquet(path)
        )

    return write


def read_latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Current table: the last emitted row per key."""
    return latest_by_key(spark.read.parquet(path), keys, EPOCH).drop(EPOCH)


def compact(spark: SparkSession, path: str, target: str, keys: Sequence[str]) -> None:
    """Write only the current row of each key to a fresh changelog.

    Rows keep their epoch, so a stopped query can go on with ``target``.
    """
    current = latest_by_key(spark.read.parquet(path), keys, EPOCH)
    current.hint("rebalance", EPOCH).write.partitionBy(EPOCH).parquet(target)


def dead_letter_sink(
    good: Callable[[DataFrame, int], None], failed: Callable[[DataFrame, int], None]
) -> Callable[[DataFrame, int], None]:
    """Micro-batch sink for routed messages: readings one way, bad messages the other."""

    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()
        try:
            good(good_readings(batch), epoch_id)
            failed(failed_messages(batch), epoch_id)
        finally:
            batch.unpersist()

    return write
