"""Readings that come too late, kept aside instead of dropped unseen.

Spark drops a row from a window that the watermark has passed and says so only in a counter.
Here a query of its own splits the feed before: readings with a window still open go on, those
with a closed one are kept in a second folder, and the KPI reads what goes on.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stormgauge.sinks.versions import commit, ensure_folder, forget, move_once, version_text, versions

ON_TIME, LATE, BOUND = "on_time", "late", "bound"
KEPT = 5  # bounds left; only the newest counts


@dataclass(frozen=True)
class Span:
    """Windows of ``width`` seconds, one every ``slide`` seconds, waited for ``delay`` seconds."""

    delay: int
    width: int
    slide: int

    def __post_init__(self) -> None:
        if self.width % self.slide:
            raise ValueError("the width must be a multiple of the slide")

    @property
    def per_row(self) -> int:
        return self.width // self.slide

    def closed(self, time: Column, bound_ms: int | None) -> Column:
        """How many of a row's windows end at ``bound_ms`` or before."""
        if bound_ms is None:
            return F.lit(0)
        last_end = (F.floor(F.unix_seconds(time) / self.slide) * self.slide + self.width) * 1000
        still_open = F.ceil((last_end - F.lit(bound_ms)) / (self.slide * 1000))
        return (self.per_row - F.greatest(F.lit(0), F.least(F.lit(self.per_row), still_open))).cast("int")


def late_split_sink(
    folder: str, span: Span, time: str = "start_time_utc"
) -> Callable[[DataFrame, int], None]:
    """Micro-batch sink that splits rows into ``folder/on_time`` and ``folder/late``.

    The bound is the greatest time of all epochs before, less the delay, as for a watermark.  A
    row goes on if one of its windows is open (or its time is NULL); it is kept aside, with the
    number ``n_closed`` of its closed windows, if there is one.  A row with both is in both.

    A replayed epoch is split by the same bound, and its folders appear once: they are renamed
    into place when whole, and the one that is there stays.  Only the bound passes the driver.
    """

    def write(batch: DataFrame, epoch_id: int) -> None:
        spark, bounds = batch.sparkSession, f"{folder}/{BOUND}"
        held = versions(spark, bounds)
        if held and epoch_id <= held[-1]:
            return
        newest = version_text(spark, bounds, held[-1]) if held else ""
        batch.persist()
        try:
            bound = int(newest) - span.delay * 1000 if newest else None
            rows = batch.withColumn("n_closed", F.coalesce(span.closed(F.col(time), bound), F.lit(0)))
            parts = {
                ON_TIME: rows.where(F.col("n_closed") < span.per_row).drop("n_closed"),
                LATE: rows.where(F.col("n_closed") > 0),
            }
            for name, part in parts.items():
                staged = f"{folder}/staged-{uuid.uuid4().hex}"
                part.write.parquet(staged)
                move_once(spark, staged, f"{folder}/{name}/epoch-{epoch_id:020d}")
            latest = batch.agg(F.max(F.unix_millis(time))).first()[0]
        finally:
            batch.unpersist()
        known = [t for t in (latest, int(newest) if newest else None) if t is not None]
        commit(spark, bounds, epoch_id, str(max(known)) if known else "")
        for old in held[: 1 - KEPT]:
            forget(spark, bounds, old)

    return write


def on_time_stream(spark: SparkSession, folder: str, schema) -> DataFrame:
    """The rows that go on, as a stream.

    Its query must take epochs whole and in order, as it does without a limit of files; its own
    watermark then is never ahead of the bound, so it drops no row of an open window.
    """
    path = f"{folder}/{ON_TIME}"
    ensure_folder(spark, path)
    return spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(path)


def late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """All rows kept aside so far, with ``n_closed``."""
    return spark.read.option("recursiveFileLookup", True).parquet(f"{folder}/{LATE}")


def on_time_rows(spark: SparkSession, folder: str) -> DataFrame:
    """All rows that went on so far."""
    return spark.read.option("recursiveFileLookup", True).parquet(f"{folder}/{ON_TIME}")
