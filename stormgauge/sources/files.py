"""Batch file sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormgauge.sources.schemas import (
    AIRPORT_SCHEMA,
    CORRUPT,
    EVENTS_CLEAN_SCHEMA,
    RAW_SCHEMA,
)


def dated_path(base: str, run_date: str) -> str:
    """Landing folder of one run date."""
    return f"{base.rstrip('/')}/{run_date}"


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw event CSV with header; all columns strings, malformed lines kept.

    The declared schema avoids an inference pass.  The header is checked against
    it, so files with other or reordered columns fail instead of shifting values.
    """
    return (
        spark.read.schema(f"{RAW_SCHEMA}, {CORRUPT} string")
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        # a line is malformed by all its fields, also where a query needs only some
        .option("columnPruning", False)
        .option("enforceSchema", False)
        .csv(path)
    )


def read_events(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    months: tuple[str, str] | None = None,
) -> DataFrame:
    """The cleaned table, optionally cut to columns and a range of UTC months.

    ``months=("2019-11", "2020-03")`` becomes a filter on the partition columns,
    so only those partitions are listed and read.
    """
    events = spark.read.schema(EVENTS_CLEAN_SCHEMA).parquet(path)
    if months:
        first, last = (int(m[:4]) * 12 + int(m[5:7]) for m in months)
        at = F.col("event_year") * 12 + F.col("event_month")
        events = events.where(at.between(first, last))
    return events.select(*columns) if columns else events


def read_airports(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Airport dimension CSV with header; ``limit`` takes the first rows of the file."""
    airports = (
        spark.read.schema(AIRPORT_SCHEMA)
        .option("header", True)
        .option("enforceSchema", False)
        .csv(path)
    )
    return airports.limit(limit) if limit is not None else airports
