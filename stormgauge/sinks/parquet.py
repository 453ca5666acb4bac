"""Partitioned Parquet output and its catalog table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from stormgauge.sources.schemas import EVENTS_CLEAN_PARTITIONS, EVENTS_CLEAN_SCHEMA


def write_partitioned(
    df: DataFrame, path: str, partition_by: Sequence[str] = EVENTS_CLEAN_PARTITIONS
) -> None:
    """Overwrite the partitions present in ``df``; others stay as they are.

    The rebalance hint brings the rows of a partition together for few, large
    files, and lets Spark split a partition that is too large for one task, where
    a plain repartition by month would send a whole month to one.
    """
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def write_bucketed(
    df: DataFrame, table: str, path: str, by: str, buckets: int, sort_by: Sequence[str] = ()
) -> None:
    """Catalog table whose files are bucketed by a distribution key.

    Joins and aggregates of such tables on ``by`` need no shuffle.  ``buckets`` is
    for the cluster to choose; rows are placed by it once, here.
    """
    writer = df.repartition(buckets, by).write.mode("overwrite").option("path", path)
    writer = writer.bucketBy(buckets, by)
    if sort_by:
        writer = writer.sortBy(*sort_by)
    writer.saveAsTable(table)


def buckets_of(spark: SparkSession, table: str) -> tuple[int, list[str]]:
    """Number of buckets of a catalog table and the columns they go by; (0, []) without."""
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    columns = told.get("Bucket Columns", "[]").strip("[]").replace("`", "")
    return int(told.get("Num Buckets", 0)), [c.strip() for c in columns.split(",") if c.strip()]


def join_colocated(
    spark: SparkSession, left: str, right: str, how: str = "inner", prepare_left=None, prepare_right=None
) -> DataFrame:
    """Join of two tables of the same buckets on their bucket column; neither is shuffled.

    ``prepare_left`` and ``prepare_right`` (``DataFrame -> DataFrame``) may filter a side or sum it
    up per key first, which needs no shuffle either.  Tables whose buckets differ would be shuffled
    unnoticed and are refused.  A key's rows are in one bucket, so a table should be summed up
    per key, or have bounded rows per key, before it is joined to many rows of the same key.
    """
    mine, theirs = buckets_of(spark, left), buckets_of(spark, right)
    if mine != theirs or not mine[0]:
        raise ValueError(f"{left} has buckets {mine}, {right} has {theirs}")
    sides = [
        prepare(spark.table(name)) if prepare else spark.table(name)
        for name, prepare in ((left, prepare_left), (right, prepare_right))
    ]
    # sorted buckets are merged; without the hint a side that looks small is broadcast
    return sides[0].hint("merge").join(sides[1], mine[1], how)


def register_external_table(
    spark: SparkSession,
    table: str,
    path: str,
    schema: str = EVENTS_CLEAN_SCHEMA,
    partition_by: Sequence[str] = EVENTS_CLEAN_PARTITIONS,
) -> None:
    """Create an external table over Parquet files and discover its partitions."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({schema}) USING parquet "
        f"PARTITIONED BY ({', '.join(partition_by)}) LOCATION '{path}'"
    )
    spark.catalog.recoverPartitions(table)
