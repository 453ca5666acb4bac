"""Session settings for the jobs, and the folder for shared scratch data."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def build_session(app: str) -> SparkSession:
    """Session for a job; cluster sizing is left to spark-submit.

    The results do not depend on the session time zone, UTC only makes the
    displayed instants of the live tables the same everywhere.
    """
    spark = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach.

    It lies under ``spark.checkpoint.dir``, which must be set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever Spark can write one; nothing happens if there is none."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
