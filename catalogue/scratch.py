"""Where the registered queries write what they read back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from stormgauge import session


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """Below ``spark.checkpoint.dir``; a local session without it gets a temporary folder."""
    master = spark.sparkContext.master
    if not spark.conf.get("spark.checkpoint.dir", None) and (
        master == "local" or master.startswith("local[")
    ):
        return f"{tempfile.mkdtemp(prefix='stormgauge-')}/{purpose}-{uuid.uuid4().hex}"
    return session.shared_folder(spark, purpose)
