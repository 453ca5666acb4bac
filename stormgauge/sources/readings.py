"""The readings feed: JSON messages from Kafka or files, parsed to typed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stormgauge.sources.schemas import CORRUPT, PAYLOAD_SCHEMA, READING_SCHEMA
from stormgauge.streaming.kpis import attach_airports

JSON_OPTIONS = {"timeZone": "UTC"}  # event times carry no zone and mean UTC


def kafka_messages(
    spark: SparkSession,
    servers: str,
    topic: str = "weather_raw",
    starting: str = "latest",
    per_trigger: int = 1_000_000,
) -> DataFrame:
    """Streaming messages of a topic (``value`` as text).

    ``starting`` says where a query without a checkpoint begins, ``per_trigger`` bounds
    the messages of a micro-batch.  Needs Spark's Kafka connector on the class path.
    """
    return (
        spark.readStream.format("kafka")
        .options(**kafka_options(servers, topic, starting, per_trigger))
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def kafka_options(
    servers: str, topic: str, starting: str = "latest", per_trigger: int = 1_000_000
) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "maxOffsetsPerTrigger": str(per_trigger),
    }


def file_messages(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Streaming JSON lines (``value`` as text) of the files landing in a folder."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def parse_readings(messages: DataFrame, column: str = "value") -> DataFrame:
    """JSON text to reading columns; fields that do not parse are NULL."""
    parsed = F.from_json(F.col(column).cast("string"), READING_SCHEMA, JSON_OPTIONS)
    return messages.select(parsed.alias("data")).select("data.*")


def route_readings(
    messages: DataFrame, column: str = "value", required: Sequence[str] = ("airport_code",)
) -> DataFrame:
    """Parsed readings plus the message text and a ``failed`` flag.

    A message fails if it is not valid JSON for the schema, carries no event time (it
    could join no time window and would vanish silently) or lacks a ``required`` field: those
    are key columns of the table to be written, which may not be NULL.
    """
    options = {**JSON_OPTIONS, "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(
        F.col(column).cast("string"), f"{READING_SCHEMA}, {CORRUPT} string", options
    )
    failed = F.col(f"data.{CORRUPT}").isNotNull()
    for name in ("start_time_utc", *required):
        failed |= F.col(f"data.{name}").isNull()
    return (
        messages.withColumn("data", parsed)
        .withColumn("failed", failed)
        .withColumn("data", F.col("data").dropFields(CORRUPT))
    )


def good_readings(routed: DataFrame) -> DataFrame:
    return routed.where(~F.col("failed")).select("data.*")


def failed_messages(routed: DataFrame, column: str = "value") -> DataFrame:
    return routed.where("failed").select(column)


def flatten_payload(
    payloads: DataFrame,
    airports: DataFrame,
    observed_at: Column | None = None,
    body: str = "body",
) -> DataFrame:
    """Nested API responses (``airport_code``, JSON body) to flat readings.

    The airport row supplies place and zone, which are NULL for an airport that is
    not listed; one row per airport counts.  The event time is the time of
    observation (now, unless given).
    """
    current = F.from_json(F.col(body), PAYLOAD_SCHEMA)["current"]
    time = F.current_timestamp() if observed_at is None else observed_at
    flat = payloads.select(
        "airport_code", time.alias("start_time_utc"), current.alias("current")
    ).select("airport_code", "start_time_utc", "current.*")
    places = airports.select("airport_code", "state", "county", "timezone")
    measures = [c for c in flat.columns if c not in ("airport_code", "start_time_utc")]
    return attach_airports(flat, places).select(
        "airport_code", "state", "county", "timezone", "start_time_utc", *measures
    )
