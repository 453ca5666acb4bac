"""Weather-shaped views of the generic test tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stormgauge.functions.calendar import (
    instant_from_utc_wall,
    meteorological_season,
    night_hours,
    wall_seconds,
    wall_timestamp,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thirty days with many overlaps, from ``events``."""
    return (
        _table(spark, sf_dir, "events")
        .select(
            "event_id",
            "user_id",
            F.expr(
                "case event_type when 'click' then 'FOG' when 'error' then 'STORM' "
                "when 'purchase' then 'SNOW' when 'signup' then 'RAIN' else 'COLD' end"
            ).alias("type"),
            F.expr(
                "case event_id % 4 when 0 then 'Light' when 1 then 'Moderate' "
                "when 2 then 'Heavy' else 'Other' end"
            ).alias("severity"),
            F.expr("concat('K', cast(user_id % 10 as string))").alias("airport_code"),
            wall_seconds("ts").alias("start_s"),
            F.expr("cast(floor(value * 60) as bigint)").alias("dur_s"),
        )
        .select(
            "event_id",
            "user_id",
            "type",
            "severity",
            "airport_code",
            wall_timestamp("start_s").alias("local_start_ts"),
            wall_timestamp(F.col("start_s") + F.col("dur_s")).alias("local_end_ts"),
        )
    )


def sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several years of events per county, from ``orders`` and its dimensions."""
    joined = (
        _table(spark, sf_dir, "orders")
        .join(_table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
        .join(_table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(_table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
    )
    start_s = wall_seconds("o_orderdate") + F.expr("(o_orderkey * 37) % 1440") * 60
    return (
        joined.select(
            F.col("o_orderkey").alias("event_id"),
            F.expr(
                "case o_orderpriority when '1-URGENT' then 'SNOW' when '2-HIGH' then 'ICE' "
                "when '3-MEDIUM' then 'COLD' when '4-NOT SPECIFIED' then 'RAIN' else 'STORM' end"
            ).alias("type"),
            F.expr(
                "case o_orderstatus when 'F' then 'Heavy' when 'O' then 'Moderate' "
                "else 'Light' end"
            ).alias("severity"),
            F.col("r_name").alias("state"),
            F.expr("concat('C', cast(c_custkey % 4 as string))").alias("county"),
            F.expr("concat('K', cast(o_custkey % 10 as string))").alias("airport_code"),
            F.expr("30 + (o_orderkey * 53) % 1171").alias("dur_min"),
            start_s.alias("start_s"),
        )
        .select(
            "event_id",
            "type",
            "severity",
            "state",
            "county",
            "airport_code",
            F.col("dur_min").cast("double").alias("duration_min"),
            wall_timestamp("start_s").alias("local_start_ts"),
            wall_timestamp(F.col("start_s") + F.col("dur_min") * 60).alias("local_end_ts"),
        )
        .withColumns(
            {
                "season": meteorological_season(F.month("local_start_ts")),
                "is_night": night_hours(F.hour("local_start_ts")),
            }
        )
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor readings, from ``events``; event time is a TIMESTAMP instant."""
    double = {
        "precip_in": "case when event_id % 3 = 0 "
        "then cast(event_id % 10 as double) / cast(10 as double) else cast(0 as double) end",
        "temp_c": "event_id % 45 - 5",
        "humidity": "30 + event_id % 70",
        "cloud": "event_id % 101",
        "wind_kph": "event_id % 40",
        "pressure_mb": "980 + event_id % 60",
        "vis_km": "1 + event_id % 20",
        "dewpoint_c": "event_id % 45 - 5 - event_id % 15",
        "uv": "event_id % 12",
        "gust_kph": "event_id % 40 + event_id % 13",
        "gti": "event_id % 900",
    }
    return _table(spark, sf_dir, "events").select(
        "event_id",
        F.expr("concat('K', cast(user_id % 10 as string))").alias("airport_code"),
        F.expr("concat('S', cast(user_id % 5 as string))").alias("state"),
        F.expr("concat('C', cast(user_id % 10 as string))").alias("county"),
        F.lit("UTC").alias("timezone"),
        instant_from_utc_wall("ts").alias("start_time_utc"),
        F.expr("case when hour(ts) between 6 and 19 then 1 else 0 end").alias("is_day"),
        *[F.expr(f"cast({sql} as double)").alias(name) for name, sql in double.items()],
    )


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airport dimension, one row per airport code seen in ``events``."""
    return (
        _table(spark, sf_dir, "events")
        .select(F.expr("user_id % 10").alias("n"))
        .distinct()
        .select(
            F.expr("concat('K', cast(n as string))").alias("airport_code"),
            F.expr("concat('S', cast(n % 5 as string))").alias("state"),
            F.expr("concat('C', cast(n as string))").alias("county"),
            F.expr(
                "case n % 3 when 0 then 'US/Eastern' when 1 then 'US/Central' "
                "else 'US/Pacific' end"
            ).alias("timezone"),
            F.expr("cast(30 + n as double)").alias("location_lat"),
            F.expr("cast(-80 - n as double)").alias("location_lng"),
        )
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-string raw rows with the original header spelling, from ``events``.

    Derived flaws: padded lower-case types, repeated event ids (one copy of a
    row in seven, one hour later), bad numbers, zones and timestamps.
    """
    source = dense(spark, sf_dir).withColumn(
        "copy", F.explode(F.expr("case when event_id % 7 = 0 then array(0, 1) else array(0) end"))
    )
    start_s = wall_seconds("local_start_ts") + F.col("copy") * 3600
    end_s = wall_seconds("local_end_ts") + F.col("copy") * 3600
    return source.select(
        F.expr("concat('W-', cast(event_id as string))").alias("EventId"),
        F.expr("concat(' ', lower(type), ' ')").alias("Type"),
        F.expr("concat(lower(severity), ' ')").alias("Severity"),
        wall_timestamp(start_s).cast("string").alias("StartTime(UTC)"),
        F.when(F.expr("event_id % 97 = 5"), "not a time")
        .otherwise(wall_timestamp(end_s).cast("string"))
        .alias("EndTime(UTC)"),
        F.expr(
            "case when event_id % 50 = 3 then 'trace' "
            "else cast(cast(event_id % 8 as double) / cast(4 as double) as string) end"
        ).alias("Precipitation(in)"),
        F.expr(
            "case when event_id % 83 = 1 then 'Mars/Phobos' when event_id % 89 = 2 then '' "
            "when event_id % 79 = 3 then null "
            "else case user_id % 3 when 0 then 'US/Eastern' when 1 then 'US/Central' "
            "else 'US/Pacific' end end"
        ).alias("TimeZone"),
        F.col("airport_code").alias("AirportCode"),
        F.expr("cast(cast(30 + user_id % 10 as double) as string)").alias("LocationLat"),
        F.expr("cast(cast(-80 - user_id % 10 as double) as string)").alias("LocationLng"),
        F.expr("concat('City', cast(user_id as string))").alias("City"),
        F.expr("concat('C', cast(user_id % 10 as string))").alias("County"),
        F.expr("concat('S', cast(user_id % 5 as string))").alias("State"),
        F.expr("lpad(cast(user_id % 100000 as string), 5, '0')").alias("ZipCode"),
    )


def flawed_raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rows with further flaws, and a part of them forty days later.

    Lines the reader found malformed, missing and blank ids, starts that do not parse,
    white space around zones, and rows that come twice.
    """
    raw = raw_events(spark, sf_dir)
    number = F.substring("EventId", 3, 20).cast("bigint")
    forty_days = F.when(number % 5 == 0, 40 * 86400).otherwise(0)

    def moved(name: str) -> Column:
        at = F.col(name).try_cast("timestamp_ntz")
        return F.coalesce(wall_timestamp(wall_seconds(at) + forty_days).cast("string"), F.col(name))

    return raw.withColumn("n", number).withColumns(
        {
            "twice": F.explode(F.expr("case when n % 11 = 0 then array(0, 0) else array(0) end")),
            "StartTime(UTC)": F.when(F.col("n") % 109 == 13, "unknown").otherwise(
                moved("StartTime(UTC)")
            ),
            "EndTime(UTC)": moved("EndTime(UTC)"),
            "TimeZone": F.when(F.col("n") % 29 == 3, F.concat(F.lit("\t"), "TimeZone", F.lit(" \n")))
            .otherwise(F.col("TimeZone")),
            "EventId": F.when(F.col("n") % 101 == 7, F.lit(None))
            .when(F.col("n") % 103 == 9, "  ")
            .otherwise(F.col("EventId")),
            "_corrupt_record": F.when(F.col("n") % 107 == 11, F.concat(F.lit("cut,"), "EventId")),
        }
    ).drop("n", "twice")
