"""Curated tables: columns, keys and distribution, and checks against them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stormgauge.functions.weather import pair_label


@dataclass(frozen=True)
class Table:
    """A result table; ``place`` is the key its rows are distributed by."""

    name: str
    ddl: str
    key: tuple[str, ...]
    place: str
    created_at: bool = False

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]


AIRPORT_WINDOW = (
    "airport_code string not null, state string, county string, "
    "event_window_start timestamp not null, event_window_end timestamp not null, event_count int, "
)

# Names, columns and keys of the published tables.
_TABLES = (
    Table(
        "exposure_hours_daily",
        "airport_code string not null, event_date date not null, "
        "exposure_hours_day double not null, exposure_hours_30d double, exposure_hours_90d double",
        ("airport_code", "event_date"),
        "airport_code",
    ),
    Table(
        "longest_episodes",
        "airport_code string not null, type string not null, session_start timestamp_ntz not null, "
        "session_end timestamp_ntz not null, session_duration_hours double not null, "
        "events_in_session int not null",
        ("airport_code", "type", "session_start"),
        "airport_code",
    ),
    Table(
        "cooccurrence_minutes_daily",
        "airport_code string not null, event_date date not null, type_i string not null, "
        "type_j string not null, overlap_minutes double not null, type_pair string not null",
        ("airport_code", "event_date", "type_pair"),
        "airport_code",
    ),
    Table(
        "peak_exposure_3h_daily",
        "airport_code string not null, event_date date not null, p3h_minutes double not null, "
        "window_start timestamp_ntz not null, window_end timestamp_ntz not null",
        ("airport_code", "event_date"),
        "airport_code",
    ),
    Table(
        "monthly_risk_trend_by_type",
        "airport_code string not null, year int not null, month int not null, "
        "type string not null, avg_duration_min double not null, total_events bigint not null, "
        "mom_change_pct double",
        ("airport_code", "year", "month", "type"),
        "airport_code",
    ),
    Table(
        "winter_workload_index",
        "state string not null, county string not null, year int not null, month int not null, "
        "workload_index double not null, mom_change_pct double, rolling_3m_avg double, "
        "rank_in_state int",
        ("state", "county", "year", "month"),
        "state",
    ),
    Table(
        "risky_sequences",
        "state string not null, county string not null, seq_start_ts timestamp_ntz not null, "
        "seq_end_ts timestamp_ntz not null, duration_h double not null, sequence string not null",
        ("state", "county", "seq_start_ts"),
        "state",
    ),
    Table(
        "winter_burstiness",
        "state string not null, county string not null, season_year int not null, "
        "total_episodes int not null, episodes_over_threshold int not null, "
        "avg_interepisode_gap_h double, avg_episode_duration_h double, "
        "max_episode_duration_h double",
        ("state", "county", "season_year"),
        "state",
    ),
    Table(
        "night_thunderstorm_risk",
        "state string not null, county string not null, year int not null, month int not null, "
        "count_events int not null, count_night_events int not null, night_event_ratio double, "
        "avg_duration_h double, avg_severity_score double, rolling_3m_avg_duration double",
        ("state", "county", "year", "month"),
        "state",
    ),
    Table(
        "winter_fenology",
        "state string not null, county string not null, season_year int not null, "
        "first_event_ts timestamp_ntz not null, last_event_ts timestamp_ntz not null, "
        "season_length_days double not null, start_shift_days double, end_shift_days double, "
        "yoy_length_change_days double, rolling_3y_length_avg_days double",
        ("state", "county", "season_year"),
        "state",
    ),
    Table(
        "weather_events_realtime",
        AIRPORT_WINDOW + "avg_precipitation double, avg_temp_c double, avg_humidity double, "
        "avg_cloud double, avg_wind_kph double, avg_vis_km double, avg_pressure_mb double",
        ("airport_code", "event_window_start"),
        "airport_code",
        created_at=True,
    ),
    Table(
        "weather_realtime_sliding",
        AIRPORT_WINDOW + "total_precip_in double, avg_temp_c double, avg_humidity double, "
        "max_wind_kph double, min_vis_km double, rainy_rate double, heat_stress_rate double",
        ("airport_code", "event_window_start"),
        "airport_code",
        created_at=True,
    ),
    Table(
        "weather_state_analytics",
        "state string not null, interval_start timestamp not null, "
        "interval_end timestamp not null, event_count bigint, avg_temp_c double, "
        "min_temp_c double, max_temp_c double, stddev_temp_c double, avg_humidity double, "
        "stddev_humidity double, heat_stress_days int, weather_volatility double",
        ("state", "interval_start"),
        "state",
        created_at=True,
    ),
    Table(
        "weather_realtime_radiation",
        AIRPORT_WINDOW + "avg_temp_c double, avg_humidity double, min_dewpoint_spread double, "
        "avg_uv_index double, max_gust_kph double, daytime_rate double, avg_gti double",
        ("airport_code", "event_window_start"),
        "airport_code",
        created_at=True,
    ),
    Table(
        "weather_realtime_instability",
        AIRPORT_WINDOW + "min_dewpoint_spread double, stddev_pressure_mb double, "
        "max_gust_factor double, stddev_cloud double, instability_score double",
        ("airport_code", "event_window_start"),
        "airport_code",
        created_at=True,
    ),
)

TABLES = {table.name: table for table in _TABLES}


def conform(df: DataFrame, table: Table) -> DataFrame:
    """Columns in contract order and type, with generated and default columns."""
    names = table.schema.fieldNames()
    if "type_pair" in names and "type_pair" not in df.columns:
        df = df.withColumn("type_pair", pair_label(F.col("type_i"), F.col("type_j")))
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema]
    if table.created_at:
        columns.append(F.current_timestamp().alias("created_at"))
    return df.select(*columns)


def violations(df: DataFrame, table: Table) -> DataFrame:
    """One row: rows, rows with a missing required value, keys that occur twice or more.

    Rows are first counted per key, which Spark combines map-side, so repeated
    keys do not pile up in one task.
    """
    missing = reduce(or_, [F.col(c).isNull() for c in table.required])
    per_key = df.groupBy(*table.key).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(missing).alias("missing")
    )
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("row_count"),
        F.coalesce(F.sum("missing"), F.lit(0)).cast("bigint").alias("missing_values"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
    )


def require(df: DataFrame, table: Table) -> None:
    """Raise if ``df`` breaks the contract.  Runs one aggregate over ``df``."""
    found = violations(df, table).first()
    if found["missing_values"] or found["duplicate_keys"]:
        raise ValueError(f"{table.name} breaks its contract: {found.asDict()}")
