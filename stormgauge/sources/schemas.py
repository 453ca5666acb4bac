"""Declared schemas of the inputs and of the cleaned table."""

from __future__ import annotations

CORRUPT = "_corrupt_record"

RAW_COLUMNS = (
    "EventId",
    "Type",
    "Severity",
    "StartTime(UTC)",
    "EndTime(UTC)",
    "Precipitation(in)",
    "TimeZone",
    "AirportCode",
    "LocationLat",
    "LocationLng",
    "City",
    "County",
    "State",
    "ZipCode",
)
RAW_SCHEMA = ", ".join(f"`{name}` string" for name in RAW_COLUMNS)

EVENTS_CLEAN_PARTITIONS = ("event_year", "event_month")
EVENTS_CLEAN_SCHEMA = (
    "event_id string, type string, severity string, start_time_utc timestamp_ntz, "
    "end_time_utc timestamp_ntz, duration_min double, timezone string, airport_code string, "
    "state string, county string, city string, zip_code string, location_lat double, "
    "location_lng double, precipitation_in double, event_date date, event_day int, "
    "hour_of_day int, dow int, season string, is_night boolean, local_start_ts timestamp_ntz, "
    "local_end_ts timestamp_ntz, event_year int, event_month int"
)

# every field any of the reading KPIs uses; JSON without a field yields NULL
READING_SCHEMA = (
    "airport_code string, state string, county string, timezone string, "
    "start_time_utc timestamp, precip_in double, temp_c double, humidity double, cloud double, "
    "wind_kph double, pressure_mb double, vis_km double, dewpoint_c double, uv double, "
    "gust_kph double, is_day int, gti double"
)

CURRENT_FIELDS = (
    "precip_in double, temp_c double, humidity double, cloud double, wind_kph double, "
    "pressure_mb double, vis_km double, dewpoint_c double, uv double, gust_kph double, "
    "is_day int, gti double"
)
PAYLOAD_SCHEMA = f"current struct<{CURRENT_FIELDS}>"

AIRPORT_SCHEMA = (
    "airport_code string, state string, county string, timezone string, "
    "location_lat double, location_lng double"
)
