"""DuckDB SQL for the reading KPIs, feed parsing and keyed sinks."""

READINGS = """
readings as (
  select event_id, concat('K', cast(user_id % 10 as varchar)) as airport_code,
    concat('S', cast(user_id % 5 as varchar)) as state,
    concat('C', cast(user_id % 10 as varchar)) as county, 'UTC' as timezone, user_id,
    date_trunc('second', ts) as start_time_utc, cast(floor(epoch(ts)) as bigint) as sec,
    case when event_id % 3 = 0 then cast(event_id % 10 as double) / cast(10 as double)
      else cast(0 as double) end as precip_in,
    cast(event_id % 45 - 5 as double) as temp_c, cast(30 + event_id % 70 as double) as humidity,
    cast(event_id % 101 as double) as cloud, cast(event_id % 40 as double) as wind_kph,
    cast(980 + event_id % 60 as double) as pressure_mb,
    cast(1 + event_id % 20 as double) as vis_km,
    cast(event_id % 45 - 5 - event_id % 15 as double) as dewpoint_c,
    cast(event_id % 12 as double) as uv,
    cast(event_id % 40 + event_id % 13 as double) as gust_kph,
    cast(event_id % 900 as double) as gti,
    case when hour(ts) between 6 and 19 then 1 else 0 end as is_day
  from events
)"""

SLIDING = f"""
{READINGS},
spread as (
  select *, make_timestamp(((sec // 1800 - k) * 1800) * 1000000) as event_window_start
  from (select *, unnest([0, 1, 2, 3]) as k from readings)
)"""

PLACE = """airport_code, state, county, event_window_start,
  event_window_start + interval 2 hours as event_window_end"""

SLIDING_KPI = f"""
with {SLIDING}
select {PLACE}, count(*) as event_count, r6(sum(precip_in)) as total_precip_in,
  r6(avg(temp_c)) as avg_temp_c, r6(avg(humidity)) as avg_humidity,
  max(wind_kph) as max_wind_kph, min(vis_km) as min_vis_km,
  r6(avg(case when precip_in > 0 then cast(1 as double) else 0 end)) as rainy_rate,
  r6(avg(case when temp_c >= 30 and humidity >= 60 then cast(1 as double) else 0 end))
    as heat_stress_rate
from spread group by airport_code, state, county, event_window_start"""

MEASURES = (
    "precip_in, temp_c, humidity, cloud, wind_kph, pressure_mb, vis_km, dewpoint_c, uv, "
    "gust_kph, gti"
)

ZONE = """case (user_id % 10) % 3 when 0 then 'US/Eastern' when 1 then 'US/Central'
    else 'US/Pacific' end"""

# starts of events that are not light, one for each airport and second
STARTS = f"""
{READINGS},
starts as (
  select concat('K', cast(user_id % 10 as varchar)) as airport_code, max(event_id) as last_event,
    cast(floor(epoch(ts)) as bigint) as start_s
  from events where event_id % 4 <> 0 group by 1, 3
),
named as (
  select s.*, case event_type when 'click' then 'FOG' when 'error' then 'STORM'
      when 'purchase' then 'SNOW' when 'signup' then 'RAIN' else 'COLD' end as type,
    case event_id % 4 when 1 then 'Moderate' when 2 then 'Heavy' else 'Other' end as severity
  from starts as s join events on event_id = last_event
)"""

ORACLES = {
    "as_of_event_state": f"""
with {STARTS}
select r.event_id, r.airport_code, r.sec, n.last_event, n.type, n.severity, n.start_s as as_of_s
from readings as r left join named as n on n.airport_code = r.airport_code
  and n.start_s = (select max(s.start_s) from starts as s where s.airport_code = r.airport_code
    and s.start_s < r.sec and s.start_s >= r.sec - 3600)""",
    "as_of_next_event": f"""
with {STARTS}
select r.event_id, r.airport_code, r.sec, n.last_event, n.type, n.start_s as as_of_s
from readings as r left join named as n on n.airport_code = r.airport_code
  and n.start_s = (select min(s.start_s) from starts as s where s.airport_code = r.airport_code
    and s.start_s >= r.sec)""",
    # landings by time, every tenth reading one later; windows of 2 hours wait for 15 minutes
    "late_readings_aside": f"""
with {READINGS},
landed as (
  select event_id, sec, least(2, case when sec < 1704931200 then 0 when sec < 1705795200 then 1 else 2 end
    + case when event_id % 10 = 0 then 1 else 0 end) as part
  from readings
),
bounds as (
  select p.part, (select max(l.sec) - 900 from landed as l where l.part < p.part) as bound
  from (select distinct part from landed) as p
),
counted as (
  select l.event_id, (select count(*) from (select unnest([0, 1, 2, 3]) as k) as w
    where (l.sec // 1800 - w.k) * 1800 + 7200 <= b.bound) as n_closed
  from landed as l join bounds as b on b.part = l.part
)
select event_id, n_closed < 4 as passed, cast(n_closed as integer) as n_closed from counted""",
    "stream_tumbling_5h": f"""
with {READINGS},
placed as (select *, make_timestamp((sec // 18000) * 18000 * 1000000) as event_window_start
           from readings)
select airport_code, state, county, event_window_start,
  event_window_start + interval 5 hours as event_window_end, count(*) as event_count,
  r6(avg(precip_in)) as avg_precipitation, r6(avg(temp_c)) as avg_temp_c,
  r6(avg(humidity)) as avg_humidity, r6(avg(cloud)) as avg_cloud,
  r6(avg(wind_kph)) as avg_wind_kph, r6(avg(vis_km)) as avg_vis_km,
  r6(avg(pressure_mb)) as avg_pressure_mb
from placed group by airport_code, state, county, event_window_start""",
    "stream_sliding_kpi": SLIDING_KPI,
    "stream_sliding_kpi_with_airports": SLIDING_KPI,
    "changelog_upsert": SLIDING_KPI,
    "merge_on_read": SLIDING_KPI,
    "merge_on_read_asked_keys": f"""
select * from ({SLIDING_KPI}) where airport_code between 'K3' and 'K5'
  and event_window_start between make_timestamp(1705276800000000) and make_timestamp(1705449600000000)""",
    # of the places read for an airport the smallest goes along
    "stream_run_sliding_kpi": SLIDING_KPI.replace(
        "concat('C', cast(user_id % 10 as varchar)) as county",
        "case when user_id % 10 = 3 and event_id % 4 = 1 then 'D3' "
        "else concat('C', cast(user_id % 10 as varchar)) end as county",
    )
    .replace("select airport_code, state, county, event_window_start,", "select airport_code, min(state) as state, min(county) as county, event_window_start,")
    .replace("group by airport_code, state, county, event_window_start", "group by airport_code, event_window_start"),
    "stream_state_6h": f"""
with {READINGS},
placed as (select *, make_timestamp((sec // 21600) * 21600 * 1000000) as interval_start
           from readings),
grouped as (
  select state, interval_start, count(*) as event_count, avg(temp_c) as m, min(temp_c) as min_temp_c,
    max(temp_c) as max_temp_c, stddev_samp(temp_c) as sd_t, avg(humidity) as h,
    stddev_samp(humidity) as sd_h,
    count(*) filter (where temp_c >= 30 and humidity >= 60) as heat_stress_days
  from placed group by state, interval_start
)
select state, interval_start, interval_start + interval 6 hours as interval_end, event_count,
  r6(m) as avg_temp_c, min_temp_c, max_temp_c, r6(sd_t) as stddev_temp_c, r6(h) as avg_humidity,
  r6(sd_h) as stddev_humidity, heat_stress_days, r6(sd_t + sd_h) as weather_volatility
from grouped""",
    "stream_radiation": f"""
with {SLIDING}
select {PLACE}, count(*) as event_count, r6(avg(temp_c)) as avg_temp_c,
  r6(avg(humidity)) as avg_humidity, min(temp_c - dewpoint_c) as min_dewpoint_spread,
  r6(avg(uv)) as avg_uv_index, max(gust_kph) as max_gust_kph,
  r6(avg(case when is_day = 1 then cast(1 as double) else 0 end)) as daytime_rate,
  r6(avg(gti)) as avg_gti
from spread group by airport_code, state, county, event_window_start""",
    "stream_instability": f"""
with {SLIDING},
grouped as (
  select airport_code, state, county, event_window_start, count(*) as event_count,
    min(temp_c - dewpoint_c) as sp, stddev_samp(pressure_mb) as sd_p,
    max(case when wind_kph > 0 then gust_kph / wind_kph else cast(1 as double) end) as gf,
    stddev_samp(cloud) as sd_c
  from spread group by airport_code, state, county, event_window_start
)
select {PLACE}, event_count, sp as min_dewpoint_spread, r6(sd_p) as stddev_pressure_mb,
  r6(gf) as max_gust_factor, r6(sd_c) as stddev_cloud,
  r6(cast(1 as double) / nullif(sp + cast(0.1 as double), 0) + sd_p / 10 + gf + sd_c / 20)
    as instability_score
from grouped""",
    "stream_static_join": f"""
with {READINGS}
select event_id, airport_code, state, county, timezone,
  cast(30 + user_id % 10 as double) as location_lat,
  cast(-80 - user_id % 10 as double) as location_lng
from readings""",
    "latest_by_key": f"""
with {READINGS}
select airport_code, sec // 3600 as hour_number, event_id as version, temp_c, humidity
from readings
qualify row_number() over (partition by airport_code, sec // 3600 order by event_id desc) = 1""",
    "dead_letter_split": f"""
with {READINGS},
marked as (select *, event_id % 50 = 0 or event_id % 70 = 0 as bad from readings)
select event_id, case when bad then 'failed' else 'good' end as branch,
  case when not bad then airport_code end as airport_code,
  case when not bad then temp_c end as temp_c, case when not bad then is_day end as is_day
from marked""",
    "parsed_readings": f"""
with {READINGS}
select airport_code, state, county, timezone, start_time_utc, is_day, {MEASURES}
from readings""",
    "flatten_payload": f"""
with {READINGS}
select airport_code, state, county, {ZONE} as timezone, start_time_utc, is_day, {MEASURES}
from readings""",
    "airport_csv_scan": f"""
with {READINGS}
select distinct airport_code, state, county, {ZONE} as timezone,
  cast(30 + user_id % 10 as double) as location_lat,
  cast(-80 - user_id % 10 as double) as location_lng
from readings order by airport_code limit 5""",
}
