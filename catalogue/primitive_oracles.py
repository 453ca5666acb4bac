"""DuckDB SQL for the building blocks."""

from catalogue.batch_oracles import DENSE, ORACLES as BATCH, SPARSE, _day_islands, _secs
from catalogue.batch_oracles import _active, _segments, _sessions
from catalogue.live_oracles import READINGS

RAW = f"""
{DENSE},
raw as (
  select *, s + to_hours(copy) as s2,
    case when event_id % 83 = 1 then 'Mars/Phobos' when event_id % 89 = 2 then ''
      when event_id % 79 = 3 then null
      else case user_id % 3 when 0 then 'US/Eastern' when 1 then 'US/Central'
        else 'US/Pacific' end end as zone
  from (select *, unnest(case when event_id % 7 = 0 then [0, 1] else [0] end) as copy from dense)
)"""

MONTHLY = f"""
{SPARSE},
monthly as (
  select state, county, cast(year(s) as integer) as year, cast(month(s) as integer) as month,
    count(*) as n from sparse group by all
)"""

ORACLES = {
    "parquet_scan_pruned": """
select o_orderkey, o_orderpriority, o_orderstatus from orders
where o_orderpriority in ('1-URGENT', '2-HIGH')""",
    "header_normalisation": f"""
with {RAW}
select concat('W-', cast(event_id as varchar)) as eventid, concat(' ', lower(type), ' ') as type,
  strftime(s2, '%Y-%m-%d %H:%M:%S') as starttime_utc_,
  case when event_id % 50 = 3 then 'trace'
    else cast(cast(event_id % 8 as double) / 4 as varchar) end as precipitation_in_,
  lpad(cast(user_id % 100000 as varchar), 5, '0') as zipcode
from raw""",
    "raw_csv_scan": f"""
with {RAW}
select concat('W-', cast(event_id as varchar)) as eventid, lower(type) as type,
  strftime(s2, '%Y-%m-%d %H:%M:%S') as starttime_utc_, nullif(zone, '') as timezone,
  lpad(cast(user_id % 100000 as varchar), 5, '0') as zipcode
from raw""",
    "partitioned_parquet_sink": f"""
select event_id, type, local_start_ts, event_year, event_month
from ({BATCH["clean_events"]}) as c
where event_year * 12 + event_month between 2023 * 12 + 12 and 2024 * 12 + 1""",
    "external_table": f"""
select event_id, severity, event_date, event_year from ({BATCH["clean_events"]}) as c""",
    "contract_conform": f"""
select *, concat(type_i, '+', type_j) as type_pair
from ({BATCH["cooccurrence_minutes_daily"]}) as c""",
    "bucketed_table": f"""
with {DENSE},
days as (select airport_code, s, e, unnest(generate_series(date_trunc('day', s),
           date_trunc('day', e), interval 1 day)) as d
         from dense where e > s
           and (type in ('FOG', 'SNOW') or severity in ('Moderate', 'Heavy'))),
daily as (
  select airport_code, cast(d as date) as event_date,
    sum({_secs("greatest(s, d)", "least(e, d + interval 1 day)")}) as secs
  from days group by all
)
select airport_code, count(*) as days, r2(cast(max(secs) as double) / 3600) as worst_day,
  max(event_date) as last_date
from daily group by airport_code""",
    "colocated_join": f"""
select * from (
  select airport_code, count(*) as days, max(exposure_hours_day) as worst_day
  from ({BATCH["exposure_hours_daily"]}) as d group by airport_code
) as d full join (
  select airport_code, count(*) as episodes, max(session_duration_hours) as longest_hours
  from ({BATCH["longest_episodes"]}) as s group by airport_code
) as s using (airport_code)""",
    "contract_violations": f"""
with {SPARSE},
per_key as (
  select state, county, count(*) as n, count(*) filter (where type <> 'STORM') as missing
  from sparse group by all
)
select cast(sum(n) as bigint) as row_count, cast(sum(missing) as bigint) as missing_values,
  count(*) filter (where n > 1) as duplicate_keys
from per_key""",
    "valid_intervals": f"""
with {DENSE}
select event_id, airport_code, type, {_secs("s", "e")} as duration_s from dense where e > s""",
    "split_by_day": f"""
with {DENSE},
days as (select event_id, s, e, unnest(generate_series(date_trunc('day', s), date_trunc('day', e),
           interval 1 day)) as d from dense where e > s)
select event_id, cast(d as date) as event_date,
  {_secs("greatest(s, d)", "least(e, d + interval 1 day)")} as covered_s
from days""",
    "day_islands": f"""
with {DENSE},
{_day_islands("true", "airport_code, type")}
select airport_code, type, event_date, s as start_ts, e as end_ts from islands""",
    "merge_islands": f"""
with {DENSE},
{_sessions("dense", "airport_code, type", "true", 0, "max_end")}
select airport_code, type, session_start as start_ts, session_end as end_ts from sessions""",
    "net_delta_markers": f"""
with {DENSE},
ev as (select * from dense where e > s)
select airport_code, type, ts, cast(sum(delta) as bigint) as net
from (select airport_code, type, time_bucket(interval 30 minutes, s) as ts, 1 as delta from ev
      union all select airport_code, type, time_bucket(interval 30 minutes, e), -1 from ev)
group by all""",
    "interval_overlap_join": f"""
with {DENSE},
{_day_islands("true", "airport_code, type")}
select a.airport_code, a.event_date,
  cast(sum({_secs("greatest(a.s, b.s)", "least(a.e, b.e)")}) as bigint) as seconds
from islands a join islands b on a.airport_code = b.airport_code
  and a.event_date = b.event_date and a.type = 'FOG' and b.type = 'SNOW'
  and a.s < b.e and b.s < a.e
group by all""",
    "timeline_segments": f"""
with {DENSE},
{_segments("true")}
select airport_code, ts, next_ts from segments""",
    "running_active_count": f"""
with {DENSE},
ev as (select * from dense where e > s),
moments as (
  select airport_code, type, s as ts from ev union select airport_code, type, e from ev
)
select m.airport_code, m.type, m.ts, count(v.s) as total
from moments m left join ev v on v.airport_code = m.airport_code and v.type = m.type
  and v.s <= m.ts and v.e > m.ts
group by all""",
    "state_forward_fill": f"""
with {DENSE},
{_active("true")}
select airport_code, type, ts, next_ts, n as active from active""",
    "active_type_sets": f"""
with {DENSE},
{_active("true")}
select airport_code, ts, string_agg(type, '+' order by type) as types,
  cast(count(*) as integer) as n_types
from active group by airport_code, ts having count(*) >= 2""",
    "active_type_pairs": f"""
with {DENSE},
{_active("true")}
select a.airport_code, concat(a.type, '+', b.type) as type_pair,
  cast(sum({_secs("a.ts", "a.next_ts")}) as bigint) as seconds
from active a join active b on a.airport_code = b.airport_code and a.ts = b.ts
  and a.type < b.type
group by all""",
    "overlapping_pairs": f"""
with {DENSE}
select a.airport_code, a.event_id as left_event_id, b.event_id as right_event_id,
  {_secs("greatest(a.s, b.s)", "least(a.e, b.e)")} as seconds
from dense a join dense b on a.airport_code = b.airport_code and a.s < b.e and b.s < a.e
where a.type = 'FOG' and b.type = 'SNOW' and a.severity = 'Heavy' and b.severity = 'Heavy'
  and a.e > a.s and b.e > b.s""",
    "overlapping_pairs_any_severity": f"""
with {DENSE}
select a.airport_code, a.event_id as left_event_id, b.event_id as right_event_id,
  {_secs("greatest(a.s, b.s)", "least(a.e, b.e)")} as seconds
from dense a join dense b on a.airport_code = b.airport_code and a.s < b.e and b.s < a.e
where a.type = 'FOG' and b.type = 'SNOW' and a.e > a.s and b.e > b.s""",
    "overlapping_pairs_nested": f"""
with {DENSE},
longer as (
  select airport_code, event_id, type, s,
    e + to_days(cast(case when event_id % 40 = 1 then event_id % 301 else 0 end as integer)) as e
  from dense where e > s
)
select a.airport_code, a.event_id as left_event_id, b.event_id as right_event_id,
  {_secs("greatest(a.s, b.s)", "least(a.e, b.e)")} as seconds
from longer a join longer b on a.airport_code = b.airport_code and a.s < b.e and b.s < a.e
where a.type = 'FOG' and b.type = 'SNOW'""",
    "rejected_events": f"""
with {DENSE}
select case when event_id % 107 = 11 then 'malformed line' else 'no event id' end as reason,
  case when event_id % 101 = 7 then null when event_id % 103 = 9 then '  '
    else concat('W-', cast(event_id as varchar)) end as event_id
from (select event_id, unnest(case when event_id % 7 = 0 then [0, 1] else [0] end) from dense)
  as copies, (select unnest([0, 1]) as twice) as t
where (event_id % 101 = 7 or event_id % 103 = 9 or event_id % 107 = 11)
  and (twice = 0 or event_id % 11 = 0)""",
    "episodes_session_window": f"""
with {DENSE},
{_sessions("dense", "airport_code, type", "true", 60, "max_end")}
select airport_code, type, session_start, session_end, cast(n as bigint) as events
from sessions""",
    "projection_and_rename": f"""
with {DENSE} select event_id, type, s as started_at from dense""",
    "risk_filter_any": f"""
with {DENSE}
select event_id, type, severity from dense
where type in ('FOG', 'SNOW') or severity = 'Heavy'""",
    "lookup_weights": f"""
with {SPARSE}
select event_id,
  case severity when 'Moderate' then 2 when 'Heavy' then 3 else 1 end as severity_weight,
  case type when 'SNOW' then 3 when 'ICE' then 2 when 'COLD' then 1 else 0 end as type_weight
from sparse""",
    "null_fill": f"""
with {READINGS}
select event_id, case when event_id % 3 = 0 then temp_c end as temp_c,
  case when event_id % 3 = 0 then temp_c else cast(0 as double) end as filled
from readings""",
    "union_markers": f"""
with {DENSE}
select airport_code, delta, count(*) as n, min(ts) as first_ts, max(ts) as last_ts
from (select airport_code, s as ts, 1 as delta from dense
      union all select airport_code, e, -1 from dense)
group by airport_code, delta""",
    "distinct_rows": f"""
with {DENSE} select distinct airport_code, type, severity from dense""",
    "conditional_aggregates": f"""
with {SPARSE}
select state, type, count(*) as n, count(*) filter (where is_night) as n_night,
  cast(sum(dur_min) filter (where is_night) as double) as night_min,
  r2(avg(dur_min) filter (where is_night)) as avg_night_min,
  r2(cast(count(*) filter (where is_night) as double) / count(*)) as night_ratio,
  cast(sum(dur_min) as double) / nullif(count(*) filter (where severity = 'None'), 0)
    as no_such_severity
from sparse group by state, type""",
    "stddev_by_group": f"""
with {READINGS}
select airport_code, is_day, r6(stddev_samp(temp_c)) as sd_temp,
  r6(stddev_samp(pressure_mb)) as sd_pressure
from readings group by airport_code, is_day""",
    "dedup_keep_first": f"""
with {SPARSE}
select state, county, type, s as local_start_ts, event_id from sparse
qualify row_number() over (partition by state, county, type order by s, event_id) = 1""",
    "top_one_per_group": f"""
with {DENSE}
select airport_code, type, event_id, {_secs("s", "e")} as duration_s from dense
qualify row_number() over (partition by airport_code, type order by e - s desc, event_id) = 1""",
    "dense_rank_in_group": f"""
with {MONTHLY}
select *, cast(dense_rank() over (partition by state, year, month order by n desc) as integer)
  as rank_in_state from monthly""",
    "moving_average_3": f"""
with {MONTHLY}
select *, r6(avg(n) over (partition by state, county order by year, month
  rows between 2 preceding and current row)) as average from monthly""",
    "lag_and_lead": f"""
with {MONTHLY}
select *, lag(n) over w as before, lead(n) over w as next, lead(n, 2) over w as second
from monthly window w as (partition by state, county order by year, month)""",
    "consecutive_month_change": f"""
with {SPARSE},
monthly as (
  select state, type, cast(year(s) as integer) as year, cast(month(s) as integer) as month,
    count(*) as n from sparse group by all
)
select state, type, year, month, n,
  year * 12 + month - lag(year * 12 + month) over w = 1 as is_next_month,
  r2((n - lag(n) over w) / cast(lag(n) over w as double) * 100) as change_pct
from monthly window w as (partition by state, type order by year, month)""",
    "calendar_range_sum": f"""
with {DENSE},
days as (select airport_code, s, e, unnest(generate_series(date_trunc('day', s),
           date_trunc('day', e), interval 1 day)) as d from dense where e > s and type = 'SNOW'),
daily as (
  select airport_code, cast(d as date) as event_date,
    sum({_secs("greatest(s, d)", "least(e, d + interval 1 day)")}) as secs
  from days group by all
)
select airport_code, event_date, r2(cast(secs as double) / 3600) as exposure_hours_day,
  r2(cast(sum(secs) over (partition by airport_code order by event_date
    range between interval 2 days preceding and current row) as double) / 3600)
    as exposure_hours_3d,
  r2(cast(sum(secs) over (partition by airport_code order by event_date
    range between interval 6 days preceding and current row) as double) / 3600)
    as exposure_hours_7d
from daily""",
    "seconds_range_sum": f"""
with {DENSE},
starts as (select airport_code, s, count(*) as n from dense where e > s group by all)
select airport_code, s as ts, cast(sum(n) over (partition by airport_code, cast(s as date)
  order by s range between interval 3 hours preceding and current row) as bigint) as started_3h
from starts""",
    "two_key_left_join": f"""
with {DENSE}
select airport_code, cast(s as date) as event_date, count(*) as n,
  count(*) filter (where type = 'STORM' and severity = 'Heavy') as n_storms
from dense group by airport_code, cast(s as date)""",
    "first_rows": f"""
with {DENSE}
select event_id, type, {_secs("s", "e")} as duration_s from dense
order by duration_s desc, event_id limit 20""",
    "calendar_parts": f"""
with {SPARSE}
select event_id, cast(year(s) as integer) as y, cast(month(s) as integer) as m,
  cast(day(s) as integer) as d, cast(hour(s) as integer) as h, cast(isodow(s) as integer) as dow,
  cast(dayofyear(s) as integer) as doy,
  cast(cast(s as date) + interval 1 day as date) as next_date, s + interval 3 hours as plus_3h,
  cast(season_year as integer) as season_year,
  case when month(s) in (12, 1, 2) then 'DJF' when month(s) in (3, 4, 5) then 'MAM'
    when month(s) in (6, 7, 8) then 'JJA' else 'SON' end as season,
  is_night
from sparse""",
    "zone_conversion": f"""
with {SPARSE}
select event_id, (s at time zone 'UTC') at time zone (case event_id % 6
  when 0 then 'America/New_York' when 1 then 'US/Pacific' when 5 then 'Asia/Kolkata'
  else 'UTC' end) as local_ts
from sparse""",
    "cyclic_day_shift": f"""
with {SPARSE},
d as (select event_id, dayofyear(e) - dayofyear(s) as diff from sparse)
select event_id, cast(case when diff > 180 then diff - 365 when diff < -180 then diff + 365
  else diff end as integer) as shift_days from d""",
    "text_cleanup": f"""
with {DENSE} select distinct type, severity from dense""",
    "reading_features": f"""
with {READINGS}
select event_id, temp_c - dewpoint_c as spread,
  case when wind_kph > 0 then gust_kph / wind_kph else cast(1 as double) end as gust_factor,
  cast(case when precip_in > 0 then 1 else 0 end as double) as rainy,
  temp_c >= 30 and humidity >= 60 as heat_stress, cast(is_day as double) as daytime
from readings""",
}
