"""DuckDB SQL over the test tables for every registered query.

Written separately from the Spark plans: QUALIFY, arg_max and correlated subqueries here
against two-phase aggregates and joins there.
"""

from __future__ import annotations


def rounded(value: str, digits: int) -> str:
    return f"cast(round(cast({value} as decimal(38,9)), {digits}) as double)"


COLUMNS = {
    "sessions": (
        "session_key, session_name, session_type, date_start, date_end, gmt_offset, location, "
        "country_name, country_code, circuit_key, circuit_short_name, year"
    ),
    "drivers": (
        "driver_number, session_key, broadcast_name, full_name, name_acronym, team_name, "
        "team_colour, country_code, headshot_url"
    ),
    "laps": (
        "session_key, driver_number, lap_number, lap_duration, duration_sector_1, "
        "duration_sector_2, duration_sector_3, i1_speed, i2_speed, st_speed, is_pit_out_lap, "
        "date_start"
    ),
    "pit_stops": "session_key, driver_number, lap_number, pit_duration, date",
    "weather": (
        "session_key, date, air_temperature, track_temperature, humidity, pressure, wind_speed, "
        "wind_direction, rainfall"
    ),
    "positions": "session_key, driver_number, date, position",
}

RAW = """
raw_sessions as (
  select cast(o_orderkey // 100 as int) as session_key,
    case when o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM') then 'Race'
         when o_orderpriority = '4-NOT SPECIFIED' then 'Sprint' else 'Qualifying'
    end as session_name,
    case when o_orderpriority = '5-LOW' then 'Qualifying' else 'Race' end as session_type,
    o_orderdate as date_start,
    case when o_orderkey % 1300 = 0 then null
         else o_orderdate + 7200 * interval 1 second end as date_end,
    '00:00:00' as gmt_offset, n_name as location, r_name as country_name,
    substr(r_name, 1, 3) as country_code, cast(n_nationkey as int) as circuit_key,
    n_name as circuit_short_name, cast(year(o_orderdate) as int) as year
  from (select * from orders
        qualify o_orderkey = min(o_orderkey) over (partition by o_orderkey // 100)) o
  join nation on n_nationkey = o_custkey % 25
  join region on r_regionkey = n_regionkey),
raw_drivers as (
  select cast(entry + 1 as int) as driver_number, session_key,
    upper(s_name) as broadcast_name,
    case when entry = 7 and session_key % 5 = 0 then null
         else concat('  ', s_name, ' ') end as full_name,
    case when entry = 9 then null
         else concat('D', lpad(cast(entry + 1 as varchar), 2, '0')) end as name_acronym,
    case when entry = 3 and session_key % 7 = 0 then '   '
         else concat('TEAM_', cast(s_nationkey % 10 as varchar), ' ') end as team_name,
    lpad(cast(s_nationkey * 1111 as varchar), 6, '0') as team_colour,
    case when entry % 4 = 0 then null
         else concat('C', cast(s_nationkey as varchar)) end as country_code,
    concat('img/', cast(entry as varchar)) as headshot_url
  from (select distinct cast(o_orderkey // 100 as int) as session_key
        from orders) k
  cross join (select s_suppkey % 20 as entry, arg_min(s_name, s_suppkey) as s_name,
                arg_min(s_nationkey, s_suppkey) as s_nationkey
              from supplier group by all) e),
raw_laps as (
  select case when l_partkey % 401 = 0 then null else cast(l_orderkey // 100 as int) end
      as session_key,
    case when l_partkey % 307 = 0 then null else cast(l_suppkey % 20 + 1 as int) end
      as driver_number,
    case when l_partkey % 211 = 0 then null else cast(l_quantity as int) end as lap_number,
    case when l_partkey % 97 = 0 then null when l_partkey % 199 = 0 then cast(-1 as double)
         when l_partkey % 89 = 0 then cast(60 as double)
         when l_partkey % 101 = 0 then cast(300 as double)
         else l_extendedprice / 300 end as lap_duration,
    l_extendedprice / 1000 as duration_sector_1, l_extendedprice / 900 as duration_sector_2,
    case when l_linenumber = 7 then null else l_extendedprice / 800 end as duration_sector_3,
    cast(200 + l_quantity as double) as i1_speed, cast(210 + l_quantity as double) as i2_speed,
    cast(220 + l_quantity as double) as st_speed,
    case when l_linestatus = 'O' and l_returnflag = 'R' then true
         when l_linestatus = 'O' then null else false end as is_pit_out_lap,
    case when l_partkey % 53 = 0 then null
         else l_shipdate + l_orderkey * interval 1 second end as date_start
  from lineitem),
timing_events as (
  select event_id * 2 as id, event_id, user_id, value, ts from events
  union all
  select event_id * 2 + 1, event_id, user_id, value + 1, ts from events where event_id % 9 = 0),
raw_pit_stops as (
  select cast(id as bigint) as id, cast(event_id // 67 as int) as session_key,
    cast(user_id % 20 + 1 as int) as driver_number, cast(event_id % 50 as int) as lap_number,
    case when event_id % 83 = 0 then null else value * 3 / 2 end as pit_duration,
    case when event_id % 91 = 0 then null else ts end as date
  from timing_events),
raw_positions as (
  select cast(id as bigint) as id, cast(event_id // 67 as int) as session_key,
    cast(user_id % 20 + 1 as int) as driver_number, ts as date,
    case when event_id % 87 = 0 then null
         else cast(cast(floor(value) as bigint) % 32 as int) end as position
  from timing_events),
raw_weather as (
  select cast(o_orderkey as bigint) as id,
    case when o_custkey % 79 = 0 then null else cast(o_orderkey // 100 as int) end
      as session_key,
    case when o_custkey % 71 = 0 then null else o_orderdate end as date,
    case when o_custkey % 59 = 0 then null when o_custkey % 83 = 0 then cast(-25 as double)
         else o_totalprice / 8000 end as air_temperature,
    case when o_custkey % 89 = 0 then null else o_totalprice / 8000 + o_custkey % 35 end
      as track_temperature,
    case when o_custkey % 61 = 0 then null else cast(o_custkey % 104 as double) end as humidity,
    case when o_custkey % 67 = 0 then null else cast(690 + o_orderkey % 420 as double) end
      as pressure,
    case when o_custkey % 73 = 0 then null else cast(o_custkey % 107 as double) end as wind_speed,
    case when o_custkey % 11 = 0 then null else cast(o_custkey % 365 as int) end
      as wind_direction,
    case o_orderstatus when 'P' then true when 'F' then false else null end as rainfall
  from orders)"""

STAGED = """
stg_sessions as (
  select * exclude (gmt_offset, circuit_key) from raw_sessions where session_key is not null),
stg_drivers as (
  select session_key, driver_number, trim(full_name) as full_name,
    trim(name_acronym) as name_acronym, trim(team_name) as team_name,
    trim(team_colour) as team_colour, trim(country_code) as country_code
  from raw_drivers
  where session_key is not null and driver_number is not null
    and length(trim(full_name)) > 0 and length(trim(team_name)) > 0
  qualify row_number() over (partition by session_key, driver_number
    order by trim(full_name) nulls last, trim(name_acronym) nulls last,
      trim(team_name) nulls last, trim(team_colour) nulls last,
      trim(country_code) nulls last) = 1),
stg_laps as (
  select * replace (coalesce(is_pit_out_lap, false) as is_pit_out_lap) from raw_laps
  where session_key is not null and driver_number is not null and lap_number is not null and lap_duration is not null
    and lap_duration > 60 and lap_duration < 300 and is_pit_out_lap is distinct from true
  qualify row_number() over (partition by session_key, driver_number, lap_number
    order by date_start desc nulls last, lap_duration nulls last, duration_sector_1 nulls last,
      duration_sector_2 nulls last, duration_sector_3 nulls last, i1_speed nulls last,
      i2_speed nulls last, st_speed nulls last) = 1),
stg_pit_stops as (
  select id, session_key, driver_number, lap_number, pit_duration, date as pit_stop_timestamp,
    case when pit_duration < 5 then 'very_fast' when pit_duration < 15 then 'normal'
         when pit_duration < 60 then 'slow' else 'very_slow' end as pit_stop_category
  from raw_pit_stops
  where session_key is not null and driver_number is not null and lap_number is not null and pit_duration is not null and date is not null
    and lap_number > 0 and pit_duration > 0 and pit_duration < 600
  qualify row_number() over (partition by session_key, driver_number, lap_number, date
    order by id desc, pit_duration) = 1),
stg_positions as (
  select id, session_key, driver_number, date as position_timestamp, position
  from raw_positions
  where session_key is not null and driver_number is not null and date is not null and position is not null and position between 1 and 30
  qualify row_number() over (partition by session_key, driver_number, date
    order by id desc, position desc) = 1),
stg_weather as (
  select id, session_key, date as weather_timestamp, air_temperature, track_temperature,
    humidity, pressure, wind_speed, wind_direction, coalesce(rainfall, false) as rainfall,
    track_temperature - air_temperature as temperature_difference,
    case when rainfall then 'rainy' when track_temperature >= 40 then 'hot_track'
         when air_temperature <= 10 then 'cold' else 'normal' end as weather_condition
  from raw_weather
  where session_key is not null and date is not null
    and air_temperature between -20 and 60 and track_temperature between -20 and 90
    and humidity between 0 and 100 and pressure between 700 and 1100
    and wind_speed between 0 and 100 and coalesce(wind_direction, 0) between 0 and 359
  qualify row_number() over (partition by session_key, date order by id desc) = 1)"""

_FINISHES = """count(*) filter (where final_position = 1) as wins,
    count(*) filter (where final_position <= 3) as podiums,
    count(*) filter (where final_position <= 10) as points_finishes"""

_WEATHER_MEANS = ", ".join(
    f"{rounded(f'avg({m})', 2)} as avg_{m}"
    for m in ["air_temperature", "track_temperature", "humidity", "pressure", "wind_speed"]
)

MARTS = f"""
race_sessions as (
  select session_key, year, circuit_short_name, country_name from stg_sessions
  where (session_type, session_name) = ('Race', 'Race')),
final_positions as (
  select session_key, driver_number, arg_max(position, position_timestamp) as final_position
  from stg_positions group by all),
driver_lap_stats as (
  select session_key, driver_number, avg(lap_duration) as avg_lap_sec,
    min(lap_duration) as best_lap_sec
  from stg_laps group by all),
race_results as (
  select year, session_key, driver_number, full_name, name_acronym, team_name, final_position,
    avg_lap_sec, best_lap_sec
  from race_sessions join final_positions using (session_key)
  join stg_drivers using (session_key, driver_number)
  left join driver_lap_stats using (session_key, driver_number)),
driver_performance as (
  select year, driver_number, full_name, name_acronym, team_name,
    count(distinct session_key) as races, {rounded("avg(final_position)", 2)} as avg_finish,
    {_FINISHES},
    {rounded("avg(avg_lap_sec)", 3)} as avg_lap_time, {rounded("min(best_lap_sec)", 3)} as best_lap
  from race_results group by all),
season_bests as (
  select l.*, year, circuit_short_name, country_name
  from stg_laps l join race_sessions using (session_key)
  qualify row_number() over (partition by driver_number, circuit_short_name, year
    order by lap_duration, lap_number, session_key) = 1),
fastest_laps as (
  select driver_number, full_name as driver_name, name_acronym, team_name, circuit_short_name,
    country_name, year, lap_number, lap_duration as fastest_lap_sec, duration_sector_1,
    duration_sector_2, duration_sector_3,
    cast(cast(floor(lap_duration / 60) as int) as varchar) || ':'
      || lpad(cast(round(cast(lap_duration as decimal(38,9)) % 60, 3) as varchar), 6, '0')
      as fastest_lap_fmt,
    rank() over (partition by circuit_short_name, year order by lap_duration) as rank_on_circuit
  from season_bests join stg_drivers using (session_key, driver_number)),
pit_stop_impact as (
  select year, circuit_short_name, country_name, full_name as driver_name, name_acronym,
    team_name, pit_stop_count, {rounded("mean_seconds", 2)} as avg_pit_duration_sec,
    {rounded("total_seconds", 2)} as total_pit_time_sec, final_position
  from (select session_key, driver_number, count(*) as pit_stop_count,
          avg(pit_duration) as mean_seconds, sum(pit_duration) as total_seconds
        from stg_pit_stops where pit_duration < 60 group by all)
  join race_sessions using (session_key)
  join final_positions using (session_key, driver_number)
  join stg_drivers using (session_key, driver_number)),
race_winners as (
  select session_key, full_name as winner_name, name_acronym as winner_acronym,
    team_name as winner_team
  from final_positions join stg_drivers using (session_key, driver_number)
  where final_position = 1),
session_fastest_lap as (
  select session_key, full_name as fastest_lap_driver, team_name as fastest_lap_team,
    lap_number as fastest_lap_number, {rounded("lap_duration", 3)} as fastest_lap_sec
  from (select * from stg_laps qualify row_number() over (partition by session_key
          order by lap_duration, lap_number, driver_number) = 1)
  join stg_drivers using (session_key, driver_number)),
pit_stats_by_session as (
  select session_key, count(*) as total_pit_stops,
    count(distinct driver_number) as drivers_with_pit_stops,
    {rounded("avg(pit_duration)", 2)} as avg_pit_duration_sec,
    {rounded("min(pit_duration)", 2)} as fastest_pit_stop_sec,
    {rounded("max(pit_duration)", 2)} as slowest_pit_stop_sec
  from stg_pit_stops where pit_duration < 60 group by all),
weather_stats as (
  select session_key, {_WEATHER_MEANS}, bool_or(rainfall) as had_rain,
    count(*) as weather_measurements
  from stg_weather group by all),
race_summary as (
  select r.*, w.* exclude (session_key), f.* exclude (session_key),
    coalesce(p.total_pit_stops, 0) as total_pit_stops,
    coalesce(p.drivers_with_pit_stops, 0) as drivers_with_pit_stops,
    p.avg_pit_duration_sec, p.fastest_pit_stop_sec, p.slowest_pit_stop_sec,
    s.* exclude (session_key, weather_measurements)
  from race_sessions r
  left join race_winners w on w.session_key = r.session_key
  left join session_fastest_lap f on f.session_key = r.session_key
  left join pit_stats_by_session p on p.session_key = r.session_key
  left join weather_stats s on s.session_key = r.session_key
  where exists (select 1 from stg_positions x where x.session_key = r.session_key)),
team_lap_stats as (
  select year, team_name, {rounded("avg(mean_lap)", 3)} as avg_lap_time_sec,
    {rounded("min(best_lap)", 3)} as best_lap_time_sec
  from (select year, session_key, driver_number, team_name, avg(lap_duration) as mean_lap,
          min(lap_duration) as best_lap
        from stg_laps join race_sessions using (session_key)
        join stg_drivers using (session_key, driver_number) group by all)
  group by all),
team_comparison as (
  select * from (
    select year, team_name, count(distinct session_key) as races_count,
      {rounded("avg(final_position)", 2)} as avg_position, {_FINISHES}
    from race_results group by all)
  left join team_lap_stats using (year, team_name)),
weather_analysis as (
  select year, circuit_short_name, country_name, s.* exclude (session_key)
  from race_sessions join weather_stats s using (session_key)),
pit_stop_category_counts as (
  select pit_stop_category, count(*) as n_stops from stg_pit_stops group by all),
dq_lap_anomalies as (
  select * from (
    select *, coalesce(
      if(session_key is null, 'missing_session_key', null),
      if(driver_number is null, 'missing_driver_number', null),
      if(lap_number is null, 'missing_lap_number', null),
      if(lap_duration is null, 'missing_lap_duration', null),
      if(lap_duration <= 0, 'non_positive_lap_duration', null),
      if(lap_duration < 60, 'lap_too_short', null),
      if(lap_duration > 300, 'lap_too_long', null),
      if(is_pit_out_lap, 'pit_out_lap', null)) as anomaly_reason
    from raw_laps) where anomaly_reason is not null),
dq_weather_anomalies as (
  select * from (
    select *, coalesce(
      if(session_key is null, 'missing_session_key', null),
      if(date is null, 'missing_timestamp', null),
      if(air_temperature is null, 'missing_air_temperature', null),
      if(air_temperature not between -20 and 60, 'invalid_air_temperature', null),
      if(track_temperature is null, 'missing_track_temperature', null),
      if(track_temperature not between -20 and 90, 'invalid_track_temperature', null),
      if(humidity is null, 'missing_humidity', null),
      if(humidity not between 0 and 100, 'invalid_humidity', null),
      if(pressure is null, 'missing_pressure', null),
      if(pressure not between 800 and 1100, 'invalid_pressure', null),
      if(wind_speed is null, 'missing_wind_speed', null),
      if(wind_speed not between 0 and 100, 'invalid_wind_speed', null),
      if(wind_direction not between 0 and 359, 'invalid_wind_direction', null))
      as anomaly_reason
    from raw_weather) where anomaly_reason is not null),
dq_reason_counts as (
  select 'laps' as table_name, anomaly_reason, count(*) as n_rows
  from dq_lap_anomalies group by all
  union all
  select 'weather', anomaly_reason, count(*) from dq_weather_anomalies group by all)"""

STAGING_NAMES = [
    "stg_sessions",
    "stg_drivers",
    "stg_laps",
    "stg_pit_stops",
    "stg_positions",
    "stg_weather",
]
MART_NAMES = [
    "race_summary",
    "driver_performance",
    "team_comparison",
    "fastest_laps",
    "pit_stop_impact",
    "weather_analysis",
    "dq_lap_anomalies",
    "dq_weather_anomalies",
]
OTHER_NAMES = [
    "race_sessions",
    "final_positions",
    "race_winners",
    "session_fastest_lap",
    "pit_stats_by_session",
    "pit_stop_category_counts",
    "team_lap_stats",
    "weather_stats",
    "dq_reason_counts",
]


def query(body: str) -> str:
    return f"with {RAW},{STAGED},{MARTS}\n{body}"


def _replaced(table: str, value: str) -> str:
    sent = "(select session_key from raw_sessions where year >= 1996)"
    return query(f"""
      select * from raw_{table} t where not exists (
        select 1 from raw_{table} n where n.session_key = t.session_key
          and n.session_key in {sent})
      union all
      select * replace ({value} + 1 as {value}) from raw_{table} where session_key in {sent}""")


def _upserted(table: str, key: list[str], change: str, known: str, sent: str) -> str:
    same_key = " and ".join(f"c.{k} = b.{k}" for k in key)
    return query(f"""
      , current_rows as (select * from raw_{table} where {known}),
      batch as (select * replace ({change}) from raw_{table} where {sent})
      select c.*, timestamp '2024-01-01 00:00:00' as created_at from current_rows c
      where not exists (select 1 from batch b where {same_key})
      union all
      select b.*, case when exists (select 1 from current_rows c where {same_key})
        then timestamp '2024-01-01 00:00:00' else timestamp '2024-02-01 00:00:00' end
      from batch b""")


def _null_counts(model: str, source: str, names: list[str]) -> list[str]:
    return [
        f"select 'not_null' as check_name, '{model}' as model, '{c}' as column_name, "
        f"count(*) as n_violations from {source} where {c} is null"
        for c in names
    ]


def _repeats(check: str, model: str, source: str, names: list[str], where: str = "true") -> str:
    key = ", ".join(names)
    return (
        f"select '{check}', '{model}', '{key}', count(*) from (select {key} from {source} "
        f"where {where} group by all having count(*) > 1)"
    )


def _orphans(model: str, source: str, parent: str) -> str:
    return (
        f"select 'relationships', '{model}', 'session_key', count(*) from {source} "
        f"where session_key is not null and session_key not in (select session_key from {parent})"
    )


def _unaccepted(model: str, column: str, accepted: list[str]) -> str:
    values = ", ".join(f"'{v}'" for v in accepted)
    return (
        f"select 'accepted_values', '{model}', '{column}', count(distinct {column}) from {model} "
        f"where {column} not in ({values})"
    )


_PIT_CATEGORIES = ["very_fast", "normal", "slow", "very_slow"]
_CONDITIONS = ["rainy", "hot_track", "cold", "normal"]
_LAP_KEY = ["session_key", "driver_number", "lap_number"]


def _report(sources: dict[str, str], parent: str) -> list[str]:
    required = {
        "stg_sessions": ["session_key"],
        "stg_drivers": ["session_key", "driver_number"],
        "stg_laps": [*_LAP_KEY, "lap_duration"],
        "stg_positions": ["session_key", "driver_number", "position"],
    }
    parts = []
    for model, names in required.items():
        parts += _null_counts(model, sources[model], names)
    parts.append(
        _repeats(
            "unique", "stg_sessions", sources["stg_sessions"], ["session_key"],
            "session_key is not null",
        )
    )
    parts.append(_repeats("unique_rows", "stg_laps", sources["stg_laps"], _LAP_KEY))
    for model in ["stg_drivers", "stg_laps", "stg_positions"]:
        parts.append(_orphans(model, sources[model], parent))
    return parts


_FULL_REPORT = [
    *_report({name: name for name in STAGING_NAMES}, "stg_sessions"),
    *_null_counts("stg_pit_stops", "stg_pit_stops", [*_LAP_KEY, "pit_duration"]),
    *_null_counts(
        "stg_weather",
        "stg_weather",
        ["session_key", "air_temperature", "track_temperature", "humidity", "pressure"],
    ),
    _orphans("stg_pit_stops", "stg_pit_stops", "stg_sessions"),
    _orphans("stg_weather", "stg_weather", "stg_sessions"),
    _unaccepted("stg_pit_stops", "pit_stop_category", _PIT_CATEGORIES),
    _unaccepted("stg_weather", "weather_condition", _CONDITIONS),
    *_null_counts(
        "fastest_laps",
        "fastest_laps",
        ["year", "circuit_short_name", "driver_name", "fastest_lap_sec"],
    ),
    *_null_counts(
        "pit_stop_impact",
        "pit_stop_impact",
        ["year", "circuit_short_name", "driver_name", "team_name", "pit_stop_count"],
    ),
    *_null_counts(
        "team_comparison", "team_comparison", ["year", "team_name", "races_count", "avg_position"]
    ),
]

_RAW_REPORT = _report(
    {
        "stg_sessions": "race_sessions",
        "stg_drivers": "raw_drivers",
        "stg_laps": "raw_laps",
        "stg_positions": "raw_positions",
    },
    "race_sessions",
)

_SELECTED = """raw_sessions where date_end between timestamp '1998-06-30 00:00:00' - interval 180 day
  and timestamp '1998-06-30 00:00:00' and year in (1998)"""

ORACLES = {
    **{f"read_{t}": query(f"select {c} from raw_{t}") for t, c in COLUMNS.items()},
    "validate_payload": query("""
      select id, case when pressure is null then 'not_json' when humidity is null
        then 'not_an_array' when wind_speed is null or session_key is null
        then 'record_not_an_object' end as problem from raw_weather"""),
    "latest_in_batch": query("""
      select * from raw_pit_stops p where id = (select max(id) from raw_pit_stops q
        where q.session_key = p.session_key and q.driver_number = p.driver_number)"""),
    "reject_null_keys": query("""
      select * from raw_laps where session_key is not null and driver_number is not null and lap_number is not null"""),
    "upsert_sessions": _upserted(
        "sessions",
        ["session_key"],
        "session_name || ' (final)' as session_name",
        "year <= 1996",
        "year >= 1996",
    ),
    "upsert_drivers": _upserted(
        "drivers",
        ["driver_number", "session_key"],
        "trim(team_name) || ' II' as team_name",
        "session_key in (select session_key from raw_sessions where year <= 1996)",
        "session_key in (select session_key from raw_sessions where year >= 1996)",
    ),
    "replace_partitions": query("""
      select * from raw_weather where rainfall and date is not null
      union all
      select * from raw_weather t where not exists (
        select 1 from raw_weather n where n.date = t.date and n.rainfall)"""),
    "replace_laps": _replaced("laps", "st_speed"),
    "replace_pit_stops": _replaced("pit_stops", "pit_duration"),
    "replace_weather": _replaced("weather", "humidity"),
    "replace_positions": _replaced("positions", "position"),
    "select_incremental": query(f"select * from {_SELECTED}"),
    "select_backfill": query("select * from raw_sessions where year in (1996, 1998)"),
    "parse_utc": query("""
      select session_key, driver_number, date_start as from_zulu,
        date_start - interval 2 hour as from_offset, date_start as from_naive from raw_laps"""),
    "facts_for_sessions": query(
        f"select * from raw_laps where session_key in (select session_key from {_SELECTED})"
    ),
    "driver_lap_stats": query(f"""
      select session_key, driver_number, {rounded("avg_lap_sec", 3)} as avg_lap_sec,
        {rounded("best_lap_sec", 3)} as best_lap_sec from driver_lap_stats"""),
    **{n: query(f"select * from {n}") for n in [*STAGING_NAMES, *MART_NAMES, *OTHER_NAMES]},
    "lap_time_format": query("""
      select lap_duration, cast(cast(floor(lap_duration / 60) as int) as varchar) || ':'
        || lpad(cast(round(cast(lap_duration as decimal(38,9)) % 60, 3) as varchar), 6, '0')
        as lap_fmt from raw_laps where lap_duration > 0"""),
    "build_all": query(
        " union all ".join(
            f"select '{n}' as model, count(*) as n_rows from {n}"
            for n in [*STAGING_NAMES, *MART_NAMES]
        )
    ),
    "check_not_null": query(
        " union all ".join(
            f"select '{t}' as table_name, '{c.strip()}' as column_name, count(*) as n_rows "
            f"from raw_{t} where {c} is null having count(*) > 0"
            for t, names in COLUMNS.items()
            for c in names.split(",")
        )
    ),
    "check_unique": query("""
      select date, count(*) as n_rows from raw_weather where date is not null
      group by all having count(*) > 1"""),
    "check_relationships": query("""
      select session_key, count(*) as n_rows from raw_laps
      where session_key not in (select session_key from race_sessions) group by all"""),
    "check_accepted_values": query("""
      select pit_stop_category, count(*) as n_rows from stg_pit_stops
      where pit_stop_category not in ('very_fast', 'normal') group by all"""),
    "check_unique_laps": query("""
      select session_key, driver_number, lap_number, count(*) as n_rows from raw_laps
      group by all having count(*) > 1"""),
    "check_report": query(" union all ".join(_FULL_REPORT)),
    "check_report_raw": query(" union all ".join(_RAW_REPORT)),
    "published_race_summary": query("select * from race_summary"),
    "published_check_report": query(" union all ".join(_FULL_REPORT)),
    "stored_replace_pit_stops": query(f"""
      , again as (select session_key from raw_sessions where year >= 1996)
      select {COLUMNS["pit_stops"]}, timestamp '2024-01-01 00:00:00' as created_at from raw_pit_stops
      where session_key is not null and session_key not in (from again)
      union all
      select {COLUMNS["pit_stops"].replace("pit_duration", "pit_duration + 1 as pit_duration")},
        timestamp '2024-02-01 00:00:00' as created_at from raw_pit_stops where session_key in (from again)"""),
    "stored_upsert_drivers": _upserted(
        "drivers",
        ["driver_number", "session_key"],
        "trim(team_name) || ' II' as team_name",
        "session_key in (select session_key from raw_sessions where year <= 1996)",
        "session_key in (select session_key from raw_sessions where year >= 1996)",
    ),
    "streamed_weather": query(f"""
      select {COLUMNS["weather"]} from raw_weather where session_key in (
        select session_key from raw_sessions
        where date_end between timestamp '1998-06-30 00:00:00' - interval 14 day and timestamp '1998-06-30 00:00:00')"""),
}
