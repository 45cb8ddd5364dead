"""The same queries in plain SQL, written without the library, for a check by another engine."""

from __future__ import annotations

_CTES = {
    "raw_readings": """
select event_id, user_id, ts,
  case when event_id % 211 = 0 then '' else case user_id % 12
    when 0 then 'Phoenix' when 1 then 'Houston' when 2 then 'Los Angeles' when 3 then 'San Antonio'
    when 4 then 'San Diego' when 5 then 'Dallas' when 6 then 'Philadelphia' when 7 then 'San Jose'
    when 8 then 'Chicago' when 9 then 'New York' when 10 then 'Busan' when 11 then 'Jeju' end
  end as location,
  case when event_id % 97 = 0 then '2024-99-99 99:99:99'
       else strftime(ts, '%Y-%m-%d %H:%M:%S') end as date_time,
  case when event_id % 53 = 0 then '' when event_id % 59 = 0 then 'abc_xyz'
       else cast(cast(value as decimal(10,2)) - cast(10 as decimal(10,2)) as varchar) end as temperature_c,
  case when event_id % 61 = 0 then 'abc_xyz' else cast(20 + user_id % 70 as varchar) end as humidity_pct,
  json_extract_string(props, '$.k') as precipitation_mm,
  cast(event_id % 45 as varchar) as wind_speed_kmh,
  strftime(ts, 'weather_%Y%m%d_000000.csv') as file_name
from events""",
    "verdicts": """
select *,
  case when coalesce(location, '') = '' then 'Location' when coalesce(date_time, '') = '' then 'Date_Time'
       when coalesce(temperature_c, '') = '' then 'Temperature_C'
       when coalesce(humidity_pct, '') = '' then 'Humidity_pct'
       when coalesce(precipitation_mm, '') = '' then 'Precipitation_mm'
       when coalesce(wind_speed_kmh, '') = '' then 'Wind_Speed_kmh' end as missing_field,
  case when try_cast(temperature_c as double) is null
         then 'Invalid float field: Temperature_C=''' || temperature_c || ''''
       when try_cast(humidity_pct as double) is null
         then 'Invalid float field: Humidity_pct=''' || humidity_pct || ''''
       when try_cast(precipitation_mm as double) is null
         then 'Invalid float field: Precipitation_mm=''' || precipitation_mm || ''''
       when try_cast(wind_speed_kmh as double) is null
         then 'Invalid float field: Wind_Speed_kmh=''' || wind_speed_kmh || '''' end as type_error
from raw_readings""",
    "rejected": """
select *, case when missing_field is not null then 'MISSING_FIELD' else 'TYPE_ERROR' end as error_type,
  case when missing_field is not null then 'Missing required field: ' || missing_field
       else type_error end as error_reason,
  case when coalesce(location, '') = '' then 'unknown' else location end as key,
  '{"Location":"' || location || '","Date_Time":"' || date_time || '","Temperature_C":"' || temperature_c
    || '","Humidity_pct":"' || humidity_pct || '","Precipitation_mm":"' || precipitation_mm
    || '","Wind_Speed_kmh":"' || wind_speed_kmh || '","retry":0}' as raw_row
from verdicts where missing_field is not null or type_error is not null""",
    "valid": """
select event_id, user_id, ts, location, date_time, cast(temperature_c as double) as temperature_c,
  cast(humidity_pct as double) as humidity_pct, cast(precipitation_mm as double) as precipitation_mm,
  cast(wind_speed_kmh as double) as wind_speed_kmh,
  try_cast(date_time as timestamp) as event_time
from verdicts where missing_field is null and type_error is null""",
    "timed": "select * from valid where event_time is not null",
    "messages": """
select event_id, location, event_time,
  '{"Location":"' || location || '","Date_Time":"' || date_time || '","Temperature_C":'
    || cast(temperature_c as varchar) || ',"Humidity_pct":' || cast(humidity_pct as varchar)
    || ',"Precipitation_mm":' || cast(precipitation_mm as varchar) || ',"Wind_Speed_kmh":'
    || cast(wind_speed_kmh as varchar) || ',"retry":0' as body
from valid""",
    "regions": """
select * from (values ('Phoenix', 0), ('Houston', 1), ('Los Angeles', 2), ('San Antonio', 3),
  ('San Diego', 4), ('Dallas', 5), ('Philadelphia', 6), ('San Jose', 7), ('Chicago', 8),
  ('New York', 9)) as r(location, "partition")""",
    "retry_messages": """
select event_id, location, case
  when event_id % 101 = 0 then body || '}'
  when event_id % 103 = 0 then replace(whole, '"retry":0', '"retry":"x"')
  when event_id % 107 = 0 then regexp_replace(whole, '"Temperature_C":[^,]*,', '')
  when event_id % 109 = 0 then regexp_replace(whole, '"Temperature_C":[^,]*,', '"Temperature_C":null,')
  when event_id % 113 = 0 then replace(whole, '"retry":0', '"retry":2.0')
  when event_id % 127 = 0 then replace(whole, 'T' || strftime(event_time, '%H') || ':', 'T99:')
  else whole end as value
from (select *, body || ',"event_time":"' || strftime(event_time, '%Y-%m-%dT%H:%M:%S') || '"}' as whole
      from messages where event_time is not null)""",
    "decoded": """
select event_id, value, json_extract_string(value, '$.Location') as location,
  list_contains(json_keys(value), 'Temperature_C') as has_temperature,
  case when list_contains(json_keys(value), 'Temperature_C')
       then try_cast(json_extract_string(value, '$.Temperature_C') as double) else -999.0 end as temperature_c,
  try_cast(json_extract_string(value, '$.Precipitation_mm') as double) as precipitation_mm,
  try_cast(json_extract_string(value, '$.Wind_Speed_kmh') as double) as wind_speed_kmh,
  cast(trunc(try_cast(json_extract_string(value, '$.retry') as double)) as integer) as retry,
  json_extract_string(value, '$.event_time') as time_text,
  try_cast(json_extract_string(value, '$.event_time') as timestamp) as event_time
from retry_messages""",
    "judged": """
select *, coalesce(retry, 0) + 1 as retry_count, case
  when retry is null then 'Invalid retry count: ' || json_extract_string(value, '$.retry')
  when cast('0x' || substr(md5('retry-failure|' || event_id), 1, 8) as bigint) < ceil(0.01 * 4294967296)
    then 'Intentional Chaos Error (Simulated Failure)'
  when not list_contains(json_keys(value), 'event_time') then '''event_time'''
  when event_time is null then 'Invalid isoformat string: ''' || time_text || '''' end as failure
from decoded""",
    "dead_letters": """
select event_id, location, retry_count, failure as error_reason, location as key,
  '{"error_type":"CONSUMER3_RETRY_FAIL","error_reason":"' || failure || '","raw_row":' || value
    || ',"file_name":"processed_by_consumer3","retry_count":' || retry_count || '}' as value
from judged where failure is not null""",
    "errors": """
select r.event_id as id, error_type, error_reason as error_message, raw_row, location, file_name,
  ts as created_at, event_id % 3 = 0 as slack_sent
from rejected r""",
    "time_texts": """
select event_id, case
  when event_id % 97 = 0 then '2024-99-99 99:99:99'
  when event_id % 5 = 1 then strftime(ts, '%Y-%m-%dT%H:%M:%S')
  when event_id % 5 = 2 then strftime(ts, '%Y-%-m-%-d %-H:%-M:%-S')
  when event_id % 5 = 3 then strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
  else strftime(ts, '%Y-%m-%d %H:%M:%S') end as text
from events""",
    "topics": """
select *, case when event_id % 10 = 0 then 'error-data' when event_id % 10 <= 2 then 'retry-data'
  else 'weather-data' end as topic from events""",
    "samples": """
select ts, 'broker-' || (user_id % 3) as instance, event_id % 2000 as count,
  case when event_id % 89 = 0 then '' else topic end as topic from topics""",
}

_NEEDS = {
    "verdicts": ["raw_readings"],
    "rejected": ["verdicts"],
    "valid": ["verdicts"],
    "timed": ["valid"],
    "messages": ["valid"],
    "retry_messages": ["messages"],
    "decoded": ["retry_messages"],
    "judged": ["decoded"],
    "dead_letters": ["judged"],
    "errors": ["rejected"],
    "samples": ["topics"],
}


def _with(needs: list[str], body: str, extra: list[tuple[str, str]] = ()) -> str:
    """Put the named tables, everything they need, and the extra ones before a query."""
    order: list[str] = []

    def add(name: str) -> None:
        for other in _NEEDS.get(name, []):
            add(other)
        if name not in order:
            order.append(name)

    for name in needs:
        add(name)
    parts = [(name, _CTES[name]) for name in order] + list(extra)
    tables = ",\n".join(f"{name} as ({sql.strip()})" for name, sql in parts)
    return f"with {tables}\n{body.strip()}"


_DIVERTED = "cast('0x' || substr(md5('divert|' || event_id), 1, 8) as bigint) < ceil(0.2 * 4294967296)"


def _fired(source: str, keep: str, hi: int, lo: int, rain: int, wind: int, where: str = "true") -> str:
    rows = []
    for kind, column, op, limit in (
        ("TEMP_HIGH", "temperature_c", ">=", hi),
        ("TEMP_LOW", "temperature_c", "<=", lo),
        ("RAIN_HEAVY", "precipitation_mm", ">=", rain),
        ("WIND_STRONG", "wind_speed_kmh", ">=", wind),
    ):
        rows.append(
            f"select {keep}, '{kind}' as alert_type, {column} as value, "
            f"cast({limit} as double) as threshold from {source} "
            f"where {column} {op} {limit} and not isnan({column}) and {where}"
        )
    return "\nunion all\n".join(rows)


def _alert_fired(source="timed", keep="event_id, location, event_time", where="true") -> str:
    return _fired(source, keep, 35, 0, 30, 40, where)


_WHOLE = (
    "temperature_c is not null and precipitation_mm is not null and wind_speed_kmh is not null"
)


def _retry_fired(source="judged", keep="event_id, location, event_time, retry_count", where="failure is null") -> str:
    return _fired(source, keep, 31, -10, 11, 35, f"{_WHOLE} and {where}")


def _chain(fired: str, minutes: int, tag: str = "", seed: str = "") -> list[tuple[str, str]]:
    """Kept alerts: fold the sorted times of a key, adding each that lies a span after the last."""
    times = "list_transform(list(event_time order by event_time), lambda x: [x])"
    if seed:
        lists = f"""select f.location, f.alert_type, case when any_value(s.event_time) is null then {times}
  else list_prepend([any_value(s.event_time)], {times}) end as times, any_value(s.event_time) as seed
from firsts{tag} f left join {seed} s on f.location = s.location and f.alert_type = s.alert_type
group by f.location, f.alert_type""".replace("event_time order by event_time", "f.event_time order by f.event_time")
    else:
        lists = f"""select location, alert_type, {times} as times, cast(null as timestamp) as seed
from firsts{tag} group by location, alert_type"""
    return [
        (
            f"firsts{tag}",
            f"select location, alert_type, event_time, min(event_id) as event_id from {fired} group by all",
        ),
        (f"lists{tag}", lists),
        (
            f"chain{tag}",
            f"""select location, alert_type, event_time
from (select location, alert_type, seed, unnest(list_reduce(times, lambda kept, x:
        case when x[1] >= kept[-1] + interval {minutes} minute then list_concat(kept, x) else kept end))
        as event_time from lists{tag})
where seed is null or event_time > seed""",
        ),
        (
            f"kept{tag}",
            f"""select x.* from {fired} x join firsts{tag} using (location, alert_type, event_time, event_id)
join chain{tag} using (location, alert_type, event_time)""",
        ),
    ]


_KEPT = [("fired", _alert_fired())] + _chain("fired", 30)
_RETRY_KEPT = [("fired", _retry_fired())] + _chain("fired", 30)

_REASON = """case alert_type
  when 'TEMP_HIGH' then 'Temperature ' || value || '°C >= ' || threshold || '°C'
  when 'TEMP_LOW' then 'Temperature ' || value || '°C <= ' || threshold || '°C'
  when 'RAIN_HEAVY' then 'Rainfall ' || value || 'mm >= ' || threshold || 'mm'
  when 'WIND_STRONG' then 'Wind ' || value || ' km/h >= ' || threshold || ' km/h' end"""


_RAWS = """select event_id,
  body || ',"event_time":"' || strftime(event_time, '%Y-%m-%dT%H:%M:%S') || '"}' as raw
from messages where event_time is not null"""


def _alert_columns(profile: str, retry_count: str) -> str:
    return f"""md5('{profile}|' || location || '|' || alert_type || '|'
    || strftime(event_time, '%Y-%m-%dT%H:%M:%S')) as alert_id,
  location, alert_type, {_REASON} as alert_reason, event_time, value, threshold,
  false as slack_sent, {retry_count} as retry_count"""


_CYCLE_TIME = "timestamp '2024-02-01 00:00:00'"
_TENTH = "select id from errors where not slack_sent order by created_at, id limit 10"
_STRICT = """case when regexp_full_match({0}, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}\\s+\\d{{1,2}}:\\d{{1,2}}:\\d{{1,2}}')
  then try_strptime({0}, '%Y-%m-%d %H:%M:%S') end"""
_ARCHIVED = "select *, cast(event_time as date) as date from timed"

_LAYOUT = _with(
    ["timed"],
    """select location, date, count(*) as n_rows, min(event_time) as first_time, max(event_time) as last_time,
  cast(ceil(count(*) / 2000.0) as bigint) as min_files from archived group by location, date""",
    [("archived", _ARCHIVED)],
)
_KEPT_ROWS = "select event_id, location, event_time, alert_type, value from kept"

ORACLES = {
    "csv_scan": _with(
        ["raw_readings"],
        """select location, date_time, temperature_c, humidity_pct, precipitation_mm, wind_speed_kmh
from raw_readings""",
    ),
    "csv_scan_headers": _with(
        ["raw_readings"],
        """select case when event_id % 20 = 0 then '"The" ' || location || ', x' else location end as location,
  date_time, temperature_c, case when event_id % 4 <> 3 then humidity_pct end as humidity_pct,
  precipitation_mm, wind_speed_kmh from raw_readings""",
    ),
    "new_files_anti": _with(
        ["raw_readings"],
        """select distinct file_name from raw_readings
where cast(substr(file_name, 15, 2) as integer) % 2 <> 0""",
    ),
    "topic_encode": _with(
        ["messages", "regions"],
        """select event_id, location as key, body || '}' as value, 'weather-data' as topic, "partition"
from messages join (select * from regions union all select * from fresh) using (location)""",
        [
            (
                "fresh",
                """select location, cast(((select count(*) from regions)
    + row_number() over (order by first_seen, location) - 1) % 10 as integer) as "partition"
from (select location, coalesce(min(event_time), timestamp '9999-12-31') as first_seen from messages
      where location not in (select location from regions) group by location)""",
            )
        ],
    ),
    "topic_decode": _with(
        ["valid"],
        """select event_id, location, date_time, temperature_c, humidity_pct, precipitation_mm,
  wind_speed_kmh, cast(0 as double) as retry from valid""",
    ),
    "topic_read_from": _with(
        ["valid"],
        """select location, date_time, temperature_c, humidity_pct, precipitation_mm, wind_speed_kmh,
  cast(0 as double) as retry from valid where event_id % 3 >= 1""",
    ),
    "range_filter": _with(
        ["timed"],
        """select event_id, event_time from timed
where event_time >= timestamp '2024-01-05 12:00:00' and event_time < timestamp '2024-01-08'""",
    ),
    "time_span": _with(
        ["timed"],
        """select date_trunc('minute', min(event_time)) as start_time,
  date_trunc('minute', max(event_time)) as end_time, count(*) as n_rows from timed""",
    ),
    "json_decode_fixed": _with(
        ["valid"],
        """select event_id, case when ok then location end as location,
  case when ok then date_time end as date_time, case when ok then temperature_c end as temperature_c,
  case when ok and event_id % 19 <> 0 then humidity_pct end as humidity_pct,
  case when ok then precipitation_mm end as precipitation_mm,
  case when ok then wind_speed_kmh end as wind_speed_kmh,
  case when ok then cast(0 as double) end as retry
from (select *, event_id % 17 <> 0 as ok from valid)""",
    ),
    "json_decode_dynamic": _with(
        ["decoded"],
        """select event_id, location, temperature_c, precipitation_mm, wind_speed_kmh, has_temperature,
  event_time from decoded""",
    ),
    "json_encode": _with(
        ["raw_readings"],
        """select event_id, '{"Location":' || coalesce('"' || nullif(location, '') || '"', 'null')
  || ',"Date_Time":"' || date_time || '","Temperature_C":'
  || coalesce('"' || nullif(temperature_c, '') || '"', 'null') || ',"Humidity_pct":"' || humidity_pct
  || '","Precipitation_mm":"' || precipitation_mm || '","Wind_Speed_kmh":"' || wind_speed_kmh
  || '","retry":0}' as value from raw_readings""",
    ),
    "default_location": _with(
        ["raw_readings"],
        "select event_id, coalesce(nullif(location, ''), 'unknown') as location from raw_readings",
    ),
    "coerce_float": _with(
        ["raw_readings"],
        """select event_id, try_cast(temperature_c as double) as temperature,
  case when try_cast(temperature_c as double) is null
    then 'Invalid float field: Temperature_C=''' || temperature_c || '''' end as temperature_error,
  try_cast(humidity_pct as double) as humidity,
  case when try_cast(humidity_pct as double) is null
    then 'Invalid float field: Humidity_pct=''' || humidity_pct || '''' end as humidity_error
from raw_readings""",
    ),
    "coerce_int_default": _with(
        ["raw_readings"],
        """select event_id,
  case when regexp_full_match(wind_speed_kmh, '[+-]?\\d+') then cast(wind_speed_kmh as bigint) else 0 end as wind,
  case when regexp_full_match(temperature_c, '[+-]?\\d+') then cast(temperature_c as bigint) else 0 end as temperature
from raw_readings""",
    ),
    "event_time_lenient": _with(
        ["time_texts"],
        """select event_id, case when event_id % 97 <> 0 and event_id % 5 = 2
  then strptime(text, '%Y-%m-%d %H:%M:%S') else try_cast(text as timestamp) end as event_time
from time_texts""",
    ),
    "event_time_strict": _with(
        ["time_texts"], f"select event_id, {_STRICT.format('text')} as event_time from time_texts"
    ),
    "iso_roundtrip": """select event_id, case when event_id % 2 = 0 or microsecond(ts) % 1000000 = 0
    then strftime(ts, '%Y-%m-%dT%H:%M:%S') else strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') end as iso,
  case when event_id % 2 = 0 then date_trunc('second', ts) else ts end as event_time from events""",
    "iso_spellings": """select event_id, case event_id % 6 when 4 then date_trunc('day', ts) when 5 then null
    else date_trunc('second', ts) end as event_time from events""",
    "retry_increment": _with(["judged"], "select event_id, retry_count from judged"),
    "validate_missing": _with(["verdicts"], "select event_id, missing_field from verdicts"),
    "validate_type": _with(["verdicts"], "select event_id, type_error from verdicts"),
    "route_valid": _with(
        ["valid"],
        """select event_id, location, date_time, temperature_c, humidity_pct, precipitation_mm,
  wind_speed_kmh, 0 as retry from valid""",
    ),
    "route_errors": _with(
        ["rejected"], "select event_id, error_type, error_reason, key, file_name from rejected"
    ),
    "error_envelopes": _with(
        ["rejected"],
        """select event_id, key, '{"error_type":"' || error_type || '","error_reason":"' || error_reason
  || '","raw_row":' || raw_row || ',"timestamp":' || cast(event_id as double) || ',"file_name":"'
  || file_name || '","retry_count":0}' as value, 'error-data' as topic,
  cast(null as integer) as "partition" from rejected""",
    ),
    "file_counts": _with(
        ["verdicts"],
        """select file_name, count(*) filter (missing_field is null and type_error is null) as success_count,
  count(*) filter (missing_field is not null or type_error is not null) as error_count
from verdicts group by file_name""",
    ),
    "table_contract": _with(
        ["raw_readings"],
        """select event_id, case when nullif(location, '') is null then 'location is null'
  when event_id % 31 = 0 then 'alert_type is longer than 50'
  when try_cast(date_time as timestamp) is null then 'event_time is null' end as violation
from raw_readings""",
    ),
    "sample_retry": _with(["timed"], f"select event_id from timed where {_DIVERTED}"),
    "sample_fail": _with(
        ["timed"],
        """select event_id from timed
where cast('0x' || substr(md5('retry-failure|' || event_id), 1, 8) as bigint) < ceil(0.01 * 4294967296)""",
    ),
    "assign_partition": _with(
        ["valid", "regions"],
        'select event_id, location, "partition" from valid left join regions using (location)',
    ),
    "assign_new_partition": _with(
        ["timed", "regions"],
        """select location, cast(((select count(*) from regions)
    + row_number() over (order by first_seen, location) - 1) % 10 as integer) as "partition"
from (select location, min(event_time) as first_seen from timed
      where location not in (select location from regions) group by location)""",
    ),
    "detect_alerts": _with(
        ["valid"],
        f"select event_id, location, alert_type, value, threshold, {_REASON} as alert_reason from fired",
        [("fired", _alert_fired("valid", "event_id, location"))],
    ),
    "detect_alerts_retry": _with(
        ["judged"],
        f"select event_id, location, alert_type, value, threshold, {_REASON} as alert_reason from fired",
        [("fired", _retry_fired("judged", "event_id, location", "true"))],
    ),
    "drop_null_time": _with(
        ["valid"],
        """select location, count(*) as n_without_time from valid where event_time is null
group by location""",
    ),
    "cooldown_alerts": _with(["timed"], _KEPT_ROWS, _KEPT),
    "cooldown_six_hours": _with(
        ["timed"], _KEPT_ROWS, [("fired", _alert_fired())] + _chain("fired", 360)
    ),
    "cooldown_dense": """select 'Dallas' as location, 'TEMP_HIGH' as alert_type, t as event_id,
  make_timestamp((1704067200000 + t) * 1000) as event_time
from (select event_id * 64 + n as t, min(event_id * 64) over () as first
      from events, (select unnest(range(64)) as n)) where (t - first) % 7 = 0""",
    "cooldown_seeded": _with(
        ["timed"],
        _KEPT_ROWS,
        [
            ("fired_all", _alert_fired()),
            ("fired_early", "select * from fired_all where event_time < timestamp '2024-01-11'"),
            ("fired_late", "select * from fired_all where event_time >= timestamp '2024-01-11'"),
        ]
        + _chain("fired_early", 90, "_early")
        + [
            (
                "seed",
                """select location, alert_type, max(event_time) as event_time from kept_early
group by location, alert_type""",
            )
        ]
        + _chain("fired_late", 90, "", "seed"),
    ),
    "alerts_table": _with(
        ["retry_messages"],
        f"select {_alert_columns('alert', '0')}, raw as raw_json from kept join raws using (event_id)",
        [("timed", _CTES["timed"]), *_KEPT, ("raws", _RAWS)],
    ),
    "alert_counts": _with(
        ["timed"], "select alert_type, count(*) as n_alerts from kept group by alert_type", _KEPT
    ),
    "alerts_by_filter": _with(
        ["timed"],
        """select alert_id, location, alert_type, event_time, value, threshold from alerts
where event_time >= timestamp '2024-01-10 06:00:00' and event_time < timestamp '2024-01-12 18:00:00'
  and location in ('Dallas', 'Chicago') and alert_type in ('RAIN_HEAVY', 'TEMP_HIGH') and not slack_sent""",
        _KEPT + [("alerts", f"select {_alert_columns('alert', '0')} from kept")],
    ),
    "alerts_union": _with(
        ["timed"],
        f"""select {_alert_columns('alert', '0')} from kept
union all select {_alert_columns('retry', '1')} from kept_late""",
        [("fired", _alert_fired(where=f"not ({_DIVERTED})"))]
        + _chain("fired", 30)
        + [("fired_late", _retry_fired("timed", "event_id, location, event_time", _DIVERTED))]
        + _chain("fired_late", 30, "_late"),
    ),
    "render_alert": _with(
        ["timed"],
        f"""select event_id, alert_type, case alert_type when 'TEMP_HIGH' then '🔥' when 'TEMP_LOW' then '❄️'
    when 'RAIN_HEAVY' then '🌧️' when 'WIND_STRONG' then '💨' end
  || ' *' || replace(alert_type, '_', ' ') || ' Alert*' || chr(10) || 'Location: ' || location || chr(10)
  || {_REASON} || chr(10) || 'Event Time: ' || strftime(event_time, '%Y-%m-%d %H:%M:%S') || chr(10)
  || 'Window: ' || strftime(date_trunc('minute', event_time), '%Y-%m-%d %H:%M:%S') || ' ~ '
  || strftime(date_trunc('minute', event_time) + interval 1 minute, '%Y-%m-%d %H:%M:%S') as text
from kept""",
        _KEPT,
    ),
    "window_collect": _with(
        ["timed"],
        """select date_trunc('hour', event_time) as window_start,
  date_trunc('hour', event_time) + interval 1 hour as window_end, location, cast(0 as integer) as part,
  count(*) as n_rows, min(event_time) as first_time, max(event_time) as last_time,
  min(event_id) as least_id, cast(sum(event_id) as bigint) as sum_ids,
  max(temperature_c) as max_temperature
from timed group by 1, 2, 3""",
    ),
    "window_rows": _with(
        ["timed"],
        """select event_id, location, date_trunc('minute', event_time) as window_start,
  date_trunc('minute', event_time) + interval 1 minute as window_end from timed""",
    ),
    "window_counts": _with(
        ["timed"],
        """select date_trunc('minute', event_time) as window_start,
  date_trunc('minute', event_time) + interval 1 minute as window_end, location, count(*) as n_rows
from timed group by all""",
    ),
    "time_slices": _with(
        ["timed"],
        """select strftime(slice_start, 'weather_%Y%m%d_%H%M%S') as slice_name, slice_start, count(*) as n_rows
from (select time_bucket(interval 10 minute, event_time,
        (select date_trunc('minute', min(event_time)) from timed)) as slice_start from timed)
group by slice_start""",
    ),
    "archive_filter": _with(
        ["time_texts"],
        f"""select event_id, 'unknown' as location, event_time, cast(event_time as date) as date
from (select event_id, {_STRICT.format('text')} as event_time from time_texts) where event_time is not null""",
    ),
    "archive_layout": _LAYOUT,
    "archive_roundtrip": _LAYOUT,
    "daily_summary": _with(
        ["timed"],
        """select location, date, count(*) as n_readings, min(temperature_c) as min_temperature,
  max(temperature_c) as max_temperature,
  cast(sum(cast(temperature_c as decimal(18,4))) as double) / count(temperature_c) as avg_temperature,
  cast(sum(cast(precipitation_mm as decimal(18,4))) as double) as total_precipitation,
  max(wind_speed_kmh) as max_wind_speed
from archived group by location, date""",
        [("archived", _ARCHIVED)],
    ),
    "daily_summary_wide": _with(
        ["timed"],
        """select location, date, count(*) as n_readings, min(t) as min_temperature, max(t) as max_temperature,
  cast(sum(cast(f as decimal(38,12))) as double) / nullif(count(f), 0) as avg_temperature,
  cast(sum(cast(r as decimal(38,12))) as double) as total_precipitation,
  max(wind_speed_kmh) as max_wind_speed
from (select *, case when isnan(t) then null else t end as f from changed) group by location, date""",
        [
            ("archived", _ARCHIVED),
            (
                "changed",
                """select *, case when event_id % 3 = 0 then trunc(temperature_c) + 0.000125
    when event_id % 7 = 0 then cast('nan' as double) else temperature_c end as t,
  case when event_id % 11 = 0 then 1e15 else precipitation_mm end as r from archived""",
            ),
        ],
    ),
    "retry_alerts": _with(
        ["judged"],
        f"""select event_id, {_alert_columns('retry', 'retry_count')}, value as raw_json
from (select k.* exclude (value), k.value, m.value as message from kept k
      join retry_messages m using (event_id))""".replace("value as raw_json", "message as raw_json"),
        _RETRY_KEPT,
    ),
    "render_retry": _with(
        ["judged"],
        f"""select event_id, alert_type, '♻️ *Retry Alert (' || retry_count || ')*' || chr(10)
  || 'Location: ' || location || chr(10) || {_REASON} || chr(10)
  || 'Time: ' || strftime(event_time, '%Y-%m-%d %H:%M:%S') as text from kept""",
        _RETRY_KEPT,
    ),
    "retry_dlq": _with(
        ["dead_letters"],
        """select event_id, location, retry_count, error_reason, key, value, 'error-data' as topic,
  cast(null as integer) as "partition" from dead_letters""",
    ),
    "retry_republish": _with(
        ["judged"],
        """select event_id, location, retry_count, '{"Location":"' || location || '","Date_Time":"'
  || json_extract_string(value, '$.Date_Time') || '","Temperature_C":'
  || coalesce(cast(temperature_c as varchar), 'null') || ',"Humidity_pct":'
  || cast(cast(json_extract_string(value, '$.Humidity_pct') as double) as varchar) || ',"Precipitation_mm":'
  || precipitation_mm || ',"Wind_Speed_kmh":' || wind_speed_kmh || ',"retry":' || retry_count || '}' as value,
  'weather-data' as topic
from judged where failure is null and retry_count < 3""",
    ),
    "dlq_load": _with(
        ["rejected", "dead_letters"],
        """select event_id, error_type, error_reason as error_message, raw_row, location, file_name,
  0 as retry_count, 'NEW' as processing_status, false as slack_sent,
  timestamp '1970-01-01' + event_id * interval 1 second as detected_at,
  md5('error-data|' || event_id % 3 || '|' || event_id) as id from rejected
union all
select event_id, 'CONSUMER3_RETRY_FAIL', error_reason, json_extract(value, '$.raw_row')::varchar, location,
  'processed_by_consumer3', retry_count, 'NEW', false, cast(null as timestamp),
  md5('error-data|' || event_id % 3 || '|' || event_id) from dead_letters""",
    ),
    "outbox_top10": _with(
        ["errors"],
        """select id, error_type, error_message, location, file_name, raw_row, created_at
from errors where not slack_sent order by created_at, id limit 10""",
    ),
    "render_error": _with(
        ["errors"],
        """select id, '🚨 *Error Detected*' || chr(10) || '• Type: `' || error_type || '`' || chr(10)
  || '• Location: `' || location || '`' || chr(10) || '• File: `' || file_name || '`' || chr(10)
  || '• Reason: ' || error_message || chr(10) || '• Raw Row: ```{' || chr(10) || '  '
  || replace(replace(substr(raw_row, 2, length(raw_row) - 2), ',"', ',' || chr(10) || '  "'), '":', '": ')
  || chr(10) || '}```' || chr(10) || '• Time: ' || case when microsecond(created_at) % 1000000 = 0
    then strftime(created_at, '%Y-%m-%d %H:%M:%S') else strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') end as text
from errors""",
    ),
    "outbox_ack": _with(
        ["errors"],
        """select id, slack_sent or id % 5 = 0 as slack_sent,
  case when id % 5 = 0 then created_at + interval 1 minute end as slack_sent_at from errors""",
    ),
    "outbox_cycle": _with(
        ["errors"],
        f"""select id, slack_sent or id in (select id from done) as slack_sent,
  case when id in (select id from done) then {_CYCLE_TIME} end as slack_sent_at from errors""",
        [
            ("one", f"select id from errors where error_type = 'TYPE_ERROR' and id in ({_TENTH})"),
            (
                "two",
                f"""select id from errors where error_type = 'TYPE_ERROR' and id in (
  select id from errors where not slack_sent and id not in (select id from one)
  order by created_at, id limit 10)""",
            ),
            ("done", "select id from one union all select id from two"),
        ],
    ),
    "alert_outbox_cycle": _with(
        ["timed"],
        f"""select alert_id, alert_id in (select alert_id from done) as slack_sent,
  case when alert_id in (select alert_id from done) then {_CYCLE_TIME} end as slack_sent_at from alerts""",
        _KEPT
        + [
            ("alerts", f"select {_alert_columns('alert', '0')} from kept"),
            ("oldest", "select * from alerts order by event_time, alert_id limit 10"),
            ("one", "select alert_id from oldest where alert_type = 'TEMP_HIGH'"),
            (
                "next",
                """select * from alerts where alert_id not in (select alert_id from one)
order by event_time, alert_id limit 10""",
            ),
            ("done", "from one union all select alert_id from next where alert_type = 'TEMP_HIGH'"),
        ],
    ),
    "topic_tps": _with(
        ["samples"],
        """select window_start, topic, cast(sum(increase) as bigint) as increase, round(sum(increase / seconds), 6) as rate
from (select window_start, instance, topic, sum(grown) as increase,
        (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 as seconds
      from (select *, case when before is null then 0 when count < before then count else count - before end as grown
            from (select *, lag(count) over (partition by window_start, instance, topic order by ts, count) as before
                  from (select *, date_trunc('hour', ts) as window_start from samples)))
      group by window_start, instance, topic)
where seconds > 0 group by window_start, topic""",
    ),
    "outbox_poison": _with(
        ["errors"],
        """select id, slack_sent or not fails as slack_sent,
  cast(case when slack_sent or fails then 0 else 1 end as bigint) as n_sent,
  cast(case when not slack_sent and fails then 2 else 0 end as bigint) as n_failed,
  count(*) filter (not slack_sent and fails) over () as n_due_again
from (select *, id % 211 = 0 and id < 211 * 15 as fails from errors)""",
    ),
    "topic_rate_steps": _with(
        ["samples"],
        """select step_time, topic, round(sum(grown * (span + head + tail) / span / 21600), 9) as rate
from (select *,
        least(case when to_first >= mean * 1.1 then mean / 2 else to_first end,
              case when grown > 0 and first >= 0 then span * (first / grown) end) as head,
        case when to_last >= mean * 1.1 then mean / 2 else to_last end as tail
      from (select step_time, instance, topic, count(*) as n, cast(sum(up) as double) as grown,
              cast(arg_min(count, (ts, count)) as double) as first,
              (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 as span,
              (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 / (count(*) - 1) as mean,
              (epoch_us(min(ts)) - epoch_us(step_time) + 21600000000) / 1e6 as to_first,
              (epoch_us(step_time) - epoch_us(max(ts))) / 1e6 as to_last
            from (select *, case when before is null then 0 when count < before then count
                    else count - before end as up
                  from (select step_time, instance, topic, ts, count, lag(count) over (
                          partition by step_time, instance, topic order by ts, count) as before
                        from steps join samples on ts <= step_time and ts > step_time - interval 6 hour
                        where topic <> ''))
            group by step_time, instance, topic having count(*) > 1 and max(ts) > min(ts)))
group by step_time, topic""",
        [
            (
                "steps",
                """select unnest(generate_series(date_trunc('hour', min(ts)),
  date_trunc('hour', max(ts)) + interval 7 hour, interval 1 hour)) as step_time from events""",
            )
        ],
    ),
    "topic_tps_counted": _with(
        ["topics"],
        """select date_trunc('hour', ts) as window_start, topic, count(*) as n_messages,
  round(count(*) / 3600.0, 6) as rate from topics group by all""",
    ),
    "consumer_lag": _with(
        ["topics"],
        """select hour as ts, "group", cast(sum(lag) as bigint) as lag
from (select date_trunc('hour', ts) as hour, event_type as "group",
        case when user_id % 50 > 0 then user_id % 50 else event_id end as lag,
        row_number() over (partition by date_trunc('hour', ts), event_type, topic, user_id % 10
                           order by ts desc, event_id desc) as place
      from topics)
where place = 1 group by all""",
    ),
    "topic_list": _with(["samples"], "select distinct topic from samples where topic <> ''"),
    "stream_cooldown_alerts": _with(["timed"], _KEPT_ROWS, _KEPT),
    "stream_cooldown_batches": _with(["timed"], _KEPT_ROWS, _KEPT),
    "restart_exactly_once": _with(["timed"], _KEPT_ROWS, _KEPT),
    "late_drop": _with(
        ["timed"],
        """select window_start, window_start + interval 1 hour as window_end, location, n_rows
from (select date_trunc('hour', event_time) as window_start, location, count(*) as n_rows
      from timed group by 1, 2)""",
    ),
    "replay_exactly_once": _with(
        ["timed"],
        """select location, n_archived, n_alerts, n_alerts as n_ids, n_alerts as n_raw, n_alerts as n_created
from (select location, count(*) as n_archived from timed group by location)
left join (select location, count(*) as n_alerts from kept group by location) using (location)""",
        _KEPT,
    ),
    "archive_compacted": _with(
        ["timed"],
        """select location, cast(event_time as date) as date, count(*) as n_rows,
  cast(1 as bigint) as n_files, cast(sum(event_id) as bigint) as sum_ids
from timed where not (location = 'Dallas' and event_id % 3 = 2) group by 1, 2""",
    ),
    "alerts_repeated_delivery": _with(
        ["timed"],
        """select md5('alert|' || location || '|' || alert_type || '|'
    || strftime(event_time, '%Y-%m-%dT%H:%M:%S')) as alert_id, location, alert_type, event_time,
  threshold, cast(1 as bigint) as n_rows, location as raw_location,
  strftime(event_time, '%Y-%m-%dT%H:%M:%S') as raw_time
from kept""",
        _KEPT,
    ),
    "stream_observed": _with(
        ["timed"],
        """select batch, n_valid, n_invalid, n_valid as n_rows, n_without_time,
  case when batch = 2 then n_timed else 0 end as n_late,
  (select count(*) from kept where case when day(event_time) <= 10 then 0 else 1 end = batch) as n_alerts,
  n_without_time as n_put_aside
from (select cast(case when early and location <> 'Busan' then 0 when not early then 1 else 2 end as bigint) as batch,
        count(*) filter (fine) as n_valid, count(*) filter (not fine) as n_invalid,
        count(*) filter (fine and event_time is null) as n_without_time,
        count(*) filter (fine and event_time is not null) as n_timed
      from (select *, missing_field is null and type_error is null as fine,
              try_cast(date_time as timestamp) as event_time,
              coalesce(day(try_cast(date_time as timestamp)) <= 10, event_id % 2 = 0) as early
            from verdicts)
      group by 1)""",
        [("fired", _alert_fired(where="(day(event_time) > 10 or location <> 'Busan')"))]
        + _chain("fired", 30),
    ),
    "consumer_lag_live": _with(
        ["valid"],
        """select batch, 'lagging' as "group",
  cast(sum(n) over () - sum(n) over (order by batch) as bigint) as lag
from (select cast(least((day(ts) - 1) // 5, 5) as bigint) as batch, count(*) as n from valid group by 1)""",
    ),
    "late_alerts": _with(
        ["timed"],
        """select md5('alert|' || location || '|' || alert_type || '|'
    || strftime(event_time, '%Y-%m-%dT%H:%M:%S')) as alert_id, location, alert_type, event_time,
  (select count(*) from timed where location = 'Busan' and day(event_time) <= 10) as n_late
from kept""",
        [("fired", _alert_fired(where="(day(event_time) > 20 or location <> 'Busan')"))]
        + _chain("fired", 30),
    ),
}
ORACLES["daily_summary_incremental"] = ORACLES["daily_summary"]
# The same alerts, in one piece or as a stream that the early ones seed.
ORACLES["stream_cooldown_seeded"] = ORACLES["cooldown_seeded"]
