"""DuckDB SQL that states the expected result of each registered query.

Every statement reads the driver's tables (``events``) directly; the CTEs
below restate the fixture mapping and the session rules in plain SQL.
"""

from __future__ import annotations

from bayline.sources.fixture import FIXTURE_TIMEOUT_SECONDS

T = FIXTURE_TIMEOUT_SECONDS
PRICE, BLOCK = 10000, 600
N_ZONES = 3
CLOSED_LIMIT = 50


def _cost(d: str) -> str:
    return f"cast(ceil(({d}) / cast({BLOCK} as double)) as bigint) * {PRICE}"


PE = """
pe as (
  select event_id,
         strftime(ts, '%Y-%m-%d %H:%M:%S') as "timestamp",
         cast(floor(epoch(ts)) as bigint) as timestamp_unix,
         'P' || lpad(cast(user_id as varchar), 6, '0') as license_plate,
         substr('ABCDEF', cast(user_id % 6 as integer) + 1, 1)
           || cast((user_id // 12) * 3 + event_id % 3 + 1 as varchar) as location,
         case event_type when 'signup' then 'ENTERING' when 'view' then 'PARKED'
              when 'click' then 'PARKED' when 'error' then 'MOVING'
              when 'purchase' then 'EXITING' end as status_code,
         value, props
  from events)"""

AS_OF = "a as (select max(timestamp_unix) as as_of from pe)"


def _sessions_ctes(exit_rule: bool = True) -> str:
    split = "ps = 'EXITING' or " if exit_rule else ""
    closed = ("max(case when status_code = 'EXITING' then 1 else 0 end)" if exit_rule
              else "0")
    return f"""
l as (
  select *, lag(status_code) over w as ps, lag(timestamp_unix) over w as pt from pe
  window w as (partition by license_plate, location order by timestamp_unix, event_id)),
n as (
  select *, cast(sum(case when pt is null or {split}timestamp_unix - pt > {T}
                          then 1 else 0 end)
    over (partition by license_plate, location order by timestamp_unix, event_id
          rows between unbounded preceding and current row) as bigint) as session_no from l),
g as (
  select license_plate, location, session_no,
         min(timestamp_unix) as start_time, max(timestamp_unix) as end_time,
         count(*) as n_events, {closed} as closed,
         arg_max(event_id, (timestamp_unix, event_id)) as last_event_id
  from n group by license_plate, location, session_no),
{AS_OF},
sess as (
  select license_plate, location, session_no, start_time, end_time,
         end_time - start_time as duration,
         {_cost('end_time - start_time')} as cost,
         case when closed = 1 then 'CLOSED'
              when as_of - end_time > {T} then 'TIMEOUT' else 'ACTIVE' end as status,
         end_time as last_updated, cast(n_events as bigint) as n_events, last_event_id
  from g cross join a)"""


CHG = f"""
chg as (
  select license_plate, location, session_no,
         min(timestamp_unix) over (partition by license_plate, location, session_no) as start_time,
         timestamp_unix as end_time,
         timestamp_unix - min(timestamp_unix) over (partition by license_plate, location, session_no)
           as duration,
         {_cost('timestamp_unix - min(timestamp_unix) over (partition by license_plate, location, session_no)')}
           as cost,
         case when status_code = 'EXITING' then 'CLOSED' else 'ACTIVE' end as status,
         timestamp_unix as last_updated, timestamp_unix as change_time,
         cast(0 as bigint) as change_kind, event_id
  from n
  union all
  select license_plate, location, session_no, start_time, end_time, duration, cost, status,
         last_updated, end_time + {T} as change_time, cast(1 as bigint) as change_kind,
         last_event_id as event_id
  from sess where status = 'TIMEOUT')"""

DIM = f"""
m as (select cast((max(user_id) // 12) * 3 + 4 as bigint) as nc from events),
grid as (select cast(r as bigint) as r, unnest(generate_series(1, nc)) as c
         from range(6) t(r) cross join m),
dim as (
  select substr('ABCDEF', cast(r as integer) + 1, 1) || cast(c as varchar) as location,
         substr('ABCDEF', cast(r as integer) + 1, 1) as "row",
         cast(c as bigint) as col,
         cast(r * nc + c - 1 as bigint) as idx,
         cast(least(floor((r * nc + c - 1) / greatest((6 * nc) // {N_ZONES}, 1)), {N_ZONES - 1})
              as bigint) as zone
  from grid cross join m)"""

BUSY = "busy as (select distinct location from sess where status = 'ACTIVE')"


def _with(*ctes: str) -> str:
    return "with " + ",".join(ctes) + "\n"


SESSION_FIELDS = "license_plate, location, start_time, end_time, duration, cost, status, last_updated"


def oracle_sql() -> dict[str, str]:
    S = _sessions_ctes()
    q: dict[str, str] = {}
    q["parking_events"] = _with(PE) + """
select event_id, "timestamp", timestamp_unix, license_plate, location, status_code from pe"""
    q["parking_sessions"] = _with(PE, S) + "select * exclude (last_event_id) from sess"
    q["gap_sessions"] = (_with(PE, _sessions_ctes(exit_rule=False))
                         + "select * exclude (last_event_id) from sess")
    q["stream_sessions"] = _with(PE, S) + f"select {SESSION_FIELDS}, n_events from sess"
    q["stream_sessions_ordered"] = q["stream_sessions"]
    # the keyed-state changelog of a replay in 4 equal time slices, one trigger
    # per slice: a session gives one ACTIVE row for each slice in which it has
    # events and is still open at the slice's end, plus its final row
    q["stream_changelog"] = _with(PE, S) + f"""
, nb as (select min(timestamp_unix) as lo, (max(timestamp_unix) - min(timestamp_unix)) // 4 + 1
                as width from pe),
ev as (select n.*, cast(floor((timestamp_unix - lo) / cast(width as double)) as bigint) as slice
       from n cross join nb),
info as (
  select license_plate, location, session_no, min(timestamp_unix) as s_start,
         arg_min(event_id, (timestamp_unix, event_id)) as first_id,
         max(slice) as last_slice
  from ev group by license_plate, location, session_no),
nxt as (
  select *, lead(first_slice) over (partition by license_plate, location order by session_no)
              as next_first_slice
  from (select i.*, (select min(slice) from ev e where e.license_plate = i.license_plate
                     and e.location = i.location and e.session_no = i.session_no) as first_slice
        from info i)),
per_slice as (
  select license_plate, location, session_no, slice, max(timestamp_unix) as end_k,
         count(*) as cnt_k
  from ev group by license_plate, location, session_no, slice),
cum as (
  select p.*, sum(cnt_k) over (partition by license_plate, location, session_no
                               order by slice) as n_k
  from per_slice p),
active_rows as (
  select c.license_plate, c.location, x.s_start as start_time, c.end_k as end_time,
         c.end_k - x.s_start as duration, {_cost('c.end_k - x.s_start')} as cost,
         'ACTIVE' as status, c.end_k as last_updated, cast(c.n_k as bigint) as n_events,
         x.first_id as start_event_id
  from cum c
  join nxt x using (license_plate, location, session_no)
  join sess t using (license_plate, location, session_no)
  where not (c.slice = x.last_slice
             and (t.status = 'CLOSED' or coalesce(x.next_first_slice = c.slice, false)))),
final_rows as (
  select t.license_plate, t.location, t.start_time, t.end_time, t.duration, t.cost, t.status,
         t.last_updated, t.n_events, x.first_id as start_event_id
  from sess t join nxt x using (license_plate, location, session_no)
  where t.status <> 'ACTIVE')
select * from active_rows union all select * from final_rows"""
    q["stream_table_sessions"] = q["stream_sessions"]
    q["stream_gap_sessions"] = (_with(PE, _sessions_ctes(exit_rule=False)) + """
select license_plate, location, start_time, end_time, duration, cost, n_events from sess
where status = 'TIMEOUT'""")
    q["decode_events"] = _with(PE) + """
select event_id, "timestamp", timestamp_unix, license_plate, location, status_code
from pe where value >= 1.5"""
    q["bad_events"] = _with(PE) + """
select event_id,
       case when value < 0.5 then 'unparseable' when value < 1.0 then 'missing_plate'
            else 'missing_time' end as reason
from pe where value < 1.5"""
    q["encode_changelog"] = _with(PE, S) + """
select license_plate as key,
       to_json(struct_pack(license_plate := license_plate, location := location,
                           start_time := start_time, end_time := end_time,
                           duration := duration, cost := cost, status := status,
                           last_updated := last_updated)) as value
from sess"""
    q["session_changelog"] = _with(PE, S, CHG) + "select * from chg"
    q["exit_notifications"] = _with(PE, S) + """
select 'EXIT' as type, license_plate, location, duration, cost, end_time as "timestamp",
       printf('Xe %s đã rời vị trí %s', license_plate, location) as message
from sess where status = 'CLOSED'"""
    q["location_dim"] = _with(DIM) + "select * from dim"
    q["valid_locations"] = _with(PE, DIM) + """
, req as (select distinct lower(substr(location, 1, 1)) || json_extract_string(props, '$.k')
                 as location_id from pe)
select location_id, upper(location_id) as location,
       upper(location_id) in (select location from dim) as valid
from req"""
    q["active_sessions"] = _with(PE, S) + f"""
select license_plate, location, start_time, as_of - start_time as duration,
       {_cost('as_of - start_time')} as cost, 'ACTIVE' as status
from sess cross join a where status = 'ACTIVE'"""
    q["active_by_plate"] = _with(PE, S, CHG) + f"""
, last as (
  select *, row_number() over (partition by license_plate
            order by change_time desc, change_kind desc, coalesce(event_id, 0) desc,
                     location desc, status desc, start_time desc) as rn
  from chg)
select license_plate, location, start_time, as_of - start_time as duration,
       {_cost('as_of - start_time')} as cost, 'ACTIVE' as status
from last cross join a where rn = 1 and status = 'ACTIVE'"""
    q["occupancy"] = _with(PE, S, CHG) + """
, last as (
  select *, row_number() over (partition by location
            order by change_time desc, change_kind desc, coalesce(event_id, 0) desc,
                     license_plate desc, status desc) as rn
  from chg)
select location, license_plate, status as last_status, status = 'ACTIVE' as occupied
from last where rn = 1"""
    q["busy_locations"] = _with(PE, S, BUSY) + "select location from busy"
    q["free_locations"] = _with(PE, S, BUSY, DIM) + """
select location from dim where location not in (select location from busy)"""
    q["location_info"] = _with(PE, S, DIM) + f"""
, occ as (
  select location, start_time, license_plate,
         row_number() over (partition by location order by start_time, license_plate) as rn
  from sess where status = 'ACTIVE')
select d.location, case when o.location is null then 'FREE' else 'OCCUPIED' end as status,
       o.license_plate, o.start_time, as_of - o.start_time as duration,
       {_cost('as_of - o.start_time')} as cost
from dim d left join (select * from occ where rn = 1) o on d.location = o.location
cross join a"""
    q["location_info_at"] = _with(PE, S, CHG) + f"""
, scan as (
  select location, change_time as t, 0 as is_request, change_kind, coalesce(event_id, 0) as id, license_plate,
         status, null as request_id, {{'status': status, 'plate': license_plate, 'start': start_time}} as held
  from chg
  union all
  select location, timestamp_unix + 3600, 1, 0, 0, '', '', event_id, null from pe),
seen as (
  select *, last_value(held ignore nulls) over (partition by location
              order by t, is_request, change_kind, id, license_plate, status
              rows between unbounded preceding and current row) as h
  from scan)
select request_id, location, t as "at",
       case when h.status = 'ACTIVE' then 'OCCUPIED' else 'FREE' end as status,
       case when h.status = 'ACTIVE' then h.plate end as license_plate,
       case when h.status = 'ACTIVE' then h.start end as start_time,
       case when h.status = 'ACTIVE' then t - h.start end as duration,
       case when h.status = 'ACTIVE' then {_cost('t - h.start')} end as cost
from seen where is_request = 1"""
    q["closed_history"] = _with(PE, S) + f"""
select {SESSION_FIELDS} from sess where status = 'CLOSED'
order by end_time desc, license_plate, location, start_time limit {CLOSED_LIMIT}"""
    q["statistics"] = _with(PE, S, BUSY, DIM) + """
select (select count(*) from dim) as total_locations,
       (select count(*) from busy) as busy_count,
       (select count(*) from dim where location not in (select location from busy)) as free_count,
       (select count(*) from sess where status = 'ACTIVE') as active_sessions,
       (select count(*) from sess where status = 'CLOSED') as closed_sessions_total"""
    allowed = " or ".join(
        f"(ps = '{a}' and status_code = '{b}')" for a, b in (
            ("ENTERING", "PARKED"), ("PARKED", "PARKED"), ("PARKED", "MOVING"),
            ("PARKED", "EXITING"), ("MOVING", "EXITING"), ("EXITING", "ENTERING")))
    q["transition_audit"] = _with(PE, S) + f"""
, p as (select *, pt is null as at_start from l)
select at_start, case when at_start then null else ps end as from_status,
       status_code as to_status, count(*) as n_transitions,
       count(distinct license_plate || '|' || location) as n_keys
from p
where not coalesce(case when at_start then status_code = 'ENTERING' else ({allowed}) end, false)
group by 1, 2, 3"""
    q["zone_occupancy"] = _with(PE, S, BUSY, DIM) + """
select zone, count(*) as n_locations,
       cast(sum(case when b.location is not null then 1 else 0 end) as bigint) as busy_count,
       cast(sum(case when b.location is null then 1 else 0 end) as bigint) as free_count
from dim d left join busy b on d.location = b.location group by zone"""
    q["plate_conflicts"] = _with(PE, S) + """
select license_plate, count(distinct location) as n_locations,
       min(location) as first_location, max(location) as last_location
from sess where status = 'ACTIVE' group by license_plate
having count(distinct location) > 1"""
    q["spot_conflicts"] = _with(PE, S) + """
select x.location, x.license_plate as plate_a, x.start_time as start_a, x.end_time as end_a,
       y.license_plate as plate_b, y.start_time as start_b, y.end_time as end_b,
       y.start_time as overlap_start, least(x.end_time, y.end_time) as overlap_end
from sess x join sess y
  on x.location = y.location
 and (x.start_time, x.license_plate, x.session_no) < (y.start_time, y.license_plate, y.session_no)
 and y.start_time <= x.end_time
where x.license_plate <> y.license_plate"""
    q["stream_spot_conflicts"] = q["spot_conflicts"]
    q["stream_active_by_plate"] = q["active_by_plate"]
    q["stream_occupancy"] = q["occupancy"]
    q["stream_unordered"] = q["stream_table_sessions"]
    q["stream_sessions_salted"] = q["stream_sessions"]
    q["state_active_sessions"] = q["active_sessions"]
    # arrival in three slices; a row is late when it lies at or before the
    # newest readable event of earlier slices less six hours
    q["stream_late_events"] = _with(PE) + """
, arr as (select *, timestamp_unix + (event_id * 7919) % 172800 as arrival from pe),
nb as (select min(arrival) as lo, (max(arrival) - min(arrival)) // 3 + 1 as width from arr),
sl as (select arr.*, (arrival - lo) // width as slice,
              case when value < 0.5 then 'unparseable' when value < 1.0 then 'missing_plate'
                   when value < 1.5 then 'missing_time' end as reason
       from arr cross join nb),
clock as (select s.slice, max(e.timestamp_unix) as newest
          from (select distinct slice from sl) s join sl e on e.slice < s.slice and e.reason is null
          group by s.slice),
rows as (
  select event_id, coalesce(reason, status_code) as detail,
         case when reason is not null then 'bad'
              when timestamp_unix <= newest - 21600 then 'late' else 'accepted' end as outcome
  from sl left join clock using (slice)),
counted as (
  select 'accepted' as outcome, cast(null as bigint) as event_id, cast(null as varchar) as detail,
         count(*) filter (outcome = 'accepted') as n from rows
  union all
  select outcome, event_id, detail, 1 from rows where outcome <> 'accepted')
select form, outcome, event_id, detail, cast(n as bigint) as n
from counted cross join (select unnest(['keyed', 'ordered', 'table']) as form)"""
    q["stream_live_gap_sessions"] = (_with(PE, _sessions_ctes(exit_rule=False))
                                     + f"select {SESSION_FIELDS}, n_events from sess")
    q["stream_compacted_changelog"] = q["stream_sessions"]
    q["stream_fan_out"] = _with(PE, S) + f"""
select sink, {SESSION_FIELDS} from sess cross join (select unnest(['table', 'wire']) as sink)"""
    row = "license_plate, location, start_time, end_time, duration, cost, status, n_events"
    q["stream_live_views"] = _with(PE, S) + f"""
, latest as (
  select {row} from sess where status = 'CLOSED'
  order by end_time desc, license_plate, location, start_time limit {CLOSED_LIMIT})
select 'active' as view, {row} from sess where status = 'ACTIVE'
union all select 'closed', {row} from latest
union all select 'closed_total', null, null, null, null, null, null, null, count(*) from sess where status = 'CLOSED'"""
    q["changelog_round_trip"] = _with(PE, S) + f"select {SESSION_FIELDS} from sess"
    return q
