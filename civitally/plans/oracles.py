"""Independent SQL for every registered query, in the DuckDB dialect."""

from __future__ import annotations

from ..sources.adapters import DENSE_AS_OF, DENSE_CUT, HISTORY_AS_OF, HISTORY_CUT

_A_NOW, _B_NOW = f"timestamp '{HISTORY_AS_OF}'", f"timestamp '{DENSE_AS_OF}'"
_A_CUT, _B_CUT = f"timestamp '{HISTORY_CUT}'", f"timestamp '{DENSE_CUT}'"
_A_CUT_DAY = f"timestamp '{HISTORY_CUT:%Y-%m-%d} 00:00:00'"

_HOURS = (
    "cast(cast(date_diff('second', created_date, closed_date) / 3600.0::double"
    " as decimal(20,8)) as decimal(10,2))"
)

_HISTORY = f"""
req0 as (
  select o_orderkey as unique_key,
    case when o_orderkey % 11 <> 0 then o_orderpriority end as agency,
    c_mktsegment as complaint_type,
    case when o_orderkey % 13 <> 0 then concat('D', cast(o_orderkey % 4 as varchar)) end as descriptor,
    r_name as borough, n_name as community_board,
    case when o_orderkey % 5 <> 0 then 10000 + cast(c_nationkey as bigint) * 10 + o_orderkey % 3 end as incident_zip,
    case when o_orderkey % 6 <> 0 then concat('CITY_', n_name) end as city,
    case when o_orderkey % 8 <> 0 then concat('AT_', cast(o_orderkey % 3 as varchar)) end as address_type,
    case when o_orderkey % 9 <> 0 then concat('LT_', cast(o_orderkey % 5 as varchar)) end as location_type,
    case when o_orderkey % 10 <> 0 then cast(c_nationkey as bigint) + 1 end as council_district,
    concat('Precinct ', cast(c_nationkey as varchar)) as police_precinct,
    case when o_orderkey % 4 <> 0 then cast(c_nationkey as double) + (o_orderkey % 7) / 10.0::double end as latitude,
    case when o_orderkey % 4 <> 0 then -cast(c_nationkey as double) - (o_orderkey % 3) / 10.0::double end as longitude,
    case when o_orderstatus = 'O' then 'Open' else 'Closed' end as status,
    o_orderdate + to_seconds((o_orderkey * 7919) % 86400) as created_date,
    case when o_orderstatus <> 'O' then o_orderdate
      + to_seconds((o_orderkey * 7919) % 86400 + (o_orderkey * 104729) % 2000003) end as closed_date
  from orders join customer on o_custkey = c_custkey
    join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
req as (select *, closed_date as resolution_action_updated_date, closed_date is not null as is_closed,
    {_HOURS} as h from req0)"""

_DENSE = f"""
req0 as (
  select event_id as unique_key, concat('AG', cast(user_id % 7 as varchar)) as agency,
    event_type as complaint_type, date_trunc('second', ts) as created_date,
    case when event_id % 4 <> 0 then date_trunc('second', ts)
      + to_seconds(cast(floor(value * 1000) as bigint)) end as closed_date
  from events),
req as (select *, closed_date as resolution_action_updated_date, closed_date is not null as is_closed,
    {_HOURS} as h from req0)"""

_COLUMNS = (
    "unique_key, agency, complaint_type, descriptor, borough, community_board, incident_zip, city,"
    " address_type, location_type, council_district, police_precinct, latitude, longitude, status,"
    " created_date, closed_date"
)


def _history(body: str, *ctes: str) -> str:
    return "with " + ",".join([_HISTORY, *ctes]) + body


def _dense(body: str, *ctes: str) -> str:
    return "with " + ",".join([_DENSE, *ctes]) + body


# ---- metrics ---------------------------------------------------------------------


def _r2(x: str) -> str:
    return f"cast(round(cast({x} as decimal(20,8)), 2) as double)"


_CLOSED = "count(*) filter (where is_closed)"
_H = "cast(h as double)"
_METRICS = {
    "total_count": "count(*)",
    "closed_count": _CLOSED,
    "open_count": "count(*) filter (where not is_closed)",
    "pct_closed": _r2(f"100.0 * {_CLOSED} / nullif(count(*), 0)"),
    "avg_resolution_hours": _r2(f"avg({_H})"),
    "median_resolution_hours": _r2(f"percentile_cont(0.5) within group (order by {_H})"),
    "p90_resolution_hours": _r2(f"percentile_cont(0.9) within group (order by {_H})"),
}


def _metrics(*skip: str) -> str:
    return ", ".join(f"{e} as {n}" for n, e in _METRICS.items() if n not in skip)


_DAILY = f"daily as (select cast(created_date as date) as request_date, {_metrics()} from req group by 1)"
_BOROUGH = f"""v as (select coalesce(borough, 'UNKNOWN') as borough, {_metrics("p90_resolution_hours")}
  from req group by 1)"""
_TYPE = f"v as (select complaint_type, {_metrics('open_count')} from req group by 1)"
_AGENCY = (
    f"v as (select agency as agency_code, {_metrics('median_resolution_hours')} from req"
    " where agency is not null group by 1),"
    " w as (select agency_code, total_count, closed_count, open_count as open_backlog, pct_closed,"
    " avg_resolution_hours, p90_resolution_hours from v)"
)


def _aging(now: str) -> str:
    def band(cond: str, name: str) -> str:
        return f"cast(sum(case when {cond} then 1 else 0 end) as bigint) as {name}"

    age = f"({now} - created_date)"
    bands = ", ".join(
        [
            band(f"{age} < interval 7 day", "lt_7d"),
            band(f"{age} >= interval 7 day and {age} < interval 30 day", "d7_to_30"),
            band(f"{age} >= interval 30 day and {age} < interval 90 day", "d30_to_90"),
            band(f"{age} >= interval 90 day", "gt_90d"),
        ]
    )
    return f"aging as (select {bands} from req where not is_closed)"


def _series(now: str) -> str:
    return f"""series as (select request_date, total_count, closed_count, open_count,
  pct_closed as pct_closure_daily, avg_resolution_hours as avg_resolution_time_in_hours,
  median_resolution_hours as median_resolution_time_in_hours
  from daily where cast(request_date as timestamp) >= {now} - interval 30 day)"""


def _weekly(now: str) -> str:
    """From raw requests: number each request's week back from now, fold days, lay weeks side by side."""

    def of(week: int, column: str) -> str:
        return f"max({column}) filter (where age = {week})"

    def grown(column: str) -> str:
        return _r2(f"100.0 * ({of(0, column)} - {of(1, column)}) / nullif({of(1, column)}, 0)")

    return f"""
aged as (select *, cast(created_date as date) as d,
  cast(floor(epoch({now} - cast(cast(created_date as date) as timestamp)) / 604800.0) as integer)
    - case when epoch({now} - cast(cast(created_date as date) as timestamp)) % 604800.0 = 0
        and epoch({now} - cast(cast(created_date as date) as timestamp)) > 0 then 1 else 0 end as age
  from req where cast(cast(created_date as date) as timestamp) <= {now}),
days as (select age, d, count(*) as n, {_CLOSED} as c,
  round(cast(avg({_H}) as decimal(20,8)), 2) as h from aged where age in (0, 1) group by age, d),
weeks as (select age, min(d) as d, cast(sum(n) as bigint) as n, cast(sum(c) as bigint) as c,
  round(cast(avg(cast(h as double)) as decimal(20,8)), 2) as h from days group by age),
weekly as (select {of(0, "d")} as week_start, {of(0, "n")} as week_total_requests,
  {of(0, "c")} as week_closed_requests,
  {_r2(f"100.0 * {of(0, 'c')} / nullif({of(0, 'n')}, 0)")} as week_closed_requests_pct,
  cast({of(0, "h")} as double) as week_avg_resolution_time_in_hours,
  {of(1, "n")} as prev_week_total_requests, {of(1, "c")} as prev_week_total_closed_requests,
  {grown("n")} as prev_week_change_in_requests_pct, {grown("c")} as prev_week_change_in_closed_requests_pct,
  cast({of(1, "h")} as double) as prev_week_avg_resolution_time_in_hours,
  {grown("h")} as prev_week_avg_resolution_time_in_hours_pct from weeks)"""


# ---- imputation ----------------------------------------------------------------


def _imputed(base: str, order: str, scope: str = "", extra: str = "") -> list[str]:
    """CTEs filling ``base`` step by step, within ``scope``; the result is ``filled``."""

    def same(keys: list[str], left: str, right: str) -> str:
        return " and ".join(f"{left}.{k} = {right}.{k}" for k in keys)

    def first(name: str, src: str, keys: list[str], value: str) -> str:
        known = " and ".join(f"{k} is not null" for k in [*keys, value])
        by = ", ".join(keys)
        return f"{name} as (select {by}, arg_min({value}, {order}) as v from {src} where {known} group by {by})"

    def step(name: str, src: str, lookup: str, keys: list[str], old: str, new: str) -> str:
        return (
            f"{name} as (select s.*, coalesce(s.{old}, l.v) as {new} from {src} s"
            f" left join {lookup} l on {same(keys, 's', 'l')})"
        )

    inside = [scope] if scope else []
    chain: list[str] = []
    source = base
    for i, (keys, old, new) in enumerate(
        [
            (["latitude", "longitude"], "incident_zip", "zip1"),
            (["borough"], "zip1", "zip2"),
            (["complaint_type"], "address_type", "at1"),
            (["agency"], "at1", "at2"),
            (["borough"], "city", "city1"),
            (["complaint_type"], "location_type", "lt1"),
            (["descriptor"], "lt1", "lt2"),
            (["zip2"], "council_district", "cd1"),
            (["community_board"], "cd1", "cd2"),
        ]
    ):
        chain.append(first(f"l{i}", source, [*inside, *keys], old))
        chain.append(step(f"f{i}", source, f"l{i}", [*inside, *keys], old, new))
        source = f"f{i}"
    both = "latitude is not null and longitude is not null"
    for name, key in (("cz", "zip2"), ("cb", "community_board")):
        by = ", ".join([*inside, key])
        chain.append(
            f"{name} as (select {by}, avg(latitude) as la, avg(longitude) as lo from {source}"
            f" where {both} and {key} is not null group by {by})"
        )
    chain.append(
        f"""filled as (select s.unique_key, s.agency, s.complaint_type, s.descriptor, s.borough,
  s.community_board, s.zip2 as incident_zip, coalesce(s.city1, 'UNKNOWN') as city,
  coalesce(s.at2, 'UNKNOWN') as address_type, coalesce(s.lt2, 'UNKNOWN') as location_type,
  s.cd2 as council_district, s.police_precinct,
  cast(round(cast(coalesce(s.latitude, cz.la, cb.la) as decimal(20,10)), 6) as double) as latitude,
  cast(round(cast(coalesce(s.longitude, cz.lo, cb.lo) as decimal(20,10)), 6) as double) as longitude,
  s.status, s.created_date, s.closed_date, s.is_closed, s.h,
  s.incident_zip is null and s.zip2 is not null as imputed{extra}
  from {source} s left join cz on {same([*inside, "zip2"], "s", "cz")}
    left join cb on {same([*inside, "community_board"], "s", "cb")})"""
    )
    return chain


_FILLED = _imputed("req", "unique_key")

# ---- snapshots and merges --------------------------------------------------------


def _snapshot(cut: str) -> str:
    return f"""snap as (select * replace (
    case when closed_date <= {cut} then closed_date end as closed_date,
    case when closed_date <= {cut} then status else 'Open' end as status,
    coalesce(closed_date <= {cut}, false) as is_closed,
    case when closed_date <= {cut} then h end as h)
  from req where created_date < {cut})"""


_CHANGED = f"(closed_date >= {_A_CUT_DAY} or created_date >= {_A_CUT_DAY})"
_MERGE = [
    _snapshot(_A_CUT),
    f"""incoming as (select unique_key, coalesce(agency, 'X') as agency, created_date,
    case when unique_key % 7 <> 0 then closed_date end as closed_date,
    case when unique_key % 7 = 0 then 'Open' else status end as status,
    is_closed and unique_key % 7 <> 0 as is_closed,
    case when unique_key % 7 <> 0 then h end as h
  from req where {_CHANGED})""",
]
_UPSERTED = """
select coalesce(o.unique_key, n.unique_key) as unique_key,
  case when o.unique_key is null then n.agency else o.agency end as agency,
  case when o.unique_key is null then n.created_date else o.created_date end as created_date,
  coalesce(n.closed_date, o.closed_date) as closed_date,
  case when n.unique_key is null then o.status else n.status end as status,
  case when n.unique_key is null then o.is_closed else n.is_closed end as is_closed,
  coalesce(n.h, o.h) as resolution_time_in_hours
from snap o full outer join incoming n on o.unique_key = n.unique_key"""

_TWO_RUNS = [
    _snapshot(_A_CUT),
    f"""landed as (select 1 as run, * from snap union all select 2 as run, * from req where {_CHANGED})""",
    """placed as (select *, row_number() over (order by run, created_date desc, unique_key) as rn from landed)""",
    """picked as (select * from placed qualify row_number() over (partition by unique_key order by rn) = 1)""",
    *_imputed("picked", "rn"),
]

_LANDED_PAGES = [
    """paged as (select *, rn // 1000 as page from (select *,
      row_number() over (order by created_date desc, cast(unique_key as varchar)) - 1 as rn from req))""",
    *_imputed("paged", "rn", "page"),
]
_LANDED_RUN_PAGES = [
    *_TWO_RUNS[:2],
    """numbered as (select *, row_number() over (partition by run
      order by created_date desc, cast(unique_key as varchar)) - 1 as nth from landed)""",
    """paged as (select *, run * 1000000000 + nth as rn, run * 1000000 + nth // 1000 as page from numbered)""",
    *_imputed("paged", "rn", "page", ", s.rn"),
]
_MIXED_RUNS = [
    _TWO_RUNS[0],
    f"""landed as (
      select 1 as run, * replace (null::bigint as incident_zip, null::double as latitude, null::double as longitude) from snap
      union all select 2 as run, * from req where {_CHANGED})""",
    *_TWO_RUNS[2:],
]

_STAR = (
    "unique_key, agency as agency_code, complaint_type, created_date, closed_date, is_closed,"
    " h as resolution_time_in_hours"
)


def _location(src: str) -> str:
    return f"""loc as (select unique_key, coalesce(borough, 'UNKNOWN') as borough,
  coalesce(community_board, '') as community_board,
  coalesce(cast(incident_zip as varchar), '') as incident_zip, coalesce(city, 'UNKNOWN') as city,
  cast(coalesce(council_district, -1) as integer) as council_district,
  coalesce(police_precinct, '') as police_precinct from {src})"""


_LOC = "borough, community_board, incident_zip, city, council_district, police_precinct"
_DIM_LOCATION = f"dl as (select distinct {_LOC} from loc)"
_DIM_TYPE = "dct as (select distinct complaint_type, coalesce(descriptor, '') as descriptor from req)"

ORACLES: dict[str, str] = {
    "incremental_extract": _history(
        f"""
select {_COLUMNS}, resolution_action_updated_date from req
where resolution_action_updated_date >= date_trunc('day', {_A_CUT})
   or created_date >= date_trunc('day', {_A_CUT})"""
    ),
    "backfill_extract": _history(
        """
select unique_key, created_date, closed_date, agency, incident_zip from req
where closed_date >= timestamp '1996-02-29 00:00:00' or created_date >= timestamp '1996-02-29 00:00:00'"""
    ),
    "watermark_advance": _history(
        f"""
select greatest({_A_CUT}, least(max(coalesce(closed_date, created_date)), {_A_NOW})) as latest_watermark,
  count(*) as total_records_fetched
from req where {_CHANGED}"""
    ),
    "bronze_roundtrip": _history(f" select {_COLUMNS} from req"),
    "dedup_first": _history(
        f"""
select {_COLUMNS} from snap
union all
select {_COLUMNS} from req where unique_key not in (select unique_key from snap)""",
        _snapshot(_A_CUT),
    ),
    "impute_zip": _history(" select unique_key, incident_zip, imputed from filled", *_FILLED),
    "impute_categorical": _history(
        " select unique_key, address_type, city, location_type from filled", *_FILLED
    ),
    "impute_district": _history(" select unique_key, council_district from filled", *_FILLED),
    "impute_coordinates": _history(" select unique_key, latitude, longitude from filled", *_FILLED),
    "fill_from_group": _history(
        " select unique_key, zip1 as incident_zip from f0", *_FILLED[:2]
    ),
    "clean_by_page": _history(
        f" select {_COLUMNS} from filled",
        "paged as (select *, unique_key // 1000 as page from req)",
        *_imputed("paged", "unique_key", "page"),
    ),
    "clean_requests": _history(f" select {_COLUMNS} from filled", *_FILLED),
    "imputation_stats": _history(
        """
select total, filled + still_null as originally_null, filled, still_null,
  cast(round(cast(100.0 * (filled + still_null) / nullif(total, 0) as decimal(20,8)), 1) as double) as originally_null_pct,
  cast(round(cast(100.0 * filled / nullif(total, 0) as decimal(20,8)), 1) as double) as filled_pct,
  cast(round(cast(100.0 * still_null / nullif(total, 0) as decimal(20,8)), 1) as double) as still_null_pct
from (select count(*) as total, count(*) filter (where imputed) as filled,
  count(*) filter (where incident_zip is null) as still_null from filled)""",
        *_FILLED,
    ),
    "enrich_requests": _history(
        " select unique_key, is_closed, h as resolution_time_in_hours from req"
    ),
    "silver_by_page": _history(
        f" select {_COLUMNS} from filled qualify row_number() over (partition by unique_key order by rn) = 1",
        *_LANDED_RUN_PAGES,
    ),
    "silver_mixed_headers": _history(f" select {_COLUMNS} from filled", *_MIXED_RUNS),
    "stream_catch_up": _dense(f" select {_STAR} from req"),
    "stream_fills": _history(
        f""" select {_STAR}, coalesce(cast(incident_zip as varchar), '') as incident_zip, city,
  cast(coalesce(council_district, -1) as integer) as council_district,
  latitude, longitude, location_type, address_type from filled""",
        *_LANDED_PAGES,
    ),
    "load_folds_repeats": _dense(
        f"""
select unique_key, case when created_date < {_B_CUT} then agency else 'late' end as agency_code, complaint_type,
  created_date, closed_date, is_closed, h as resolution_time_in_hours from req
where created_date < {_B_CUT} or closed_date is not null or unique_key % 3 = 0"""
    ),
    "silver_requests": _history(
        f"""
select {_COLUMNS}, is_closed,
  cast(date_diff('second', created_date, closed_date) / 3600.0::double as decimal(20,6)) as resolution_time_in_hours
from filled""",
        *_TWO_RUNS,
    ),
    "dim_date": _history(
        """
select distinct cast(created_date as date) as full_date, cast(year(created_date) as integer) as year,
  cast(quarter(created_date) as integer) as quarter, cast(month(created_date) as integer) as month,
  monthname(created_date) as month_name, cast(day(created_date) as integer) as day,
  cast(isodow(created_date) as integer) as day_of_week, dayname(created_date) as day_name
from req"""
    ),
    "dim_agency": _history(
        " select distinct agency as agency_code from req where agency is not null"
    ),
    "dim_complaint_type": _history(" select * from dct", _DIM_TYPE),
    "dim_location": _history(f" select {_LOC} from dl", _location("req"), _DIM_LOCATION),
    "fact_keys": _history(
        f"""
select unique_key, cast(req.created_date as date) as full_date, req.agency as agency_code,
  req.complaint_type, coalesce(req.descriptor, '') as descriptor,
  {", ".join("loc." + c.strip() for c in _LOC.split(","))}
from req join loc using (unique_key)""",
        _location("req"),
    ),
    "fact_upsert": _history(_UPSERTED, *_MERGE),
    "replay_idempotent": _history(_UPSERTED, *_MERGE),
    "gold_load": _history(
        f"""
select f.unique_key, f.agency as agency_code, f.complaint_type, f.created_date, f.closed_date,
  f.is_closed, f.h as resolution_time_in_hours, cast(f.created_date as date) as full_date,
  cast(isodow(f.created_date) as integer) as day_of_week, coalesce(f.descriptor, '') as descriptor,
  {", ".join("loc." + c.strip() for c in _LOC.split(","))},
  f.latitude, f.longitude, f.location_type, f.address_type, f.status
from filled f join loc using (unique_key)""",
        *_FILLED,
        _location("filled"),
    ),
    "late_closure_upsert": _history(f" select {_STAR}, status from req"),
    "stream_upsert": _dense(f" select {_STAR} from req"),
    "check_fact_key": _history(
        """
select 'facts' as table_name, cast(0 as bigint) as null_keys,
  count(*) - count(distinct unique_key) as duplicate_keys,
  count(*) filter (where created_date is null) as null_created_date,
  count(*) filter (where is_closed is null) as null_is_closed from req
union all
select 'unmerged', cast(0 as bigint), (select count(*) from snap join incoming using (unique_key)),
  cast(0 as bigint), cast(0 as bigint)""",
        *_MERGE,
    ),
    "check_fact_fks": _history(
        """
select 'date_id' as foreign_key, cast(0 as bigint) as dangling_rows, cast(0 as bigint) as null_rows
union all select 'agency_id', cast(0 as bigint), count(*) filter (where agency is null) from req
union all select 'complaint_type_id', cast(0 as bigint), cast(0 as bigint)
union all select 'location_id', cast(0 as bigint), cast(0 as bigint)"""
    ),
    "check_dim_keys": _history(
        """
select 'dim_date' as table_name, count(distinct cast(created_date as date)) as members,
  cast(0 as bigint) as duplicate_natural_keys, cast(0 as bigint) as duplicate_ids from req
union all select 'dim_agency', count(distinct agency), cast(0 as bigint), cast(0 as bigint) from req
union all select 'dim_complaint_type', count(*), cast(0 as bigint), cast(0 as bigint) from dct
union all select 'dim_location', count(*), cast(0 as bigint), cast(0 as bigint) from dl""",
        _DIM_TYPE,
        _location("req"),
        _DIM_LOCATION,
    ),
    "requests_daily": _dense(" select * from daily", _DAILY),
    "requests_daily_history": _history(" select * from daily", _DAILY),
    "requests_7d": _dense(
        f" select {_metrics()} from req where created_date >= {_B_NOW} - interval 7 day"
    ),
    "requests_7d_history": _history(
        f" select {_metrics()} from req where created_date >= {_A_NOW} - interval 7 day"
    ),
    "requests_30d": _dense(
        f" select {_metrics()} from req where created_date >= {_B_NOW} - interval 30 day"
    ),
    "requests_by_borough": _history(" select * from v", _BOROUGH),
    "requests_by_complaint_type": _history(" select * from v", _TYPE),
    "requests_by_agency": _history(" select * from w", _AGENCY),
    "requests_by_day_of_week": _history(
        f"""
select cast(isodow(created_date) as integer) as day_of_week, dayname(created_date) as day_name,
  {_metrics("closed_count", "open_count", "median_resolution_hours", "p90_resolution_hours")}
from req group by 1, 2"""
    ),
    "backlog_aging": _history(" select * from aging", _aging(_A_NOW)),
    "backlog_aging_dense": _dense(" select * from aging", _aging(_B_NOW)),
    "daily_30d_summary": _dense(" select * from series", _DAILY, _series(_B_NOW)),
    "daily_chart_series": _dense(
        """
select strftime(request_date, '%m-%d') as date, closed_count as closed_requests,
  open_count as open_requests, pct_closure_daily as pct_closed,
  avg_resolution_time_in_hours as avg_resolution_time_hours,
  median_resolution_time_in_hours as median_resolution_time_hours from series""",
        _DAILY,
        _series(_B_NOW),
    ),
    "weekly_summary": _dense(" select * from weekly", _DAILY, _weekly(_B_NOW)),
    "weekly_summary_history": _history(" select * from weekly", _DAILY, _weekly(_A_NOW)),
    "overview_headline": _dense(
        """
select week_total_requests as total_7d,
  prev_week_change_in_requests_pct as change_in_requests_pct,
  case sign(prev_week_change_in_requests_pct) when 1 then 'up' when -1 then 'down' else 'flat' end as requests_trend,
  prev_week_change_in_closed_requests_pct as change_in_closed_requests_pct,
  case sign(prev_week_change_in_closed_requests_pct) when 1 then 'up' when -1 then 'down' else 'flat' end as closed_trend,
  l.total_count as latest_day_total, l.closed_count as latest_day_closed,
  cast(round(cast(l.pct_closure_daily as decimal(20,8)), 1) as double) as latest_day_pct_closed,
  cast(round(cast(week_avg_resolution_time_in_hours as decimal(20,8)), 1) as double) as week_avg_resolution_hours,
  prev_week_avg_resolution_time_in_hours_pct as change_in_avg_resolution_pct,
  case sign(prev_week_avg_resolution_time_in_hours_pct) when -1 then 'up' when 1 then 'down' else 'flat' end as resolution_trend,
  (select cast(sum(open_count) as bigint) from series) as open_30d
from weekly, (select * from series order by request_date desc limit 1) l""",
        _DAILY,
        _series(_B_NOW),
        _weekly(_B_NOW),
    ),
    "top10_complaint_types": _history(
        " select * from v order by total_count desc, complaint_type limit 10", _TYPE
    ),
    "top10_agencies": _history(
        " select * from w order by total_count desc, agency_code limit 10", _AGENCY
    ),
    "agency_headline": _history(
        """
select count(*) as agencies,
  cast(round(cast(avg(pct_closed) as decimal(20,8)), 1) as double) as avg_pct_closed,
  cast(sum(open_backlog) as bigint) as total_open_backlog from w""",
        _AGENCY,
    ),
    "complaints_headline": _history(
        """
select (select count(*) from v) as complaint_types, b.complaint_type as busiest_type,
  b.total_count as busiest_total, s.complaint_type as slowest_type,
  cast(round(cast(s.p90_resolution_hours as decimal(20,8)), 0) as double) as slowest_p90_hours
from (select * from v order by total_count desc, complaint_type limit 1) b,
  (select * from v where p90_resolution_hours is not null
   order by p90_resolution_hours desc, complaint_type limit 1) s""",
        _TYPE,
    ),
    "backlog_share": _history(
        """
select bucket, open_requests,
  cast(round(cast(100.0 * open_requests / nullif(total_open, 0) as decimal(20,8)), 1) as double) as share_pct,
  total_open
from (select *, lt_7d + d7_to_30 + d30_to_90 + gt_90d as total_open from aging)
unpivot (open_requests for bucket in (lt_7d, d7_to_30, d30_to_90, gt_90d))""",
        _aging(_A_NOW),
    ),
    "borough_cards": _history(
        """
select borough, total_count,
  cast(round(cast(pct_closed as decimal(20,8)), 1) as double) as pct_closed from v""",
        _BOROUGH,
    ),
}
