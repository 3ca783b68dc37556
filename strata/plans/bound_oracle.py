"""DuckDB SQL equivalents of ``bound_queries`` (the correctness oracle)."""

from __future__ import annotations

from strata.plans.tpch_sql import calendar, with_ctes

SQL: dict[str, str] = {}


def _mean_by(keys: str, source: str, support: int = 1) -> str:
    """Closed cases and their mean duration per key combination."""
    return (f"select {keys}, count(duration_days) as n_closed, "
            f"round(sum(duration_days) / count(duration_days), 1) as avg_days "
            f"from {source} group by all having count(duration_days) >= {support}")


_BY_DISTRICT = "fact_cases join dim_district using (district_id)"
_OPENED = "join (select cal_date as opened, cal_year from dim_calendar) using (opened)"
_CLOSED = "join (select cal_date as closed, cal_year from dim_calendar) using (closed)"

SQL["duration_by_district_class_year"] = with_ctes("fact_cases", "dim_district", "dim_class", "dim_calendar") + _mean_by(
    "district_name, class_name, cal_year", f"{_BY_DISTRICT} join dim_class using (class_id) {_OPENED}")
SQL["duration_by_district_year"] = with_ctes("fact_cases", "dim_district", "dim_calendar") + _mean_by(
    "district_name, cal_year", f"{_BY_DISTRICT} {_OPENED}")
SQL["duration_by_court_min_support"] = with_ctes("fact_cases", "dim_district") + _mean_by(
    "district_name, court_id", _BY_DISTRICT, 3)
SQL["close_role_by_year"] = with_ctes("fact_cases", "dim_calendar") + _mean_by("cal_year", f"fact_cases {_CLOSED}")

SQL["court_key_not_unique"] = with_ctes("fact_cases") + """
select court_id, cast(sum(n) as bigint) as n_cases, count(*) as n_districts
from (select court_id, district_id, count(duration_days) as n from fact_cases group by all having count(duration_days) > 0)
group by court_id"""

_GRAIN = "select count(duration_days) as n_rows, round(avg(duration_days), 1) as mean_days from fact_cases"
_FANOUT = "select count(duration_days) as n_rows, round(avg(duration_days), 1) as mean_days from fact_cases join stg_events using (case_id)"
SQL["grain_mean"] = with_ctes("fact_cases") + _GRAIN
SQL["fanout_mean"] = with_ctes("fact_cases", "stg_events") + _FANOUT
SQL["grain_report"] = with_ctes("fact_cases", "stg_events") + f"""
select g.n_rows as grain_rows, g.mean_days as grain_mean, f.n_rows as fanout_rows, f.mean_days as fanout_mean
from ({_GRAIN}) g, ({_FANOUT}) f"""

SQL["calendar_dim"] = with_ctes("dim_calendar") + "select * from dim_calendar"
SQL["fact_cases"] = with_ctes("fact_cases") + "select * from fact_cases"
SQL["clean_cases"] = with_ctes("stg_cases") + "select * from stg_cases"
SQL["clean_districts"] = with_ctes("stg_districts") + "select * from stg_districts"
SQL["preferred_spelling"] = with_ctes("stg_classes") + "select * from stg_classes"
SQL["clean_events"] = with_ctes("stg_events") + "select * from stg_events"
SQL["dim_district"] = with_ctes("dim_district") + "select * from dim_district"
SQL["dim_class"] = with_ctes("dim_class") + "select * from dim_class"
SQL["clean_names"] = """
select p_partkey as part_id,
       array_to_string([upper(left(w, 1)) || lower(substr(w, 2)) for w in string_split(p_name, ' ')], ' ') as part_name
from part"""
SQL["case_number"] = with_ctes("stg_cases") + """
select case_id, district_id, lpad(cast(case_id % 10000000 as varchar), 7, '0') || '-25.2026.8.12.'
       || lpad(cast(district_id as varchar), 4, '0') as case_number
from stg_cases"""

SQL["norm_courts"] = with_ctes("vara") + "select * from vara"
SQL["norm_classes"] = with_ctes("classe") + "select * from classe"
SQL["norm_districts"] = with_ctes("comarca") + "select * from comarca"
SQL["norm_cases"] = with_ctes("processo", "situacao") + """
select p.status_id, p.case_id, p.case_number, p.class_id, p.court_id, p.opened,
       s.description as status
from processo p join situacao s on s.status_id = p.status_id"""
SQL["norm_events"] = with_ctes("movimentacao") + "select * from movimentacao"
SQL["norm_counts"] = with_ctes("comarca", "vara", "classe", "situacao", "tipo_movimento",
                               "processo", "movimentacao") + """
select 'comarca' as table_name, count(*) as n_rows from comarca
union all select 'vara', count(*) from vara
union all select 'classe', count(*) from classe
union all select 'situacao', count(*) from situacao
union all select 'tipo_movimento', count(*) from tipo_movimento
union all select 'processo', count(*) from processo
union all select 'movimentacao', count(*) from movimentacao"""
SQL["event_union"] = with_ctes("event_union") + "select * from event_union"
SQL["first_close_event"] = with_ctes("closure") + "select * from closure"

_EVENTS_BY_COURT = _mean_by(
    "district_name, court_name",
    "(select *, date_diff('day', opened, closed) as duration_days from processo join vara using (court_id) "
    "join comarca using (district_id) join closure using (case_id) where closed >= opened)", 3)
SQL["duration_from_events"] = with_ctes("processo", "vara", "comarca", "closure") + _EVENTS_BY_COURT
_GOLD_BY_COURT = _mean_by("district_name, court_id || 'ª Vara' as court_name", _BY_DISTRICT, 3)
SQL["events_equal_gold"] = with_ctes("fact_cases", "dim_district", "processo", "vara", "comarca",
                                     "closure") + f""",
g as ({_GOLD_BY_COURT}),
e as ({_EVENTS_BY_COURT})
select (select count(*) from (select * from g except all select * from e)) as only_in_gold,
       (select count(*) from (select * from e except all select * from g)) as only_in_events"""

_STATUSES = "'Baixado', 'Em andamento'"
#: The model's column tests: (table, column, rule, rows or values that break it).
_NULLS = [("stg_cases", "case_id"), ("stg_cases", "opened"), ("stg_districts", "district_id"),
          ("stg_classes", "class_id"), ("stg_events", "case_id"), ("stg_events", "event_date"),
          ("fact_cases", "case_id"), ("dim_district", "district_id"), ("dim_class", "class_id"),
          ("dim_calendar", "cal_date")]
_KEYS = [("stg_cases", "case_id"), ("stg_districts", "district_id"), ("stg_classes", "class_id"),
         ("fact_cases", "case_id"), ("dim_district", "district_id"), ("dim_class", "class_id"),
         ("dim_calendar", "cal_date")]
_PARENTS = [("fact_cases", "district_id", "dim_district"), ("fact_cases", "class_id", "dim_class")]
_CHECKS = (
    [(t, c, "not_null", f"count(*) - count({c}) from {t}") for t, c in _NULLS]
    + [(t, c, "unique", f"count(*) from (select {c} from {t} where {c} is not null group by 1 having count(*) > 1)")
       for t, c in _KEYS]
    + [("stg_cases", "status", "accepted_values", f"count(distinct status) from stg_cases where status not in ({_STATUSES})")]
    + [(t, c, "relationships", f"count({c}) from {t} anti join {p} using ({c})") for t, c, p in _PARENTS])


def _suite_sql(*kinds: str) -> str:
    own = [r for r in _CHECKS if not kinds or r[2] in kinds]
    tables = {r[0] for r in own} | ({p for _, _, p in _PARENTS} if not kinds or "relationships" in kinds else set())
    one = [f"select '{t}' as table_name, '{c}' as column_name, '{k}' as rule, cast((select {v}) as bigint) as violations"
           for t, c, k, v in own]
    return with_ctes(*sorted(tables)) + f"select *, violations = 0 as passed from ({' union all '.join(one)})"


SQL["dq_suite"] = _suite_sql()
for _kind in ("not_null", "unique", "accepted_values", "relationships"):
    SQL[f"dq_{_kind}"] = _suite_sql(_kind)

SQL["profile_mixed_dates"] = with_ctes("bronze_cases") + """
select case when opened is null then 'null'
            when regexp_matches(trim(opened), '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$') then 'iso'
            when regexp_matches(trim(opened), '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}[ T]') then 'iso_with_time'
            when regexp_matches(trim(opened), '^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}') then 'year_first_slash'
            when regexp_matches(trim(opened), '^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$') then 'day_first_slash'
            else 'other' end as format_class,
       count(*) as n_values
from bronze_cases group by 1"""
SQL["profile_slash_dates"] = with_ctes("bronze_cases") + """
select closed, count(*) as n from bronze_cases where closed like '%/%' group by 1"""
SQL["profile_duplicates"] = with_ctes("bronze_cases") + """
select case_id, count(*) as n_copies from bronze_cases group by 1 having count(*) > 1"""
SQL["profile_missing_ids"] = with_ctes("bronze_cases") + """
select * from bronze_cases where case_id is null or case_id = ''"""
SQL["profile_orphans"] = with_ctes("bronze_cases", "bronze_districts") + """
select p.case_id, p.district_id from bronze_cases p
left join bronze_districts d on p.district_id = d.district_id where d.district_id is null"""
SQL["profile_spellings"] = with_ctes("bronze_classes") + """
select class_id, spelling, n_rows, n_spellings from (
  select class_id, spelling, n_rows, count(*) over (partition by class_id) as n_spellings
  from (select class_id, class_name as spelling, count(*) as n_rows
        from bronze_classes group by 1, 2)) where n_spellings > 1"""

SQL["profile_summary"] = with_ctes("bronze_cases", "bronze_districts", "bronze_classes") + """
select 'non_iso_dates' as check_name, count(*) filter (
         where opened is not null
           and not regexp_matches(trim(opened), '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$')) as findings
from bronze_cases
union all
select 'duplicated_keys', count(*) from (
  select case_id from bronze_cases group by case_id having count(*) > 1)
union all
select 'missing_ids', count(*) from bronze_cases where case_id is null or case_id = ''
union all
select 'orphan_references', count(*) from bronze_cases p
  left join bronze_districts d on p.district_id = d.district_id where d.district_id is null
union all
select 'spelling_variants', count(*) from (
  select class_id from bronze_classes group by class_id having count(distinct class_name) > 1)"""

_DRIFT_COLS = [("case_id", "bigint"), ("class_id", "int"), ("district_id", "int"),
               ("court_id", "int"), ("opened", "date"), ("closed", "date"), ("status", "string")]
SQL["schema_drift"] = with_ctes("bronze_cases", "stg_cases") + ",\nb as (" + " union all ".join(
    f"select '{c}' as column_name, 'string' as type_before, "
    f"(select count({c}) from bronze_cases) as nonnull_before" for c, _ in _DRIFT_COLS) + \
    "),\na as (" + " union all ".join(
    f"select '{c}' as column_name, '{t}' as type_after, "
    f"(select count({c}) from stg_cases) as nonnull_after" for c, t in _DRIFT_COLS) + """)
select coalesce(b.column_name, a.column_name) as column_name, b.type_before, b.nonnull_before,
       a.type_after, a.nonnull_after
from b full outer join a on a.column_name = b.column_name"""

SQL["parquet_path_scan"] = """
select o_orderstatus, count(*) as n_orders, cast(min(o_orderdate) as date) as first_order,
       cast(max(o_orderdate) as date) as last_order
from orders group by o_orderstatus"""
SQL["bronze_csv_roundtrip"] = """
select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer"""
SQL["bronze_stream_roundtrip"] = SQL["bronze_csv_roundtrip"]
SQL["bronze_json_roundtrip"] = """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, cast(o_orderdate as date) as o_orderdate,
       o_orderpriority from orders"""
SQL["ingest_checks"] = """
select 'row_count' as check_name, cast(count(*) as varchar) as expected,
       cast(count(*) as varchar) as actual, true as passed from customer
union all select 'stamp_column', '_ingerido_em', '_ingerido_em', true
union all select 'required_columns', 'c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment',
                 'c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment', true"""

SQL["flagship_sql"] = SQL["duration_by_district_class_year"]
SQL["by_court_sql"] = SQL["duration_by_court_min_support"]
SQL["by_district_year_sql"] = SQL["duration_by_district_year"]
for _name in ("court_key_not_unique", "grain_mean", "fanout_mean", "duration_from_events"):
    SQL[f"{_name}_sql"] = SQL[_name]

SQL["bronze_csv_by_name"] = """
select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'x' as extra from customer"""
SQL["bronze_malformed"] = """
select 'csv' as source, c_custkey % 10 = 3 as malformed, count(*) as n_records,
       count(*) filter (where c_custkey % 10 <> 4) as n_nations from customer group by 2
union all
select 'json', c_custkey % 10 in (5, 6), count(*), count(*) filter (where c_custkey % 10 not in (5, 6))
from customer group by 2"""
SQL["bronze_json_array"] = "select cast(n_nationkey as integer) as n_nationkey, n_name from nation"
SQL["lenient_ints"] = """
select o_orderkey, case o_orderkey % 6 when 3 then null when 4 then o_orderkey + 1 else o_orderkey end as value
from orders"""
SQL["incremental_two_batches"] = with_ctes("fact_cases", "dim_district", "dim_class") + """
select f.*, d.district_name, c.class_name from fact_cases f join dim_district d on d.district_id = f.district_id
left join dim_class c on c.class_id = f.class_id"""
SQL["named_source"] = "select r_regionkey, r_name from region"
SQL["calendar_all_open"] = with_ctes("stg_cases") + calendar("date '2003-07-01'")
SQL["file_sizes"] = """
select 'customer_csv' as dataset, 'csv' as format, true as has_files, true as has_bytes
union all select 'customer_parquet', 'parquet', true, true"""

# --- optional tier ---------------------------------------------------------------------------

SQL["quarantine_cases"] = with_ctes("bronze_cases", "stg_districts") + """
select b.*, if(try_cast(b.case_id as bigint) is null, 'missing_id', 'unknown_district') as reject_reason
from bronze_cases b
where try_cast(b.case_id as bigint) is null or b.district_id is null
   or try_cast(b.district_id as integer) not in (select district_id from stg_districts)"""

SQL["duration_by_district_with_unknown"] = with_ctes("stg_cases", "stg_districts") + """,
dim as (select district_id, district_name, uf from stg_districts
        union all select 0, 'Não informado', null),
cases as (
  select coalesce(k.district_id, 0) as district_id,
         case when s.closed is not null and s.closed >= s.opened
              then date_diff('day', s.opened, s.closed) end as duration_days
  from stg_cases s left join stg_districts k on s.district_id = k.district_id)
select dim.district_name, count(*) as n_closed, round(avg(duration_days), 1) as avg_days
from cases join dim on cases.district_id = dim.district_id
where duration_days is not null group by 1 order by 1"""

SQL["bronze_lineage"] = """
select cast(c_custkey as varchar) as c_custkey,
       sha256(concat_ws('␟', coalesce(cast(c_custkey as varchar), '␀'), coalesce(c_name, '␀'),
                        coalesce(cast(c_nationkey as varchar), '␀'), coalesce(cast(c_acctbal as varchar), '␀'),
                        coalesce(c_mktsegment, '␀'))) as _row_hash,
       'customer_csv' as _source
from customer"""

SQL["open_case_age"] = with_ctes("fact_cases", "dim_district") + """
select dd.district_name, count(*) as n_open,
       round(avg(case when date '2002-01-01' >= f.opened
                      then date_diff('day', f.opened, date '2002-01-01') end), 1) as avg_age_days
from fact_cases f join dim_district dd on f.district_id = dd.district_id
where f.closed is null group by 1"""

SQL["fact_upsert"] = with_ctes("fact_cases") + "select * from fact_cases"

SQL["drill_across_district"] = with_ctes("fact_cases", "stg_events") + """,
durations as (select district_id, count(*) as n_closed, round(avg(duration_days), 1) as avg_days
              from fact_cases where duration_days is not null group by 1),
volumes as (select f.district_id, count(*) as n_events
            from stg_events e join fact_cases f on f.case_id = e.case_id group by 1)
select coalesce(d.district_id, v.district_id) as district_id, d.n_closed, d.avg_days, v.n_events
from durations d full outer join volumes v on d.district_id = v.district_id"""

SQL["district_history"] = with_ctes("stg_districts") + """,
snaps as (
  select district_id, district_name, uf, date '2024-01-01' as valid_from from stg_districts
  union all
  select district_id, case when district_id % 3 = 0 then upper(district_name)
                           else district_name end, uf, date '2024-02-01' from stg_districts
  union all
  select district_id, case when district_id % 5 = 0 then lower(district_name)
                           else district_name end, uf, date '2024-03-01' from stg_districts),
marked as (
  select *, lag(district_name) over w as pn, lag(uf) over w as pu,
         row_number() over w as rn
  from snaps window w as (partition by district_id order by valid_from)),
changes as (
  select district_id, district_name, uf, valid_from from marked
  where rn = 1 or pn is distinct from district_name or pu is distinct from uf)
select district_id, district_name, uf, valid_from,
       lead(valid_from) over (partition by district_id order by valid_from) as valid_to,
       lead(valid_from) over (partition by district_id order by valid_from) is null as is_current
from changes"""

SQL["district_history_merged"] = SQL["district_history"]

# --- type inference, readers in splits ------------------------------------------------------

SQL["csv_inferred_customer"] = """
select cast(c_custkey as bigint) as c_custkey, c_name, cast(c_nationkey as bigint) as c_nationkey, c_acctbal, c_mktsegment
from customer"""

_KINDS = """orders_text as (
  select o_orderkey as k, cast(o_orderdate as date) as d, o_totalprice as price from orders)"""
SQL["csv_inferred_orders"] = f"""
with {_KINDS}
select cast(k as bigint) as order_id, price, d as ordered, d as day_first, d as month_first,
       case when k % 3 = 0 then cast(d as timestamp)
            else cast(d as timestamp) + interval 12 hour + interval 30 minute + to_seconds(k % 60) end as stamp,
       k % 2 = 0 as flag, lpad(cast(k as varchar), 12, '0') as code,
       case when k % 7 = 0 then null when k % 11 = 0 then k + 0.5 else k end :: double as mostly_whole,
       case when k % 97 = 0 then 'n/d' else cast(k as varchar) end as mostly_number,
       cast(null as varchar) as blank
from orders_text"""

_TYPES = {
    "customer": {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "bigint", "c_acctbal": "double", "c_mktsegment": "string"},
    "orders": {"order_id": "bigint", "price": "double", "ordered": "date", "day_first": "date", "month_first": "date",
               "stamp": "timestamp_ntz", "flag": "boolean", "code": "string", "mostly_whole": "double", "mostly_number": "string",
               "blank": "string"}}
_MISSING = {"mostly_whole": "count(*) filter (where o_orderkey % 7 = 0)", "blank": "count(*)"}
SQL["csv_inferred_types"] = " union all ".join(
    f"select '{t}' as table_name, '{c}' as column_name, '{kind}' as type, count(*) as n_rows, "
    f"{_MISSING.get(c, '0')} :: bigint as n_null from {t}" for t, cols in _TYPES.items() for c, kind in cols.items())

SQL["csv_quoted_lines"] = """
select cast(c_custkey as bigint) as customer,
       c_name || chr(10) || 'says "' || c_mktsegment || '",' || chr(10) || chr(10) || cast(c_custkey % 7 as varchar) as note,
       c_mktsegment as segment
from customer"""
SQL["json_arrays_in_splits"] = """
select cast(c_custkey as bigint) as customer, c_name || ' {"' || c_mktsegment || '"}]' as name,
       '{"xs":[' || c_nationkey || ',1]}' as more
from customer"""

# --- sources and sinks shown in full ----------------------------------------------------------

SQL["preview_longest_cases"] = with_ctes("fact_cases") + """
select case_id, district_id, duration_days from fact_cases order by duration_days desc nulls last, case_id limit 10"""
SQL["bronze_stamp"] = """
select cast(c_custkey as varchar) as c_custkey, c_name, '2026-01-02T03:04:05.000006+00:00' as _ingerido_em,
       count(*) over () as n_written
from customer"""
SQL["file_bytes"] = """
select 'customer' as dataset, cast(sum(strlen(c_name) + 1) as bigint) as bytes, true as has_files from customer
union all select 'part', cast(sum(strlen(p_name) + 1) as bigint), true from part"""

# --- tables kept up to date -------------------------------------------------------------------

SQL["stable_court_ids"] = with_ctes("stg_districts") + """
select district_id, cast(n as integer) as court_number,
       row_number() over (order by district_id % 2 <> 0, district_id, n) as court_id
from stg_districts, range(1, 6) r(n)"""
SQL["fact_changed_partitions"] = SQL["fact_cases"]
SQL["duration_by_district_as_of"] = with_ctes("fact_cases", "stg_districts") + """
select case when opened >= date '1998-06-01' and district_id % 5 = 0 then lower(district_name)
            when opened >= date '1998-06-01' then district_name
            when opened >= date '1995-03-01' and district_id % 3 = 0 then upper(district_name)
            else district_name end as district_name,
       count(duration_days) as n_closed, round(sum(duration_days) / count(duration_days), 1) as avg_days
from fact_cases join stg_districts using (district_id) group by 1 having count(duration_days) > 0"""
SQL["report_from_deltas"] = SQL["duration_by_district_year"]
SQL["distinct_any_range"] = with_ctes("fact_cases") + """
select court_id, count(distinct district_id) as n_districts, count(distinct case_id) as n_cases
from fact_cases where opened between date '1994-03-15' and date '1996-09-20' group by 1"""

# --- rules, spellings and shapes ----------------------------------------------------------------

SQL["dq_batch_rules"] = with_ctes("fact_cases", "dim_district") + """,
batch as (
  select case_id, district_id from fact_cases where opened >= date '1997-01-01'
  union all select case_id, district_id from fact_cases where opened < date '1997-01-01' and case_id % 211 = 5
  union all select -case_id, district_id + 900 from fact_cases where opened >= date '1997-01-01' and case_id % 97 = 1),
every as (select case_id from fact_cases where opened < date '1997-01-01' union all select case_id from batch),
results as (
  select 'unique' as rule, count(*) as violations from (select case_id from every group by 1 having count(*) > 1)
  union all
  select 'relationships', count(*) from batch where district_id not in (select district_id from dim_district))
select *, violations = 0 as passed from results"""

SQL["misspelt_words"] = """
with recursive words as (select p_partkey % 10 as k, string_split(p_name, ' ')[1] as w from part),
labels as (
  select case k when 1 then left(w, 1) || substr(w, 3) when 2 then w || right(w, 1)
                when 3 then substr(w, 2, 1) || left(w, 1) || substr(w, 3) else w end as label, count(*) as n_rows
  from words group by 1),
pairs as (
  select a.label as a, b.label as b from labels a, labels b
  where a.label <> b.label and least(length(a.label), length(b.label)) >= 3
    and levenshtein(a.label, b.label) <= case when greatest(length(a.label), length(b.label)) >= 8 then 2 else 1 end),
reach as (select a, b from pairs union select r.a, p.b from reach r join pairs p on p.a = r.b),
named as (select a as label, min(least(a, b)) as component from reach group by 1)
select first_value(label) over (partition by component order by n_rows desc, label) as cluster, label, n_rows,
       count(*) over (partition by component) as n_labels
from named join labels using (label)"""

_CASE_COLUMNS = ("case_id", "class_id", "district_id", "court_id", "opened", "closed", "status")
SQL["format_shapes"] = with_ctes("bronze_cases") + ",\ncells as (" + " union all ".join(
    f"select '{c}' as column_name, {c} as v from bronze_cases where {c} is not null" for c in _CASE_COLUMNS) + r"""),
shapes as (
  select column_name, regexp_replace(regexp_replace(regexp_replace(v, '[A-Z]+', 'A', 'g'), '[a-z]+', 'a', 'g'), '[0-9]+', '9', 'g') as shape
  from cells)
select column_name, shape, count(*) as n, any_value(n_values) as n_values
from shapes join (select column_name, count(*) as n_values from cells group by 1) using (column_name)
group by 1, 2 having count(*) >= 0.01 * any_value(n_values)"""

SQL["bronze_header_versions"] = """
select cast(c_custkey as bigint) as c_custkey, c_name, cast(case when c_custkey % 2 = 0 then c_nationkey end as bigint) as c_nationkey,
       case when c_custkey % 2 = 1 then c_mktsegment end as c_mktsegment
from customer"""
