"""DuckDB oracle for the registered queries.

One CTE chain re-states the pipeline in plain SQL over the driver tables
(pre-registered views ``lineitem``, ``orders``, ``nation``, ``region``):
raw trips -> bronze (window-count dedup, flags) -> silver label -> staging ->
facts -> dims -> marts. Each oracle query is that chain plus a final SELECT
whose doubles are rounded exactly like ``fareline.functions.rounding``.
The SQL follows the reference's model semantics literally (e.g. the monthly
marts join ``dim_date``; the airport mart is two joins + UNION ALL), so it
checks the Spark rewrites rather than repeating them.
"""

from __future__ import annotations

from fareline.functions.rounding import round_sql
from fareline.sources.fixture import COPIES_DUCKDB, SOURCE_FILE_SQL, TRIPS_SQL, ZONES_SQL
from fareline.config import ALT_DUP_KEY_COLUMNS, REQUIRED_FOR_ROW
from fareline.sources.seeds import PAYMENT_TYPES, VENDORS

_KEY = "vendor_id, pickup_at, dropoff_at, pu_location_id, do_location_id, fare_amount, trip_distance_mi"
_BASE = (
    "vendor_id, pickup_at, dropoff_at, passenger_count, trip_distance_mi, rate_code_id, store_and_fwd_flag, "
    "pu_location_id, do_location_id, payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount, "
    "improvement_surcharge, total_amount, congestion_surcharge, airport_fee, cbd_congestion_fee"
)


def _values(rows, cols, types) -> str:
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    sel = ", ".join(f"cast({c} as {t}) as {c}" for c, t in zip(cols, types))
    return f"select {sel} from (values {body}) v({', '.join(cols)})"


_MISSING = (
    "pickup_at is null or dropoff_at is null or trip_distance_mi is null or total_amount is null "
    "or pu_location_id is null or pu_location_id <= 0 or do_location_id is null or do_location_id <= 0"
)
_ANOMALY = "(not qa_in_file_window or qa_outlier_distance or qa_outlier_speed) and not qa_is_fare_mismatch"
_DUR = "date_diff('minute', pickup_at, dropoff_at)"

CHAIN = f"""
fx_raw0 as ({TRIPS_SQL.format(lineitem='lineitem', orders='orders', copies=COPIES_DUCKDB)}),
fx_raw as (select * exclude (source_year, source_month), {SOURCE_FILE_SQL} as source_file from fx_raw0),
fx_dd as (select *, count(*) over (partition by source_file, {_KEY}) as n_copies from fx_raw),
fx_b1 as (
  select {_BASE}, source_file,
    cast(regexp_extract(source_file, '(\\d{{4}})-(\\d{{2}})', 1) as int) as source_year,
    cast(regexp_extract(source_file, '(\\d{{4}})-(\\d{{2}})', 2) as int) as source_month
  from fx_dd where n_copies = 1),
fx_b2 as (
  select *,
    (epoch_us(dropoff_at) - epoch_us(pickup_at)) / 60000000.0e0 as duration_min,
    coalesce(fare_amount,0)+coalesce(extra,0)+coalesce(mta_tax,0)+coalesce(tolls_amount,0)
      +coalesce(improvement_surcharge,0)+coalesce(congestion_surcharge,0)+coalesce(airport_fee,0)
      +coalesce(cbd_congestion_fee,0)+coalesce(tip_amount,0) as manualTotal,
    cast(make_date(source_year, source_month, 1) as timestamp) as m0
  from fx_b1),
fx_b3 as (select *, case when duration_min > 0 then 60e0 * trip_distance_mi / duration_min end as speed_mph from fx_b2),
bronze as (
  select {_BASE}, manualTotal, duration_min, speed_mph,
    coalesce(pickup_at between m0 - interval 2 day and m0 + interval 1 month + interval 2 day
         and dropoff_at between m0 - interval 2 day and m0 + interval 1 month + interval 2 day, false) as qa_in_file_window,
    coalesce(not (trip_distance_mi > 0 and trip_distance_mi <= 150), false) as qa_outlier_distance,
    coalesce(duration_min < 1 or duration_min > 360 or speed_mph > 80, false) as qa_outlier_speed,
    coalesce(abs(manualTotal - total_amount) > 0.5, false) as qa_is_fare_mismatch,
    coalesce(total_amount < 0 or fare_amount < 0 or extra < 0 or mta_tax < 0 or tolls_amount < 0
      or improvement_surcharge < 0 or congestion_surcharge < 0 or airport_fee < 0 or cbd_congestion_fee < 0
      or payment_type in (3, 4, 6), false) as qa_is_adjustment,
    false as qa_is_duplicate_in_file,
    source_year, source_month, source_file
  from fx_b3),
silver as (
  select *, case when {_MISSING} then 'rejected' when qa_is_adjustment then 'trips_admin'
                 when {_ANOMALY} then 'trips_anomalies' else 'trips_clean' end as silver_split
  from bronze),
trips_clean as (select * exclude (silver_split) from silver where silver_split = 'trips_clean'),
trips_admin as (select * exclude (silver_split) from silver where silver_split = 'trips_admin'),
trips_anomalies as (select * exclude (silver_split) from silver where silver_split = 'trips_anomalies'),
trips_fare_miss as (select * from trips_clean where qa_is_fare_mismatch),
stg_trips as (
  select * exclude (manualTotal, payment_type),
    manualTotal as manual_total,
    cast(pickup_at as date) as pickup_date,
    cast(hour(pickup_at) as smallint) as pickup_hour,
    cast(if(payment_type between 1 and 6, payment_type, 5) as smallint) as payment_type
  from trips_clean),
fact_trips as (
  select cast(pickup_at as date) as date_day,
    * exclude (pickup_date, pickup_hour, qa_is_duplicate_in_file, source_year, source_month)
  from stg_trips),
fact_revenue_adjustments as (
  select * from (
    select ifnull(cast(pickup_at as date), cast(dropoff_at as date)) as date_day,
      cast(if(payment_type between 1 and 6, payment_type, 5) as smallint) as payment_type,
      pu_location_id, do_location_id,
      total_amount, fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge,
      congestion_surcharge, airport_fee, cbd_congestion_fee,
      true as is_adjustment, source_year, source_month, source_file
    from trips_admin) a
  where date_day is not null),
dd_bounds as (
  select min(date_day) - 2 as lo, max(date_day) + 2 as hi
  from (select date_day from fact_trips union all select date_day from fact_revenue_adjustments) u),
dim_date as (
  select d as date_day, cast(year(d) as int) as year, cast(quarter(d) as int) as quarter,
    cast(month(d) as int) as month, cast(day(d) as int) as day, strftime(d, '%Y-%m') as year_month,
    dayname(d) as day_name, cast(isodow(d) as int) as iso_dow, isodow(d) >= 6 as is_weekend
  from (select cast(unnest(generate_series(cast(lo as timestamp), cast(hi as timestamp), interval 1 day)) as date) as d
        from dd_bounds) s),
seed_vendors as ({_values(VENDORS, ["vendor_id", "vendor_name"], ["smallint", "varchar"])}),
seed_payment_types as ({_values(PAYMENT_TYPES, ["payment_type", "payment_desc"], ["smallint", "varchar"])}),
seed_zones as ({ZONES_SQL.format(nation='nation', region='region')}),
dim_payment as (select * from seed_payment_types),
dim_vendor as (
  select s.vendor_id, ifnull(v.vendor_name, 'Unknown') as vendor_name
  from (select vendor_id from stg_trips group by all having vendor_id is not null) s
  left join seed_vendors v on v.vendor_id = s.vendor_id),
dim_zone as (
  select l.location_id, ifnull(z.borough, 'Unknown') as borough, ifnull(z.zone, 'Unknown') as zone,
    ifnull(z.service_zone, 'Unknown') as service_zone
  from (select distinct unnest([pu_location_id, do_location_id]) as location_id from stg_trips) l
  left join seed_zones z on z.location_id = l.location_id
  where l.location_id is not null),
mart_kpi_daily as (
  select *, if(avg_duration_min > 0, 60.0e0 * avg_miles / avg_duration_min, null) as avg_speed_mph
  from (
    select f.date_day, count(*) as trips, sum(f.total_amount) as gross_revenue,
      ifnull(sum(f.total_amount), 0) + ifnull(max(a.adj), 0) as net_revenue,
      sum(f.tip_amount) as tips,
      if(sum(f.total_amount) > 0, sum(f.tip_amount) / sum(f.total_amount), null) as tip_rate,
      sum(f.congestion_surcharge) as congestion, sum(f.tolls_amount) as tolls,
      avg(f.trip_distance_mi) as avg_miles, avg({_DUR}) as avg_duration_min
    from fact_trips f
    left join (select date_day, sum(total_amount) as adj from fact_revenue_adjustments group by all) a
      on a.date_day = f.date_day
    group by f.date_day) k),
mart_revenue_daily_zone as (
  select date_day, pu_location_id as location_id, sum(total_amount) as total_revenue,
    sum(fare_amount) as fare_revenue, sum(tip_amount) as tip_revenue, sum(trip_distance_mi) as total_miles,
    count(*) as trips
  from fact_trips group by all),
mart_trips_hourly_vendor as (
  select time_bucket(interval 1 hour, pickup_at) as hour, vendor_id, count(*) as trips,
    sum(total_amount) as revenue, avg(trip_distance_mi) as avg_miles, avg({_DUR}) as avg_duration_min
  from fact_trips group by all),
mart_payment_mix_daily as (
  select date_day, payment_type, count(*) as trips, sum(total_amount) as revenue,
    sum(total_amount) / nullif(count(*), 0) as avg_ticket,
    count(*) / nullif(sum(count(*)) over (partition by date_day), 0) as share
  from fact_trips group by date_day, payment_type),
mart_vendor_scorecard_monthly as (
  select d.year_month, f.vendor_id, count(*) as trips, sum(f.total_amount) as revenue,
    sum(f.total_amount) / nullif(count(*), 0) as avg_ticket, avg(f.trip_distance_mi) as avg_miles,
    avg(date_diff('minute', f.pickup_at, f.dropoff_at)) as avg_duration_min,
    sum(f.tip_amount) / nullif(sum(f.total_amount), 0) as tip_rate,
    sum(f.total_amount) / nullif(sum(sum(f.total_amount)) over (partition by d.year_month), 0) as revenue_share
  from fact_trips f, dim_date d where d.date_day = f.date_day
  group by d.year_month, f.vendor_id),
mart_od_matrix_monthly as (
  select d.year_month, f.pu_location_id, f.do_location_id, count(*) as trips, sum(f.total_amount) as revenue,
    avg(f.trip_distance_mi) as avg_miles, avg(date_diff('minute', f.pickup_at, f.dropoff_at)) as avg_duration_min
  from fact_trips f, dim_date d where d.date_day = f.date_day
  group by d.year_month, f.pu_location_id, f.do_location_id),
mart_adjustments_daily_zone as (
  select date_day, cast(if(payment_type between 1 and 6, payment_type, 5) as smallint) as payment_type,
    pu_location_id as location_id, count(*) as trips, sum(total_amount) as total_revenue
  from fact_revenue_adjustments where date_day is not null group by all),
mart_congestion_impact_daily as (
  select date_day,
    cast(sum(if(congestion_surcharge > 0, 1, 0)) as bigint) as trips_with_congestion,
    count(*) as trips_total,
    sum(if(congestion_surcharge > 0, total_amount, 0)) as revenue_with_congestion,
    sum(if(congestion_surcharge > 0, 0, total_amount)) as revenue_without_congestion,
    avg(fare_amount) filter (where congestion_surcharge > 0) as avg_fare_with_congestion,
    avg(fare_amount) filter (where not ifnull(congestion_surcharge > 0, false)) as avg_fare_without_congestion
  from fact_trips group by all),
airport_ids as (
  select location_id, case when zone ilike 'nation_3' then 'N3' when zone ilike 'nation_8' then 'N8' end as airport
  from dim_zone where service_zone = 'Airports'),
airport_rides as (
  select f.*, z.airport, 'PU' as direction from fact_trips f join airport_ids z on f.pu_location_id = z.location_id
  union all
  select f.*, z.airport, 'DO' as direction from fact_trips f join airport_ids z on f.do_location_id = z.location_id),
mart_airport_daily as (
  select date_day, airport, direction, count(*) as trips, sum(total_amount) as total_revenue, sum(fare_amount) as fare_revenue,
    sum(tip_amount) as tip_revenue, sum(airport_fee) as airport_fee_total, avg(trip_distance_mi) as avg_miles
  from airport_rides where airport is not null group by date_day, airport, direction),
mart_anomaly_summary_daily as (
  select *, distance_outliers + duration_outliers + speed_outliers + negative_total as anomalies
  from (
    select date_day, location_id,
      cast(sum(cast(trip_distance_mi > 150 or trip_distance_mi < 0 as int)) as bigint) as distance_outliers,
      cast(sum(cast(dm < 1 or dm > 360 as int)) as bigint) as duration_outliers,
      cast(sum(cast(case when dm > 0 then 60.0e0 * trip_distance_mi / dm end > 80 as int)) as bigint) as speed_outliers,
      cast(sum(cast(total_amount < 0 as int)) as bigint) as negative_total
    from (select date_day, pu_location_id as location_id, trip_distance_mi, total_amount, {_DUR} as dm
          from fact_trips) b
    group by all) c)
"""


def with_chain(final_select: str) -> str:
    return f"with {CHAIN.strip()}\n{final_select}"


def rounded(select_from: str, doubles) -> str:
    """``select * replace (<rounded doubles>) from (<select_from>)``."""
    if not doubles:
        return f"select * from ({select_from}) q"
    rep = ", ".join(round_sql(c) for c in doubles)
    return f"select * replace ({rep}) from ({select_from}) q"


def q(final_select: str, doubles=()) -> str:
    return with_chain(rounded(final_select, doubles))


MONEY = (
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
    "total_amount", "congestion_surcharge", "airport_fee", "cbd_congestion_fee",
)
BRONZE_DOUBLES = ("trip_distance_mi", *MONEY, "manualTotal", "duration_min", "speed_mph")
STG_DOUBLES = ("trip_distance_mi", *MONEY, "manual_total", "duration_min", "speed_mph")

MART_DOUBLES = {
    "mart_kpi_daily": ("gross_revenue", "net_revenue", "tips", "tip_rate", "congestion", "tolls", "avg_miles",
                       "avg_duration_min", "avg_speed_mph"),
    "mart_revenue_daily_zone": ("total_revenue", "fare_revenue", "tip_revenue", "total_miles"),
    "mart_trips_hourly_vendor": ("revenue", "avg_miles", "avg_duration_min"),
    "mart_payment_mix_daily": ("revenue", "avg_ticket", "share"),
    "mart_vendor_scorecard_monthly": ("revenue", "avg_ticket", "avg_miles", "avg_duration_min", "tip_rate",
                                      "revenue_share"),
    "mart_od_matrix_monthly": ("revenue", "avg_miles", "avg_duration_min"),
    "mart_adjustments_daily_zone": ("total_revenue",),
    "mart_congestion_impact_daily": ("revenue_with_congestion", "revenue_without_congestion",
                                     "avg_fare_with_congestion", "avg_fare_without_congestion"),
    "mart_airport_daily": ("total_revenue", "fare_revenue", "tip_revenue", "airport_fee_total", "avg_miles"),
    "mart_anomaly_summary_daily": (),
}


def base_queries() -> dict[str, str]:
    out = {
        "canonicalized": q(f"select {_BASE}, source_file from fx_raw"),
        "bronze_flags": q("select * from bronze"),
        "dedup_in_file": q(
            "select source_file, sum(n)::bigint as rows_in, "
            "sum(case when n > 1 then n else 0 end)::bigint as duplicates_removed, "
            "count_if(n = 1)::bigint as rows_written "
            f"from (select source_file, count(*) as n from fx_raw group by source_file, {_KEY}) g group by source_file"
        ),
        "dup_key_classes": q(
            f"select copies, count(*)::bigint as keys from (select count(*)::bigint as copies from bronze group by {_KEY}) g "
            "group by copies"),
        "alt_dup_key_classes": q(
            "select copies, count(*)::bigint as keys from (select count(*)::bigint as copies from bronze "
            f"group by {', '.join(ALT_DUP_KEY_COLUMNS)}) g group by copies"),
        "classified_rows": q(
            f"select *, ({_MISSING} or {' or '.join(c + ' is null' for c in REQUIRED_FOR_ROW)}) as is_rejected_missing, "
            "qa_is_adjustment as is_admin_issue, qa_is_fare_mismatch as is_fare_mismatch, "
            f"({_ANOMALY}) as is_anomaly from bronze"),
        "raw_file_report": q(
            "select count(distinct source_file)::bigint as files, count(*)::bigint as rows_in, "
            "count_if(n_copies = 1)::bigint as rows_written, count_if(n_copies > 1)::bigint as duplicates_removed from fx_dd"),
        "raw_schema_families": q(
            "select min(source_file) as first_file, count(distinct source_file)::bigint as files "
            "from (select source_file, cast(regexp_extract(source_file, '(\\d{4})-(\\d{2})', 2) as int) % 5 as family from fx_raw) f group by family"),
        "bronze_from_files": q("select * from bronze"),
        "silver_from_files": q(
            "select * exclude (silver_split), silver_split as split from silver "
            "union all by name select *, 'trips_fare_miss' as split from trips_fare_miss"),
        "silver_split_counts": q(
            "select silver_split, count(*)::bigint as rows, sum(total_amount) as total_amount_sum from silver group by 1 "
            "union all select 'trips_fare_miss', count(*)::bigint, sum(total_amount) from trips_fare_miss",
            ("total_amount_sum",),
        ),
        "silver_coverage": q(
            "select total_rows, rejected, admin, anomalies, clean, fare_miss, "
            "total_rows - rejected - admin as base_good, clean + anomalies as covered, "
            "(total_rows - rejected - admin) = (clean + anomalies) as coverage_ok from ("
            "select count(*)::bigint as total_rows, count_if(silver_split = 'rejected')::bigint as rejected, "
            "count_if(silver_split = 'trips_admin')::bigint as admin, "
            "count_if(silver_split = 'trips_anomalies')::bigint as anomalies, "
            "count_if(silver_split = 'trips_clean')::bigint as clean, "
            "count_if(silver_split = 'trips_clean' and qa_is_fare_mismatch)::bigint as fare_miss from silver) c"
        ),
        "fare_miss_rows": q("select *, date_trunc('day', pickup_at)::date as pickup_date from trips_fare_miss"),
        "stg_admin": q("select *, date_trunc('day', pickup_at)::date as pickup_date from trips_admin"),
        "stg_anomalies": q("select *, date_trunc('day', pickup_at)::date as pickup_date from trips_anomalies"),
        "stg_trips": q("select * from stg_trips"),
        "fact_trips": q("select * from fact_trips"),
        "fact_revenue_adjustments": q("select * from fact_revenue_adjustments"),
        "dim_date": q("select * from dim_date"),
        "dim_payment": q("select * from dim_payment"),
        "dim_vendor": q("select * from dim_vendor"),
        "dim_zone": q("select * from dim_zone"),
    }
    for name, doubles in MART_DOUBLES.items():
        out[name] = out[f"incremental_{name}"] = q(f"select * from {name}", doubles)
    for name in ("fact_revenue_adjustments", "dim_date", "dim_vendor", "dim_zone"):
        out[f"incremental_{name}"] = out[name]
    return out


# the files whose missing values are texts, and the file that lands short at first
_MONTH = "cast(regexp_extract(source_file, '(\\d{4})-(\\d{2})', 2) as int)"
_LOST = (("airport_fee", "n/a"), ("payment_type", "99999"), ("pickup_at", "unknown"))
_SHORT = f"(select max(source_file) from fx_raw where {_MONTH} % 5 = 2)"


def file_queries() -> dict[str, str]:
    """Queries on files, versions and the catalog."""
    lost = " union all ".join(
        f"select source_file, '{c}' as column_name, count(*)::bigint as lost, '{text}' as example "
        f"from fx_raw where {_MONTH} % 5 = 0 and {c} is null group by source_file" for c, text in _LOST)
    kept = f"select source_file, {_KEY}, count(*) as n from {{}} group by source_file, {_KEY}"
    views = " union all ".join(
        f"select 'silver_{v}' as view_name, count(*)::bigint as rows, sum(total_amount) as total_amount_sum, "
        f"count(distinct source_file)::bigint as files from {v if v != 'rejected' else rejected}"
        for rejected in ["(select * from silver where silver_split = 'rejected') r"]
        for v in ("rejected", "trips_admin", "trips_anomalies", "trips_clean", "trips_fare_miss"))
    total = "coalesce(fare_amount, 0) + coalesce(extra, 0) + coalesce(mta_tax, 0)"
    rest = ("coalesce(tolls_amount, 0) + coalesce(improvement_surcharge, 0) + coalesce(congestion_surcharge, 0) "
            "+ coalesce(airport_fee, 0) + coalesce(cbd_congestion_fee, 0)")
    early = f"({total} + coalesce(tip_amount, 0) + {rest})"
    near = "{0} between total_amount - 0.02 and total_amount + 0.02"
    counts = " union all ".join(
        f"select '{layer}' as table_schema, '{name}' as table_name, 'EXTERNAL' as kind, count(*)::bigint as row_count from {name}"
        for name, layer, *_ in _PROFILE)
    return {
        "cast_losses": q(lost),
        "snapshot_rows": q(
            "select source_file, count_if(n = 1)::bigint as rows, any_value(coalesce(b.rows_before, 0))::bigint as rows_before "
            f"from ({kept.format('fx_raw')}) g left join (select source_file, count_if(n = 1) as rows_before from "
            f"({kept.format(f'(select * from fx_raw where source_file <> {_SHORT} or passenger_count <= 3) s')}) h group by source_file) b "
            "using (source_file) group by source_file"),
        "split_view_totals": q(views, ("total_amount_sum",)),
        "seeds_from_csv": q(
            "select 'taxi_zones' as seed, location_id as id, zone as name, borough, service_zone from seed_zones "
            "union all select 'vendors', vendor_id::int, vendor_name, null, null from seed_vendors "
            "union all select 'payment_types', payment_type::int, payment_desc, null, null from seed_payment_types"),
        "near_totals": q(
            f"select source_file, count_if({near.format('manualTotal')})::bigint as near_rows, "
            f"count_if({near.format(early)})::bigint as near_rows_early_tip, sum({early}) as components_sum "
            "from bronze group by source_file", ("components_sum",)),
        "catalog_row_counts": q(counts),
    }


def _lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else str(v)


def _check_sql(c) -> str:
    meta = f"'{c.kind}' as check_name, '{c.table}' as table_name, '{c.column}' as column_name, '{c.detail}' as detail"
    if c.kind == "not_null":
        cond = "false" if c.column == "dup_key" else f"{c.column} is null"
        return f"select {meta}, count_if({cond})::bigint as failures from {c.table}"
    if c.kind == "unique":
        if c.column == "dup_key":
            inner = f"select 1 from {c.table} group by {_KEY} having count(*) > 1"
        else:
            inner = f"select 1 from {c.table} where {c.column} is not null group by {c.column} having count(*) > 1"
        return f"select {meta}, count(*)::bigint as failures from ({inner}) u"
    if c.kind == "accepted_values":
        vals = ", ".join(_lit(v) for v in c.values)
        return (f"select {meta}, count(distinct case when {c.column} not in ({vals}) then {c.column} end)::bigint "
                f"as failures from {c.table}")
    if c.kind == "fare_within_tolerance":
        cond = (f"{c.column} is not null and {c.expected} is not null and "
                f"abs(cast({c.column} as double) - cast({c.expected} as double)) > {c.tolerance}")
        if c.exclude_flagged:
            cond += f" and coalesce({c.flag_column}, false) = false"
        return f"select {meta}, count_if({cond})::bigint as failures from {c.table}"
    if c.kind == "relationships":
        return (f"select {meta}, count(*)::bigint as failures from {c.table} ch where ch.{c.column} is not null "
                f"and not exists (select 1 from {c.to_table} p where p.{c.to_column} = ch.{c.column})")
    raise ValueError(c.kind)


def check_results_sql() -> str:
    from fareline.operators.checks import DEFAULT_SUITE

    body = "\nunion all\n".join(_check_sql(c) for c in DEFAULT_SUITE)
    return with_chain(f"select *, failures = 0 as passed from ({body}) r")


def strict_check_results_sql() -> str:
    from fareline.operators.checks import fare_within_tolerance

    checks = [fare_within_tolerance("stg_trips", "manual_total", "total_amount", tol, flagged) for tol in (0.5, 2.0) for flagged in (False, True)]
    body = "\nunion all\n".join(_check_sql(c) for c in checks)
    return with_chain(f"select *, failures = 0 as passed from ({body}) r")


# Expected catalog facts, written from the models: table -> (layer, columns, date column, relationships)
_REL = {
    "fact_trips": [("date_day", "dim_date", "date_day"), ("vendor_id", "dim_vendor", "vendor_id"),
                   ("payment_type", "dim_payment", "payment_type"), ("pu_location_id", "dim_zone", "location_id"),
                   ("do_location_id", "dim_zone", "location_id")],
    "fact_revenue_adjustments": [("date_day", "dim_date", "date_day"), ("payment_type", "dim_payment", "payment_type"),
                                 ("pu_location_id", "dim_zone", "location_id"),
                                 ("do_location_id", "dim_zone", "location_id")],
    "mart_kpi_daily": [("date_day", "dim_date", "date_day")],
    "mart_revenue_daily_zone": [("date_day", "dim_date", "date_day"), ("location_id", "dim_zone", "location_id")],
    "mart_trips_hourly_vendor": [("vendor_id", "dim_vendor", "vendor_id")],
    "mart_payment_mix_daily": [("date_day", "dim_date", "date_day"), ("payment_type", "dim_payment", "payment_type")],
    "mart_vendor_scorecard_monthly": [("vendor_id", "dim_vendor", "vendor_id")],
    "mart_od_matrix_monthly": [("pu_location_id", "dim_zone", "location_id"),
                               ("do_location_id", "dim_zone", "location_id")],
    "mart_adjustments_daily_zone": [("date_day", "dim_date", "date_day"), ("payment_type", "dim_payment", "payment_type"),
                                    ("location_id", "dim_zone", "location_id")],
    "mart_congestion_impact_daily": [("date_day", "dim_date", "date_day")],
    "mart_airport_daily": [("date_day", "dim_date", "date_day")],
    "mart_anomaly_summary_daily": [("date_day", "dim_date", "date_day"), ("location_id", "dim_zone", "location_id")],
}
_PROFILE = [
    ("fact_trips", "gold", "FACT", 31, "date_day"),
    ("fact_revenue_adjustments", "gold", "FACT", 18, "date_day"),
    ("dim_date", "gold", "DIMENSION", 9, "date_day"),
    ("dim_payment", "gold", "DIMENSION", 2, None),
    ("dim_vendor", "gold", "DIMENSION", 2, None),
    ("dim_zone", "gold", "DIMENSION", 4, None),
    ("mart_kpi_daily", "marts", "MART", 11, "date_day"),
    ("mart_revenue_daily_zone", "marts", "MART", 7, "date_day"),
    ("mart_trips_hourly_vendor", "marts", "MART", 6, None),
    ("mart_payment_mix_daily", "marts", "MART", 6, "date_day"),
    ("mart_vendor_scorecard_monthly", "marts", "MART", 9, None),
    ("mart_od_matrix_monthly", "marts", "MART", 7, None),
    ("mart_adjustments_daily_zone", "marts", "MART", 5, "date_day"),
    ("mart_congestion_impact_daily", "marts", "MART", 7, "date_day"),
    ("mart_airport_daily", "marts", "MART", 9, "date_day"),
    ("mart_anomaly_summary_daily", "marts", "MART", 7, "date_day"),
]


# Columns of every built table, with Spark's type names, written from the models.
_COLUMNS = {
    "dim_date": "date_day date, year int, quarter int, month int, day int, year_month string, day_name string, iso_dow int, is_weekend boolean",
    "dim_payment": "payment_type smallint, payment_desc string",
    "dim_vendor": "vendor_id smallint, vendor_name string",
    "dim_zone": "location_id int, borough string, zone string, service_zone string",
    "fact_revenue_adjustments": "date_day date, payment_type smallint, pu_location_id int, do_location_id int, total_amount double, "
    "fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, "
    "congestion_surcharge double, airport_fee double, cbd_congestion_fee double, is_adjustment boolean, source_year int, source_month int, "
    "source_file string",
    "fact_trips": "trip_key string, date_day date, vendor_id smallint, payment_type smallint, pu_location_id int, do_location_id int, "
    "pickup_at timestamp_ntz, dropoff_at timestamp_ntz, passenger_count smallint, trip_distance_mi double, rate_code_id smallint, "
    "store_and_fwd_flag string, fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double, "
    "improvement_surcharge double, congestion_surcharge double, airport_fee double, cbd_congestion_fee double, total_amount double, "
    "manual_total double, duration_min double, speed_mph double, qa_in_file_window boolean, qa_outlier_distance boolean, "
    "qa_outlier_speed boolean, qa_is_fare_mismatch boolean, qa_is_adjustment boolean, source_file string",
    "mart_adjustments_daily_zone": "date_day date, payment_type smallint, location_id int, trips bigint, total_revenue double",
    "mart_airport_daily": "date_day date, airport string, direction string, trips bigint, total_revenue double, fare_revenue double, "
    "tip_revenue double, airport_fee_total double, avg_miles double",
    "mart_anomaly_summary_daily": "date_day date, location_id int, distance_outliers bigint, duration_outliers bigint, "
    "speed_outliers bigint, negative_total bigint, anomalies bigint",
    "mart_congestion_impact_daily": "date_day date, trips_with_congestion bigint, trips_total bigint, revenue_with_congestion double, "
    "revenue_without_congestion double, avg_fare_with_congestion double, avg_fare_without_congestion double",
    "mart_kpi_daily": "date_day date, trips bigint, gross_revenue double, net_revenue double, tips double, tip_rate double, "
    "congestion double, tolls double, avg_miles double, avg_duration_min double, avg_speed_mph double",
    "mart_od_matrix_monthly": "year_month string, pu_location_id int, do_location_id int, trips bigint, revenue double, avg_miles double, "
    "avg_duration_min double",
    "mart_payment_mix_daily": "date_day date, payment_type smallint, trips bigint, revenue double, avg_ticket double, share double",
    "mart_revenue_daily_zone": "date_day date, location_id int, total_revenue double, fare_revenue double, tip_revenue double, "
    "total_miles double, trips bigint",
    "mart_trips_hourly_vendor": "hour timestamp_ntz, vendor_id smallint, trips bigint, revenue double, avg_miles double, avg_duration_min double",
    "mart_vendor_scorecard_monthly": "year_month string, vendor_id smallint, trips bigint, revenue double, avg_ticket double, "
    "avg_miles double, avg_duration_min double, tip_rate double, revenue_share double",
}


def table_columns_sql() -> str:
    rows = []
    for table, text in _COLUMNS.items():
        layer = "marts" if table.startswith("mart_") else "gold"
        for i, c in enumerate(text.split(", "), start=1):
            name, kind = c.split(" ")
            rows.append(f"('{layer}', '{table}', {i}, '{name}', '{kind}', true)")
    body = ", ".join(rows)
    return (
        "select table_schema, table_name, ordinal::int as ordinal, column_name, data_type, nullable "
        f"from (values {body}) v(table_schema, table_name, ordinal, column_name, data_type, nullable)"
    )


def table_profile_sql() -> str:
    parts = []
    for name, layer, kind, ncols, dcol in _PROFILE:
        if dcol:
            rng = (f"strftime(min({dcol})::date, '%Y-%m-%d') as date_min, "
                   f"strftime(max({dcol})::date, '%Y-%m-%d') as date_max")
            dc = f"'{dcol}'"
        else:
            rng, dc = "null::varchar as date_min, null::varchar as date_max", "null::varchar"
        parts.append(
            f"select '{layer}' as table_schema, '{name}' as table_name, '{kind}' as kind, count(*)::bigint as row_count, "
            f"{dc} as date_column, {rng}, {ncols} as n_columns, {len(_REL.get(name, []))} as n_relationships from {name}"
        )
    return with_chain("\nunion all\n".join(parts))


def table_relationships_sql() -> str:
    parts = []
    for name, rels in _REL.items():
        layer = "gold" if name.startswith("fact_") else "marts"
        for col, dim, key in rels:
            parts.append(
                f"select '{layer}.{name}' as fk_table, '{col}' as fk_column, 'gold.{dim}' as pk_table, "
                f"'{key}' as pk_column, 'high' as confidence, count(*)::bigint as orphan_rows from {name} ch "
                f"where ch.{col} is not null and not exists (select 1 from {dim} p where p.{key} = ch.{col})"
            )
    return with_chain("\nunion all\n".join(parts))


def all_queries() -> dict[str, str]:
    out = base_queries()
    out.update(file_queries())
    out["check_results"] = check_results_sql()
    out["strict_check_results"] = strict_check_results_sql()
    out["table_columns"] = table_columns_sql()
    out["table_profile"] = table_profile_sql()
    out["table_relationships"] = table_relationships_sql()
    out.update(bi_queries())
    return out


# ----------------------------------------------------------------- questions
PP = 0.5 / 100.0  # default shift in share points, as a fraction


def _win(n: int) -> str:
    return (f"select today, today - {n - 1} as current_start, today - {n - 1} - {n} as previous_start, "
            f"today - {n} as previous_end, {n} as window_days "
            "from (select greatest(least(max(date_day), max(date_day)), min(date_day)) as today from mart_kpi_daily) t")


BI_CHAIN = f"""
win30 as ({_win(30)}),
win90 as ({_win(90)}),
win365 as ({_win(365)}),
kpi_rows as (
  select k.date_day, case when k.date_day between w.current_start and w.today then 'current'
                          when k.date_day between w.previous_start and w.previous_end then 'previous' end as period,
         coalesce(k.trips, 0) as trips, coalesce(k.gross_revenue, 0) as revenue, k.tip_rate
  from mart_kpi_daily k, win30 w where k.date_day between w.previous_start and w.today),
kpis30 as (
  select *,
    case when trips_previous <> 0 then (trips_current - trips_previous) / trips_previous else 0.0 end as trips_delta,
    case when revenue_previous <> 0 then (revenue_current - revenue_previous) / revenue_previous else 0.0 end as revenue_delta,
    case when avg_ticket_previous <> 0 then (avg_ticket_current - avg_ticket_previous) / avg_ticket_previous else 0.0 end as avg_ticket_delta,
    case when days_previous > 0 then tip_rate_current - tip_rate_previous else 0.0 end as tip_rate_delta
  from (
    select *, case when trips_current <> 0 then revenue_current / trips_current else 0.0 end as avg_ticket_current,
              case when trips_previous <> 0 then revenue_previous / trips_previous else 0.0 end as avg_ticket_previous
    from (
      select 30 as window_days, w.today, w.current_start, w.previous_start, w.previous_end,
        count(case when period = 'current' then 1 end) as days_current,
        count(case when period = 'previous' then 1 end) as days_previous,
        coalesce(sum(case when period = 'current' then trips end), 0)::bigint as trips_current,
        coalesce(sum(case when period = 'previous' then trips end), 0)::bigint as trips_previous,
        coalesce(sum(case when period = 'current' then revenue end), 0.0)::double as revenue_current,
        coalesce(sum(case when period = 'previous' then revenue end), 0.0)::double as revenue_previous,
        coalesce(avg(case when period = 'current' then tip_rate end), 0.0) as tip_rate_current,
        coalesce(avg(case when period = 'previous' then tip_rate end), 0.0) as tip_rate_previous
      from win30 w left join kpi_rows r on true
      group by w.today, w.current_start, w.previous_start, w.previous_end) a) b),
pmix30 as (
  select period, payment_desc, trips, avg_ticket,
    case when sum(trips) over (partition by period) <> 0 then trips / sum(trips) over (partition by period) else 0.0 end as share
  from (
    select case when m.date_day between w.current_start and w.today then 'current'
                when m.date_day between w.previous_start and w.previous_end then 'previous' end as period,
           d.payment_desc, sum(m.trips)::bigint as trips, avg(m.avg_ticket) as avg_ticket
    from mart_payment_mix_daily m left join dim_payment d using (payment_type), win30 w
    where m.date_day between w.previous_start and w.today and d.payment_desc is not null
    group by 1, 2) g),
mix_labels as (
  select coalesce(c.payment_desc, p.payment_desc) as payment_desc, coalesce(c.share, 0.0) as s1,
         coalesce(c.avg_ticket, 0.0) as p1, coalesce(p.share, 0.0) as s0,
         c.payment_desc is not null as in_cur, p.payment_desc is not null as in_prev
  from (select * from pmix30 where period = 'current') c
  full join (select * from pmix30 where period = 'previous') p on c.payment_desc = p.payment_desc),
mix_card as (
  select coalesce(
    (select min(payment_desc) from mix_labels where in_cur and lower(payment_desc) like '%card%'),
    (select min(payment_desc) from mix_labels where in_cur and s1 = (select max(s1) from mix_labels where in_cur))) as card,
    (select min(payment_desc) from mix_labels where in_cur and lower(payment_desc) like '%cash%') as cash),
mix_s1 as (
  select l.*, case when l.payment_desc = c.card then least(greatest(l.s1 + {PP!r}, 0.0), 1.0) else l.s1 end as s_adj
  from mix_labels l, mix_card c),
mix_take as (
  select coalesce((select cash from mix_card),
    (select min(payment_desc) from mix_s1 where payment_desc <> (select card from mix_card)
       and s_adj = (select max(s_adj) from mix_s1 where payment_desc <> (select card from mix_card)))) as take_from),
mix_s2 as (
  select m.* replace (case when m.payment_desc = t.take_from then greatest(m.s_adj - {PP!r}, 0.0) else m.s_adj end as s_adj)
  from mix_s1 m, mix_take t),
mix_s3 as (
  select m.* replace (case when tot.s <> 0 then m.s_adj / tot.s else m.s_adj end as s_adj)
  from mix_s2 m, (select sum(s_adj) as s from mix_s2) tot),
win_trips30 as (
  select coalesce(sum(k.trips), 0)::bigint as t from mart_kpi_daily k, win30 w
  where k.date_day between w.current_start and w.today),
vend30_0 as (
  select f.vendor_id, dv.vendor_name, count(*)::bigint as trips, sum(f.total_amount) as revenue,
    avg(f.total_amount) as avg_ticket, sum(f.tip_amount) / nullif(sum(f.total_amount), 0) as tip_rate
  from fact_trips f left join dim_vendor dv using (vendor_id), win30 w
  where f.date_day between w.current_start and w.today group by 1, 2),
vend30 as (
  select *, trips / (select sum(trips) from vend30_0) as share, revenue / nullif(trips, 0) as revenue_per_trip
  from vend30_0),
zone_days90 as (
  select r.date_day, r.location_id, z.borough, z.zone, coalesce(r.trips, 0) as trips,
         coalesce(r.total_revenue, 0.0) as total_revenue
  from mart_revenue_daily_zone r left join dim_zone z using (location_id), win90 w
  where r.date_day between w.current_start and w.today),
zone_tot90_0 as (
  select location_id, borough, zone, sum(trips)::bigint as trips, sum(total_revenue) as revenue
  from zone_days90 where borough is not null and zone is not null group by 1, 2, 3),
zone_tot90 as (
  select *, revenue / nullif(trips, 0) as avg_ticket,
    case when (select sum(revenue) from zone_tot90_0) <> 0 then revenue / (select sum(revenue) from zone_tot90_0)
         else 0.0 end as rev_share,
    concat_ws(' — ', borough, zone) as label
  from zone_tot90_0),
top_zones90 as (select * from zone_tot90 order by revenue desc, location_id limit 12)
"""


_WINDOWS_OF_DAYS = """
select *,
  case when trips_previous <> 0 then (trips_current - trips_previous) / trips_previous else 0.0 end as trips_delta,
  case when revenue_previous <> 0 then (revenue_current - revenue_previous) / revenue_previous else 0.0 end as revenue_delta,
  case when avg_ticket_previous <> 0 then (avg_ticket_current - avg_ticket_previous) / avg_ticket_previous else 0.0 end as avg_ticket_delta,
  case when days_previous > 0 then tip_rate_current - tip_rate_previous else 0.0 end as tip_rate_delta
from (
  select *, case when trips_current <> 0 then revenue_current / trips_current else 0.0 end as avg_ticket_current,
            case when trips_previous <> 0 then revenue_previous / trips_previous else 0.0 end as avg_ticket_previous
  from (
    select n::int as window_days, t.today, t.today - (n - 1)::int as current_start, t.today - (2 * n - 1)::int as previous_start,
      t.today - n::int as previous_end,
      count(case when k.date_day > t.today - n::int then 1 end) as days_current,
      count(case when k.date_day <= t.today - n::int then 1 end) as days_previous,
      coalesce(sum(case when k.date_day > t.today - n::int then k.trips end), 0)::bigint as trips_current,
      coalesce(sum(case when k.date_day <= t.today - n::int then k.trips end), 0)::bigint as trips_previous,
      coalesce(sum(case when k.date_day > t.today - n::int then k.gross_revenue end), 0.0)::double as revenue_current,
      coalesce(sum(case when k.date_day <= t.today - n::int then k.gross_revenue end), 0.0)::double as revenue_previous,
      coalesce(avg(case when k.date_day > t.today - n::int then k.tip_rate end), 0.0) as tip_rate_current,
      coalesce(avg(case when k.date_day <= t.today - n::int then k.tip_rate end), 0.0) as tip_rate_previous
    from (select cast(unnest(generate_series(min(date_day)::timestamp, max(date_day)::timestamp, interval 1 day)) as date) as today from mart_kpi_daily) t,
      (values (7), (30), (90)) w(n),
      mart_kpi_daily k
    where k.date_day between t.today - (2 * n - 1)::int and t.today
    group by 1, 2, 3, 4, 5) a) b
"""


def bq(final_select: str, doubles=()) -> str:
    return f"with {CHAIN.strip()},\n{BI_CHAIN.strip()}\n{rounded(final_select, doubles)}"


def bi_queries() -> dict[str, str]:
    return {
        "window_kpis": bq("select * from kpis30", (
            "revenue_current", "revenue_previous", "avg_ticket_current", "avg_ticket_previous", "tip_rate_current",
            "tip_rate_previous", "trips_delta", "revenue_delta", "avg_ticket_delta", "tip_rate_delta")),
        "window_kpis_of_days": bq(_WINDOWS_OF_DAYS, (
            "revenue_current", "revenue_previous", "avg_ticket_current", "avg_ticket_previous", "tip_rate_current",
            "tip_rate_previous", "trips_delta", "revenue_delta", "avg_ticket_delta", "tip_rate_delta")),
        "zone_hotspots_year": bq(
            "select a.location_id, z.borough, z.zone, concat_ws(' — ', z.borough, z.zone) as label, a.anomalies, a.trips, "
            "a.anomalies / nullif(a.trips, 0) as anomaly_rate "
            "from (select m.location_id, coalesce(sum(m.anomalies), 0)::bigint as anomalies, sum(r.trips)::bigint as trips "
            "from mart_revenue_daily_zone r join win365 w on r.date_day between w.current_start and w.today "
            "left join mart_anomaly_summary_daily m on m.date_day = r.date_day and m.location_id = r.location_id group by 1) a "
            "join dim_zone z using (location_id) where a.trips >= 100 "
            "order by anomaly_rate desc nulls last, a.location_id limit 8",
            ("anomaly_rate",)),
        "corridor_months": bq(
            "select year_month, sum(trips)::bigint as trips, sum(revenue) as revenue, count(*)::bigint as corridors "
            "from mart_od_matrix_monthly where year_month in (select strftime(unnest(generate_series("
            "date_trunc('month', current_start), date_trunc('month', today), interval 1 month)), '%Y-%m') from win90) group by 1",
            ("revenue",)),
        "kpi_daily_series": bq(
            "select date_day, period, trips, revenue as gross_revenue, max(trips) over () as trips_axis_max, "
            "max(revenue) over () as revenue_axis_max from kpi_rows", ("gross_revenue", "revenue_axis_max")),
        "kpi_alerts": bq(
            "select window_days, window_days <> 90 as alerts_enabled, "
            "window_days <> 90 and trips_delta < -0.05 as trips_alert, "
            "window_days <> 90 and revenue_delta < -0.05 as revenue_alert, "
            "window_days <> 90 and tip_rate_delta < 0.0 as tip_rate_alert, trips_delta, revenue_delta, tip_rate_delta "
            "from kpis30", ("trips_delta", "revenue_delta", "tip_rate_delta")),
        "payment_mix": bq("select * from pmix30", ("avg_ticket", "share")),
        "payment_mix_daily_share": bq(
            "select m.date_day, d.payment_desc, avg(m.share) as share "
            "from mart_payment_mix_daily m left join dim_payment d using (payment_type), win30 w "
            "where m.date_day between w.current_start and w.today and d.payment_desc is not null group by 1, 2",
            ("share",)),
        "mix_sensitivity": bq(
            "select (select card from mix_card) as card_label, (select take_from from mix_take) as take_from_label, "
            f"{PP * 100.0!r} as shift_pp, (select t from win_trips30) as window_trips, "
            "(select t from win_trips30) * sum(s1 * p1) as base_revenue, "
            "(select t from win_trips30) * sum(s_adj * p1) as sensitivity_revenue, "
            "(select t from win_trips30) * sum(s_adj * p1) - (select t from win_trips30) * sum(s1 * p1) as delta_revenue "
            "from mix_s3 having count_if(in_cur) > 0",
            ("shift_pp", "base_revenue", "sensitivity_revenue", "delta_revenue")),
        "mix_impact": bq(
            "select (select card from mix_card) as card_label, "
            "max(case when payment_desc = (select card from mix_card) then (s1 - s0) * 100.0 end) as card_share_change_pp, "
            "(select t from win_trips30) * sum((s1 - s0) * p1) as mix_impact "
            "from mix_labels having count_if(in_cur) > 0 and count_if(in_prev) > 0",
            ("card_share_change_pp", "mix_impact")),
        "vendor_cards": bq(
            "select vendor_id, vendor_name, trips, revenue, share, revenue_per_trip, tip_rate from vend30 "
            "where vendor_name is not null and vendor_name not ilike '%unknown%' and trips > 0 "
            "order by trips desc, vendor_id limit 2",
            ("revenue", "share", "revenue_per_trip", "tip_rate")),
        "vendor_gap": bq(
            "select vendor_id, vendor_name, trips, revenue_per_trip, median_revenue_per_trip, "
            "(revenue_per_trip - median_revenue_per_trip) * trips as gap from ("
            "select *, (select median(revenue_per_trip) from vend30) as median_revenue_per_trip from vend30) g "
            "order by gap asc nulls last, vendor_id limit 1",
            ("revenue_per_trip", "median_revenue_per_trip", "gap")),
        "airport_vs_city": bq(
            "with t as (select k.date_day, k.gross_revenue as total_revenue, coalesce(a.airport_revenue, 0.0) as airport_revenue "
            "from mart_kpi_daily k join win30 w on k.date_day between w.current_start and w.today "
            "left join (select date_day, sum(total_revenue) as airport_revenue from mart_airport_daily, win30 w2 "
            "where date_day between w2.current_start and w2.today group by 1) a using (date_day)) "
            "select date_day, 'airport_revenue' as segment, airport_revenue as revenue from t "
            "union all select date_day, 'city_revenue', total_revenue - airport_revenue from t",
            ("revenue",)),
        "top_zones": bq("select * from top_zones90", ("revenue", "avg_ticket", "rev_share")),
        "borough_dow_skew": bq(
            "select borough, day_name, revenue, revenue / nullif(sum(revenue) over (partition by borough), 0) as pct_of_borough "
            "from (select z.borough, d.day_name, sum(z.total_revenue) as revenue from zone_days90 z "
            "left join (select date_day, day_name from dim_date, win90 w where date_day between w.current_start and w.today) d "
            "using (date_day) where z.borough is not null and d.day_name is not null group by 1, 2) s",
            ("revenue", "pct_of_borough")),
        "top_corridors": bq(
            "select *, concat(pu_borough, ' — ', pu_zone, ' → ', do_borough, ' — ', do_zone) as corridor from ("
            "select od.pu_location_id, od.do_location_id, dpu.zone as pu_zone, ddo.zone as do_zone, "
            "dpu.borough as pu_borough, ddo.borough as do_borough, sum(od.trips)::bigint as trips, sum(od.revenue) as revenue "
            "from mart_od_matrix_monthly od left join dim_zone dpu on dpu.location_id = od.pu_location_id "
            "left join dim_zone ddo on ddo.location_id = od.do_location_id, win90 w "
            "where od.year_month between strftime(w.current_start, '%Y-%m') and strftime(w.today, '%Y-%m') "
            "and od.pu_location_id in (select location_id from top_zones90) "
            "and dpu.zone is not null and ddo.zone is not null and dpu.borough is not null and ddo.borough is not null "
            "and od.do_location_id is not null group by 1, 2, 3, 4, 5, 6) g "
            "order by revenue desc, pu_location_id, do_location_id limit 20",
            ("revenue",)),
        "zone_hotspots": bq(
            "select a.location_id, z.borough, z.zone, z.label, a.anomalies, z.trips, "
            "a.anomalies / nullif(z.trips, 0) as anomaly_rate "
            "from (select location_id, coalesce(sum(anomalies), 0)::bigint as anomalies from mart_anomaly_summary_daily, win90 w "
            "where date_day between w.current_start and w.today group by 1) a "
            "left join zone_tot90 z using (location_id) where z.trips >= 20 "
            "order by anomaly_rate desc nulls last, a.location_id limit 8",
            ("anomaly_rate",)),
        "zone_hotspots_floor_100": bq(
            "select a.location_id, z.borough, z.zone, z.label, a.anomalies, z.trips, "
            "a.anomalies / nullif(z.trips, 0) as anomaly_rate "
            "from (select location_id, coalesce(sum(anomalies), 0)::bigint as anomalies from mart_anomaly_summary_daily, win90 w "
            "where date_day between w.current_start and w.today group by 1) a "
            "left join zone_tot90 z using (location_id) where z.trips >= 100 "
            "order by anomaly_rate desc nulls last, a.location_id limit 8",
            ("anomaly_rate",)),
    }
