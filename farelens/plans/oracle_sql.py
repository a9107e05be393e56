"""The registered queries as plain SQL (DuckDB dialect) over the driver tables.

An independent statement of each query's semantics, used as the correctness
oracle: the same mapping, rules, cleaning and aggregates written as one SQL
text per key, with the same column names and types as the Spark results.
"""

from __future__ import annotations

# Nothing is imported from the code under test: a wrong constant there shows.
# Code points that count as white space (fixed values).
_SPACES = (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
_WS = " || ".join(f"chr({c})" for c in _SPACES)
_PEAK = "'Eid', 'Hajj', 'Winter Holidays'"
BASELINE_SEASON = "Regular"
KNOWN_FARE_UPLIFT_FACTOR = 1.2
UPLIFT_TOLERANCE = 1.21e-06
MIN_VALID_ROW_RATIO = 0.95
TAX_FLOOR_BDT = 200
FACT_COLUMNS = (
    "airline", "source", "source_name", "destination", "destination_name", "departure_datetime", "arrival_datetime",
    "duration_hrs", "stopovers", "aircraft_type", "flight_class", "booking_source", "base_fare_bdt",
    "tax_surcharge_bdt", "total_fare_bdt", "seasonality", "days_before_departure", "route", "is_peak_season",
    "has_fare_uplift", "_source_file",
)


def _strip(c: str) -> str:
    return f"trim({c}, {_WS})"


def _code(c: str) -> str:
    return f"upper({_strip(c)})"


def _r2(x: str) -> str:
    """SQL numeric ROUND(x, 2) on a double: half away from zero."""
    return (f"(case when ({x}) < 0 then -(floor(abs({x}) * 100.0 + 0.5) / 100.0) "
            f"else floor(abs({x}) * 100.0 + 0.5) / 100.0 end)")


def _re(x: str, digits: int) -> str:
    """Half-to-even rounding at ``digits`` decimals."""
    scale = float(10 ** digits)
    return f"(round_even(({x}) * {scale!r}, 0) / {scale!r})"


def _mean(c: str, cond: str | None = None) -> str:
    f = f" filter (where {cond})" if cond else ""
    return f"(cast(sum({c}){f} as double) / count({c}){f})"


MAPPING = """
j as (
  select l_orderkey, l_linenumber, l_orderkey % 1009 as d, p_brand, p_type, p_size, s_nationkey as a,
         case when s_nationkey = c_nationkey and l_orderkey % 7 <> 0 then (c_nationkey + 1) % 25 else c_nationkey end as b,
         l_shipdate, l_returnflag, l_linestatus, o_orderpriority, o_orderdate,
         cast(cast(l_extendedprice as decimal(10,2)) * cast(1 - l_discount as decimal(4,2)) as decimal(14,4)) as base0,
         greatest(cast(200 as decimal(14,4)), cast(cast(l_extendedprice as decimal(10,2)) * cast(l_tax as decimal(4,2)) as decimal(14,4))) as tax0,
         abs(date_diff('day', o_orderdate, l_shipdate)) % 90 as days0
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
       join supplier on l_suppkey = s_suppkey join part on l_partkey = p_partkey),
staged as (
  select l_orderkey, l_linenumber,
    case d when 1 then null when 2 then '   ' when 19 then chr(9) || p_brand || chr(160) || ' ' else p_brand end as airline,
    case d when 3 then 'DHAKA' when 11 then concat(' n', chr(97 + cast(floor(a / 5.0) as int)), chr(97 + a % 5), ' ')
           when 12 then null when 17 then chr(9) || ' '
           else concat('N', chr(65 + cast(floor(a / 5.0) as int)), chr(65 + a % 5)) end as source,
    concat('NATION_', cast(a as varchar), case d when 19 then '  ' else '' end) as source_name,
    case d when 4 then null when 18 then 'C9P' else concat('N', chr(65 + cast(floor(b / 5.0) as int)), chr(65 + b % 5)) end as destination,
    concat('NATION_', cast(b as varchar)) as destination_name,
    l_shipdate as departure_datetime,
    case d when 8 then l_shipdate - interval '15' minute * p_size else l_shipdate + interval '15' minute * p_size end as arrival_datetime,
    cast(case d when 9 then 0 else p_size * 0.25 end as double) as duration_hrs,
    case l_linestatus when 'O' then 'Direct' else '1 Stop' end as stopovers,
    p_type as aircraft_type,
    case l_returnflag when 'A' then 'Economy' when 'N' then 'Business' else 'First Class' end as flight_class,
    o_orderpriority as booking_source,
    cast(case d when 5 then -base0 when 13 then null else base0 end as decimal(14,4)) as base_fare_bdt,
    cast(case d when 14 then null when 15 then -tax0 else tax0 end as decimal(14,4)) as tax_surcharge_bdt,
    cast(case when d = 6 then null when d = 7 then base0 + tax0 + 50 when d = 16 then -(base0 + tax0)
              when l_orderkey % 23 = 0 then (base0 + tax0) * 1.2 else base0 + tax0 end as decimal(14,4)) as total_fare_bdt,
    case when d = 20 then 'Puja' when d = 21 then null when d = 24 then ' Eid' || chr(9) when month(l_shipdate) in (12, 1) then 'Winter Holidays' when month(l_shipdate) = 4 then 'Eid'
         when month(l_shipdate) = 6 then 'Hajj' else 'Regular' end as seasonality,
    cast(case d when 10 then -1 when 22 then null else days0 end as int) as days_before_departure,
    'lineitem.parquet' as _source_file
  from j)"""

# (label, family, predicate) in label order, for a typed staging frame.
RULES = [
    *[(f"null_{c}", "null", f"{c} is null") for c in
      ("airline", "source", "destination", "base_fare_bdt", "tax_surcharge_bdt", "total_fare_bdt")],
    *[(f"negative_{c}", "negative", f"{c} < 0") for c in
      ("base_fare_bdt", "tax_surcharge_bdt", "total_fare_bdt")],
    *[(f"blank_{c}", "blank", f"({c} is null or {_strip(c)} = '')") for c in
      ("airline", "source", "destination")],
    *[(f"malformed_{c}_code", "malformed_code",
       f"({_code(c)} is not null and not regexp_full_match({_code(c)}, '[A-Z]{{3}}'))")
      for c in ("source", "destination")],
    ("source_equals_destination", "same_endpoints", f"{_code('source')} = {_code('destination')}"),
    ("fare_mismatch", "fare_mismatch", "not (reconciles_exactly or has_known_uplift)"),
    ("arrival_before_departure", "arrival_order", "arrival_datetime < departure_datetime"),
    ("non_positive_duration", "duration", "duration_hrs <= 0"),
    ("negative_days_before_departure", "lead_time", "days_before_departure < 0"),
]

_ERRORS = ",\n      ".join(f"case when {p} then '{label}' end" for label, _, p in RULES)

LABELS = f"""
flags as (
  select *,
    coalesce(abs(total_fare_bdt - (base_fare_bdt + tax_surcharge_bdt)) <= 0.01, false) as reconciles_exactly,
    coalesce(abs(cast(total_fare_bdt as double) / nullif(cast(base_fare_bdt + tax_surcharge_bdt as double), 0)
                 - cast({KNOWN_FARE_UPLIFT_FACTOR!r} as double)) <= {UPLIFT_TOLERANCE!r}, false) as has_known_uplift
  from staged),
labelled as (
  select *, validation_errors is null as is_valid from (
    select *, nullif(concat_ws(';',
      {_ERRORS}), '') as validation_errors
    from flags))"""

FACT = f"""
valid as (select * from labelled where is_valid),
enriched as (
  select l_orderkey, l_linenumber,
    {_strip('airline')} as airline,
    {_code('source')} as source,
    {_strip('source_name')} as source_name,
    {_code('destination')} as destination,
    {_strip('destination_name')} as destination_name,
    departure_datetime, arrival_datetime, duration_hrs,
    {_strip('stopovers')} as stopovers,
    {_strip('aircraft_type')} as aircraft_type,
    {_strip('flight_class')} as flight_class,
    {_strip('booking_source')} as booking_source,
    base_fare_bdt, tax_surcharge_bdt,
    coalesce(total_fare_bdt, try_cast(base_fare_bdt + tax_surcharge_bdt as decimal(14,4))) as total_fare_bdt,
    {_strip('seasonality')} as seasonality,
    days_before_departure,
    {_code('source')} || '-' || {_code('destination')} as route,
    coalesce({_strip('seasonality')} in ({_PEAK}), false) as is_peak_season,
    coalesce(has_known_uplift, false) as has_fare_uplift,
    _source_file
  from valid),
fact as (select {', '.join(FACT_COLUMNS)} from enriched)"""

PREFIX = "with " + MAPPING.strip() + ",\n" + LABELS.strip() + ",\n" + FACT.strip() + "\n"

D = "cast({} as double)".format


def _kpi_average_fare() -> str:
    return f"""select airline,
  {_re(_mean('base_fare_bdt'), 4)} as average_base_fare,
  {_re(_mean('tax_surcharge_bdt'), 4)} as average_tax_charge,
  {_re(_mean('total_fare_bdt'), 4)} as average_total_fare,
  cast(min(total_fare_bdt) as double) as min_total_fare,
  cast(max(total_fare_bdt) as double) as max_total_fare,
  count(*) as flight_count
from fact where airline is not null group by airline"""


def _kpi_seasonal() -> str:
    pct = "(mean_total - baseline) / baseline * 100"
    return f"""select seasonality, coalesce(is_peak, false) as is_peak_season,
  {_re('mean_total', 4)} as average_total_fare, flight_count,
  {_re(pct, 2)} as variation_vs_baseline_pct
from (select seasonality, bool_or(is_peak_season) as is_peak, {_mean('total_fare_bdt')} as mean_total,
             count(*) as flight_count
      from fact where seasonality is not null group by seasonality) s
cross join (select max(case when seasonality = '{BASELINE_SEASON}' then mean_total end) as baseline
            from (select seasonality, {_mean('total_fare_bdt')} as mean_total
                  from fact where seasonality is not null group by seasonality)) b"""


def _kpi_booking() -> str:
    share = "cast(booking_count as double) / nullif(total, 0) * 100"
    return f"""select airline, booking_count, {_re(share, 2)} as booking_share_pct
from (select airline, count(*) as booking_count from fact where airline is not null group by airline) c
cross join (select sum(n) as total from (select count(*) as n from fact where airline is not null group by airline)) t"""


def _kpi_routes(n: int) -> str:
    return f"""select route, source, destination, booking_count, {_re('mean_total', 4)} as average_total_fare,
  cast(row_number() over (order by booking_count desc, route, source, destination) as integer) as rank_position
from (select route, source, destination, count(*) as booking_count, {_mean('total_fare_bdt')} as mean_total
      from fact where route is not null and source is not null and destination is not null
      group by route, source, destination) r
order by booking_count desc, route, source, destination limit {n}"""


def _lineage(cols: list[str], frame: str, where: str = "") -> str:
    return f"select l_orderkey, l_linenumber, {', '.join(cols)} from {frame} {where}"


_FARE_D = {c: D(c) + f" as {c}" for c in ("base_fare_bdt", "tax_surcharge_bdt", "total_fare_bdt")}
_STAGED_COLS = ["airline", "source", "source_name", "destination", "destination_name",
                "departure_datetime", "arrival_datetime", "duration_hrs", "stopovers",
                "aircraft_type", "flight_class", "booking_source", "base_fare_bdt",
                "tax_surcharge_bdt", "total_fare_bdt", "seasonality", "days_before_departure"]


def _d(cols: list[str]) -> list[str]:
    return [_FARE_D.get(c, c) for c in cols]


def _rule_family(family: str) -> str:
    parts = [f"select l_orderkey, l_linenumber, '{label}' as rule from flags where {p}"
             for label, fam, p in RULES if fam == family]
    return "\nunion all\n".join(parts)


def _rule_counts() -> str:
    parts = [f"select cast({i + 1} as integer) as rule_order, '{label}' as rule, "
             f"count(*) filter (where {p}) as rows from flags"
             for i, (label, _, p) in enumerate(RULES)]
    return "\nunion all\n".join(parts)


def _quality_report() -> str:
    counts = _rule_counts()
    return f"""select total_rows, valid_rows, total_rows - valid_rows as invalid_rows,
  {_re('cast(valid_rows as double) / total_rows', 6)} as valid_ratio,
  failed_checks, rows_with_known_fare_uplift,
  cast({KNOWN_FARE_UPLIFT_FACTOR!r} as double) as fare_uplift_factor,
  cast({MIN_VALID_ROW_RATIO!r} as double) as min_valid_ratio_required
from (select count(*) as total_rows, count(*) filter (where is_valid) as valid_rows,
             count(*) filter (where has_known_uplift) as rows_with_known_fare_uplift from labelled) a
cross join (select '{{' || coalesce(string_agg('"' || rule || '":' || cast(rows as varchar), ',' order by rule_order)
                                 filter (where rows > 0), '') || '}}' as failed_checks
            from ({counts}) rc) f"""


def _flagged_rows() -> str:
    cols = ["l_orderkey", "l_linenumber", "airline", "source", "destination", "base_fare_bdt",
            "tax_surcharge_bdt", "total_fare_bdt", "validation_errors"]
    order = ", ".join(f"{c} asc nulls first" for c in cols)
    return f"""select * from (select {', '.join(_d(cols))} from labelled where not is_valid) x
order by {order} limit 100"""


def _fare_cases() -> str:
    comp = "(base_fare_bdt + tax_surcharge_bdt)"
    case = f"""case when abs(total_fare_bdt - {comp}) <= 0.01 then 'reconciles exactly'
     when {comp} <> 0 and abs(cast(total_fare_bdt as double) / cast({comp} as double) - cast(1.2 as double)) <= 0.000001
       then 'known 1.20x uplift'
     else 'unexplained mismatch' end"""
    return f"""select fare_case, rows_affected, {_r2('cast(rows_affected as double) * 100.0 / table_rows')} as pct_of_table
from (select {case} as fare_case, count(*) as rows_affected from labelled group by 1) c
cross join (select count(*) as table_rows from labelled) t"""


_LENGTHS = {"airline": 100, "source": 10, "source_name": 255, "destination": 10, "destination_name": 255, "stopovers": 50, "aircraft_type": 100,
            "flight_class": 50, "booking_source": 50, "seasonality": 50, "_source_file": 255}


def _declared_lengths() -> str:
    return "\nunion all\n".join(
        f"select '{c}' as column_name, cast({n} as bigint) as declared, max(length({c})) as longest, count(*) filter (where length({c}) > {n}) as overlong from labelled"
        for c, n in _LENGTHS.items())


def _null_counts() -> str:
    cols = ("airline", "source", "destination", "base_fare_bdt", "tax_surcharge_bdt", "total_fare_bdt")
    return "\nunion all\n".join(
        f"select '{c}' as column_name, count(*) filter (where {c} is null) as null_rows from labelled" for c in cols)


def _uplift_effect() -> str:
    all_m, excl = _mean("total_fare_bdt"), _mean("total_fare_bdt", "not has_fare_uplift")
    return f"""select airline, count(*) as total_flights, count(*) filter (where has_fare_uplift) as uplift_flights,
  {_r2(all_m)} as avg_fare_all, {_r2(excl)} as avg_fare_excluding_uplift,
  {_r2(f'{all_m} - {excl}')} as uplift_effect_bdt
from fact group by airline"""


def _peak_premium() -> str:
    peak, off = _mean("total_fare_bdt", "is_peak_season"), _mean("total_fare_bdt", "not is_peak_season")
    prem = f"({peak} - {off}) * 100 / nullif({off}, 0)"
    return f"""select airline, {_r2(peak)} as avg_peak_fare, {_r2(off)} as avg_offpeak_fare,
  {_r2(prem)} as peak_premium_pct
from fact group by airline having count(*) filter (where is_peak_season) > 0"""


def _simple(group: str, alias: str, where: str = "") -> str:
    return f"""select {group} as {alias}, count(*) as flights, {_r2(_mean('total_fare_bdt'))} as avg_total_fare
from fact {where} group by 1"""


def _lead_time() -> str:
    case = """case when days_before_departure <= 7 then '1. 0-7 days'
     when days_before_departure <= 14 then '2. 8-14 days'
     when days_before_departure <= 30 then '3. 15-30 days'
     when days_before_departure <= 60 then '4. 31-60 days'
     else '5. 61+ days' end"""
    return _simple(case, "lead_time_bucket", "where days_before_departure is not null")


def _route_spread() -> str:
    return f"""select route, count(*) as bookings,
  cast(round(min(total_fare_bdt), 2) as double) as cheapest,
  {_r2(_mean('total_fare_bdt'))} as average,
  cast(round(max(total_fare_bdt), 2) as double) as dearest,
  count(distinct airline) as airlines_serving
from fact group by route order by bookings desc, route asc nulls first limit 20"""


def _route_airline_spread() -> str:
    return f"""select route, airlines_serving, {_r2('lo')} as cheapest_airline_avg, {_r2('hi')} as dearest_airline_avg,
  {_r2('hi - lo')} as spread_bdt
from (select route, count(airline) as airlines_serving, min(airline_avg) as lo, max(airline_avg) as hi
      from (select route, airline, {_mean('total_fare_bdt')} as airline_avg from fact group by route, airline) p
      group by route having count(airline) > 1) s
order by spread_bdt desc nulls first, route asc nulls first limit 20"""


def _reconciliation() -> str:
    return """select 'fact rows' as metric, cast(count(*) as varchar) as value from fact
union all select 'sum of KPI bookings', cast(sum(n) as varchar) from (select count(*) as n from fact where airline is not null group by airline)
union all select 'sum of KPI flights', cast(sum(n) as varchar) from (select count(*) as n from fact where airline is not null group by airline)
union all select 'distinct fact airlines', cast(count(distinct airline) as varchar) from fact
union all select 'KPI airline rows', cast(count(*) as varchar) from (select airline from fact where airline is not null group by airline)"""


def _row_counts() -> str:
    kpi = {
        "kpi_average_fare_by_airline": _kpi_average_fare(),
        "kpi_seasonal_fare_variation": _kpi_seasonal(),
        "kpi_booking_count_by_airline": _kpi_booking(),
        "kpi_popular_routes": _kpi_routes(20),
    }
    parts = ["select 'flight_prices' as table_name, count(*) as rows from fact"]
    parts += [f"select '{t}', count(*) from ({q}) k" for t, q in kpi.items()]
    return "\nunion all\n".join(parts)


def _compute_all() -> str:
    parts = (("kpi_average_fare_by_airline", _kpi_average_fare(), "airline", "flight_count", "average_total_fare", "max_total_fare"),
             ("kpi_seasonal_fare_variation", _kpi_seasonal(), "seasonality", "flight_count", "average_total_fare", "variation_vs_baseline_pct"),
             ("kpi_booking_count_by_airline", _kpi_booking(), "airline", "booking_count", "cast(null as double)", "booking_share_pct"),
             ("kpi_popular_routes", _kpi_routes(20), "route", "booking_count", "average_total_fare", "cast(rank_position as double)"))
    return "\nunion all\n".join(
        f"select '{t}' as kpi, {name} as name, cast({n} as bigint) as rows_counted, {mean} as average_total_fare, {own} as figure from ({q}) k" for t, q, name, n, mean, own in parts)


# The same rows with the defects that only text can have, typed again.
_RAW = {"base_fare_bdt": "case d when 41 then 'abc' when 42 then '1.0d' end", "tax_surcharge_bdt": "case d when 44 then '12,5' end",
        "total_fare_bdt": "case d when 45 then 'x1' end", "duration_hrs": "case d when 46 then '1.5f' end"}
_TEXT_VALUE = {
    "airline": "case d when 55 then null else airline end",
    "departure_datetime": "case d when 53 then null when 54 then date_trunc('minute', departure_datetime) else departure_datetime end",
    "duration_hrs": "case when d in (46, 47) then null else duration_hrs end",
    "base_fare_bdt": "case when d in (41, 42) then null else base_fare_bdt end",
    "tax_surcharge_bdt": "case when d in (43, 44) then null else tax_surcharge_bdt end",
    "total_fare_bdt": "case when d = 45 then null else total_fare_bdt end",
    "seasonality": "case d when 48 then null when 49 then ' null ' else seasonality end",
    "days_before_departure": "cast(case d when 50 then -3 when 51 then 14 when 52 then null when 57 then 10 else days_before_departure end as integer)",
}
TEXT_STAGED = ("select l_orderkey, l_linenumber, " + ", ".join(f"{_TEXT_VALUE.get(c, c)} as {c}" for c in _STAGED_COLS)
               + ", " + ", ".join(f"{raw} as _raw_{c}" for c, raw in _RAW.items()) + " from (select *, l_orderkey % 1009 as d from staged)")
TEXT_FLAGS = f"""select *,
    coalesce(abs(total_fare_bdt - (base_fare_bdt + tax_surcharge_bdt)) <= 0.01, false) as reconciles_exactly,
    coalesce(abs(cast(total_fare_bdt as double) / nullif(cast(base_fare_bdt + tax_surcharge_bdt as double), 0)
                 - cast(1.2 as double)) <= {UPLIFT_TOLERANCE!r}, false) as has_known_uplift
  from ({TEXT_STAGED}) t"""
_NULL_RULES = [(label, fam, f"({p}{f' and _raw_{label[5:]} is null' if label[5:] in _RAW else ''})") for label, fam, p in RULES if fam == "null"]
TEXT_RULES = [*_NULL_RULES, *[(f"non_numeric_{c}", "non_numeric", f"_raw_{c} is not null") for c in _RAW], *[r for r in RULES if r[1] != "null"]]


def _text_rule_labels() -> str:
    errors = ", ".join(f"case when {p} then '{label}' end" for label, _, p in TEXT_RULES)
    return f"""select l_orderkey, l_linenumber, validation_errors is null as is_valid, validation_errors
from (select l_orderkey, l_linenumber, nullif(concat_ws(';', {errors}), '') as validation_errors from ({TEXT_FLAGS}) f) x"""


def _text_rule_counts() -> str:
    return "\nunion all\n".join(
        f"select cast({i + 1} as integer) as rule_order, '{label}' as rule, count(*) filter (where {p}) as rows from ({TEXT_FLAGS}) f"
        for i, (label, _, p) in enumerate(TEXT_RULES))


def _rule_non_numeric() -> str:
    return "\nunion all\n".join(f"select l_orderkey, l_linenumber, '{label}' as rule from ({TEXT_FLAGS}) f where {p}"
                                for label, fam, p in TEXT_RULES if fam == "non_numeric")


BODIES: dict[str, str] = {
    "na_spellings": f"""select l_orderkey, l_linenumber, airline, seasonality, tax_surcharge_bdt is null and _raw_tax_surcharge_bdt is null as no_tax,
  duration_hrs is null and _raw_duration_hrs is null as no_duration from ({TEXT_STAGED}) t""",
    "text_staged": "select " + ", ".join(["l_orderkey", "l_linenumber", *_d(_STAGED_COLS), *[f"_raw_{c}" for c in _RAW]]) + f" from ({TEXT_STAGED}) t",
    "text_rule_labels": _text_rule_labels(),
    "text_rule_counts": _text_rule_counts(),
    "rule_non_numeric": _rule_non_numeric(),
    "valid_rows": _lineage(_d(_STAGED_COLS) + ["_source_file"], "valid"),
    "provenance": "select _source_file, count(*) as rows_loaded from labelled group by _source_file",
    "row_ids": "select row_number() over (order by l_orderkey, l_linenumber) as id, l_orderkey, l_linenumber from labelled",
    "labels_written_back": _lineage(["is_valid", "validation_errors"], "labelled"),
    "declared_lengths": _declared_lengths(),
    "rule_labels": _lineage(["is_valid", "validation_errors"], "labelled"),
    "invalid_rows": _lineage(["validation_errors"], "labelled", "where not is_valid"),
    "fare_flags": _lineage(["reconciles_exactly", "has_known_uplift"], "labelled"),
    "rule_counts": _rule_counts(),
    "quality_report": _quality_report(),
    **{f"rule_{fam}": _rule_family(fam) for fam in
       ("null", "negative", "blank", "malformed_code", "same_endpoints", "fare_mismatch",
        "arrival_order", "duration", "lead_time")},
    "clean_text": _lineage(["airline", "source_name", "destination_name", "stopovers", "aircraft_type",
                            "flight_class", "booking_source", "seasonality"], "enriched"),
    "clean_codes": _lineage(["source", "destination"], "enriched"),
    "reconcile_total": _lineage(
        ["cast(coalesce(total_fare_bdt, try_cast(base_fare_bdt + tax_surcharge_bdt as decimal(14,4))) as double)"
         " as total_fare_bdt"], "staged"),
    "enrich_route": _lineage(["route"], "enriched"),
    "enrich_peak": _lineage(["seasonality", "is_peak_season"], "enriched"),
    "enrich_uplift": _lineage(["has_fare_uplift"], "enriched"),
    "unknown_seasons": f"""select distinct {_strip('seasonality')} as seasonality from valid
where {_strip('seasonality')} is not null and {_strip('seasonality')} not in ({_PEAK}, '{BASELINE_SEASON}')""",
    "fact_table": "select " + ", ".join(_d(list(FACT_COLUMNS))) + " from fact",
    "kpi_average_fare": _kpi_average_fare(),
    "kpi_seasonal_variation": _kpi_seasonal(),
    "kpi_booking_count": _kpi_booking(),
    "kpi_popular_routes": _kpi_routes(20),
    "kpi_popular_routes_top5": _kpi_routes(5),
    "staging_verdict": f"""select count(*) as total_rows, count(*) filter (where is_valid) as valid_rows,
  count(*) filter (where not is_valid) as invalid_rows, count(*) filter (where is_valid is null) as unlabelled_rows,
  {_r2('cast(count(*) filter (where is_valid) as double) * 100.0 / count(*)')} as valid_pct
from labelled""",
    "failure_signatures": """select validation_errors, count(*) as rows_affected from labelled
where not is_valid group by validation_errors""",
    "flagged_rows": _flagged_rows(),
    "fare_cases": _fare_cases(),
    "null_counts": _null_counts(),
    "source_codes": "select source as code, count(*) as rows_affected from labelled group by source",
    "airline_validity": """select airline, count(*) as total_rows, count(*) filter (where not is_valid) as invalid_rows
from labelled group by airline having count(*) filter (where not is_valid) > 0""",
    "uplift_effect": _uplift_effect(),
    "uplift_ratio": """select count(*) as uplift_rows,
  min(cast(total_fare_bdt as double) / cast(base_fare_bdt + tax_surcharge_bdt as double)) as min_ratio,
  max(cast(total_fare_bdt as double) / cast(base_fare_bdt + tax_surcharge_bdt as double)) as max_ratio
from fact where has_fare_uplift and base_fare_bdt + tax_surcharge_bdt <> 0""",
    "peak_vs_offpeak": f"""select is_peak_season, count(*) as flights,
  {_r2(_mean('total_fare_bdt'))} as avg_total_fare, {_r2(_mean('base_fare_bdt'))} as avg_base_fare,
  {_r2(_mean('tax_surcharge_bdt'))} as avg_tax_surcharge
from fact group by is_peak_season""",
    "peak_premium": _peak_premium(),
    "monthly_trend": _simple("cast(date_trunc('month', departure_datetime) as date)", "departure_month",
                             "where departure_datetime is not null"),
    "lead_time": _lead_time(),
    "airline_class": f"""select airline, flight_class, count(*) as flights, {_r2(_mean('total_fare_bdt'))} as avg_total_fare
from fact group by airline, flight_class""",
    "tax_share": f"""select flight_class, count(*) as flights,
  count(*) filter (where tax_surcharge_bdt = {TAX_FLOOR_BDT}) as at_tax_floor,
  {_r2('avg(100 * cast(tax_surcharge_bdt as double) / nullif(cast(total_fare_bdt as double), 0))')} as avg_tax_pct_of_total
from fact group by flight_class""",
    "route_spread": _route_spread(),
    "route_airline_spread": _route_airline_spread(),
    "stopovers": f"""select stopovers, count(*) as flights, {_r2('avg(duration_hrs)')} as avg_duration_hrs,
  {_r2(_mean('total_fare_bdt'))} as avg_total_fare
from fact group by stopovers""",
    "fact_provenance": """select _source_file, count(*) as rows_loaded, count(distinct airline) as airlines,
  count(distinct route) as routes, count(*) filter (where has_fare_uplift) as uplift_rows
from fact group by _source_file""",
    "reconciliation": _reconciliation(),
    "row_counts": _row_counts(),
    "compute_all": _compute_all(),
    "fact_summary": """select f.*, s.staged_rows, s.excluded_invalid_rows from
(select count(*) as fact_rows_loaded, count(*) filter (where has_fare_uplift) as rows_with_fare_uplift,
        count(distinct airline) as distinct_airlines, count(distinct route) as distinct_routes from fact) f
cross join (select count(*) as staged_rows, count(*) filter (where not is_valid) as excluded_invalid_rows
            from labelled) s""",
}


def oracle_sql() -> dict[str, str]:
    return {k: PREFIX + body for k, body in BODIES.items()}
