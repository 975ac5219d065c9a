"""The pipeline's queries in DuckDB's SQL."""

from __future__ import annotations

from registra.functions.geo import EARTH_KM
from registra.functions.text import FOLD_FROM, FOLD_LONGER, FOLD_TO, POSTAL_SHAPE, ranges
from registra.plans.reference import END, ENDED, NOW, RULES, SINCE, START, STATES, STREAMLINED, UNTIL
from registra.plans.register_sql import DECIMAL, ISO, RECORD_COLUMNS, whole
from registra.schema import ADDRESS, COLUMNS

_BLANK = r"[\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_SEQ = "issued_date nulls first, licence_number nulls first, coalesce(licence_revision_number, -1), licence_rsn"


def _day(c: str) -> str:
    return f"cast(({c} at time zone 'UTC') as date)"


def _sec(c: str) -> str:
    return f"cast(floor(epoch({c})) as bigint)"


def _num(c: str) -> str:
    return f"(case when regexp_matches({c}, '{DECIMAL}') then try_cast(trim({c}, ' \t\n\r') as double) end)"


def _ts(c: str) -> str:
    return (
        f"(case when regexp_matches(trim({c}), '{ISO}') then try_cast(trim({c}) as timestamptz) "
        f"when regexp_matches(trim({c}), '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') then try_cast(trim({c}) || 'T00:00:00Z' as timestamptz) end)"
    )


def _century(c: str) -> str:
    return f"(case when {c} < 80 then {c} + 2000 when {c} < 100 then {c} + 1900 else {c} end)"


def _rounded(c: str, digits: int) -> str:
    return f"round_even(({c}) * {10.0**digits}, 0) / {10.0**digits}"


def _squeeze(c: str) -> str:
    return f"nullif(trim(regexp_replace({c}, '{_BLANK}', ' ', 'g')), '')"


def _upper(c: str) -> str:
    for k, v in {"ß": "ss", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}.items():
        c = f"replace({c}, '{k}', '{v}')"
    return f"upper({c})"


def _plain_key(c: str) -> str:
    return _squeeze(f"regexp_replace({_upper(c)}, '[^A-Z0-9 ]', '', 'g')")


_LONGER = "MAP {" + ", ".join(f"'{k}': '{v.replace(chr(39), chr(39) * 2)}'" for k, v in FOLD_LONGER.items()) + "}"


def _fold(c: str) -> str:
    wide = f"(case when regexp_matches({c}, '[{ranges(''.join(FOLD_LONGER))}]') then array_to_string(list_transform(string_split({c}, ''), lambda x: coalesce({_LONGER}[x], x)), '') else {c} end)"
    return f"(case when regexp_matches({c}, '^[\\x00-\\x7f]*$') then {c} else regexp_replace(translate({wide}, '{FOLD_FROM}', '{FOLD_TO.replace(chr(39), chr(39) * 2)}'), '[^\\x00-\\x7f]', '', 'g') end)"


def _spaced_key(c: str) -> str:
    return _squeeze(f"regexp_replace(upper({_fold(c)}), '[^A-Z0-9 ]', ' ', 'g')")


def _title(c: str) -> str:
    return f"array_to_string(list_transform(regexp_extract_all({c}, '(\\p{{L}}+|[^\\p{{L}}]+)', 1), lambda t: upper(t[1]) || lower(t[2:])), '')"


def _postal(c: str) -> str:
    k = f"nullif(regexp_replace(upper({c}), '[^A-Z0-9]', '', 'g'), '')"
    return f"(case when length({k}) = 6 then {k}[1:3] || ' ' || {k}[4:6] else {k} end)"


def _md5_key(c: str) -> str:
    return f"('0x' || substr(md5({c}), 1, 15))::bigint"


def _natural(columns: list[str]) -> str:
    return "concat_ws(chr(31), " + ", ".join(f"coalesce(trim({c}), '')" for c in columns) + ")"


def _typed(c: str, kind: str) -> str:
    return {"bigint": f"try_cast(round_even({_num(c)}, 0) as bigint)", "double": _num(c), "timestamp": _ts(c), "date": _day(_ts(c))}.get(kind, c)


def _select() -> str:
    out = []
    for raw, (to, kind) in COLUMNS.items():
        value = _typed(raw, kind)
        out.append(f"{_century(value) if to == 'folder_year' else value} as {to}")
    return ", ".join(out)


TYPED = f"typed as (select record_no, {_select()}, geom, geo_point_2d from records)"


def _json(c: str, path: str) -> str:
    return f"json_extract_string(case when json_valid({c}) then {c} end, '{path}')"


_TEXT = r"^\s*([+-]?\d+(?:\.\d+)?)\s*,\s*([+-]?\d+(?:\.\d+)?)\s*$"


def _spot(source: str, i: int) -> str:
    if source == "o":
        return _num(_json("geo_point_2d", ("$.lat", "$.lon")[i]))
    if source == "t":
        return _num(f"nullif(regexp_extract(geo_point_2d, '{_TEXT}', {i + 1}), '')")
    at = 1 - i
    return _num(f"case when {_json('geom', '$.geometry')} is not null then {_json('geom', f'$.geometry.coordinates[{at}]')} else {_json('geom', f'$.coordinates[{at}]')} end")


SPOTS = "spots as (select *, " + ", ".join(f"{_spot(s, i)} as {s}{i}" for s in "otg" for i in (0, 1)) + " from {0})"
_HAS = {s: f"({s}0 is not null and {s}1 is not null)" for s in "otg"}


def _pick(i: int) -> str:
    return "case " + " ".join(f"when {_HAS[s]} then {s}{i}" for s in "otg") + " end"


_STD = {c: _squeeze(c) for c in RULES.kept_case} | {c: _title(_squeeze(c)) for c in RULES.title_case} | {c: f"upper({_squeeze(c)})" for c in RULES.upper_case} | {"postal_code": _postal("postal_code")}
CHECKED = f"""{TYPED}, {SPOTS.replace("{0}", "typed")},
std as (select record_no, {", ".join(f"{_STD.get(to, to)} as {to}" for to, _ in COLUMNS.values())}, {_pick(0)} as latitude, {_pick(1)} as longitude from spots),
chk as (select *, regexp_matches(postal_code, '{POSTAL_SHAPE}') as postal_code_valid, {_plain_key("business_name")} as business_name_key, latitude is not null as has_coordinates from std),
flagged as (select *, nullif(concat_ws(';',
  case when issued_date > timestamptz '{NOW}+00' then 'future_issued_date' end,
  case when expired_date < {_day("issued_date")} then 'expired_before_issued' end,
  case when status not in ({", ".join(f"'{s}'" for s in RULES.known_status)}) then 'unknown_status' end,
  case when not postal_code_valid then 'postal_code_not_canadian' end,
  case when not (latitude between -90 and 90 and longitude between -180 and 180) then 'coordinates_out_of_bounds' end,
  case when licence_number is null then 'null_licence_number' end, case when status is null then 'null_status' end, case when folder_year is null then 'null_folder_year' end), '') as dq_flags from chk),
ranked as (select *, row_number() over (partition by licence_rsn order by {" + ".join(f"cast({c} is null as int)" for c in [to for to, _ in COLUMNS.values()] + ["postal_code_valid", "business_name_key", "latitude", "longitude", "has_coordinates", "dq_flags"])},
  extract_date desc nulls last, licence_revision_number desc nulls last, record_no) as rn from flagged)"""

_KEPT_OUT = ", ".join((_sec(to) if kind == "timestamp" else f"cast({to} as varchar)" if kind == "date" else to) + f" as {to}" for to, kind in COLUMNS.values())
_IN = "issued_date >= timestamptz '" + SINCE + " 00:00:00+00' and issued_date < timestamptz '" + UNTIL + " 00:00:00+00' + interval 1 day"

_IDENT = f"""ident as (select *, coalesce({_spaced_key("business_name")}, {_spaced_key("business_trade_name")}, licence_number) as business_identity_key,
  case when {_spaced_key("business_name")} is not null then 'legal_name' when {_spaced_key("business_trade_name")} is not null then 'trade_name' when licence_number is not null then 'licence_only' end as identity_source from curated_licence),
keyed as (select *, case when business_identity_key is null then -1 else {_md5_key(_natural(["business_identity_key"]))} end as business_key from ident)"""
_ADDR = f"case when house is null and street is null then -1 else {_md5_key(_natural(list(ADDRESS)))} end"


def _member(columns: list[str]) -> str:
    return f"case when {columns[0]} is null then -1 else {_md5_key(_natural(columns))} end"


def _flags(source: str, entity: str) -> str:
    return f"""flags as (select *, licence_number is not null and coalesce(licence_revision_number, -1) = max(coalesce(licence_revision_number, -1)) over (partition by licence_number) as is_current_revision,
  {entity} is not null and max(issued_date) over (partition by {entity} order by {_SEQ} rows between 1 following and unbounded following) is not null as has_later_licence,
  issued_date is not distinct from max(issued_date) over (partition by {entity}) as is_latest_licence from {source})"""


FLAGS = _flags("fact_licence", "business_sk")
CURRENT = f"{FLAGS}, cur as (select *, row_number() over (partition by business_sk order by {_SEQ}) as o from flags where is_current_revision and business_sk <> -1)"


def _last(c: str) -> str:
    return f"arg_max({c}, o) filter ({c} is not null)"


def _first(c: str) -> str:
    return f"arg_min({c}, o) filter ({c} is not null)"


def _floor(a: str, b: str) -> str:
    return f"cast(floor((epoch_us({a}) - epoch_us({b})) / 86400000000.0) as bigint)"


_SPAN = _floor("coalesce(max(expired_date), max(issued_date))", "min(issued_date)")
LIVES = f"""{CURRENT}, lives as (select business_sk, count(distinct licence_number) as licence_count, count(*) as record_count, min(issued_date) as first_issued, max(issued_date) as last_issued,
  max(expired_date) as last_expired, min(folder_year) as first_folder_year, max(folder_year) as last_folder_year,
  {", ".join(f"{_last(c)} as latest_{c}" for c in ("status", "category_sk", "neighbourhood_sk", "address_sk"))}, {_SPAN} as span_days, {_rounded(_SPAN + " / 365.25", 3)} as span_years from cur group by business_sk)"""
_KM = _rounded(f"2 * {EARTH_KM} * asin(sqrt(least(pow(sin(radians(b.latitude - a.latitude) / 2), 2) + cos(radians(a.latitude)) * cos(radians(b.latitude)) * pow(sin(radians(b.longitude - a.longitude) / 2), 2), 1.0)))", 3)
MOVES = f"""{CURRENT}, yr as (select business_sk, folder_year, count(distinct address_sk) as sites, {_first("address_sk")} as address_sk, {_first("neighbourhood_sk")} as neighbourhood_sk, {_first("licence_number")} as licence_number, min(issued_date) as changed_on
  from cur where address_sk <> -1 and folder_year is not null group by all),
one as (select * from yr where business_sk not in (select business_sk from yr where sites > 1)),
lg as (select *, {", ".join(f"lag({c}) over (partition by business_sk order by folder_year) as from_{c}" for c in ("folder_year", "address_sk", "neighbourhood_sk", "licence_number"))} from one),
moves as (select lg.business_sk, from_folder_year, folder_year as to_folder_year, from_address_sk, lg.address_sk as to_address_sk, from_licence_number, lg.licence_number as to_licence_number, changed_on,
  from_neighbourhood_sk, lg.neighbourhood_sk as to_neighbourhood_sk, from_neighbourhood_sk <> lg.neighbourhood_sk as crossed_neighbourhood, {_KM} as distance_km
  from lg left join dim_address a on a.address_sk = from_address_sk left join dim_address b on b.address_sk = lg.address_sk where from_address_sk is not null and from_address_sk <> lg.address_sk)"""
RENEW = f"""{CURRENT}, yr as (select business_sk, folder_year, count(distinct licence_number) as licences_held, min(issued_date) as renewed_on, max(expired_date) as expired, {_last("status")} as status_after from cur where folder_year is not null group by all),
lg as (select *, lag(folder_year) over w as from_folder_year, lag(renewed_on) over w as previous_first_issued, lag(expired) over w as previous_last_expired from yr window w as (partition by business_sk order by folder_year)),
g as (select *, {_floor("renewed_on", "previous_last_expired")} as gap_days, folder_year - from_folder_year as year_gap from lg where from_folder_year is not null)"""
TRANS = f"""tr as (select business_sk, status, issued_date, licence_number, {", ".join(f"lag({c}) over (partition by business_sk order by {_SEQ}) as p_{c}" for c in ("status", "issued_date", "licence_number"))} from fact_licence where business_sk <> -1),
moves as (select business_sk, p_status as from_status, status as to_status, {_sec("issued_date")} as effective_date, {_sec("p_issued_date")} as previous_date, p_licence_number as from_licence_number, licence_number as to_licence_number,
  case when licence_number = p_licence_number then 'revision' else 'renewal' end as transition_source, {_floor("issued_date", "p_issued_date")} as days_in_previous_status from tr where status is not null and p_status is not null and status <> p_status)"""
_ATTR = ("business_name", "status", "category_sk", "address_sk", "neighbourhood_sk")
_NULLED = {c: f"nullif({c}, -1)" if c.endswith("_sk") else c for c in _ATTR}
HIST = f"""day as (select business_sk, {_day("issued_date")} as d, extract_date, licence_rsn, {", ".join(f"{v} as {c}" for c, v in _NULLED.items())} from fact_licence where business_sk <> -1 and issued_date is not null),
one as (select * from day qualify row_number() over (partition by business_sk, d order by extract_date desc nulls last, licence_rsn desc nulls last) = 1),
seen as (select business_sk, d, {", ".join(f"last_value({c} ignore nulls) over w as {c}" for c in _ATTR)} from one window w as (partition by business_sk order by d rows between unbounded preceding and current row)),
pv as (select *, row_number() over w as n, {", ".join(f"lag({c}) over w as p_{c}" for c in _ATTR)} from seen window w as (partition by business_sk order by d)),
st as (select *, concat_ws(';', {", ".join(f"case when p_{c} is not null and {c} is distinct from p_{c} then '{c}' end" for c in _ATTR)}) as why from pv),
ver as (select * from st where n = 1 or why <> ''),
vv as (select *, lead(d) over (partition by business_sk order by d) as e from ver)"""
_YMD = "cast(strftime({}, '%Y%m%d') as bigint)"
_COL = {s: s.lower().replace(" ", "_") for s in STATES}
_DAYKEYS = f"""dk as (select *, coalesce(strftime({_day("issued_date")}, '%Y'), cast(folder_year as varchar), 'unknown') as year, coalesce(strftime({_day("issued_date")}, '%m'), 'unknown') as month, coalesce(strftime({_day("issued_date")}, '%Y-%m-%d'), 'no-issued-date') as issued_day from curated_licence)"""
_Y = _century(whole("folderyear"))
_PROBE = f"offered as (select {_Y} as partition, count(*) as row_count, max({_ts('extractdate')}) as watermark from records group by 1), held as (select folder_year as partition, count(*) as row_count, max(extract_date) as watermark from curated_licence group by 1)"
SQL = {
    "scan_project_rename": f"with {TYPED} select record_no, {_KEPT_OUT} from typed",
    "safe_cast_losses": " union all ".join(f"select '{to}' as column_name, count(*) filter ({raw} is not null and {_typed(raw, kind)} is null) as lost from records" for raw, (to, kind) in COLUMNS.items() if kind != "string"),
    "two_digit_year": f"select folderyear, count(*) as n, {_Y} as folder_year from records group by 1",
    "partition_discovery": f"select {_Y} as folder_year, count(*) as n from records group by 1 having folder_year >= 2025",
    "partition_probe": f"with {_PROBE} select partition, row_count, {_sec('watermark')} as watermark from offered",
    "needs_refresh": f"""with {_PROBE}, r as (select coalesce(a.partition, b.partition) as partition, case when b.row_count is null then 'new' when a.row_count is null then 'gone' when a.watermark is distinct from b.watermark then 'watermark' when a.row_count <> b.row_count then 'row_count' else 'current' end as reason
      from offered a full join held b on a.partition = b.partition) select *, reason in ('new', 'watermark', 'row_count') as refresh from r""",
    "partition_profile": f"with {TYPED} select folder_year as partition, count(*) as row_count, count(distinct licence_rsn) as distinct_keys, count(*) filter (issued_date is null) as undated, {_sec('min(extract_date)')} as watermark_min, {_sec('max(extract_date)')} as watermark_max, count(*) - count(distinct licence_rsn) as surplus_rows, "
    + ", ".join([f"round(avg(cast({c} is null as int)), 4) as null_rate_{c}" for c in ("licence_number", "postal_code", "fee_paid")] + [f"count(*) filter (status = '{s}') as rows_{s.lower().replace(' ', '_')}" for s in RULES.known_status])
    + " from typed group by 1",
    "null_rate_profile": " union all ".join(f"select '{c}' as column_name, round(avg(cast({c} is null as int)), 4) as null_rate from records" for c in RECORD_COLUMNS),
    "null_rate_drift": "select * from (" + " union all ".join(f"select '{c}' as column_name, round(avg(cast({c} is null as int)) filter (y = 2026), 4) as null_rate, round(avg(cast({c} is null as int)) filter (y = 2025), 4) as previous_rate from (select *, {_Y} as y from records)" for c in RECORD_COLUMNS) + ") where abs(null_rate - previous_rate) > 0.01",
    "volume_drift": f"with {_PROBE} select a.partition, a.row_count, b.row_count as previous_count, round((a.row_count - b.row_count) / b.row_count, 4) as change from offered a join offered b on a.partition = b.partition + 1 where (a.row_count - b.row_count) / b.row_count < -0.1",
    "value_histogram": "select status, count(*) as n from records group by 1",
    "topk_histogram": "select localarea, count(*) as n from records where localarea is not null group by 1 order by n desc, localarea limit 5",
    "json_props_extract": "select event_id, try_cast(json_extract_string(props, '$.k') as bigint) as k, event_type from events",
    "geo_point_parse": f"with {SPOTS.replace("{0}", "records")} select record_no, {_pick(0)} as latitude, {_pick(1)} as longitude from spots",
    "geo_precedence": f"with {SPOTS.replace("{0}", "records")} select case when {_HAS['o']} then 'object' when {_HAS['t']} then 'text' when {_HAS['g']} then 'geometry' else 'none' end as source, count(*) as n from spots group by 1",
    "coordinate_accounting": "with c as (select case when not isnan(latitude) then latitude end as lat, case when not isnan(longitude) then longitude end as lon from curated_licence) select count(*) filter (lat is not null and lon is not null) as with_coordinates, count(*) filter (lat is null or lon is null) as without_coordinates, "
    "count(*) filter (not (lat between -90 and 90 and lon between -180 and 180)) as off_earth, count(*) filter (not (lat between 48 and 60 and lon between -139.5 and -114)) as outside_region from c",
    "text_whitespace": f"select record_no, {_squeeze('businessname')} as business_name from records",
    "text_title_case": f"select distinct street, {_title(_squeeze('street'))} as titled from records",
    "text_name_key": f"select record_no, {_plain_key(_squeeze('businessname'))} as name_key from records",
    "identity_key": f"with {_IDENT} select licence_rsn, business_identity_key, identity_source, business_key from keyed",
    "postal_normalise": f"select distinct postalcode, {_postal('postalcode')} as postal_code, regexp_matches({_postal('postalcode')}, '{POSTAL_SHAPE}') as valid from records",
    "dq_flags": f"with {CHECKED} select record_no, dq_flags from flagged",
    "flag_explode_count": f"with {CHECKED} select unnest(string_split(dq_flags, ';')) as flag, count(*) as n from flagged where dq_flags is not null group by 1",
    "pk_dedupe_keep": f"with {CHECKED} select record_no, {_KEPT_OUT}, latitude, longitude, postal_code_valid, business_name_key, has_coordinates, dq_flags from ranked where licence_rsn is not null and rn = 1",
    "pk_dedupe_rejects": f"with {CHECKED} select record_no, licence_rsn, case when licence_rsn is null then 'null_licence_rsn' else 'duplicate_licence_rsn_lost_tiebreak' end as dq_reject_reason from ranked where licence_rsn is null or rn > 1",
    "duplicate_keys": f"with {TYPED} select licence_rsn, count(*) as copies from typed where licence_rsn is not null group by 1 having count(*) > 1",
    "transform_summary": f"""with {CHECKED}, kept as (select * from ranked where licence_rsn is not null and rn = 1) select 'curated' as measure, count(*) as n from kept union all select 'flagged', count(dq_flags) from kept
      union all select 'flag:' || f, count(*) from (select unnest(string_split(dq_flags, ';')) as f from kept where dq_flags is not null) group by 1
      union all select case when licence_rsn is null then 'reject:null_licence_rsn' else 'reject:duplicate_licence_rsn_lost_tiebreak' end, count(*) from ranked where licence_rsn is null or rn > 1 group by 1""",
    "transform_window": f"with {CHECKED} select licence_rsn, {_sec('issued_date')} as issued_date, business_name_key, postal_code, dq_flags from ranked where licence_rsn is not null and rn = 1 and {_IN}",
    "date_window": f"select licence_rsn, {_sec('issued_date')} as issued_date from curated_licence where coalesce({_IN}, true)",
    "period_overlap": f"select licence_rsn from curated_licence where (issued_date is null or {_day('issued_date')} <= date '{END}') and (expired_date is null or expired_date >= date '{START}')",
    "dim_business": f"""with {_IDENT}, o as (select *, row_number() over (partition by business_key order by {_SEQ}) as o from keyed)
      select business_key, {", ".join(f"{_last(c)} as {c}" for c in ("business_identity_key", "business_name", "business_trade_name", "identity_source"))}, count(*) as licence_count, count(distinct business_name) as name_variant_count,
      strftime(min({_day("issued_date")}), '%Y-%m-%d') as first_issued, strftime(max({_day("issued_date")}), '%Y-%m-%d') as last_issued, min(folder_year) as first_folder_year, max(folder_year) as last_folder_year,
      case {_last("identity_source")} when 'legal_name' then 'medium' when 'trade_name' then 'low' when 'licence_only' then 'none' end as identity_confidence from o group by business_key""",
    "dim_address": f"""with k as (select *, {_ADDR} as address_key from curated_licence), f as (select * from k where address_key <> -1 qualify row_number() over (partition by address_key order by {_SEQ}) = 1)
      select address_key, {", ".join(ADDRESS)}, latitude, longitude, false as is_unknown from f union all select -1, {", ".join(["null"] * 10)}, true""",
    "dim_neighbourhood": f"select distinct {_md5_key(_natural(['local_area']))} as area_key, local_area from curated_licence where local_area is not null union all select -1, 'Unknown'",
    "dim_category": f"""select {_md5_key(_natural(["business_type", "business_subtype"]))} as category_key, business_type, business_subtype, bool_or(coalesce({_day("issued_date")} < date '{STREAMLINED}', false)) as seen_before
      from curated_licence where business_type is not null group by business_type, business_subtype union all select -1, 'Unknown', 'Unknown', false""",
    "dim_status": f"select distinct {_md5_key(_natural(['status']))} as status_key, status from curated_licence where status is not null union all select -1, 'Unknown'",
    "dim_date": f"""with e as (select least(min({_day("issued_date")}), min(expired_date), min({_day("extract_date")})) as a, greatest(max({_day("issued_date")}), max(expired_date), max({_day("extract_date")})) as b from curated_licence),
      d as (select cast(unnest(generate_series(a, b, interval 1 day)) as date) as d from e)
      select {_YMD.format("d")} as date_key, strftime(d, '%Y-%m-%d') as full_date, year(d) as year, quarter(d) as quarter, month(d) as month, monthname(d) as month_name, day(d) as day_of_month, d = last_day(d) as is_month_end, month(d) = 12 and day(d) = 31 as is_year_end from d""",
    "blake_keys": "select 'status' as dimension, status as member, status_sk as member_key from dim_status where status in (select status from curated_licence) union all select 'area', local_area, neighbourhood_sk from dim_neighbourhood where local_area in (select local_area from curated_licence)",
    "fact_licence": f"""with {_IDENT}, {_flags("keyed", "business_key")} select licence_rsn, business_key, {_ADDR} as address_key, {_member(["local_area"])} as area_key, {_member(["business_type", "business_subtype"])} as category_key, {_member(["status"])} as status_key,
      coalesce({_YMD.format(_day("issued_date"))}, -1) as issued_key, coalesce({_YMD.format("expired_date")}, -1) as expired_key, fee_paid, number_of_employees, is_current_revision, has_later_licence, is_latest_licence from flags""",
    "current_revision": f"with {FLAGS} select licence_rsn, licence_number from flags where is_current_revision",
    "has_later": f"with {FLAGS} select licence_rsn, has_later_licence, is_latest_licence from flags",
    "latest_record": f"select business_sk, licence_rsn from fact_licence where business_sk <> -1 qualify row_number() over (partition by business_sk order by issued_date desc nulls last, licence_number desc nulls last, coalesce(licence_revision_number, -1) desc, licence_rsn desc) = 1",
    "business_lifecycle": f"with {LIVES} select business_sk, licence_count, record_count, {_sec('first_issued')} as first_issued, {_sec('last_issued')} as last_issued, {_sec('last_expired')} as last_expired, first_folder_year, last_folder_year, latest_status, latest_category_sk, latest_neighbourhood_sk, latest_address_sk, span_days, span_years from lives",
    "address_change": f"with {MOVES} select * replace ({_sec('changed_on')} as changed_on) from moves",
    "haversine": f"with b as (select 49.25 as latitude, -123.1 as longitude) select a.address_sk, {_KM} as km from dim_address a, b where a.latitude is not null and not isnan(a.latitude)",
    "business_history": f"""with sq as (select *, row_number() over w as o, {", ".join(f"lag({c}) over w as p_{c}" for c in _ATTR)} from fact_licence where business_sk <> -1 window w as (partition by business_sk order by {_SEQ})),
      fl as (select *, concat_ws(';', {", ".join(f"case when {c} <> p_{c} then '{c}' end" for c in _ATTR)}) as why from sq),
      sp as (select *, sum(case when o = 1 or why <> '' then 1 else 0 end) over (partition by business_sk order by o rows unbounded preceding) as span from fl),
      g as (select business_sk, span, min(issued_date) as valid_from, {", ".join(f"arg_min({c}, o) filter ({c} is not null) as {c}" for c in (*_ATTR, "licence_number"))}, coalesce(nullif(arg_min(why, o), ''), 'initial') as change_reason, count(*) as record_count from sp group by all),
      n as (select *, coalesce(lead(valid_from) over (partition by business_sk order by span), timestamptz '9999-12-31 00:00:00+00') as valid_to from g)
      select * exclude (span) replace ({_sec("valid_from")} as valid_from, {_sec("valid_to")} as valid_to), valid_to = timestamptz '9999-12-31 00:00:00+00' as is_current from n""",
    "as_was_join": f"with {HIST} select day.licence_rsn, day.business_sk, vv.status as as_was_status, vv.category_sk as as_was_category_sk from day join vv on day.business_sk = vv.business_sk and day.d >= vv.d and (vv.e is null or day.d < vv.e)",
    "status_transition": f"with {TRANS} select * from moves",
    "top_transitions": f"with {TRANS} select from_status, to_status, count(*) as n from moves group by all order by n desc, from_status, to_status limit 5",
    "renewal": f"""with {RENEW} select business_sk, from_folder_year, folder_year as to_folder_year, {_sec("previous_first_issued")} as previous_first_issued, {_sec("previous_last_expired")} as previous_last_expired, {_sec("renewed_on")} as renewed_on, licences_held, status_after, gap_days, year_gap,
      coalesce(gap_days <= 0, false) as renewed_before_expiry, coalesce(gap_days > 0, false) as lapsed_then_renewed, year_gap > 1 as skipped_a_year from g""",
    "mart_neighbourhood": f"""with {FLAGS}, r as (select * from flags where is_current_revision and business_sk <> -1 and (issued_date is null or {_day("issued_date")} <= date '{END}') and (expired_date is null or {_day("expired_date")} >= date '{START}')),
      w as (select neighbourhood_sk, {", ".join(f"count(distinct business_sk) filter (status = '{s}') as {n}" for s, n in _COL.items())}, count(distinct business_sk) filter (status is null or status not in ({", ".join(f"'{s}'" for s in STATES)})) as other from r group by 1),
      t as (select *, {" + ".join(_COL.values())} + other as total, {" + ".join(_COL[s] for s in ENDED)} as ended from w)
      select t.*, {_rounded("ended / nullif(total, 0)", 4)} as ended_rate, coalesce(local_area, 'Unknown') as local_area from t left join dim_neighbourhood using (neighbourhood_sk)""",
    "mart_lifespan": f"""with {LIVES}, m as (select latest_category_sk as category_sk, count(*) as business_count, {_rounded("avg(span_years)", 2)} as avg_years, {_rounded("median(span_years)", 2)} as median_years, min(span_years) as min_years, max(span_years) as max_years
      from lives where span_years is not null and span_days >= 0 and first_folder_year > (select min(folder_year) from fact_licence) group by 1) select m.*, business_type, business_subtype, 'observed' as cohort from m left join dim_category using (category_sk)""",
    "mart_address": f"""with {MOVES} select moves.* replace ({_sec("changed_on")} as changed_on), a.street as from_street, b.street as to_street, concat_ws(' ', a.unit_type, a.unit, a.house, a.street) as from_address, concat_ws(' ', b.unit_type, b.unit, b.house, b.street) as to_address, business_name, x.local_area as from_local_area, y.local_area as to_local_area from moves
      left join dim_address a on a.address_sk = from_address_sk left join dim_address b on b.address_sk = to_address_sk left join dim_neighbourhood x on x.neighbourhood_sk = from_neighbourhood_sk left join dim_neighbourhood y on y.neighbourhood_sk = to_neighbourhood_sk
      left join (select business_sk, arg_max(business_name, o) filter (business_name is not null) as business_name from (select *, row_number() over (partition by business_sk order by {_SEQ}) as o from fact_licence) group by 1) using (business_sk)""",
    "daily_partition_keys": f"with {_DAYKEYS} select year, month, issued_day, count(*) as n from dk group by all",
    "undated_routing": f"with {_DAYKEYS} select licence_rsn, year, month, issued_day from dk where issued_date is null",
    "reconcile_counts": f"with {_PROBE} select coalesce(a.partition, b.partition) as partition, a.row_count as offered, b.row_count as held, case when a.row_count is null or b.row_count is null then 'partial' when a.row_count = b.row_count then 'match' else 'MISMATCH' end as verdict from offered a full join held b on a.partition = b.partition",
    "fanout_guard": "select address_sk, count(*) as copies from dim_address group by 1 having count(*) > 1 union all select category_sk, count(*) from dim_category group by 1 having count(*) > 1",
    "anti_join_multi_site": "with r as (select * from fact_licence where business_sk <> -1 and address_sk <> -1 and folder_year is not null) select distinct business_sk from r where business_sk not in (select business_sk from r group by business_sk, folder_year having count(distinct address_sk) > 1)",
}
