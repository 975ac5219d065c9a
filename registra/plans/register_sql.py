"""The same in DuckDB's SQL."""

from __future__ import annotations

from registra.functions import text as T
from registra.plans.register import INSTANTS, NUMBERS, RECORD_RULES

_DAY = "cast(({} at time zone 'UTC') as date)"
_YMD = "cast(strftime({}, '%Y%m%d') as bigint)"
DECIMAL = r"^\s*[+-]?([0-9]{1,200}(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]{1,2})?\s*$"
ISO = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})$"

RECORD_COLUMNS = (
    "licencersn licencenumber licencerevisionnumber folderyear businessname businesstradename status issueddate expireddate extractdate businesstype "
    "businesssubtype unit unittype house street city province country postalcode localarea numberofemployees feepaid geom geo_point_2d"
).split()


def whole(c: str) -> str:
    return f"case when regexp_matches({c}, '{DECIMAL}') then case when try_cast(trim({c}, ' \t\n\r') as decimal(38,6)) = floor(try_cast(trim({c}, ' \t\n\r') as decimal(38,6))) then try_cast(try_cast(trim({c}, ' \t\n\r') as decimal(38,6)) as bigint) end end"


def missing(c: str) -> str:
    words = ", ".join("'" + w + "'" for w in T.NO_VALUE)
    return f"coalesce(lower(regexp_replace({c}, '^\\s+|\\s+$', '', 'g')) in ({words}), true)"


DELIVERED = f"""d as (select *, case when y < 80 then y + 2000 when y < 100 then y + 1900 else y end as g from (
  select *, {whole("folderyear")} as y, {whole("licencersn")} as k,
    case when regexp_matches(trim(extractdate), '{ISO}') then {_DAY.format("try_cast(trim(extractdate) as timestamptz)")}
         when regexp_matches(trim(extractdate), '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') then try_cast(trim(extractdate) as date) end as dt from records)),
loads as (select g, dt, row_number() over (partition by g order by dt) as n from (select distinct g, dt from d where g is not null and dt is not null))"""

VERSIONS = f"""with day as (select business_sk, {_DAY.format("issued_date")} as d, extract_date, licence_rsn, business_name, status,
    nullif(address_sk, -1) as address_sk, nullif(category_sk, -1) as category_sk from fact_licence where business_sk <> -1 and issued_date is not null),
one as (select * from day qualify row_number() over (partition by business_sk, d order by extract_date desc nulls last, licence_rsn desc nulls last) = 1),
seen as (select business_sk, d, {", ".join(f"last_value({c} ignore nulls) over w as {c}" for c in ("business_name", "status", "address_sk", "category_sk"))} from one
  window w as (partition by business_sk order by d rows between unbounded preceding and current row)),
prev as (select *, row_number() over w as n, {", ".join(f"lag({c}) over w as p_{c}" for c in ("business_name", "status", "address_sk", "category_sk"))} from seen window w as (partition by business_sk order by d)),
st as (select * from prev where n = 1 or {" or ".join(f"(p_{c} is not null and {c} is distinct from p_{c})" for c in ("business_name", "status", "address_sk", "category_sk"))})
select business_sk, {_YMD.format("d")} as valid_from, coalesce({_YMD.format("lead(d) over (partition by business_sk order by d)")}, 99991231) as valid_to@MORE@ from st"""

PERIODS = f"""with iv as (select distinct business_sk, {_DAY.format("issued_date")} as s, {_DAY.format("expired_date")} as e from fact_licence where business_sk <> -1),
m as (select *, max(e) over (partition by business_sk order by s, e rows between unbounded preceding and 1 preceding) as before from iv where e >= s),
isl as (select *, sum(case when before is null or s > before + 1 then 1 else 0 end) over (partition by business_sk order by s, e rows unbounded preceding) as i from m),
p as (select business_sk, i, min(s) as s, max(e) as e from isl group by all)
select business_sk, 'period' as kind, {_YMD.format("s")} as first_day, {_YMD.format("e")} as last_day from p
union all select business_sk, 'gap', {_YMD.format("e + 1")}, {_YMD.format("nxt - 1")} from (select *, lead(s) over (partition by business_sk order by i) as nxt from p) where nxt is not null"""

_COMPARED = [c for c in RECORD_COLUMNS if c not in ("licencersn", "extractdate")]
CHANGES = f"""with {DELIVERED},
c as (select g, dt, k, list_sort(list(distinct r)) as rs from (select g, dt, k, {{{", ".join(f"'{c}': {c}" for c in _COMPARED)}}}::varchar as r from d where g is not null and dt is not null and k is not null) group by all),
num as (select c.*, n from c join loads using (g, dt))
select coalesce(a.g, b.g) as folder_year, coalesce(a.k, b.k) as licence_rsn, strftime(l.dt, '%Y-%m-%d') as extract_day,
  case when b.k is null then 'added' when a.k is null then 'removed' else 'changed' end as change
from num a full join num b on a.g = b.g and a.k = b.k and a.n = b.n + 1 join loads l on l.g = coalesce(a.g, b.g) and l.n = coalesce(a.n, b.n + 1)
where l.n > 1 and a.rs is distinct from b.rs"""


def _form(c: str) -> str:
    p = RECORD_RULES.forms.get(c)
    return "null::boolean" if p is None else f"not regexp_matches(v, '{p.replace('(?U)', '')}')"


_NUMBERS, _INSTANTS = (", ".join(f"'{c}'" for c in names) for names in (NUMBERS, INSTANTS))
_TYPED = f"{_NUMBERS}, {_INSTANTS}"
CELLS = f"""with {DELIVERED},
cells as ({" union all ".join(f"select g, dt, '{c}' as column_name, case when not {missing(c)} then {c} end as v from d where g is not null and dt is not null" for c in RECORD_COLUMNS)}),
f as (select g, dt, column_name, v, count(*) as n, case column_name {" ".join(f"when '{c}' then {_form(c)}" for c in RECORD_COLUMNS)} end as lack,
  case when column_name in ('feepaid', 'numberofemployees') and regexp_matches(v, '{DECIMAL}') then try_cast(trim(v, ' \t\n\r') as double) end as x,
  case when column_name in ({_NUMBERS}) and regexp_matches(v, '{DECIMAL}') then try_cast(trim(v, ' \t\n\r') as double) end as num,
  case when column_name in ({_INSTANTS}) then case when regexp_matches(trim(v), '{ISO}') then try_cast(trim(v) as timestamptz) when regexp_matches(trim(v), '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') then try_cast(trim(v) || 'T00:00:00Z' as timestamptz) end end as inst
  from cells group by all)"""

BREAKS = f"""{CELLS},
s as (select g, dt, column_name, cast(sum(n) as double) as rs, cast(sum(n) filter (v is null) as double) as ms, count(v) as ds, cast(sum(n) filter (lack) as double) as lk,
  sum(x * n) / sum(n) filter (x is not null) as mean, cast(sum(n) filter (v is not null) as double) as vs from f group by all),
t as (select s.*, lo.n, coalesce(ms, 0) / rs as miss from s join loads lo using (g, dt)),
pr as (select a.*, b.miss as bmiss, b.ds as bds, b.mean as bmean, b.vs as bvs, b.dt as bdt from t a join t b on a.g = b.g and a.column_name = b.column_name and a.n = b.n + 1),
sh as (select p.g, p.dt, p.column_name, max(abs(coalesce(a.n, 0) / p.vs - coalesce(b.n, 0) / p.bvs)) as ch from pr p
  join (select distinct g, column_name, v from f where v is not null) u on u.g = p.g and u.column_name = p.column_name
  left join f a on a.g = p.g and a.dt = p.dt and a.column_name = p.column_name and a.v = u.v
  left join f b on b.g = p.g and b.dt = p.bdt and b.column_name = p.column_name and b.v = u.v
  where p.column_name in ({", ".join(f"'{c}'" for c in RECORD_RULES.share_columns)}) group by all)
select cast(g as bigint) as folder_year, strftime(dt, '%Y-%m-%d') as extract_day, column_name, finding from (
 select g, dt, column_name, 'missing' as finding from pr where abs(miss - bmiss) > {RECORD_RULES.missing}
 union all select g, dt, column_name, 'form' from pr where coalesce(lk, 0) / vs > {RECORD_RULES.form}
 union all select g, dt, column_name, 'level' from pr where greatest(mean, bmean) > 2 * least(mean, bmean) and mean is not null and bmean is not null
 union all select g, dt, column_name, 'spread' from pr where greatest(ds, bds) > 2 * least(ds, bds)
 union all select g, dt, column_name, 'share' from sh where ch > {RECORD_RULES.share})"""

PROFILE = f"""{CELLS}
select cast(g as bigint) as folder_year, strftime(dt, '%Y-%m-%d') as extract_day, column_name, cast(sum(n) as bigint) as row_count, cast(coalesce(sum(n) filter (v is null), 0) as bigint) as missing_count,
  count(v) as distinct_count, min(v) filter (column_name not in ({_TYPED})) as least_value, max(v) filter (column_name not in ({_TYPED})) as greatest_value,
  min(num) as least_number, max(num) as greatest_number, epoch_us(min(inst)) as first_instant, epoch_us(max(inst)) as last_instant, cast(coalesce(sum(n) filter (lack), 0) as bigint) as without_form,
  round_even((log2(sum(n) filter (v is not null)) - sum(n * log2(n)) filter (v is not null) / sum(n) filter (v is not null)) * 1000000, 0) / 1000000 as entropy_bits from f group by all"""

DELTAS = f"""{CELLS}, m as (select f.g, f.column_name, f.v, f.n as c, l.n, l.dt from f join loads l using (g, dt)),
j as (select coalesce(a.g, b.g) as g, coalesce(a.column_name, b.column_name) as column_name, coalesce(a.v, b.v) as v, coalesce(a.n, b.n + 1) as n, coalesce(a.c, 0) as c, coalesce(b.c, 0) as bc
  from m a full join m b on a.g = b.g and a.column_name = b.column_name and a.v is not distinct from b.v and a.n = b.n + 1)
select cast(j.g as bigint) as folder_year, strftime(l.dt, '%Y-%m-%d') as extract_day, column_name, count(*) filter (v is not null and bc = 0) as values_gained,
  count(*) filter (v is not null and c = 0) as values_lost, cast(sum(c - bc) as bigint) as net_rows from j join loads l on l.g = j.g and l.n = j.n group by all"""

SQL = {
    "p1_found": VERSIONS.replace("@MORE@", ""),
    "p1_versions": VERSIONS.replace("@MORE@", ", business_name, status, address_sk, category_sk"),
    "p4_found": PERIODS,
    "p5_found": CHANGES,
    "p7_found": BREAKS,
    "p7_profile": PROFILE,
    "p7_deltas": DELTAS,
}
