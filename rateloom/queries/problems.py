"""The queries of the general problems 1 to 7 over the tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import fold
from ..operators import cdc_store, drift, nested, quantiles, quarantine, snapshots
from ..plans.materialize import materialize, scratch_path
from ..plans.skew import small_join
from ..session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    rows = quarantine.read_permissive(table(spark, d, "hpt_csv_records"))
    return quarantine.reclassify(rows).select("source_sha256", "record_no", "reason")


def p1_loaded(spark: SparkSession, d: str) -> DataFrame:
    """The valid data records as typed rows."""
    return quarantine.valid_rows(quarantine.read_permissive(table(spark, d, "hpt_csv_records")))


def _snapshots(spark: SparkSession, d: str):
    rows = table(spark, d, "nppes_full")
    # a few rows from a scan of one column, used several times
    files = materialize(snapshots.applied_files(table(spark, d, "file_log"), rows), "files")
    return snapshots.canonical_snapshots(rows, files), files


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    snaps, files = _snapshots(spark, d)
    found = snapshots.snapshot_changes(snaps, files)
    return small_join(found, files.select("seq", "source_file"), ["seq"]).select("source_file", "npi", "change_kind")


def p2_changed_fields(spark: SparkSession, d: str) -> DataFrame:
    """How often each attribute changed from one snapshot to the next."""
    snaps, files = _snapshots(spark, d)
    found = snapshots.snapshot_changes(snaps, files)
    return found.select("seq", F.explode("changed_fields").alias("field")).groupBy("seq", "field").agg(F.count(F.lit(1)).alias("changed"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    snaps, files = _snapshots(spark, d)
    h = snapshots.attribute_history(snaps, files)
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return h.select("npi", "version", day("valid_from").alias("valid_from"), F.coalesce(day("valid_to"), F.lit("")).alias("valid_to"), "status")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    found = drift.schema_changes(table(spark, d, "hpt_json_rows"), table(spark, d, "stg_hpt__files"))
    return found.select("source_sha256", "kind", "column_name", "new_name")


def p4_table(spark: SparkSession, d: str) -> DataFrame:
    """All lines of all files under consistent names and types."""
    rows, files = table(spark, d, "hpt_json_rows"), table(spark, d, "stg_hpt__files")
    prof = materialize(drift.profiles(rows), "profiles")
    return drift.consistent_table(rows, files, drift.schema_changes(rows, files, prof), prof)


#: What is no rate: the filler of suppressed values.
FILLER_RATE = 999_999_999.0


def rates(charges: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """(hospital_id, payer, negotiated_rate, carry...): each charge once, the latest loaded; rates that are no price left out."""
    ok = charges.where(F.col("negotiated_rate").isNotNull() & ~F.isnan("negotiated_rate") & (F.col("negotiated_rate") > 0) & (F.col("negotiated_rate") != FILLER_RATE))
    row = F.struct("loaded_at", "hospital_id", fold(F.col("payer_name")).alias("payer"), "negotiated_rate")
    once = ok.where("charge_id is not null").select("charge_id", row.alias("_r")).groupBy("charge_id").agg(F.max("_r").alias("_r"))
    return once.select("_r.hospital_id", "_r.payer", "_r.negotiated_rate", *[F.col(f"_r.{c}") for c in carry])


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    r = rates(table(spark, d, "fct_standard_charges")).where("hospital_id is not null and payer is not null")
    p = quantiles.radix_percentiles(r, ["hospital_id", "payer"], "negotiated_rate", [0.5, 0.9])
    return p.where("n >= 30 and p90 >= 10 * p50").select("hospital_id", "payer")


def p5_hospitals(spark: SparkSession, d: str) -> DataFrame:
    """Percentiles per hospital: a summary of each day of loading, the days merged."""
    ok = rates(table(spark, d, "fct_standard_charges"), ("loaded_at",)).where("hospital_id is not null")
    days = quantiles.radix_summary(ok.withColumn("day", F.to_date("loaded_at")), ["hospital_id", "day"], "negotiated_rate")
    # what is stored: one portion a day, which other days are added to later
    days = materialize(days, "day-summaries")
    merged = quantiles.summary_percentiles(quantiles.merge_summaries(days.drop("day")), ["hospital_id"], [0.25, 0.5, 0.75, 0.9])
    return merged.select("hospital_id", "n", *[F.round(c, 4).alias(c) for c in ("p25", "p50", "p75", "p90")])


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "nested_records")
    refs = nested.references(rows.where("record_kind = 'fhir_bundle'"))
    return refs.unionByName(nested.modifier_payers(rows.where("record_kind = 'hpt_file'")))


def p6_charges(spark: SparkSession, d: str) -> DataFrame:
    """The payer entries of charges as one flat table linked to their charge."""
    at = ("standard_charge_information", "standard_charges", "payers_information")
    members = ["payer_name", "plan_name", "standard_charge_dollar"]
    t = nested.json_triples(table(spark, d, "nested_records").where("record_kind = 'hpt_file'"), "record_id", "body", (*at, *members), containers=True)
    return nested.table_of(t, "record_id", ".".join(at), members)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    store = cdc_store.BucketStore(spark, scratch_path(spark, "provider-store"))
    store.create(cdc_store.current_rows(table(spark, d, "provider_history")), "npi")
    rows = cdc_store.apply_changes(store, table(spark, d, "nppes_changes"), table(spark, d, "file_log"))
    return rows.select("npi", "status", "change_id", F.col("practice_city_change_id").alias("city_change_id"))


QUERIES = {f.__name__: f for f in (p1_found, p1_loaded, p2_found, p2_changed_fields, p3_found, p4_found, p4_table, p5_found, p5_hospitals, p6_found, p6_charges, p7_found)}

# ---------------------------------------------------------------- what SQL can say of them

_BLANKS = "chr(32) || chr(9) || chr(10) || chr(13)"
_DAY = "try_strptime(trim({c}), '%m/%d/%Y')::date"
_FIELDS = ["entity_type", "org_name", "last_name", "first_name", "credential", "practice_address_1", "practice_city", "practice_state", "practice_postal"]
_ROW = ", ".join([*[f"nullif(trim({c}), '') as {c}" for c in _FIELDS], *[f"{_DAY.format(c=c)} as {c}" for c in ("enumeration_date", "deactivation_date", "reactivation_date")], "nullif(trim(primary_taxonomy), '') as primary_taxonomy", "array_to_string(list_filter(list_transform(taxonomy_codes, lambda x: trim(x)), lambda x: x <> ''), chr(1)) as codes"])
_ALL = ", ".join([*_FIELDS, "enumeration_date", "deactivation_date", "reactivation_date", "primary_taxonomy", "codes"])
_SNAPS = f"""with f as (select source_file, max(coverage_end) as e, row_number() over (order by max(coverage_end)) as seq from file_log where outcome = 'applied' and source_file in (select source_file from nppes_full) group by 1),
r as (select f.seq, f.e, f.source_file, trim(n.npi) as npi, {_DAY.format(c='n.last_update_date')} as day, {_ROW.replace('nullif(trim(', 'nullif(trim(n.').replace('trim(enum', 'trim(n.enum').replace('trim(deact', 'trim(n.deact').replace('trim(react', 'trim(n.react').replace('taxonomy_codes', 'n.taxonomy_codes')} from nppes_full n join f on f.source_file = n.source_file),
s as (select * from r qualify row_number() over (partition by seq, npi order by day desc nulls last) = 1)"""

ORACLES = {
    "p2_found": _SNAPS + f"""select f.source_file, coalesce(a.npi, b.npi) as npi, case when a.npi is null then 'added' when b.npi is null then 'removed' else 'changed' end as change_kind
from (select *, row({_ALL}) as v, seq + 1 as pair from s) a full join (select *, row({_ALL}) as v from s) b on a.pair = b.seq and a.npi = b.npi join f on f.seq = coalesce(b.seq, a.pair)
where f.seq > 1 and (a.npi is null or b.npi is null or a.v is distinct from b.v)""",
    "p5_found": """select hospital_id, payer from (select distinct charge_id, hospital_id, lower(trim(payer_name)) as payer, negotiated_rate as v from fct_standard_charges where negotiated_rate > 0 and not isnan(negotiated_rate) and negotiated_rate <> 999999999 and payer_name is not null and hospital_id is not null and charge_id is not null)
where payer <> '' group by 1, 2 having count(*) >= 30 and quantile_cont(v, 0.9) >= 10 * median(v)""",
}

_CELL = """("(?:[^"]|"")*"|[^",]*)"""
_CELLS = "list_transform(regexp_extract_all(',' || {x}, ',' || '" + _CELL + "', 1), lambda c: case when c like '\"%' then replace(c[2:length(c) - 1], '\"\"', '\"') else c end)"
_STRIP = "trim(x, ' ' || chr(9) || chr(10) || chr(13) || chr(65279))"
_NUMERIC = ", ".join(f"'{r.name}'" for r in quarantine.TALL_SCHEMA if r.kind == "number")
_ENUMS = " ".join(f"when z.n = '{r.name}' then z.v in ({', '.join(repr(a) for a in r.allowed)})" for r in quarantine.TALL_SCHEMA if r.kind == "enum")
ORACLES["p1_found"] = f"""with h as (select source_sha256, {_CELLS.format(x="min(raw_record)")} as cells from hpt_csv_records where record_no = 3 group by 1),
n as (select source_sha256, list_transform(cells, lambda x: regexp_replace(lower({_STRIP}), '\\s*\\|\\s*', '|', 'g')) as names from h),
d as (select distinct source_sha256, record_no, coalesce(raw_record, '') as raw from hpt_csv_records where record_no > 3),
q as (select *, regexp_full_match(raw, '{_CELL}(,{_CELL})*') as ok from d),
c as (select q.source_sha256, record_no, ok, n.names, case when ok then {_CELLS.format(x="raw")} end as cells from q left join n using (source_sha256)),
k as (select * from c where not ok or len(list_filter(cells, lambda x: {_STRIP} <> '')) > 0),
u as (select *, case when ok and len(cells) = len(names) then list_transform(range(1, len(cells) + 1), lambda i: {{'n': names[i], 'v': lower(trim(cells[i], ' ' || chr(9) || chr(10) || chr(13)))}}) end as pairs from k)
select source_sha256, record_no, case when not ok then 'broken_quoting' when names is null or len(cells) <> len(names) then 'column_count' else 'invalid_value' end as reason from u
where not ok or names is null or len(cells) <> len(names) or len(list_filter(pairs, lambda z: z.v <> '' and not (case when z.n in ({_NUMERIC}) then regexp_full_match(z.v, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)(e[+-]?[0-9]+)?') when z.n = 'count' then z.v in ('0', '1 through 10') or regexp_full_match(z.v, '0*(1[1-9]|[2-9][0-9]|[1-9][0-9][0-9]+)') {_ENUMS} else true end))) > 0""".replace("\\\\", "\\")

ORACLES["p3_found"] = _SNAPS.replace("with f as", "with recursive f as") + f""", g as (select k.npi, f.seq, f.e, s.day, case when s.npi is not null then cast(row({', '.join('s.' + c for c in _ALL.split(', '))}) as varchar) end as v, case when s.deactivation_date is not null and (s.reactivation_date is null or s.reactivation_date < s.deactivation_date) then 'deactivated' else 'active' end as st
from (select distinct npi from s where npi <> '') k cross join f left join s on s.npi = k.npi and s.seq = f.seq),
w as (select npi, cast(0 as bigint) as seq, cast(null as date) as e, 'none' as held, cast(null as varchar) as v, cast(null as date) as latest, false as opens, cast('' as varchar) as status from (select distinct npi from g)
union all select g.npi, g.seq, g.e, case when g.v is null then case when w.held = 'none' then 'none' else 'absent' end when coalesce(g.day < w.latest, false) then w.held else 'row' end, case when g.v is null or coalesce(g.day < w.latest, false) then w.v else g.v end, greatest(w.latest, g.day),
case when g.v is null then w.held = 'row' when coalesce(g.day < w.latest, false) then false else w.held <> 'row' or w.v is distinct from g.v end, case when g.v is null then 'absent_from_full' else g.st end from w join g on g.npi = w.npi and g.seq = w.seq + 1)
select npi, cast(row_number() over p as integer) as version, strftime(e, '%Y-%m-%d') as valid_from, coalesce(strftime(lead(e) over p, '%Y-%m-%d'), '') as valid_to, status from w where opens window p as (partition by npi order by seq)"""

_ATTRS = ", ".join(f"nullif(trim({a}), '') as {a}" for a in cdc_store.ATTRIBUTES)
_KEYS = ", ".join(cdc_store.ATTRIBUTES)
ORACLES["p7_found"] = f"""with f as (select source_file, max(coverage_end) as e from file_log where outcome = 'applied' group by 1),
b as (select npi, status = 'active' as live, last_update_date as since from provider_history where is_current),
c as (select change_id, trim(npi) as npi, lower(trim(change_type)) as kind, last_update_date as day, e, line_no, {_ATTRS} from nppes_changes join f using (source_file)),
o as (select * from c qualify row_number() over (partition by npi, kind, day, {_KEYS} order by e, line_no, change_id) = 1),
r as (select o.*, b.live, case when kind in ('insert', 'reactivate') then true when kind = 'deactivate' then false end as turn from o left join b using (npi) where b.since is null or o.day >= b.since),
s as (select *, live is not null or coalesce(bool_or(kind = 'insert') over p, false) as known, coalesce(last_value(turn ignore nulls) over p, live, false) as alive from r window p as (partition by npi order by day, e, line_no, change_id rows between unbounded preceding and 1 preceding)),
t as (select *, row_number() over (partition by npi order by day, e, line_no, change_id) as n from s where kind = 'insert' or (known and case when kind in ('update', 'deactivate') then alive when kind = 'reactivate' then not alive else false end))
select npi, case when arg_max(kind, n) = 'deactivate' then 'deactivated' else 'active' end as status, arg_max(change_id, n) as change_id, coalesce(arg_max(change_id, n) filter (where kind = 'insert' or (kind in ('update', 'reactivate') and practice_city is not null)), 0) as city_change_id from t group by npi"""


ORACLES["p4_found"] = """with d as (select source_sha256, min(coalesce(try_strptime(trim(last_updated_on), '%Y-%m-%d'), try_strptime(trim(last_updated_on), '%m/%d/%Y'))) as dt from stg_hpt__files group by 1),
o as (select hospital_id, source_sha256, row_number() over (partition by hospital_id order by dt, source_sha256) as seq from (select distinct hospital_id, source_sha256 from hpt_json_rows) join d using (source_sha256) where dt is not null),
x as (select hospital_id, source_sha256, line_key, unnest(json_keys(row_json)) as k, row_json from hpt_json_rows),
y as (select x.hospital_id, x.source_sha256, o.seq, line_key, regexp_replace(lower(trim(k)), '\\s*\\|\\s*', '|', 'g') as m, json_extract(row_json, '$."' || k || '"') as j from x join o using (hospital_id, source_sha256)),
c as (select *, case json_type(j) when 'VARCHAR' then 'string' when 'BOOLEAN' then 'boolean' when 'ARRAY' then 'array' when 'OBJECT' then 'object' when 'NULL' then null else 'number' end as t, case when json_type(j) in ('BIGINT', 'UBIGINT', 'HUGEINT', 'DOUBLE') then cast(cast(j as double) as varchar) else cast(j as varchar) end as v from y),
n as (select hospital_id, seq, m, t, count(*) as n from c where t is not null group by all),
p as (select u.hospital_id, u.seq, u.m, n.t from (select distinct hospital_id, seq, m from c) u left join (select * from n qualify row_number() over (partition by hospital_id, seq, m order by n desc, t) = 1) n using (hospital_id, seq, m)),
e as (select coalesce(a.hospital_id, b.hospital_id) as hospital_id, coalesce(b.seq, a.seq + 1) as seq, coalesce(a.m, b.m) as m, case when b.m is null then 'removed' when a.m is null then 'added' else 'retyped' end as kind from p a full join p b on a.hospital_id = b.hospital_id and a.seq + 1 = b.seq and a.m = b.m where a.m is null or b.m is null or a.t <> b.t),
e2 as (select e.*, o.source_sha256 from e join o using (hospital_id, seq) where seq > 1),
l as (select distinct hospital_id, seq, line_key, m, t, v from c where t is not null),
r as (select g.hospital_id, g.seq, g.source_sha256, g.m as a, w.m as b from e2 g join e2 w on g.hospital_id = w.hospital_id and g.seq = w.seq and g.kind = 'removed' and w.kind = 'added' join l p on p.hospital_id = g.hospital_id and p.seq = g.seq - 1 and p.m = g.m join l q on q.hospital_id = w.hospital_id and q.seq = w.seq and q.m = w.m and q.line_key = p.line_key group by all having 2 * count(*) filter (where p.t = q.t and p.v = q.v) >= count(*))
select source_sha256, 'renamed' as kind, a as column_name, b as new_name from r
union all select source_sha256, kind, m, '' from e2 where not exists (select 1 from r where r.source_sha256 = e2.source_sha256 and ((kind = 'removed' and r.a = m) or (kind = 'added' and r.b = m)))"""

ORACLES["p6_found"] = """with v as (select record_id, record_kind, case when json_valid(body) then body end as body from nested_records),
t as (select v.record_id, v.record_kind, j.key, j.type, j.atom, j.fullkey, j.path from v, json_tree(v.body) j where v.body is not null),
z as (select record_id, path, json_extract_string(atom, '$') as rt from t where key = 'resourceType' and type = 'VARCHAR' and record_kind = 'fhir_bundle'),
e as (select * from z where not (path = '$' and rt = 'Bundle')),
i as (select record_id, path, json_extract_string(atom, '$') as id from t where key = 'id' and type = 'VARCHAR'),
r as (select record_id, fullkey, json_extract_string(atom, '$') as item_value from t where key = 'reference' and type = 'VARCHAR' and record_kind = 'fhir_bundle'),
w as (select r.record_id, r.fullkey, r.item_value, arg_max(e.path, length(e.path)) as owner_path from r left join e on e.record_id = r.record_id and starts_with(r.fullkey, e.path || '.') group by all)
select w.record_id, coalesce(i.id, '') as owner, substr(w.fullkey, 3) as path, w.item_value from w left join i on i.record_id = w.record_id and i.path = w.owner_path
union all select p.record_id, coalesce(c.code, '') as owner, substr(p.fullkey, 3), p.item_value from (select record_id, fullkey, json_extract_string(atom, '$') as item_value, regexp_replace(path, '\\.modifier_payer_information(\\[[0-9]+\\])*$', '') as at from t where record_kind = 'hpt_file' and key = 'payer_name' and type = 'VARCHAR' and regexp_full_match(path, '\\$\\.modifier_information(\\[[0-9]+\\])*\\.modifier_payer_information(\\[[0-9]+\\])*')) p
left join (select record_id, path, json_extract_string(atom, '$') as code from t where key = 'code' and type <> 'NULL') c on c.record_id = p.record_id and c.path = p.at where p.item_value <> ''"""

_INDEX = "(\\[[0-9]+\\])*"
ORACLES["p6_charges"] = f"""with v as (select record_id, case when json_valid(body) then body end as body from nested_records where record_kind = 'hpt_file'),
t as (select v.record_id, substr(j.fullkey, 3) as row_path, j.value as x from v, json_tree(v.body) j where v.body is not null and j.type = 'OBJECT' and regexp_full_match(j.fullkey, '\\$\\.standard_charge_information{_INDEX}\\.standard_charges{_INDEX}\\.payers_information{_INDEX}'))
select record_id, row_path, regexp_replace(row_path, '\\.payers_information{_INDEX}$', '') as parent_path, cast(nullif(regexp_extract(row_path, '\\[([0-9]+)\\]$', 1), '') as int) as ordinal, {', '.join(f"case when json_type(x, '$.{m}') not in ('OBJECT', 'ARRAY') then json_extract_string(x, '$.{m}') end as {m}" for m in ('payer_name', 'plan_name', 'standard_charge_dollar'))} from t""".replace("\\\\", "\\")

# p4_table: the names a member ends under, by following its renames, and the type of the latest file that has the column
_RENAMES = ORACLES["p4_found"].replace("with d as", "with recursive d as", 1).split("select source_sha256, 'renamed'")[0].rstrip()
_RENAMES = _RENAMES.replace("x as (select hospital_id, source_sha256, line_key,", "x as (select hospital_id, source_sha256, line_no, line_key,").replace("o.seq, line_key,", "o.seq, line_no, line_key,")
ORACLES["p4_table"] = _RENAMES + """, nm as (select hospital_id, seq, m, m as cur, seq as pos from p union all select nm.hospital_id, nm.seq, nm.m, r.b, r.seq from nm join r on r.hospital_id = nm.hospital_id and r.a = nm.cur and r.seq > nm.pos and not exists (select 1 from r r2 where r2.hospital_id = nm.hospital_id and r2.a = nm.cur and r2.seq > nm.pos and r2.seq < r.seq)),
fn as (select hospital_id, seq, m, arg_max(cur, pos) as c from nm group by all),
kt as (select fn.hospital_id, fn.c, max({'s': p.seq, 't': p.t}).t as ct from fn join p using (hospital_id, seq, m) where p.t is not null group by all),
z as (select c.hospital_id, c.source_sha256, c.line_no, c.line_key, fn.c as column_name, kt.ct as column_type, case when c.t = 'string' then json_extract_string(c.j, '$') when c.t = 'number' then cast(cast(c.j as double) as varchar) when c.t is not null then regexp_replace(cast(c.j as varchar), '([0-9])\\.0([,}\\]])', '\\1\\2', 'g') end as x from c join fn using (hospital_id, seq, m) left join kt on kt.hospital_id = c.hospital_id and kt.c = fn.c),
w as (select *, case when column_type = 'number' then try_cast(trim(x) as double) end as number, case when column_type = 'boolean' then try_cast(x as boolean) end as flag from z)
select hospital_id, source_sha256, line_no, line_key, column_name, column_type, case when number is null and flag is null then x end as value, number, flag from w"""

ORACLES["p2_changed_fields"] = _SNAPS + " " + " union all ".join(f"select b.seq, '{c if c != 'codes' else 'taxonomy_codes'}' as field, count(*) as changed from s a join s b on a.npi = b.npi and a.seq + 1 = b.seq where a.{c} is distinct from b.{c} group by 1, 2" for c in _ALL.split(", "))

# a summary keeps 20 bits of the fraction
ORACLES["p5_hospitals"] = """with o as (select distinct charge_id, hospital_id, lower(trim(payer_name)) as payer, negotiated_rate as v, loaded_at from fct_standard_charges where negotiated_rate > 0 and not isnan(negotiated_rate) and negotiated_rate <> 999999999 and charge_id is not null),
k as (select * from o qualify row_number() over (partition by charge_id order by loaded_at desc, hospital_id desc, payer desc, v desc) = 1),
g as (select hospital_id, floor(v / pow(2.0, floor(log2(v)) - 20)) * pow(2.0, floor(log2(v)) - 20) as v from k where hospital_id is not null)
select hospital_id, count(*) as n, round(quantile_cont(v, 0.25), 4) as p25, round(median(v), 4) as p50, round(quantile_cont(v, 0.75), 4) as p75, round(quantile_cont(v, 0.9), 4) as p90 from g group by 1"""

# the rows that load: every cell by the name of its column
def _cell(rule: quarantine.Rule) -> str:
    v = f"nullif(list_filter(cs, lambda z: z.n = '{rule.name}')[1].o, '')"
    v = f"try_cast({v} as double)" if rule.kind == "number" else f"lower({v})" if rule.kind == "enum" else v
    return f'{v} as "{rule.name.replace("|", "_")}"'


ORACLES["p1_loaded"] = ORACLES["p1_found"].split("u as (select")[0].rstrip() + f""" bad as ({ORACLES['p1_found']}), hs as (select distinct source_sha256, record_no, hospital_id from hpt_csv_records),
g as (select k.source_sha256, k.record_no, hs.hospital_id, list_transform(range(1, len(names) + 1), lambda i: {{'n': names[i], 'o': {_STRIP.replace('x,', 'cells[i],')}}}) as cs from k join hs on hs.source_sha256 = k.source_sha256 and hs.record_no = k.record_no where ok and len(cells) = len(names) and not exists (select 1 from bad where bad.source_sha256 = k.source_sha256 and bad.record_no = k.record_no))
select source_sha256, record_no, hospital_id, {', '.join(_cell(r) for r in quarantine.TALL_SCHEMA)} from g"""
