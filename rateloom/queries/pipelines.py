"""Queries that run whole operators of the pipelines: change capture, clinical tables, gates, analysis, drift."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import analysis, gates
from ..marts import clinical as clinical_marts
from ..marts import identity, prices
from ..operators import clinical, nested, quarantine, scd2, snapshots
from ..plans.materialize import materialize, scratch_path
from ..sources import registry
from ..sources.bundles import bundle_entries
from . import problems
from .registry import Registry, Tables

_r = Registry()
query = _r.query
QUERIES, ORACLES = _r.queries, _r.oracles

# ---------------------------------------------------------------- change capture

_KEPT = ("entity_type", "org_name", "last_name", "first_name", "credential", "practice_address_1", "practice_city", "practice_state", "practice_postal", "enumeration_date", "last_update_date", "deactivation_date", "reactivation_date")
_DAY = "try_strptime(trim({c}), '%m/%d/%Y')::date"
_BLANK = "nullif({c}, '')"
_TEXTS = {a: _DAY.format(c=a) if a.endswith("_date") else _BLANK.format(c=a) if a in _KEPT else "null" for a in registry.ATTRIBUTES} | {"primary_taxonomy": "case when primary_taxonomy <> '' and list_contains(codes, primary_taxonomy) then primary_taxonomy else nullif(taxonomy_codes[1], '') end", "taxonomy_codes": "'[' || array_to_string(codes, ', ') || ']'"}
_HASH = "md5(concat_ws('|', " + ", ".join(f"coalesce(cast({x} as varchar), '')" for x in _TEXTS.values()) + "))"
_TYPED = f"""t0 as (select *, list_filter(coalesce(taxonomy_codes, []), lambda x: x is not null and x <> '') as codes from nppes_full),
t as (select source_file, npi, {_TEXTS['primary_taxonomy']} as primary_taxonomy, greatest({', '.join(_DAY.format(c=c) for c in ('last_update_date', 'deactivation_date', 'reactivation_date'))}) as effective_date, {_HASH} as row_hash, {_DAY.format(c='deactivation_date')} as off, {_DAY.format(c='reactivation_date')} as back,
{' or '.join(f"(coalesce({c}, '') <> '' and {_DAY.format(c=c)} is null)" for c in ('enumeration_date', 'last_update_date', 'deactivation_date', 'reactivation_date'))} as bad_date, coalesce(entity_type, '') = '' and {_DAY.format(c='deactivation_date')} is not null as is_stub, cast(len(codes) as int) as n_codes from t0)"""
_DEDUPED = _TYPED + """, d0 as (select t.*, case when off is not null and (back is null or back < off) then 'deactivated' else 'active' end as status from t where npi is not null qualify row_number() over (partition by source_file, npi order by effective_date desc nulls last, row_hash) = 1)"""
_FILES = """f as (select source_file, max(coverage_end) as e, row_number() over (order by max(coverage_end), source_file) as seq from file_log where outcome = 'applied' and source_file in (select source_file from nppes_full) group by 1)"""


def _raw(t: Tables) -> DataFrame:
    """The snapshots under the columns of a registry file; the slot of the primary taxonomy carries its mark."""
    n = t.nppes_full
    none = F.lit(None).cast("string")
    slot = lambda i: F.get("taxonomy_codes", F.lit(i - 1)) if "taxonomy_codes" in n.columns else none
    primary = F.col("primary_taxonomy") if "primary_taxonomy" in n.columns else none
    marks = {}
    for c in registry.HEADERS.values():
        if c.startswith("tax_"):
            marks[c] = slot(int(c[4:]))
        elif c.startswith("switch_"):
            marks[c] = F.when(slot(int(c[7:])) == primary, "Y")
        else:
            marks[c] = F.col(c) if c in n.columns else none
    return n.select("source_file", *[v.alias(k) for k, v in marks.items()])


def _typed(t: Tables) -> DataFrame:
    return registry.typed(_raw(t), ("source_file",))


@query(f"with {_TYPED} select source_file, npi, primary_taxonomy, effective_date, row_hash, bad_date, is_stub, n_codes from t")
def registry_typed(t: Tables) -> DataFrame:
    return _typed(t).select("source_file", "npi", "primary_taxonomy", "effective_date", "row_hash", "bad_date", "is_stub", F.size("taxonomy_codes").alias("n_codes"))


@query(f"with {_TYPED} select source_file, count(*) filter (where bad_date) as unparseable_date, count(*) - count(distinct npi) as duplicate_npi_in_file, count(*) filter (where effective_date is null) as no_effective_date from t group by 1")
def file_statistics(t: Tables) -> DataFrame:
    return registry.drift_by(_typed(t), "source_file")


@query(f"with {_DEDUPED} select source_file, npi, effective_date, row_hash from d0")
def dedupe_incoming(t: Tables) -> DataFrame:
    return scd2.dedupe_incoming(_typed(t), ("source_file", "npi")).select("source_file", "npi", "effective_date", "row_hash")


def _applied(t: Tables) -> list:
    """The applied snapshots in their order; a ledger has a row a delivery."""
    return snapshots.applied_files(t.file_log, t.nppes_full).orderBy("seq").collect()


@query(f"""with {_DEDUPED}, {_FILES}, d as (select d0.*, f.seq, f.e from d0 join f using (source_file))
select b.source_file, b.npi, case when a.seq is null then 'insert' when b.effective_date < a.effective_date then 'stale' when b.row_hash = a.row_hash and b.status = a.status then 'unchanged' when b.status = 'deactivated' and a.status <> 'deactivated' then 'deactivate' when b.status = 'active' and a.status = 'deactivated' then 'reactivate' else 'update' end as change_type from d b left join d a on a.npi = b.npi and a.seq + 1 = b.seq where b.seq > 1
union all select f.source_file, a.npi, 'absent_from_full' from d a join f on f.seq = a.seq + 1 where coalesce(a.effective_date, date '1900-01-01') <= f.e and not exists (select 1 from d b where b.npi = a.npi and b.seq = a.seq + 1)""")
def cdc_classify(t: Tables) -> DataFrame:
    """Changes of every applied full file against the one before it as the current state, absences included."""
    rows = materialize(scd2.dedupe_incoming(_typed(t), ("source_file", "npi")), "incoming")
    files = _applied(t)
    parts = []
    for a, b in zip(files, files[1:]):
        off = F.col("deactivation_date").isNotNull() & (F.col("reactivation_date").isNull() | (F.col("reactivation_date") < F.col("deactivation_date")))
        current = rows.where(F.col("source_file") == a["source_file"]).withColumns({"version": F.lit(1), "status": F.when(off, "deactivated").otherwise("active"), "valid_from": F.col("effective_date"), "file_end": F.lit(a["coverage_end"])})
        incoming = rows.where(F.col("source_file") == b["source_file"])
        found = scd2.classify(scd2.resolve(incoming, current), b["coverage_end"]).select("npi", "change_type")
        lost = scd2.gone(current, incoming, b["coverage_end"]).select("npi", F.lit(scd2.ABSENT).alias("change_type"))
        parts.append(found.unionByName(lost).select(F.lit(b["source_file"]).alias("source_file"), "npi", "change_type"))
    return reduce(DataFrame.unionByName, parts) if parts else rows.limit(0).select("source_file", "npi", F.lit("").alias("change_type"))


_SYNC = f"""with recursive {_FILES}, {_DEDUPED}, d as (select d0.*, f.seq from d0 join f using (source_file)),
k as (select distinct npi from d), g as (select k.npi, f.seq, f.e, f.source_file, d.npi is not null as given, d.effective_date as eff, d.row_hash as h, d.status as st from k cross join f left join d on d.npi = k.npi and d.seq = f.seq),
w as (select npi, cast(0 as bigint) as seq, 0 as version, cast(null as varchar) as h, cast(null as date) as eff, cast(null as varchar) as st, cast(null as date) as vf, cast(null as varchar) as kind, cast(null as varchar) as source_file from k
union all select n.npi, n.seq, case when opens then n.version + 1 else n.version end, case when opens and not lost then n.gh else n.h end, case when opens and not lost then n.geff else n.eff end, case when lost then 'absent_from_full' when opens then n.gst else n.st end,
case when lost then n.e when opens then case when n.st = 'absent_from_full' then greatest(n.geff, n.vf) else coalesce(n.geff, case when n.version > 0 then n.e end) end else n.vf end, n.kind, n.source_file from (
select *, kind = 'absent_from_full' as lost, kind in ('insert', 'update', 'deactivate', 'reactivate', 'absent_from_full') as opens from (
select w.npi, g.seq, g.e, g.source_file, w.version, w.h, w.eff, w.st, w.vf, g.h as gh, g.eff as geff, g.st as gst, case when not g.given then case when w.version > 0 and w.st <> 'absent_from_full' and coalesce(w.vf, date '1900-01-01') <= g.e then 'absent_from_full' else 'none' end
when w.version = 0 then 'insert' when coalesce(g.eff < w.eff, false) then 'stale' when g.h = w.h and g.st = w.st then 'unchanged' when g.st = 'deactivated' and w.st <> 'deactivated' then 'deactivate' when g.st = 'active' and w.st in ('deactivated', 'absent_from_full') then 'reactivate' else 'update' end as kind
from w join g on g.npi = w.npi and g.seq = w.seq + 1)) n)"""


def _synced(t: Tables) -> scd2.HistoryStore:
    rows = materialize(_typed(t), "typed")
    store = scd2.HistoryStore(t.spark, scratch_path(t.spark, "history"))
    for f in _applied(t):
        mine = rows.where(F.col("source_file") == f["source_file"]).drop("source_file")
        store.apply(scd2.Staged(f["source_file"], "full", f["coverage_end"], f["coverage_end"], mine))
    return store


@query(_SYNC + """, o as (select * from w where kind in ('insert', 'update', 'deactivate', 'reactivate', 'absent_from_full'))
select npi, version, status, change_type, valid_from, lead(valid_from) over (partition by npi order by version) as valid_to, lead(version) over (partition by npi order by version) is null as is_current, source_file from (select npi, version, st as status, kind as change_type, vf as valid_from, source_file from o)""")
def history_sync(t: Tables) -> DataFrame:
    """All applied snapshots merged one after the other into a type-2 history."""
    return _synced(t).history().select("npi", "version", "status", "change_type", "valid_from", "valid_to", "is_current", "source_file")


@query(_SYNC + """ select cast(w.seq as int) as seq, w.source_file, (select count(*) from nppes_full n where n.source_file = w.source_file) as rows, count(*) filter (where kind = 'insert') as inserted, count(*) filter (where kind = 'update') as updated, count(*) filter (where kind = 'deactivate') as deactivated, count(*) filter (where kind = 'reactivate') as reactivated, count(*) filter (where kind = 'unchanged') as unchanged, count(*) filter (where kind = 'stale') as stale_skipped, count(*) filter (where kind = 'absent_from_full') as absent_from_full from w where w.seq > 0 group by 1, 2""")
def history_ledger(t: Tables) -> DataFrame:
    """What each snapshot did to the history."""
    return _synced(t).ledger().select("seq", "source_file", "rows", "inserted", "updated", "deactivated", "reactivated", "unchanged", "stale_skipped", "absent_from_full")


@query("select w.source_file, w.coverage_end, w.coverage_end <= (select max(f.coverage_end) from file_log f where f.kind = 'full' and f.outcome = 'applied' and f.seq < w.seq) as superseded from file_log w where w.kind = 'weekly'")
def superseded_files(t: Tables) -> DataFrame:
    """Weekly files that an earlier applied full file covers."""
    return scd2.superseded(t.file_log)


# ---------------------------------------------------------------- gates


@query("select npi, version from (select npi, version, valid_to, lead(valid_from) over (partition by npi order by version) as nxt, lead(version) over (partition by npi order by version) as nv from provider_history) where nv is not null and valid_to is distinct from nxt")
def gate_history_gaps(t: Tables) -> DataFrame:
    return gates.history_gaps(t.provider_history, "npi")


@query("select npi, count(*) filter (where is_current) as current from provider_history group by 1 having count(*) filter (where is_current) <> 1")
def gate_one_current(t: Tables) -> DataFrame:
    return gates.one_current_version(t.provider_history, "npi")


@query("select charge_id, count(*) as n from fct_standard_charges group by 1 having count(*) > 1")
def gate_charge_grain(t: Tables) -> DataFrame:
    return gates.grain(t.fct_standard_charges, ["charge_id"])


@query("select source_sha256, template_version from stg_hpt__files where template_version is not null and template_version not in ('3.0.0')")
def gate_template_version(t: Tables) -> DataFrame:
    return gates.accepted(t.stg_hpt__files, "template_version", ["3.0.0"]).select("source_sha256", "template_version")


@query("select c.item_id, c.code_seq from dim_charge_codes c where not exists (select 1 from fct_standard_charges f where f.item_id = c.item_id)")
def gate_relationship(t: Tables) -> DataFrame:
    return gates.relationship(t.dim_charge_codes, "item_id", t.fct_standard_charges, "item_id").select("item_id", "code_seq")


@query("select seq, source_file from file_log where outcome = 'rejected_schema'")
def gate_rejected_files(t: Tables) -> DataFrame:
    return gates.no_outcome(t.file_log).select("seq", "source_file")


@query("select distinct source_sha256, npi from (select source_sha256, unnest(type_2_npis) as npi from stg_hpt__files) where npi is not null and not regexp_full_match(npi, '[0-9]{10}')")
def gate_identifier_format(t: Tables) -> DataFrame:
    n = t.stg_hpt__files.select("source_sha256", F.explode("type_2_npis").alias("npi"))
    return gates.matches(n, "npi", "[0-9]{10}").distinct()


@query("select npi, version from provider_history where valid_to < valid_from or (is_current and valid_to is not null) or (not is_current and valid_to is null)")
def gate_intervals_valid(t: Tables) -> DataFrame:
    return gates.intervals_valid(t.provider_history).select("npi", "version")


@query("select npi, count(*) as n, count(distinct version) as d, min(version) as low, max(version) as high from provider_history group by 1 having count(*) <> count(distinct version) or min(version) <> 1 or max(version) <> count(*)")
def gate_versions_dense(t: Tables) -> DataFrame:
    return gates.versions_dense(t.provider_history, "npi")


@query("select distinct b.npi, b.version from provider_history a join provider_history b on a.npi = b.npi and a.version < b.version and (b.valid_from is null or b.valid_from < coalesce(b.valid_to, date '9999-12-31')) and (a.valid_from is null or a.valid_from < coalesce(a.valid_to, date '9999-12-31')) and b.valid_from < coalesce(a.valid_to, date '9999-12-31')")
def gate_history_overlaps(t: Tables) -> DataFrame:
    return gates.history_overlaps(t.provider_history, "npi")


@query("select count(*) as n, count(distinct line_no) as d, min(line_no) as low, max(line_no) as high from nppes_changes having count(*) > 0 and (count(*) <> count(distinct line_no) or min(line_no) <> 1 or max(line_no) <> count(*))")
def gate_dense(t: Tables) -> DataFrame:
    return gates.dense(t.nppes_changes, "line_no")


@query("select source_sha256, count(*) as n from stg_hpt__files where source_sha256 is not null group by 1 having count(*) > 1")
def gate_unique(t: Tables) -> DataFrame:
    return gates.unique(t.stg_hpt__files, "source_sha256")


@query("select charge_id, loaded_at from fct_standard_charges where payer_name is null or negotiated_rate is null")
def gate_not_null(t: Tables) -> DataFrame:
    return gates.not_null(t.fct_standard_charges, "payer_name", "negotiated_rate").select("charge_id", "loaded_at")


_READ = problems.ORACLES["p1_found"].split("u as (select")[0].rstrip().rstrip(",")
_COUNTS = _READ + f""", bad as ({problems.ORACLES['p1_found']}), files as (select k.source_sha256, count(distinct k.record_no) as records_read, count(distinct bad.record_no) as quarantined_rows from k left join bad on bad.source_sha256 = k.source_sha256 and bad.record_no = k.record_no group by 1)"""


def _file_counts(t: Tables) -> tuple[DataFrame, DataFrame]:
    """(counts of each price file, its valid rows)."""
    rows = quarantine.read_permissive(t.hpt_csv_records)
    bad = quarantine.reclassify(rows).groupBy("source_sha256").agg(F.count(F.lit(1)).alias("quarantined_rows"))
    valid = quarantine.valid_rows(rows)
    good = valid.groupBy("hospital_id", "source_sha256").agg(F.count(F.lit(1)).alias("charge_rows"))
    files = good.join(bad, "source_sha256", "left").withColumn("quarantined_rows", F.coalesce("quarantined_rows", F.lit(0))).withColumn("records_read", F.col("charge_rows") + F.col("quarantined_rows"))
    return files, valid


@query(_COUNTS + " select source_sha256, records_read, quarantined_rows from files where quarantined_rows > records_read * 0.01")
def gate_quarantine_share(t: Tables) -> DataFrame:
    return gates.quarantine_share(_file_counts(t)[0]).select("source_sha256", "records_read", "quarantined_rows")


@query(_COUNTS + " select source_sha256, records_read from files where records_read = 0")
def gate_rows_kept(t: Tables) -> DataFrame:
    files, valid = _file_counts(t)
    return gates.rows_kept(files, valid).select("source_sha256", "records_read")


# ---------------------------------------------------------------- clinical


def _entries(t: Tables) -> DataFrame:
    rows = t.nested_records.where("record_kind = 'fhir_bundle'").select(F.col("record_id").cast("string").alias("bundle_sha256"), "body")
    return materialize(bundle_entries(rows), "entries")


_B = """b as (select cast(record_id as varchar) as bundle_sha256, case when json_valid(body) then cast(body as json) end as j from nested_records where record_kind = 'fhir_bundle'),
b1 as (select bundle_sha256, j, case when json_type(j -> '$.entry') = 'ARRAY' then cast(j -> '$.entry' as json[]) when json_type(j -> '$.entry') = 'OBJECT' then [j -> '$.entry'] else [] end as xs from b where json_type(j) = 'OBJECT' and j ->> '$.resourceType' = 'Bundle'),
b2 as (select bundle_sha256, unnest(xs) as x, unnest(range(len(xs))) as entry from b1),
e as (select bundle_sha256, entry, x, json_extract(x, '$.resource') as r, x ->> '$.resource.resourceType' as rt, case when json_type(x, '$.resource.id') = 'VARCHAR' then nullif(x ->> '$.resource.id', '') end as id, json_extract_string(x, '$.fullUrl') as url from b2 where json_type(x, '$.resource') = 'OBJECT' and json_type(x, '$.resource.resourceType') = 'VARCHAR')"""


def _at(x: str, paths: str, kind: str) -> str:
    one = lambda q: f"case when json_type({x}, '$.{q}') not in ('OBJECT', 'ARRAY', 'NULL') then json_extract_string({x}, '$.{q}') end"
    v = "coalesce(" + ", ".join(one(q) for q in paths.split("|")) + ")"
    if kind == "urn":
        return f"case when starts_with({v}, 'urn:uuid:') then substr({v}, 10) end"
    return f"try_cast({v} as {'double' if kind == 'double' else 'bigint'})" if kind in ("double", "long") else v


def _table_sql(name: str) -> str:
    types = ", ".join(f"'{x}'" for x, n in clinical.TABLE_OF.items() if n == name)
    cols = {c: _at("r", q, k) for c, q, k in clinical.PATHS[name]}
    if name == "organizations":
        cols["name"] = f"case when rt <> 'Practitioner' then {cols['name']} end"
    return f"with {_B} select bundle_sha256, id as resource_id, " + ", ".join(f'{v} as "{c}"' for c, v in cols.items()) + f" from e where rt in ({types})"


def _clinical_table(name: str) -> None:
    def run(t: Tables) -> DataFrame:
        return clinical.table(clinical.resources(_entries(t)), name).select("bundle_sha256", "resource_id", *[c for c, _, _ in clinical.PATHS[name]])

    run.__name__ = f"clinical_{name}"
    query(_table_sql(name))(run)


for _name in clinical.PATHS:
    if _name != "observations":
        _clinical_table(_name)

_ITEMS = "i0 as (select bundle_sha256, id as claim_id, unnest(case when json_type(r, '$.item') = 'ARRAY' then cast(json_extract(r, '$.item') as json[]) else [] end) as y from e where rt = 'Claim'), items as (select bundle_sha256, claim_id, " + ", ".join(f"{_at('y', q, k)} as {n}" for n, q, k in clinical.LINE_PATHS) + " from i0)"


@query(f"with {_B}, {_ITEMS} select * from items")
def clinical_claim_items(t: Tables) -> DataFrame:
    return clinical.claim_items(clinical.resources(_entries(t)))


_LEAVES = "l as (select e.bundle_sha256, e.entry, e.rt, e.id, j.key, j.type, json_extract_string(j.atom, '$') as v, substr(j.fullkey, 3) as path, regexp_replace(substr(j.fullkey, 3), '\\[[0-9]+\\]', '[]', 'g') as pattern, j.value as x from e, json_tree(e.r) j)"
_MAPPED = ", ".join(f"'{t} {p}'" for t, ps in sorted(clinical.mapped_paths().items()) for p in sorted(ps))
_MAPPING = f"m as (select rt as resource_type, pattern as path, count(*) as occurrences, rt || ' ' || pattern in ({_MAPPED}) as mapped, rt in ({', '.join(repr(x) for x in clinical.TABLE_OF)}) as modelled_type from l where type not in ('OBJECT', 'ARRAY') group by 1, 2)"


@query(f"with {_B}, {_LEAVES}, {_MAPPING} select * from m")
def clinical_mapping(t: Tables) -> DataFrame:
    return clinical.mapping(_entries(t))


_NEEDED = " union all ".join(f"select '{t}' as rt, '{m}' as need" for t, ms in clinical.REQUIRED.items() for m in ms)
_DATES = ", ".join(f"'{m}'" for m in clinical.DATE_MEMBERS)
_ISSUES = f"""n as ({_NEEDED}), s as (
select bundle_sha256, case when json_type(j, '$.resourceType') = 'VARCHAR' then j ->> '$.resourceType' end as resource_type, cast(null as varchar) as resource_id, 'not_a_bundle' as kind, '' as detail from b where not coalesce(json_type(j) = 'OBJECT' and j ->> '$.resourceType' = 'Bundle', false)
union all select bundle_sha256, '?', null, 'entry_without_resource', 'entry ' || entry from b2 where not coalesce(json_type(x, '$.resource') = 'OBJECT' and json_type(x, '$.resource.resourceType') = 'VARCHAR', false)
union all select bundle_sha256, rt, null, 'missing_id', 'entry ' || entry from e where id is null
union all select bundle_sha256, e.rt, id, 'missing_required', need from e join n on n.rt = e.rt where not list_contains(json_keys(r), need)
union all select bundle_sha256, rt, id, 'coding_without_system_or_code', left(pattern, 200) from l where type = 'OBJECT' and regexp_full_match(path, '(.*\\.)?coding\\[[0-9]+\\]') and (coalesce({_at('x', 'system', 'string')}, '') = '' or coalesce({_at('x', 'code', 'string')}, '') = '')
union all select bundle_sha256, rt, id, 'unparseable_date', left(pattern || '=' || v, 200) from l where key in ({_DATES}) and type = 'VARCHAR' and not ends_with(path, ']') and not regexp_full_match(v, '{clinical.DATE[1:-2]}'))"""


@query(f"with {_B}, {_LEAVES}, {_ISSUES} select resource_type, kind, detail, count(*) as n from s group by all")
def clinical_issues(t: Tables) -> DataFrame:
    return clinical.issues(_entries(t)).groupBy("resource_type", "kind", "detail").agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {_B}, {_LEAVES}, {_MAPPING}, {_ISSUES}, c as (select rt as resource_type, count(*) as resources from e group by 1), g as (select resource_type, bool_or(modelled_type) as modelled, count(*) as leaf_paths, count(*) filter (where mapped) as mapped_paths, sum(occurrences) as a, sum(occurrences) filter (where mapped) as r from m group by 1), i as (select resource_type, count(*) as n from s group by 1)
select resource_type, resources, coalesce(modelled, false) as modelled, leaf_paths, coalesce(mapped_paths, 0) as mapped_paths, round(coalesce(r, 0)::double / a, 4) as mapped_value_share, coalesce(i.n, 0) as structural_issues from c left join g using (resource_type) left join i using (resource_type)""")
def clinical_summary(t: Tables) -> DataFrame:
    e = _entries(t)
    return clinical_marts.summary(clinical.resources(e).select("resource_type"), clinical.mapping(e), clinical.issues(e))


_ORGS = f"""o0 as (select rt, id, unnest(case when json_type(r, '$.identifier') = 'ARRAY' then cast(json_extract(r, '$.identifier') as json[]) else [] end) as y from e where rt in ('Organization', 'Location', 'Practitioner')),
o as (select distinct rt || '?identifier={clinical.SYNTHETIC_SYSTEM}|' || (y ->> '$.value') as target from o0 where contains(coalesce(y ->> '$.system', ''), 'synthea') union select rt || '?identifier={clinical.NPI_SYSTEM}|' || (y ->> '$.value') from o0 where y ->> '$.system' = '{clinical.NPI_SYSTEM}')"""
_REFS = f"""{_ORGS}, q as (select bundle_sha256, entry, rt as resource_type, v as target, case when starts_with(v, '#') then 'contained' when starts_with(v, 'urn:uuid:') then 'bundle_urn' when regexp_full_match(v, '([A-Za-z]+)\\?identifier=([^|]+)\\|(.+)') then 'conditional_identifier' else 'other' end as kind from l where key = 'reference' and type = 'VARCHAR' and not ends_with(path, ']')),
h as (select q.*, case kind when 'contained' then exists (select 1 from l where l.bundle_sha256 = q.bundle_sha256 and l.entry = q.entry and l.pattern = 'contained[].id' and l.type = 'VARCHAR' and '#' || l.v = q.target) when 'bundle_urn' then exists (select 1 from e where e.bundle_sha256 = q.bundle_sha256 and e.url = q.target) when 'conditional_identifier' then exists (select 1 from o where o.target = q.target) else false end as resolved from q)"""


@query(f"with {_B}, {_LEAVES}, {_REFS} select resource_type, kind, resolved, count(*) as n from h group by all")
def clinical_references(t: Tables) -> DataFrame:
    e = _entries(t)
    r = clinical.references(e, clinical.table(clinical.resources(e), "organizations"))
    return r.groupBy("resource_type", "kind", "resolved").agg(F.count(F.lit(1)).alias("n"))


@query(f"with {_B}, {_LEAVES}, {_REFS} select resource_type, kind, count(*) as n, min(target) as example from h where not resolved group by all")
def gate_references(t: Tables) -> DataFrame:
    e = _entries(t)
    return gates.references_resolve(clinical.references(e, clinical.table(clinical.resources(e), "organizations")))


_CLAIMS = f"claims as (select id as resource_id, {_at('r', 'type.coding[0].code', 'string')} as claim_type, {_at('r', 'total.value', 'double')} as total from e where rt = 'Claim')"


@query(f"""with {_B}, {_ITEMS}, {_CLAIMS}, g as (select claim_id, count(*) as lines, count(net) as priced, sum(cast(round(net * 100) as bigint)) as cents from items group by 1), c as (select claims.*, cast(round(total * 100) as bigint) as head, g.* from claims left join g on g.claim_id = claims.resource_id)
select claim_type, count(*) as claims, cast(coalesce(sum(lines), 0) as bigint) as lines, cast(coalesce(sum(priced), 0) as bigint) as priced_lines, count(*) filter (where not coalesce(priced > 0, false)) as claims_without_priced_lines, count(*) filter (where priced > 0 and head = cents) as header_equals_lines, count(*) filter (where priced > 0 and head > cents) as header_above_lines, count(*) filter (where priced > 0 and head < cents) as header_below_lines, cast(coalesce(sum(head), 0) as bigint) as header_cents, cast(coalesce(sum(cents), 0) as bigint) as lines_cents from c group by 1""")
def claim_totals(t: Tables) -> DataFrame:
    res = clinical.resources(_entries(t))
    return clinical_marts.claim_totals(clinical.table(res, "claims"), clinical.claim_items(res))


@query(f"""with {_B}, {_ITEMS}, {_CLAIMS}, x as (select i.* from items i join claims c on c.resource_id = i.claim_id), k as (select distinct upper(code) as code, hospital_id from dim_charge_codes where code_family = 'CDT'), z as (select x.code_system, count(distinct (x.claim_id, x.sequence)) as a, count(distinct x.code) as b, count(distinct k.hospital_id) as c from x join k on k.code = upper(x.code) where x.code_system = '{clinical_marts.SHARED_SYSTEM}' group by 1)
select y.code_system, claim_lines, distinct_codes, case when y.code_system = '{clinical_marts.SHARED_SYSTEM}' then 'CDT' end as shared_with_price_files, coalesce(z.a, 0) as lines_with_a_price_file_code, coalesce(z.b, 0) as codes_with_a_price_file_code, coalesce(z.c, 0) as hospitals_with_those_codes from (select code_system, count(*) as claim_lines, count(distinct code) as distinct_codes from x group by 1) y left join z using (code_system)""")
def code_bridge(t: Tables) -> DataFrame:
    res = clinical.resources(_entries(t))
    lines = clinical_marts.claim_lines(clinical.claim_items(res), clinical.table(res, "claims"), clinical.table(res, "organizations"))
    return clinical_marts.code_bridge(lines, t.dim_charge_codes)


@query(f"""with {_B}, {_ITEMS}, {_CLAIMS}, x as (select {_at('r', 'claim.reference', 'urn')} as claim_id, {_at('r', 'total[0].amount.value', 'double')} as amount from e where rt = 'ExplanationOfBenefit'), y as (select * from x where claim_id is not null)
select 'claim_without_lines' as problem, resource_id as claim_id from claims c where not exists (select 1 from items i where i.claim_id = c.resource_id) union all select 'line_without_claim', claim_id from items i where not exists (select 1 from claims c where c.resource_id = i.claim_id) union all select 'claim_without_explanation', resource_id from claims c where not exists (select 1 from y where y.claim_id = c.resource_id)
union all select 'explanation_without_claim', claim_id from y where not exists (select 1 from claims c where c.resource_id = y.claim_id) union all select 'claim_twice', resource_id from claims group by resource_id having count(*) > 1 union all select 'totals_differ', c.resource_id from claims c join y on y.claim_id = c.resource_id where abs(c.total - y.amount) > 0.005""")
def gate_claims(t: Tables) -> DataFrame:
    res = clinical.resources(_entries(t))
    return gates.claims_match(clinical.table(res, "claims"), clinical.claim_items(res), clinical.table(res, "eobs"))


@query(f"""with {_B}, {_LEAVES}, {_ISSUES} select 'envelope' as problem, kind as what, count(*) as n from s where kind in ('not_a_bundle', 'entry_without_resource', 'missing_id') group by 2
union all select 'listed_twice', rt || '/' || id, count(*) from e where id is not null group by bundle_sha256, rt, id having count(*) > 1""")
def gate_bundles(t: Tables) -> DataFrame:
    e = _entries(t)
    res = clinical.resources(e)
    tables = {rt: clinical.table(res.where(F.col("resource_type") == rt), n) for rt, n in clinical.TABLE_OF.items()}
    return gates.bundles_intact(res, tables, clinical.issues(e))


@query("""with b as (select record_id, try_cast(body as json) as j from nested_records where record_kind = 'fhir_bundle'), e as (select record_id, unnest(case when json_type(j -> '$.entry') = 'ARRAY' then cast(j -> '$.entry' as json[]) when json_type(j -> '$.entry') = 'OBJECT' then [j -> '$.entry'] else [] end) as x from b where j is not null and json_type(j) = 'OBJECT' and j ->> '$.resourceType' = 'Bundle')
select cast(record_id as varchar) as bundle_sha256, x ->> '$.resource.id' as resource_id, x ->> '$.resource.status' as status, x ->> '$.resource.code.coding[0].code' as code, try_cast(x ->> '$.resource.valueQuantity.value' as double) as value_number from e where x ->> '$.resource.resourceType' = 'Observation'""")
def clinical_observations(t: Tables) -> DataFrame:
    return clinical.table(clinical.resources(_entries(t)), "observations").select("bundle_sha256", "resource_id", "status", "code", "value_number")


@query("""with v as (select case when json_valid(body) then body end as body from nested_records where record_kind = 'hpt_file') select regexp_replace(substr(j.fullkey, 3), '\\[[0-9]+\\]', '[]', 'g') as pattern, case j.type when 'VARCHAR' then 'string' when 'BOOLEAN' then 'boolean' when 'NULL' then 'null' else 'number' end as json_type, count(*) as n from v, json_tree(v.body) j where v.body is not null and j.type not in ('OBJECT', 'ARRAY') group by 1, 2""")
def leaf_paths(t: Tables) -> DataFrame:
    """Every leaf path of the price-file headers with its types."""
    rows = t.nested_records.where("record_kind = 'hpt_file'")
    return nested.json_triples(rows, "record_id", "body").groupBy("pattern", "json_type").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- identity and analysis


_NORM = "array_to_string(list_filter(string_split(regexp_replace(replace(upper({x}), '&', ' AND '), '[^A-Z0-9]+', ' ', 'g'), ' '), lambda w: w not in ('', 'THE', 'OF', 'AND', 'INC', 'LLC')), ' ')"
_TOKENS = "list_filter(string_split(trim(regexp_replace(upper({x}), '[^A-Z0-9]+', ' ', 'g')), ' '), lambda w: w <> '')"
_KEY = "case when regexp_full_match(tok[1], '[0-9]+') then tok[1] || ' ' || coalesce(list_filter(tok[2:], lambda x: x not in ('N', 'S', 'E', 'W', 'NORTH', 'SOUTH', 'EAST', 'WEST'))[1], '') || ' ' || zip5 end"
_IDENTITY = f"""i as (select distinct hospital_id, source_sha256, hospital_name, location_names, hospital_addresses, type_2_npis from stg_hpt__files),
names as (select distinct hospital_id, source_sha256, {_NORM.format(x='s')} as ref from (select hospital_id, source_sha256, unnest(list_concat([hospital_name], coalesce(location_names, []))) as s from i) where s is not null),
a0 as (select hospital_id, source_sha256, regexp_extract(a, '([0-9]{{5}})(-[0-9]{{4}})?\\s*$', 1) as zip5, {_TOKENS.format(x='a')} as tok from (select hospital_id, source_sha256, unnest(hospital_addresses) as a from i) where a is not null),
keys as (select distinct hospital_id, source_sha256, {_KEY} as k from a0), zips as (select distinct hospital_id, source_sha256, zip5 from a0)"""


@query(f"""with {_IDENTITY}, d as (select i.hospital_id, i.source_sha256, n.npi, n.day from i join (select distinct hospital_id, source_sha256, unnest(type_2_npis) as npi, coalesce(try_cast(try_strptime(trim(last_updated_on), '%m/%d/%Y') as date), try_cast(trim(last_updated_on) as date)) as day from stg_hpt__files) n using (hospital_id, source_sha256)),
l as (select npi, unnest(string_split('80840' || npi, '')) as c, unnest(range(15, 0, -1)) as place from (select distinct npi from d) where regexp_full_match(npi, '[0-9]{{10}}')), g as (select npi, sum(case when place % 2 = 1 then c::int else (2 * c::int) // 10 + (2 * c::int) % 10 end) % 10 = 0 as good from l group by npi)
select distinct d.hospital_id, d.source_sha256, d.npi, d.day as file_date, regexp_full_match(d.npi, '[0-9]{{10}}') as format_ok, coalesce(g.good, false) as check_digit_ok, p.npi is not null as in_registry, p.status, h.status as status_as_of_file_date from d left join g on g.npi = d.npi left join (select * from provider_history where is_current) p on p.npi = d.npi
left join provider_history h on h.npi = d.npi and d.day >= coalesce(h.valid_from, date '0001-01-01') and d.day < coalesce(h.valid_to, date '9999-12-31')""")
def identifier_resolution(t: Tables) -> DataFrame:
    """Each identifier a file discloses with its checks, its registry row and its status on the file's date."""
    h = t.provider_history
    r = identity.resolution(identity.identity(t.stg_hpt__files), h.where("is_current"), h)
    return r.select("hospital_id", "source_sha256", "npi", "file_date", "format_ok", "check_digit_ok", "in_registry", "status", "status_as_of_file_date").distinct()


@query(f"""with {_IDENTITY}, p0 as (select npi, org_name, left(practice_postal, 5) as zip5, {_TOKENS.format(x='practice_address_1')} as tok, {_NORM.format(x='org_name')} as name from provider_history where is_current and status = 'active' and entity_type = '2'), p as (select *, {_KEY} as k from p0)
select z.hospital_id, p.npi, z.zip5, round(max(jaro_winkler_similarity(p.name, n.ref)), 9) as name_similarity, bool_or(coalesce(exists (select 1 from keys where keys.hospital_id = z.hospital_id and keys.source_sha256 = z.source_sha256 and keys.k = p.k), false)) as address_match from zips z join p on p.zip5 = z.zip5 left join names n on n.hospital_id = z.hospital_id and n.source_sha256 = z.source_sha256 where z.zip5 <> '' group by 1, 2, 3 having max(jaro_winkler_similarity(p.name, n.ref)) >= 0.4 or bool_or(exists (select 1 from keys where keys.hospital_id = z.hospital_id and keys.source_sha256 = z.source_sha256 and keys.k = p.k))""")
def identity_candidates(t: Tables) -> DataFrame:
    """Registry rows of any kind in a hospital's ZIP codes that are like it in name or address."""
    c = identity.candidates(identity.identity(t.stg_hpt__files), t.provider_history.where("is_current"), 0.4, hospitals_only=False)
    return c.select("hospital_id", "npi", "zip5", F.round("name_similarity", 9).alias("name_similarity"), "address_match")


@query("""with k as (select distinct item_id, code from dim_charge_codes where code_family = 'CPT_CAT_I'), m as (select c.hospital_id, k.code, median(c.gross_charge) as gross, median(c.discounted_cash) as cash, count(*) as rows from fct_standard_charges c join k using (item_id) where c.setting in ('outpatient', 'both') and c.description not ilike '%unlisted%' group by 1, 2)
select hospital_id, code, round(gross, 4) as gross, round(cash, 4) as cash, rows from m""")
def medians_per_code(t: Tables) -> DataFrame:
    m = analysis.per_code(_comparable(t))
    return m.withColumn("gross", F.round("gross", 4)).withColumn("cash", F.round("cash", 4))


def _comparable(t: Tables) -> DataFrame:
    return analysis.comparable(t.fct_standard_charges, t.dim_charge_codes.select("item_id", "code", "code_family"), "CPT_CAT_I", F.col("setting").isin("outpatient", "both") & ~F.col("description").ilike("%unlisted%"))


@query("""with k as (select distinct item_id, code from dim_charge_codes where code_family = 'CPT_CAT_I'), p as (select c.hospital_id, k.code, c.payer_name, median(c.negotiated_rate) as rate from fct_standard_charges c join k using (item_id) where c.setting in ('outpatient', 'both') and c.description not ilike '%unlisted%' and c.negotiated_rate > 0 group by all), w as (select hospital_id, code, count(*) as payers, max(rate) / min(rate) as ratio from p group by 1, 2 having count(*) >= 3)
select count(*) as codes, round(quantile_cont(ratio, 0.25), 6) as p25, round(median(ratio), 6) as median, round(quantile_cont(ratio, 0.75), 6) as p75, round(quantile_cont(ratio, 0.9), 6) as p90, count(*) filter (where ratio >= 2) as at_least_2, count(*) filter (where ratio >= 3) as at_least_3 from w""")
def spread_within(t: Tables) -> DataFrame:
    return analysis.distribution(analysis.within(analysis.payer_rates(_comparable(t))))


@query("select hospital_id, round(median(discounted_cash / gross_charge), 6) as cash_to_gross, round(avg(case when discounted_cash = gross_charge then 1.0::double else 0.0::double end), 6) as share_equal from fct_standard_charges where gross_charge > 0 and discounted_cash is not null group by 1")
def cash_policy(t: Tables) -> DataFrame:
    return analysis.cash_policy(t.fct_standard_charges)


@query("select hospital_id, payer_name, count(*) as rows from fct_standard_charges where negotiated_rate = gross_charge group by 1, 2")
def list_equals_rate(t: Tables) -> DataFrame:
    return analysis.list_equals_rate(t.fct_standard_charges)


@query("""with m as (select hospital_id, item_id, median(gross_charge) as v from fct_standard_charges where gross_charge > 0 group by 1, 2), r as (select item_id, max(v) / min(v) as ratio from m group by 1)
select cast((ratio >= 1.0)::int + (ratio >= 1.25)::int + (ratio >= 1.5)::int + (ratio >= 1.75)::int + (ratio >= 2.0)::int + (ratio >= 2.5)::int + (ratio >= 3.0)::int + (ratio >= 4.0)::int + (ratio >= 5.0)::int + (ratio >= 10.0)::int as int) as bin, count(*) as n from r group by 1""")
def ratio_histogram(t: Tables) -> DataFrame:
    m = t.fct_standard_charges.where("gross_charge > 0").groupBy("hospital_id", "item_id").agg(F.median("gross_charge").alias("v"))
    return analysis.ratio_histogram(m.groupBy("item_id").agg((F.max("v") / F.min("v")).alias("ratio")))


@query("""select hospital_id, source_sha256, kind, n from (select hospital_id, source_sha256, type_conflict as kind, count(*) as n from (select distinct f.hospital_id, f.source_sha256, c.item_id, c.code_seq, c.type_conflict from dim_charge_codes c join fct_standard_charges f using (item_id) where c.type_conflict is not null) group by 1, 2, 3)""")
def conformance_by_file(t: Tables) -> DataFrame:
    c = t.dim_charge_codes.where("type_conflict is not null").select("item_id", "code_seq", F.col("type_conflict").alias("kind"))
    files = t.fct_standard_charges.select("hospital_id", "source_sha256", "item_id").distinct()
    return c.join(files, "item_id").distinct().groupBy("hospital_id", "source_sha256", "kind").agg(F.count(F.lit(1)).alias("n"))


@query("select source_sha256, hospital_id, count(*) as rows from fct_standard_charges c where not exists (select 1 from stg_hpt__files f where f.source_sha256 = c.source_sha256) group by 1, 2")
def charges_without_file(t: Tables) -> DataFrame:
    return t.fct_standard_charges.join(t.stg_hpt__files, "source_sha256", "left_anti").groupBy("source_sha256", "hospital_id").agg(F.count(F.lit(1)).alias("rows"))


@query("select c.* exclude (source_last_updated_on), f.hospital_name, f.day as source_last_updated_on from fct_standard_charges c join (select hospital_id, source_sha256, min(hospital_name) as hospital_name, min(last_updated_on) as day from stg_hpt__files group by 1, 2) f using (hospital_id, source_sha256)")
def charges_with_file(t: Tables) -> DataFrame:
    charges = t.fct_standard_charges.drop("source_last_updated_on").withColumn("count_raw", F.lit(None).cast("string"))
    return prices.standard_charges(charges, t.stg_hpt__files)


@query("""with d as (select f.hospital_id, f.source_sha256, c.type_conflict as kind, count(*) as n from (select distinct hospital_id, source_sha256, item_id from fct_standard_charges) f join (select distinct item_id, code_seq, type_conflict from dim_charge_codes where type_conflict is not null) c using (item_id) group by 1, 2, 3), r as (select hospital_id, source_sha256, count(*) as records from fct_standard_charges group by 1, 2), f as (select hospital_id, source_sha256, min(hospital_name) as hospital_name from stg_hpt__files group by 1, 2)
select hospital_id, hospital_name, source_sha256, kind, '' as column, n, round(n::double / records, 6) as share_of_records from d join f using (hospital_id, source_sha256) join r using (hospital_id, source_sha256)""")
def conformance_report(t: Tables) -> DataFrame:
    """Conflicts of code types by file, as the report of sources has them."""
    c = t.dim_charge_codes.where("type_conflict is not null").select("item_id", "code_seq", F.col("type_conflict").alias("kind")).distinct()
    items = t.fct_standard_charges.select("hospital_id", "source_sha256", "item_id").distinct()
    drift = c.join(items, "item_id").groupBy("hospital_id", "source_sha256", "kind").agg(F.count(F.lit(1)).alias("n"), F.min("item_id").alias("first_locator"), F.lit(None).cast("string").alias("sample_value")).withColumn("column", F.lit(""))
    records = t.fct_standard_charges.groupBy("hospital_id", "source_sha256").agg(F.count(F.lit(1)).alias("records_read"))
    files = t.stg_hpt__files.select("hospital_id", "source_sha256", "hospital_name").join(records, ["hospital_id", "source_sha256"])
    return prices.conformance(drift, files).drop("first_locator", "sample_value")


# the same query under the name by which its test knows it
QUERIES["cdc_classify_all"], ORACLES["cdc_classify_all"] = QUERIES["cdc_classify"], ORACLES["cdc_classify"]
