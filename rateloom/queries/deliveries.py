"""Queries over the file sources: the tables are written out as the files they came in, and read back by the sources."""

from __future__ import annotations

import glob
import os
import zipfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import quarantine, staging
from ..plans.materialize import local_path, scratch_path
from ..sources import records, registry
from . import pipelines, problems
from .registry import Registry, Tables

_r = Registry()
query = _r.query
QUERIES, ORACLES = _r.queries, _r.oracles


def write_files(df: DataFrame, member: str | None = None) -> list[str]:
    """Write (name, no, text) as files of the shared folder, lines in the order of no; with a member name as archives of it."""
    folder = scratch_path(df.sparkSession, "delivered")
    if not folder.startswith(("/", "file:")):
        raise RuntimeError("files are delivered into a mounted folder only")
    folder = local_path(folder)
    os.makedirs(folder, exist_ok=True)

    def run(batches):
        import pandas as pd

        now, archive, out = None, None, None
        for b in batches:
            for name, text in zip(b["name"], b["text"]):
                if name != now:
                    for x in (out, archive):
                        x.close() if x else None
                    archive = zipfile.ZipFile(f"{folder}/{name}", "w", zipfile.ZIP_DEFLATED) if member else None
                    now, out = name, archive.open(member, "w") if archive else open(f"{folder}/{name}", "wb")
                out.write((text + "\n").encode())
        for x in (out, archive):
            x.close() if x else None
        yield pd.DataFrame({"n": [1]})

    df.select("name", "no", "text").repartition("name").sortWithinPartitions("name", "no").mapInPandas(run, "n int").count()
    return sorted(glob.glob(f"{folder}/*"))


def _name(column: str = "path"):
    return F.element_at(F.split(column, "/"), -1).alias("name")


@query(f"""with q as (select source_sha256 as name, record_no, min(raw_record) as raw from hpt_csv_records where regexp_full_match(raw_record, '{problems._CELL}(,{problems._CELL})*') group by 1, 2), n as (select name, row_number() over (partition by name order by record_no) as record_no, raw from q),
c as (select name, record_no, case when raw = '' then [] else {problems._CELLS.format(x="case when record_no = 1 then ltrim(raw, chr(65279)) else raw end")} end as cells from n)
select name, record_no, cast(len(cells) as int) as n_cells, md5(array_to_string(cells, chr(31))) as hash from c""")
def csv_files_scan(t: Tables) -> DataFrame:
    """Well-quoted records as files of their own and back, with their numbers and cells."""
    ok = t.hpt_csv_records.where("raw_record is not null").where(quarantine.well_quoted(quarantine.quote_pieces(F.col("raw_record"))))
    rows = ok.groupBy(F.col("source_sha256").alias("name"), F.col("record_no").alias("no")).agg(F.min("raw_record").alias("text")).where("name is not null")
    r = records.read_delimited(t.spark, write_files(rows))
    return r.select(_name(), "record_no", F.size("cells").alias("n_cells"), F.md5(F.array_join("cells", "\x1f")).alias("hash"))


_ARRAY = staging.ARRAY
_BODIES = f"v as (select cast(record_id as varchar) as name, body from nested_records where record_kind = 'hpt_file' and json_valid(body))"


def _bodies(t: Tables) -> DataFrame:
    """Items and members of the valid price-file headers, each a file."""
    v = t.nested_records.where("record_kind = 'hpt_file'").where(F.try_parse_json("body").isNotNull())
    return records.read_json_items(t.spark, write_files(v.select(F.col("record_id").cast("string").alias("name"), F.lit(0).alias("no"), F.col("body").alias("text"))), _ARRAY)


@query(f"""with {_BODIES}, k as (select name, unnest(json_keys(body)) as key, body from v where json_type(body) = 'OBJECT')
select name, 'member' as kind, count(*) as n from k where key <> '{_ARRAY}' group by 1 union all select name, 'item', cast(json_array_length(body, '$.{_ARRAY}') as bigint) from v where json_type(body, '$.{_ARRAY}') = 'ARRAY' and json_array_length(body, '$.{_ARRAY}') > 0
union all select name, 'no_array', 1 from v where json_type(body) = 'OBJECT' and json_type(body, '$.{_ARRAY}') <> 'ARRAY' union all select name, 'no_object', 1 from v where json_type(body) <> 'OBJECT'""")
def json_files_scan(t: Tables) -> DataFrame:
    return _bodies(t).groupBy(_name(), "kind").agg(F.count(F.lit(1)).alias("n"))


def _number(x: str, key: str) -> str:
    return f"case when json_type({x}, '$.{key}') in ('BIGINT', 'UBIGINT', 'HUGEINT', 'DOUBLE', 'VARCHAR') then try_cast(trim(json_extract_string({x}, '$.{key}')) as double) end"


@query(f"""with {_BODIES}, i as (select unnest(cast(json_extract(body, '$.{_ARRAY}') as json[])) as x from v where json_type(body, '$.{_ARRAY}') = 'ARRAY'), c as (select unnest(cast(json_extract(x, '$.standard_charges') as json[])) as y from i where json_type(x) = 'OBJECT' and json_type(x, '$.standard_charges') = 'ARRAY'),
p as (select y, unnest(case when json_type(y, '$.payers_information') = 'ARRAY' and json_array_length(y, '$.payers_information') > 0 then cast(json_extract(y, '$.payers_information') as json[]) else [null] end) as z from c where json_type(y) = 'OBJECT'),
r as (select case when lower(trim(json_extract_string(y, '$.setting'))) in ('inpatient', 'outpatient', 'both') then lower(trim(json_extract_string(y, '$.setting'))) end as setting, {_number('y', 'gross_charge')} as gross, {_number('z', 'standard_charge_dollar')} as rate, nullif(trim(json_extract_string(z, '$.payer_name')), '') as payer from p)
select setting, count(*) as n, count(payer) as payers, sum(cast(round(gross * 100) as bigint)) as gross_cents, sum(cast(round(rate * 100) as bigint)) as rate_cents from r group by 1""")
def json_items_staged(t: Tables) -> DataFrame:
    """Charges of the price files' items by setting."""
    rows = staging.parse_items(_bodies(t).where("kind = 'item'").select("position", "json")).where("kind = 'charge'").select("fields.*")
    cents = lambda c: F.sum(F.round(F.col(c) * 100).cast("long"))
    return rows.groupBy("setting").agg(F.count(F.lit(1)).alias("n"), F.count("payer_name").alias("payers"), cents("gross_charge").alias("gross_cents"), cents("negotiated_dollar").alias("rate_cents"))


@query(f"""with {_BODIES}, m as (select name, unnest(cast(json_extract(body, '$.modifier_information') as json[])) as x, unnest(range(cast(json_array_length(body, '$.modifier_information') as bigint))) as i from v where json_type(body, '$.modifier_information') = 'ARRAY'),
p as (select name, i, x, unnest(case when json_type(x, '$.modifier_payer_information') = 'ARRAY' and len(os) > 0 then os else [null] end) as z from (select *, list_filter(cast(case when json_type(x, '$.modifier_payer_information') = 'ARRAY' then json_extract(x, '$.modifier_payer_information') else '[]' end as json[]), lambda o: json_type(o) = 'OBJECT') as os from m where json_type(x) = 'OBJECT'))
select json_extract_string(x, '$.code') as code, json_extract_string(z, '$.payer_name') as payer_name, count(*) as n from p group by 1, 2""")
def modifiers_staged(t: Tables) -> DataFrame:
    return staging.parse_modifiers(_bodies(t).where((F.col("kind") == "member") & (F.col("name") == staging.MODIFIERS))).groupBy("code", "payer_name").agg(F.count(F.lit(1)).alias("n"))


@query(f"with {pipelines._TYPED} select source_file, coalesce(npi, '') as npi, primary_taxonomy, effective_date, row_hash, bad_date from t where source_file is not null")
def archives_scan(t: Tables) -> DataFrame:
    """The registry's snapshots as zipped files and back, typed."""
    columns = list(registry.HEADERS.values())
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    lines = pipelines._raw(t).where("source_file is not null").select(F.col("source_file").alias("name"), F.lit(1).alias("no"), F.concat_ws(",", *[quoted(F.col(c)) for c in columns]).alias("text"))
    head = lines.select("name", F.lit(0).alias("no"), F.lit(",".join(f'"{h}"' for h in registry.HEADERS)).alias("text")).distinct()
    found = write_files(head.unionByName(lines), "npidata_pfile_20250101-20250107.csv")
    out = None
    for path in found:
        rows = registry.typed(registry.read_archive(t.spark, path)).select(F.lit(os.path.basename(path)).alias("source_file"), "npi", "primary_taxonomy", "effective_date", "row_hash", "bad_date")
        out = rows if out is None else out.unionByName(rows)
    return out if out is not None else t.nppes_full.limit(0).selectExpr("source_file", "npi", "npi as primary_taxonomy", "current_date() as effective_date", "npi as row_hash", "true as bad_date")
