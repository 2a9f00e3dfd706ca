"""Price files to staged tables: typed charges, codes, modifiers, what was set aside, what drifted.

A file is parsed once into records, which are written aside; every table is a projection of them.
What does not fit is recorded, never dropped: cells that are no number or no allowed value become
null and a drift entry, unknown columns go to unmapped_json, records of another width are quarantined.
Drift entries are made as arrays beside the rows and aggregated by (kind, column) with the first
locator and sample in record order.

Rules of the price domain (which rate applies, what a zero count means, families of codes) are left out
on purpose; the raw values they need are all kept.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import parse_number, variant_number, variant_text
from ..functions.text import clean, norm_enum
from ..plans.materialize import Manifests, hadoop_fs
from ..schemas import STAGED
from ..sources.landing import Landed, has_bom
from ..sources.records import read_delimited, read_json_items
from .quarantine import TALL_SCHEMA
from .relational import first_seen

# Header members known of the two formats, and what a file must have.
META_COLUMNS = ("hospital_name", "last_updated_on", "version", "location_name", "hospital_address", "type_2_npi", "attester_name", "financial_aid_policy", "general_contract_provisions")
META_REQUIRED = ("hospital_name", "last_updated_on", "version", "attestation", "location_name", "hospital_address", "type_2_npi")
ATTESTATION = "to the best of its knowledge and belief"
ITEM_MEMBERS = ("description", "drug_information", "code_information", "standard_charges")
CHARGE_MEMBERS = ("setting", "gross_charge", "discounted_cash", "minimum", "maximum", "modifier_code", "payers_information", "additional_generic_notes", "billing_class")
PAYER_MEMBERS = ("payer_name", "plan_name", "additional_payer_notes", "standard_charge_dollar", "standard_charge_algorithm", "standard_charge_percentage", "median_amount", "10th_percentile", "90th_percentile", "count", "methodology")
ARRAY, MODIFIERS = "standard_charge_information", "modifier_information"
ENUMS = {r.name: list(r.allowed) for r in TALL_SCHEMA if r.kind == "enum"}
OPTIONAL = ("billing_class",)
_CODE = re.compile(r"code\|(\d+)(\|type)?")
#: Staged column by tall column, where the names differ.
TALL_NAMES = {"standard_charge|gross": "gross_charge", "standard_charge|discounted_cash": "discounted_cash", "standard_charge|negotiated_dollar": "negotiated_dollar", "standard_charge|negotiated_percentage": "negotiated_percentage", "standard_charge|negotiated_algorithm": "negotiated_algorithm", "standard_charge|methodology": "methodology", "standard_charge|min": "min_charge", "standard_charge|max": "max_charge", "10th_percentile": "p10_amount", "90th_percentile": "p90_amount", "count": "count_raw"}


def _entry(kind: str | Column, column: str | Column, sample: Column | None = None) -> Column:
    col = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.struct(col(kind).alias("kind"), col(column).alias("column"), (F.lit(None).cast("string") if sample is None else sample.cast("string")).alias("sample"))


def _header_name(text: str) -> str:
    return re.sub(r"\s*\|\s*", "|", text.strip().lower())


def number_cell(raw: Column, column: str) -> tuple[Column, list[Column]]:
    """(value, drift): a bare number; others are null and recorded, numbers not above zero kept and recorded."""
    n = parse_number(raw)
    return n["value"], [F.when(~n["ok"], _entry("unparseable_numeric", column, raw)), F.when(n["value"] <= 0, _entry("nonpositive_numeric", column, n["value"]))]


def enum_cell(raw: Column, column: str, allowed: list[str]) -> tuple[Column, list[Column]]:
    e = norm_enum(raw, allowed)
    return e["value"], [F.when(~e["valid"], _entry("invalid_enum", column, raw))]


def code_rows(pairs: Column) -> tuple[Column, Column]:
    """(codes, drift) of an array of struct(seq, code, type): both blank is nothing, a half pair is recorded, a type alone dropped."""
    kept = F.filter(pairs, lambda p: p["code"].isNotNull())
    half = F.filter(pairs, lambda p: p["code"].isNull() != p["type"].isNull())
    drift = F.transform(half, lambda p: _entry("code_type_pair_incomplete", F.concat(F.lit("code|"), p["seq"].cast("string")), F.concat_ws(" ", F.coalesce(p["code"], F.lit("-")), F.coalesce(p["type"], F.lit("-")))))
    return F.transform(kept, lambda p: F.struct(p["seq"].cast("long").alias("code_seq"), F.upper(p["code"]).alias("code"), F.upper(p["type"]).alias("declared_type"))), drift


def parse_tall_meta(header: list[str], values: list[str]) -> tuple[dict, list[tuple]]:
    """(metadata, drift) from the two leading records of a tall file."""
    meta: dict = {"unmapped": {}}
    drift: list[tuple] = []
    for name, value in zip(map(_header_name, header), [*values, *[""] * len(header)]):
        value = value.strip()
        if not name:
            drift += [("meta_value_without_header", "", value)] if value else []
        elif name.startswith(ATTESTATION):
            meta["attestation"] = value.lower() or None
        elif name.startswith("license_number"):
            meta["license_state"] = name.partition("|")[2].upper() or None
            meta["license_number"] = value or None
        elif name in ("location_name", "hospital_address", "type_2_npi"):
            meta[name] = [v.strip() for v in value.split("|") if v.strip()]
        elif name in META_COLUMNS[:3] or name == "attester_name":
            meta[name] = value or None
        else:
            known = name in META_COLUMNS
            if value or not known:
                meta["unmapped"][name] = value
            drift += [] if known else [("unmapped_meta_column", name, value)]
    return meta, drift + [("missing_required_meta", m, None) for m in META_REQUIRED if not meta.get(m)]


def plan_header(header: list[str]) -> tuple[dict[str, int], dict[int, dict[str, int]], dict[str, int], list[tuple]]:
    """(columns, code pairs, unmapped columns, drift) of a data header; of equal names the first counts."""
    known = {r.name for r in TALL_SCHEMA}
    columns: dict[str, int] = {}
    pairs: dict[int, dict[str, int]] = {}
    unmapped: dict[str, int] = {}
    drift: list[tuple] = []
    for i, name in enumerate(map(_header_name, header)):
        if name in columns:
            drift.append(("duplicate_column", name, None))
            continue
        columns[name] = i
        if m := _CODE.fullmatch(name):
            pairs.setdefault(int(m[1]), {})["type" if m[2] else "code"] = i
        elif name not in known:
            unmapped[name] = i
            drift.append(("unmapped_column", name, None))
    missing = [r.name for r in TALL_SCHEMA if r.name not in columns and r.name not in OPTIONAL] + ([] if 1 in pairs else ["code|1"])
    return columns, pairs, unmapped, drift + [("missing_required_column", m, None) for m in missing]


def parse_tall(records: DataFrame, header: list[str]) -> tuple[DataFrame, list[tuple]]:
    """Rows (pos, locator, kind, fields, codes, drift, raw_json) of a tall file's data records; header is its third record.

    kind is charge, ragged or blank.
    """
    columns, pairs, unmapped, drift = plan_header(header)
    cell = lambda i: clean(F.get("cells", F.lit(i)))
    fields, entries = [], []
    for rule in TALL_SCHEMA:
        name = TALL_NAMES.get(rule.name, rule.name)
        raw = cell(columns[rule.name]) if rule.name in columns else F.lit(None).cast("string")
        if rule.kind == "number":
            value, notes = number_cell(raw, rule.name)
        elif rule.kind == "enum":
            value, notes = enum_cell(raw, rule.name.rpartition("|")[2], list(rule.allowed))
        else:
            value, notes = raw, []
        fields.append(value.alias(name))
        entries += notes
    extra = [F.struct(F.lit(n).alias("k"), cell(i).alias("v")) for n, i in sorted(unmapped.items())]
    unmapped_json = F.lit(None).cast("string")
    if extra:
        kept = F.filter(F.array(*extra), lambda e: e["v"].isNotNull())
        unmapped_json = F.when(F.size(kept) > 0, F.to_json(F.map_from_entries(kept)))
    code = F.array(*[F.struct(F.lit(k).alias("seq"), cell(p.get("code", -1)).alias("code") if "code" in p else F.lit(None).cast("string").alias("code"), cell(p["type"]).alias("type") if "type" in p else F.lit(None).cast("string").alias("type")) for k, p in sorted(pairs.items())]) if pairs else F.array().cast("array<struct<seq:int,code:string,type:string>>")
    codes, code_drift = code_rows(code)
    blank = ~F.exists("cells", lambda c: clean(c).isNotNull())
    kind = F.when(blank, "blank").when(F.size("cells") != len(header), "ragged").otherwise("charge")
    is_charge = F.col("kind") == "charge"
    noted = F.filter(F.concat(F.array(*entries), code_drift), lambda e: e.isNotNull())
    odd = F.when(F.col("kind") == "blank", F.array(_entry("blank_row", ""))).when(F.col("kind") == "ragged", F.array(_entry("ragged_row", "", F.concat(F.size("cells").cast("string"), F.lit(f" cells vs {len(header)}")))))
    rows = records.where("record_no > 3").withColumn("kind", kind)
    rows = rows.select(F.col("record_no").alias("pos"), F.concat(F.lit("r"), F.col("record_no").cast("string")).alias("locator"), "kind", F.when(is_charge, F.struct(*fields, F.lit(None).cast("string").alias("additional_payer_notes"), unmapped_json.alias("unmapped_json"))).alias("fields"), F.when(is_charge, codes).alias("codes"), F.when(is_charge, noted).otherwise(odd).alias("drift"), F.when(F.col("kind") == "ragged", F.to_json("cells")).alias("raw_json"))
    return rows.withColumn("item_locator", F.col("locator")), drift


def _object(v: Column) -> Column:
    return F.when(F.schema_of_variant(v).startswith("OBJECT"), v)


def _array(v: Column) -> Column:
    return F.when(F.schema_of_variant(v).startswith("ARRAY"), v)


def _elements(v: Column) -> Column:
    """A variant array as array<variant>; null where it is none."""
    return F.try_variant_get(_array(v), "$", "array<variant>")


def _members(v: Column) -> Column:
    return F.try_variant_get(_object(v), "$", "map<string,variant>")


def _unknown(members: Column, known: tuple[str, ...]) -> Column:
    return F.map_filter(members, lambda k, _: ~k.isin(*known))


def parse_items(items: DataFrame) -> DataFrame:
    """Rows (pos, locator, item_locator, kind, fields, codes, drift, raw_json) of a JSON price file's items.

    items: (position, json). Chained outer explodes item -> charge -> payer with positions in the
    locators; a charge without payers gives one row. An item that is no object or has no charges, and
    a charge that is no object, is quarantined; so is an item too large or too broken to parse.
    """
    i = items.withColumn("_v", F.try_parse_json("json")).withColumn("_m", _members(F.col("_v")))
    get = lambda m, k: F.try_element_at(m, F.lit(k))
    i = i.withColumn("_charges", _elements(get(F.col("_m"), "standard_charges"))).withColumn("iloc", F.concat(F.lit("i"), F.col("position").cast("string")))
    ok = F.coalesce(F.size("_charges") > 0, F.lit(False))
    bad = i.where(~ok).select(F.col("position").alias("pos"), F.col("iloc").alias("locator"), F.col("iloc").alias("item_locator"), F.lit("item_unmappable").alias("kind"), F.array(_entry("item_unmappable", ARRAY, F.col("json"))).alias("drift"), F.col("json").alias("raw_json"))
    good = i.where(ok)
    c = good.select("position", "iloc", "_m", F.posexplode("_charges").alias("k", "_c")).withColumn("_cm", _members(F.col("_c"))).withColumn("sloc", F.concat("iloc", F.lit(".s"), F.col("k").cast("string")))
    bad_charge = c.where("_cm is null").select(F.col("position").alias("pos"), F.col("sloc").alias("locator"), F.col("iloc").alias("item_locator"), F.lit("standard_charge_unmappable").alias("kind"), F.array(_entry("standard_charge_unmappable", "standard_charges", F.to_json("_c"))).alias("drift"), F.to_json("_c").alias("raw_json"))
    payers = _elements(get(F.col("_cm"), "payers_information"))
    p = c.where("_cm is not null").select("position", "iloc", "sloc", "k", "_m", "_cm", F.posexplode_outer(payers).alias("j", "_p")).withColumn("_pm", F.coalesce(_members(F.col("_p")), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<variant>"))))
    p = p.withColumn("locator", F.concat("sloc", F.lit(".p"), F.coalesce(F.col("j").cast("string"), F.lit("-"))))
    entries, fields = [], []

    def notes_on(n: Column, key: str, raw: Column) -> list[Column]:
        return [F.when(~n["ok"], _entry("unparseable_numeric", key, raw)), F.when(n["as_text"], _entry("numeric_encoded_as_string", key, raw)), F.when(n["value"] <= 0, _entry("nonpositive_numeric", key, n["value"]))]

    def number(m: str, key: str, name: str) -> None:
        n = variant_number(get(F.col(m), key))
        entries.extend(notes_on(n, key, F.to_json(get(F.col(m), key))))
        fields.append(n["value"].alias(name))

    def text(m: str, key: str, name: str) -> None:
        fields.append(variant_text(get(F.col(m), key)).alias(name))

    def enum(m: str, key: str, name: str, allowed: list[str]) -> None:
        value, notes = enum_cell(variant_text(get(F.col(m), key)), name, allowed)
        fields.append(value.alias(name))
        entries.extend(notes)

    p = p.withColumn("_drug", _members(get(F.col("_m"), "drug_information")))
    text("_m", "description", "description")
    enum("_cm", "setting", "setting", ENUMS["setting"])
    mods = get(F.col("_cm"), "modifier_code")
    listed = F.array_join(F.transform(_elements(mods), lambda x: F.try_variant_get(x, "$", "string")), "|")
    fields.append(F.coalesce(F.nullif(listed, F.lit("")), F.when(_array(mods).isNull(), variant_text(mods))).alias("modifiers"))
    # noted once an item, below
    fields.append(variant_number(get(F.col("_drug"), "unit"))["value"].alias("drug_unit_of_measurement"))
    text("_drug", "type", "drug_type_of_measurement")
    enum("_cm", "billing_class", "billing_class", ENUMS["billing_class"])
    number("_cm", "gross_charge", "gross_charge")
    number("_cm", "discounted_cash", "discounted_cash")
    text("_pm", "payer_name", "payer_name")
    text("_pm", "plan_name", "plan_name")
    number("_pm", "standard_charge_dollar", "negotiated_dollar")
    number("_pm", "standard_charge_percentage", "negotiated_percentage")
    text("_pm", "standard_charge_algorithm", "negotiated_algorithm")
    number("_pm", "median_amount", "median_amount")
    number("_pm", "10th_percentile", "p10_amount")
    number("_pm", "90th_percentile", "p90_amount")
    text("_pm", "count", "count_raw")
    enum("_pm", "methodology", "methodology", ENUMS["standard_charge|methodology"])
    number("_cm", "minimum", "min_charge")
    number("_cm", "maximum", "max_charge")
    text("_cm", "additional_generic_notes", "additional_generic_notes")
    text("_pm", "additional_payer_notes", "additional_payer_notes")
    named = lambda level, m, known: F.transform(F.map_entries(_unknown(m, known)), lambda e: F.struct(F.concat(F.lit(level + "."), e["key"]).alias("key"), F.to_json(e["value"]).alias("value")))
    unknown = lambda level, m, known: F.transform(named(level, m, known), lambda e: _entry("unmapped_field", e["key"], e["value"]))
    levels = [("item", F.col("_m"), ITEM_MEMBERS), ("standard_charges", F.col("_cm"), CHARGE_MEMBERS), ("payers_information", F.col("_pm"), PAYER_MEMBERS)]
    everything = F.array_sort(F.concat(*[named(*x) for x in levels]))
    # values are JSON already: the object is put together as text, keys sorted
    quoted = F.transform(everything, lambda e: F.concat(F.lit('"'), F.regexp_replace(e["key"], r'(["\\])', r"\\$1"), F.lit('": '), e["value"]))
    fields.append(F.when(F.size(everything) > 0, F.concat(F.lit("{"), F.array_join(quoted, ", "), F.lit("}"))).alias("unmapped_json"))
    some = lambda *xs: F.filter(F.concat(*xs), lambda e: e.isNotNull())
    none = F.lit(None).cast("string").alias("raw_json")
    rows = p.select(F.col("position").alias("pos"), "locator", F.col("iloc").alias("item_locator"), F.lit("charge").alias("kind"), F.struct(*fields).alias("fields"), some(F.array(*entries), unknown(*levels[2])).alias("drift"), none)
    # what is noted once an item or once a charge stands in rows of its own
    pairs = F.transform(_elements(get(F.col("_m"), "code_information")), lambda x, n: F.struct((n + 1).alias("seq"), variant_text(F.try_variant_get(x, "$.code", "variant")).alias("code"), variant_text(F.try_variant_get(x, "$.type", "variant")).alias("type")))
    codes, code_drift = code_rows(F.coalesce(pairs, F.array().cast("array<struct<seq:int,code:string,type:string>>")))
    missing = [F.when(~F.map_contains_key("_m", m), _entry("missing_required_field", f"item.{m}")) for m in ("description", "code_information")]
    drug = get(_members(get(F.col("_m"), "drug_information")), "unit")
    of_item = good.select(F.col("position").alias("pos"), F.col("iloc").alias("locator"), F.col("iloc").alias("item_locator"), F.lit("item").alias("kind"), codes.alias("codes"), some(F.array(*missing, *notes_on(variant_number(drug), "unit", F.to_json(drug))), unknown(*levels[0]), code_drift).alias("drift"))
    of_charge = c.where("_cm is not null").select(F.col("position").alias("pos"), F.col("sloc").alias("locator"), F.col("iloc").alias("item_locator"), F.lit("standard_charge").alias("kind"), unknown(*levels[1]).alias("drift"))
    out = rows
    for part in (of_item, of_charge, bad, bad_charge):
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def parse_modifiers(members: DataFrame) -> DataFrame:
    """Modifier by payer entries of files' modifier members (json); one entry for a modifier without payers."""
    get = lambda v, k: F.try_variant_get(v, f"$.{k}", "string")
    m = members.select(F.posexplode(_elements(F.try_parse_json("json"))).alias("i", "_m")).where(_object(F.col("_m")).isNotNull())
    payers = F.filter(_elements(F.try_variant_get("_m", "$.modifier_payer_information", "variant")), lambda p: _object(p).isNotNull())
    m = m.select("i", "_m", F.posexplode_outer(payers).alias("j", "_p"))
    at = F.concat(F.lit("m"), F.col("i").cast("string"), F.lit(".p"), F.coalesce("j", F.lit(0)).cast("string"))
    return m.select(at.alias("modifier_locator"), *[get("_m", c).alias(c) for c in ("code", "description", "setting")], *[get("_p", c).alias(c) for c in ("payer_name", "plan_name")], get("_p", "description").alias("payer_description"))


def parse_json_meta(members: dict[str, str]) -> tuple[dict, list[tuple]]:
    """(metadata, drift) from the other members of a JSON price file."""
    meta: dict = {"unmapped": {}}
    drift: list[tuple] = []
    for name, text in members.items():
        v = json.loads(text)
        if name in ("hospital_name", "last_updated_on", "version"):
            meta[name] = v
        elif name in ("location_name", "hospital_address", "type_2_npi"):
            meta[name] = [str(x).strip() for x in (v if isinstance(v, list) else [v] if v else [])]
        elif name == "license_information" and isinstance(v, dict):
            meta["license_number"], meta["license_state"] = v.get("license_number") or None, (v.get("state") or "").upper() or None
        elif name == "attestation" and isinstance(v, dict):
            confirmed = v.get("confirm_attestation")
            meta["attestation"] = None if confirmed is None else str(confirmed).lower()
        elif name == MODIFIERS:
            drift += [] if isinstance(v, list) else [("modifier_information_not_array", "", None)]
        else:
            meta["unmapped"][name] = v
            drift += [] if name in META_COLUMNS else [("unmapped_meta_column", name, text[:200])]
    return meta, drift + [("missing_required_meta", m, None) for m in META_REQUIRED if not meta.get(m)]


def stage_file(spark: SparkSession, landed: Landed, source_format: str, out: str) -> dict:
    """Stage one landed file into <out>/<owner>; returns the counts of its file row.

    Records are parsed once into a table aside; every staged table is written even when empty, and a numbered
    manifest of the owner names the directory once all are complete. What it named before stays until it is cleared away.
    """
    tag = uuid.uuid4().hex
    aside = f"{out}/{landed.owner}/data-{tag}"
    prefix = f"{landed.owner}-{landed.sha256[:16]}-"
    if source_format == "csv_tall":
        raw = read_delimited(spark, [landed.path])
        head = {r["record_no"]: r["cells"] for r in raw.where("record_no <= 3").collect()}
        meta, drift = parse_tall_meta(head.get(1) or [], head.get(2) or [])
        if len(head) < 3:
            drift.append(("truncated_header", "", None))
        rows, more = parse_tall(raw, head.get(3) or [])
        drift += more if len(head) >= 3 else []
        modifiers = None
    elif source_format == "json":
        raw = read_json_items(spark, [landed.path], ARRAY)
        raw.write.parquet(f"{aside}/.raw")
        raw = spark.read.parquet(f"{aside}/.raw")
        # the modifiers may be many and stay where they are; of them nothing but the first sign is asked
        short = F.when(F.col("name") == MODIFIERS, F.when(F.col("json").startswith("["), "[]").otherwise("null")).otherwise(F.col("json"))
        members = {r["name"]: r["json"] for r in raw.where("kind = 'member'").select("name", short.alias("json")).collect()}
        kinds = {r[0] for r in raw.select("kind").distinct().collect()}
        meta, drift = parse_json_meta(members)
        drift += [("top_level_not_object", "", None)] if "no_object" in kinds else []
        drift += [("sci_not_array", ARRAY, None)] if "no_array" in kinds else []
        drift += [("truncated_file", ARRAY, None)] if "broken" in kinds else []
        drift += [("missing_required_meta", ARRAY, None)] if not kinds & {"item", "no_array"} else []
        rows = parse_items(raw.where("kind = 'item'").select("position", "json"))
        modifiers = parse_modifiers(raw.where((F.col("kind") == "member") & (F.col("name") == MODIFIERS)))
    else:
        raise ValueError(f"no parser for {source_format}")
    rows.write.parquet(f"{aside}/.rows")
    rows = spark.read.parquet(f"{aside}/.rows")
    owner = [F.lit(landed.owner).alias("hospital_id"), F.lit(landed.sha256).alias("source_sha256")]
    charges = rows.where("kind = 'charge'").select(F.concat(F.lit(prefix), "locator").alias("charge_id"), F.concat(F.lit(prefix), "item_locator").alias("item_id"), *owner, F.col("locator").alias("source_locator"), "fields.*")
    codes = rows.select("item_locator", F.explode("codes").alias("c")).select(F.concat(F.lit(prefix), "item_locator").alias("item_id"), F.lit(landed.owner).alias("hospital_id"), "c.*")
    quarantine = rows.where("kind in ('ragged', 'item_unmappable', 'standard_charge_unmappable')").select(*owner, F.col("locator").alias("source_locator"), F.concat(F.col("kind"), F.when(F.col("kind") == "ragged", "_row").otherwise("")).alias("reason"), "raw_json")
    seen = first_seen(rows.select("pos", "locator", F.explode("drift").alias("d")).select("pos", "locator", "d.*"), ["kind", "column"], F.struct("pos", "locator"), "locator", "sample")
    drift += [(f"discovery_{f}", "index", None) for f in landed.fixes] + ([("utf8_bom_stripped", "", None)] if has_bom(landed.path) else [])
    counted: dict[tuple, list] = {}
    for kind, column, sample in drift:
        e = counted.setdefault((kind, column), [0, sample])
        e[0] += 1
    fixed = [(k, c, n, None, None if s is None else str(s)[:200]) for (k, c), (n, s) in counted.items()]
    drift_rows = seen.unionByName(spark.createDataFrame(fixed, "kind string, column string, n bigint, first_locator string, sample_value string"))
    n_charges, n_bad = charges.count(), quarantine.count()
    file_row = {
        "source_filename": landed.filename, "source_url": landed.url, "bytes": landed.bytes, "source_format": source_format, "template_version": meta.get("version"), "hospital_name": meta.get("hospital_name"), "last_updated_on": meta.get("last_updated_on"), "location_names": meta.get("location_name", []), "hospital_addresses": meta.get("hospital_address", []), "type_2_npis": meta.get("type_2_npi", []),
        "license_state": meta.get("license_state"), "license_number": meta.get("license_number"), "attestation": meta.get("attestation"), "records_read": n_charges + n_bad, "charge_rows": n_charges, "quarantined_rows": n_bad, "unmapped_meta_json": json.dumps(meta["unmapped"], sort_keys=True, ensure_ascii=False) if meta["unmapped"] else None,
        "hospital_id": landed.owner, "source_sha256": landed.sha256,
    }
    listed = spark.createDataFrame([], STAGED["modifiers"]) if modifiers is None else modifiers.select(*owner, "*")
    tables = {"charges": charges, "codes": codes, "modifiers": listed, "drift": drift_rows.select(*owner, "kind", "column", "n", "first_locator", "sample_value"), "quarantine": quarantine, "file": spark.createDataFrame([file_row], STAGED["file"])}
    for name, df in tables.items():
        names = [c.split()[0] for c in STAGED[name].split(", ")]
        df.select(*names).write.option("compression", "zstd").parquet(f"{aside}/{name}")
    fs, _ = hadoop_fs(spark, aside)
    for scratch in (".raw", ".rows"):
        fs.delete(hadoop_fs(spark, f"{aside}/{scratch}")[1], True)
    versions = Manifests(spark, f"{out}/{landed.owner}", "staged")
    versions.commit((versions.latest() or {}) | {"data": aside, "sha256": landed.sha256})
    return {"records_read": n_charges + n_bad, "charge_rows": n_charges, "quarantined_rows": n_bad}


def read_staged(spark: SparkSession, out: str, name: str) -> DataFrame:
    """One staged table over all owners, by name; an empty table where nothing is staged. Columns a file lacks are null."""
    fs, root = hadoop_fs(spark, out)
    owners = [x.getPath().toString() for x in fs.listStatus(root)] if fs.exists(root) else []
    current = [m["data"] for m in (Manifests(spark, o, "staged").latest() for o in owners) if m]
    if not current:
        return spark.createDataFrame([], STAGED[name])
    return spark.read.schema(STAGED[name]).parquet(*[f"{c}/{name}" for c in current])
