"""Clinical resources to typed tables, with a report of what is mapped.

Each table is declared as a list of (column, path, type); the projection and the set of mapped paths come
from the same list, so they cannot drift apart. Trees of unknown shape (leaf paths, codings, dates,
references) are read as path-value triples. Personal values are not kept: names and social numbers
leave only flags.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .nested import json_triples

SYNTHETIC_SYSTEM = "https://github.com/synthetichealth/synthea"
NPI_SYSTEM = "http://hl7.org/fhir/sid/us-npi"
SSN_SYSTEM = "http://hl7.org/fhir/sid/us-ssn"
RACE, ETHNICITY = ("http://hl7.org/fhir/us/core/StructureDefinition/us-core-" + x for x in ("race", "ethnicity"))
_CODING = [("code_system", "code.coding[0].system", "string"), ("code", "code.coding[0].code", "string"), ("display", "code.coding[0].display", "string")]
_WHO = [("patient_id", "subject.reference", "urn"), ("encounter_id", "encounter.reference", "urn")]


def _clinical(*time: str) -> list[tuple[str, str, str]]:
    return [*_WHO, ("status", "status|clinicalStatus.coding[0].code", "string"), *_CODING, ("time", "|".join(time), "string")]


# The columns of each table and where they are found. '|' separates alternatives, the first that is there counts; urn drops the prefix of an id.
PATHS: dict[str, list[tuple[str, str, str]]] = {
    "patients": [("gender", "gender", "string"), ("birth_date", "birthDate", "string"), ("deceased_at", "deceasedDateTime", "string"), ("city", "address[0].city", "string"), ("state", "address[0].state", "string"), ("postal_code", "address[0].postalCode", "string")],
    "encounters": [("patient_id", "subject.reference", "urn"), ("status", "status", "string"), ("class_code", "class.code", "string"), ("type_system", "type[0].coding[0].system", "string"), ("type_code", "type[0].coding[0].code", "string"), ("type_display", "type[0].coding[0].display", "string"), ("start", "period.start", "string"), ("end", "period.end", "string"), ("reason_system", "reasonCode[0].coding[0].system", "string"), ("reason_code", "reasonCode[0].coding[0].code", "string"), ("provider_ref", "serviceProvider.reference", "string"), ("practitioner_ref", "participant[0].individual.reference", "string")],
    "conditions": _clinical("onsetDateTime"),
    "observations": [*_clinical("effectiveDateTime"), ("category", "category[0].coding[0].code", "string"), ("value_number", "valueQuantity.value", "double"), ("value_unit", "valueQuantity.unit", "string"), ("value_code", "valueCodeableConcept.coding[0].code", "string")],
    "procedures": _clinical("performedDateTime", "performedPeriod.start"),
    "medication_requests": [*_WHO, ("status", "status", "string"), ("intent", "intent", "string"), *[(c, p.replace("code.coding", "medicationCodeableConcept.coding"), t) for c, p, t in _CODING], ("time", "authoredOn", "string")],
    "claims": [("patient_id", "patient.reference", "urn"), ("status", "status", "string"), ("use", "use", "string"), ("claim_type", "type.coding[0].code", "string"), ("start", "billablePeriod.start", "string"), ("created", "created", "string"), ("provider_ref", "provider.reference", "string"), ("total", "total.value", "double"), ("currency", "total.currency", "string")],
    "eobs": [("patient_id", "patient.reference", "urn"), ("status", "status", "string"), ("claim_id", "claim.reference", "urn"), ("outcome", "outcome", "string"), ("payment", "payment.amount.value", "double"), ("total_amount", "total[0].amount.value", "double")],
    "organizations": [("name", "name", "string"), ("type_code", "type[0].coding[0].code", "string"), ("city", "address[0].city", "string"), ("state", "address[0].state", "string"), ("postal_code", "address[0].postalCode", "string")],
}
# The table of each modelled type.
TABLE_OF = {"Patient": "patients", "Encounter": "encounters", "Condition": "conditions", "Observation": "observations", "Procedure": "procedures", "MedicationRequest": "medication_requests", "Claim": "claims", "ExplanationOfBenefit": "eobs", "Organization": "organizations", "Location": "organizations", "Practitioner": "organizations"}
# Lines of a claim, and what patients and organizations are read for beyond PATHS.
LINE_PATHS = [("sequence", "sequence", "long"), ("code_system", "productOrService.coding[0].system", "string"), ("code", "productOrService.coding[0].code", "string"), ("display", "productOrService.coding[0].display", "string"), ("net", "net.value", "double")]
EXTRA_PATHS = {"patients": ("identifier[].system", "identifier[].value", "name[].family", "name[].given[]", "extension[].url", "extension[].extension[].url", "extension[].extension[].valueString"), "organizations": ("identifier[].system", "identifier[].value"), "claims": tuple("item[]." + p.replace("[0]", "[]") for _, p, _ in LINE_PATHS)}
# Elements a resource of a type must have.
REQUIRED = {
    "Encounter": ("status", "class"),
    "Condition": ("subject",),
    "Observation": ("status", "code"),
    "Procedure": ("status", "subject"),
    "MedicationRequest": ("status", "intent", "subject"),
    "Claim": ("status", "type", "use", "patient", "created", "provider", "priority", "insurance"),
    "ExplanationOfBenefit": ("status", "type", "use", "patient", "created", "insurer", "provider", "outcome", "insurance"),
    "Immunization": ("status", "vaccineCode", "patient"),
    "DiagnosticReport": ("status", "code"),
}
DATE_MEMBERS = ("birthDate", "deceasedDateTime", "start", "end", "onsetDateTime", "abatementDateTime", "effectiveDateTime", "issued", "performedDateTime", "authoredOn", "created", "recorded", "date", "occurrenceDateTime")
DATE = r"^[0-9]{4}(-[0-9]{2}(-[0-9]{2}(T[0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?(Z|[+-][0-9]{2}:[0-9]{2})?)?)?)?\z"
CONDITIONAL = r"^([A-Za-z]+)\?identifier=([^|]+)\|(.+)\z"
URN = "urn:uuid:"


def mapped_paths() -> dict[str, set[str]]:
    """Patterns that are read, by resource type."""
    out = {}
    for rtype, name in TABLE_OF.items():
        read = {re.sub(r"\[0\]", "[]", p) for _, paths, _ in PATHS[name] for p in paths.split("|")}
        out[rtype] = read | set(EXTRA_PATHS.get(name, ())) | {"resourceType", "id"}
    return out


def value_at(v: Column, paths: str, kind: str) -> Column:
    """The first scalar among paths; an object or list where a text is due is none."""

    def one(path: str) -> Column:
        if kind not in ("string", "urn"):
            return F.try_variant_get(v, "$." + path, kind)
        shape = F.schema_of_variant(F.try_variant_get(v, "$." + path, "variant"))
        return F.when(~shape.startswith("OBJECT") & ~shape.startswith("ARRAY"), F.try_variant_get(v, "$." + path, "string"))

    found = F.coalesce(*[one(p) for p in paths.split("|")])
    return F.when(found.startswith(URN), F.substr(found, F.lit(len(URN) + 1))) if kind == "urn" else found


def _list(v: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(v, "$." + path, "array<variant>"), F.array().cast("array<variant>"))


def _identifier(v: Column, system: str, contains: bool = False) -> Column:
    s = lambda x: F.coalesce(F.try_variant_get(x, "$.system", "string"), F.lit(""))
    hit = F.filter(_list(v, "identifier"), lambda x: s(x).contains(system) if contains else s(x) == system)
    return F.try_variant_get(F.get(hit, F.lit(0)), "$.value", "string")


def _patient_flags(v: Column) -> dict[str, Column]:
    ssn = _identifier(v, SSN_SYSTEM)
    names = _list(v, "name")
    parts = F.flatten(F.transform(names, lambda n: F.concat(F.array(F.try_variant_get(n, "$.family", "string")), F.coalesce(F.try_variant_get(n, "$.given", "array<string>"), F.array().cast("array<string>")))))
    parts = F.filter(parts, lambda p: p.isNotNull() & (p != ""))

    def extension(url: str) -> Column:
        outer = F.filter(_list(v, "extension"), lambda x: F.try_variant_get(x, "$.url", "string") == url)
        inner = F.filter(_list(F.get(outer, F.lit(0)), "extension"), lambda x: F.try_variant_get(x, "$.url", "string") == "text")
        return F.try_variant_get(F.get(inner, F.lit(0)), "$.valueString", "string")

    return {
        "race": extension(RACE),
        "ethnicity": extension(ETHNICITY),
        "has_synthetic_identifier": F.exists(_list(v, "identifier"), lambda x: F.coalesce(F.try_variant_get(x, "$.system", "string") == SYNTHETIC_SYSTEM, F.lit(False))),
        "ssn_in_test_range": F.when(ssn.isNotNull(), ssn.startswith("999")),
        "names_digit_suffixed": (F.size(parts) > 0) & F.forall(parts, lambda p: p.rlike("[0-9]")),
    }


def resources(entries: DataFrame) -> DataFrame:
    """Entries that hold a resource, with it as a variant `v`; one too large to parse keeps null."""
    return entries.where("resource is not null").withColumn("v", F.try_parse_json("resource"))


def table(res: DataFrame, name: str) -> DataFrame:
    """One typed table of resources(); of organizations, the type is kept, practitioners have no plain name."""
    types = [t for t, n in TABLE_OF.items() if n == name]
    v = F.col("v")
    cols = {c: value_at(v, p, k) for c, p, k in PATHS[name]}
    if name == "patients":
        cols |= _patient_flags(v)
    if name == "organizations":
        cols["name"] = F.when(F.col("resource_type") != "Practitioner", cols["name"])
        cols |= {"synthetic_id": _identifier(v, "synthea", True), "npi": _identifier(v, NPI_SYSTEM), "resource_type": F.col("resource_type")}
    return res.where(F.col("resource_type").isin(types)).select("bundle_sha256", "resource_id", *[e.alias(c) for c, e in cols.items()])


def claim_items(res: DataFrame) -> DataFrame:
    """The lines of claims, tied to their claim."""
    c = res.where("resource_type = 'Claim'").select("bundle_sha256", F.col("resource_id").alias("claim_id"), F.explode(_list(F.col("v"), "item")).alias("v"))
    return c.select("bundle_sha256", "claim_id", *[value_at(F.col("v"), p, k).alias(n) for n, p, k in LINE_PATHS])


def bundles(entries: DataFrame) -> DataFrame:
    e = entries.where("problem is null or problem <> 'not_a_bundle'")
    return e.groupBy("bundle_sha256").agg(F.max("bundle_type").alias("bundle_type"), F.count_if(F.col("entry") >= 0).alias("entries"), F.count_if(F.col("resource_type") == "Patient").alias("patients"))


def _triples(entries: DataFrame, names: tuple[str, ...] | None, containers: bool = False) -> DataFrame:
    e = entries.where("resource is not null").select("bundle_sha256", "entry", "resource_type", "resource_id", "resource")
    return json_triples(e, "bundle_sha256", "resource", names, carry=("entry", "resource_type", "resource_id"), containers=containers)


def mapping(entries: DataFrame) -> DataFrame:
    """Every leaf path by type: how often it occurs and whether it is read."""
    counts = _triples(entries, None).groupBy("resource_type", F.col("pattern").alias("path")).agg(F.count(F.lit(1)).alias("occurrences"))
    read = [f"{t}\x00{p}" for t, ps in mapped_paths().items() for p in ps]
    return counts.select("resource_type", "path", "occurrences", F.concat("resource_type", F.lit("\x00"), "path").isin(read).alias("mapped"), F.col("resource_type").isin(list(TABLE_OF)).alias("modelled_type"))


def references(entries: DataFrame, organizations: DataFrame) -> DataFrame:
    """Every reference with its kind and whether it resolves.

    #id within its own resource, urn within its bundle, Type?identifier=system|value against the
    organizations; all else is unresolved. Each kind is an equi-join on the target.
    """
    t = _triples(entries, ("reference", "id"))
    refs = t.where("name = 'reference' and json_type = 'string' and path not like '%]'").select("bundle_sha256", "entry", "resource_type", "resource_id", F.regexp_replace("pattern", r"\.?reference\z", "").alias("path"), F.col("value").alias("target"))
    kind = F.when(F.col("target").startswith("#"), "contained").when(F.col("target").startswith(URN), "bundle_urn").when(F.col("target").rlike(CONDITIONAL), "conditional_identifier").otherwise("other")
    refs = refs.withColumn("kind", kind)
    inner = t.where("pattern = 'contained[].id' and json_type = 'string'").select("bundle_sha256", "entry", F.concat(F.lit("#"), "value").alias("target"), F.lit("contained").alias("kind")).distinct()
    urls = entries.where("full_url is not null").select("bundle_sha256", F.col("full_url").alias("target"), F.lit("bundle_urn").alias("kind")).distinct()
    key = lambda system, col: organizations.where(F.col(col).isNotNull()).select(F.concat("resource_type", F.lit("?identifier=" + system + "|"), col).alias("target"))
    known = key(SYNTHETIC_SYSTEM, "synthetic_id").unionByName(key(NPI_SYSTEM, "npi")).distinct().withColumn("kind", F.lit("conditional_identifier"))
    hit = lambda df, c: df.withColumn(c, F.lit(True))
    j = refs.join(hit(inner, "_a"), ["bundle_sha256", "entry", "target", "kind"], "left").join(hit(urls, "_b"), ["bundle_sha256", "target", "kind"], "left").join(hit(known, "_c"), ["target", "kind"], "left")
    return j.select("bundle_sha256", "resource_type", "resource_id", "path", "target", "kind", F.coalesce("_a", "_b", "_c", F.lit(False)).alias("resolved"))


def issues(entries: DataFrame) -> DataFrame:
    """(bundle_sha256, resource_type, resource_id, kind, detail): envelope, required elements, codings, dates."""
    cut = lambda c: F.left(c, F.lit(200)).alias("detail")
    envelope = entries.where("problem is not null").select("bundle_sha256", "resource_type", "resource_id", F.col("problem").alias("kind"), cut(F.when(F.col("entry") >= 0, F.concat(F.lit("entry "), F.col("entry").cast("string"))).otherwise("")))
    need = reduce(lambda c, t: c.when(F.col("resource_type") == t, F.array(*map(F.lit, REQUIRED[t]))), REQUIRED, F.when(F.lit(False), F.array().cast("array<string>")))
    r = resources(entries).withColumn("_need", need).where("_need is not null")
    keys = F.map_keys(F.try_variant_get("v", "$", "map<string,variant>"))
    missing = r.select("bundle_sha256", "resource_type", "resource_id", F.lit("missing_required").alias("kind"), F.explode(F.array_except("_need", keys)).alias("detail"))
    at = ["bundle_sha256", "entry", "resource_type", "resource_id"]
    t = _triples(entries, ("coding", "system", "code", *DATE_MEMBERS), True)
    codings = t.where("json_type = 'object' and pattern like '%coding[]'").select(*at, "path", "pattern")
    full = t.where("name in ('system', 'code') and parent is not null and value <> ''").groupBy("bundle_sha256", "entry", F.col("parent").alias("path")).agg(F.countDistinct("name").alias("_n")).where("_n = 2")
    bare = codings.join(full, ["bundle_sha256", "entry", "path"], "left_anti").select("bundle_sha256", "resource_type", "resource_id", F.lit("coding_without_system_or_code").alias("kind"), cut(F.col("pattern")))
    dates = t.where(F.col("name").isin(*DATE_MEMBERS) & (F.col("json_type") == "string") & ~F.col("path").endswith("]") & ~F.col("value").rlike(DATE)).select("bundle_sha256", "resource_type", "resource_id", F.lit("unparseable_date").alias("kind"), cut(F.concat("pattern", F.lit("="), "value")))
    return envelope.unionByName(missing).unionByName(bare).unionByName(dates)


def stage(entries: DataFrame) -> dict[str, DataFrame]:
    """All tables of a set of entries; write the entries aside first, they are read by each of them."""
    res = resources(entries)
    out = {n: table(res, n) for n in PATHS}
    out["claim_items"] = claim_items(res)
    out["bundles"] = bundles(entries)
    out["resources"] = res.select("bundle_sha256", "entry", "resource_type", "resource_id", "full_url")
    out["references"] = references(entries, out["organizations"])
    out["issues"] = issues(entries)
    out["mapping"] = mapping(entries)
    return out
