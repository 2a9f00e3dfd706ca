import json

import pytest

from rateloom import gates
from rateloom.marts import clinical as marts
from rateloom.operators import clinical
from rateloom.plans.materialize import materialize
from rateloom.sources import bundles

SYN = clinical.SYNTHETIC_SYSTEM


def made(kind, rid=None, **members):
    """A resource; members that are texts in angle brackets are references to a resource of the same delivery."""
    link = lambda v: {"reference": f"urn:uuid:{v[1:-1]}"} if isinstance(v, str) and v[:1] == "<" else v
    return {"resourceType": kind} | ({"id": rid} if rid else {}) | {k.rstrip("_"): link(v) for k, v in members.items()}


def delivery(*resources, rest=()):
    return {"resourceType": "Bundle", "type": "collection", "entry": [*({"resource": r, "fullUrl": "urn:uuid:" + r.get("id", "none")} for r in resources), *rest]}


def coded(code, system=None):
    return {"coding": [{"code": code} | ({"system": system} if system else {})]}


CLINIC = {"reference": f"Organization?identifier={SYN}|clinic-7"}
PATIENT = made("Patient", "pat", gender="other", birthDate="1961-11-30", maritalStatus={"text": "unknown"}, name=[{"family": "Lark5", "given": ["Io3"]}], address=[{"city": "Elm", "state": "ZB"}], identifier=[{"system": clinical.SSN_SYSTEM, "value": "999-1"}, {"system": SYN, "value": "pat"}], extension=[{"url": clinical.RACE, "extension": [{"url": "text", "valueString": "r"}]}])
ENCOUNTER = made("Encounter", "enc", class_={"code": "AMB"}, status="planned", subject="<pat>", serviceProvider=CLINIC, period={"start": "2020-01-01T10:00:00Z"})
LINES = [{"sequence": 1, "productOrService": coded("a", SYN)}, {"sequence": 2, "productOrService": coded("d0120", marts.SHARED_SYSTEM), "net": {"value": 12.345}}]
CLAIM = made("Claim", "clm", status="draft", use="claim", created="2020-01-02", type=coded("professional", "s"), patient="<pat>", provider=CLINIC, priority={}, contained=[made("Coverage", "cov")], insurance=[{"coverage": {"reference": "#cov"}}], item=LINES, total={"currency": "XTS", "value": 12.35})
OBS = made("Observation", "obs", status="final", code=coded("no system"), subject="<nobody>", effectiveDateTime="01/02/2020", valueQuantity={"unit": "mm", "value": 1})
EOB = made("ExplanationOfBenefit", "eob", outcome="complete", claim="<clm>", total=[{"amount": {"value": 12.35}}])
ORG = made("Organization", "org", name="Elm Clinic", identifier=[{"system": SYN, "value": "clinic-7"}])


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("bundles")
    odd = delivery(OBS, made("Observation", status="final", code={"coding": [{}]}), rest=({"fullUrl": "x"}, "text"))
    docs = [delivery(PATIENT, ENCOUNTER, CLAIM, EOB), odd, delivery(ORG), made("Patient")]
    for i, doc in enumerate(docs):
        (d / f"{i}.json").write_text(("﻿" if i == 0 else "") + json.dumps(doc))
    (d / "broken.json").write_text('{"resourceType": "Bundle"')
    entries = materialize(bundles.read_bundles(spark, f"{d}/*.json"), "entries")
    return entries, clinical.stage(entries)


def test_tables(staged, rows):
    _, t = staged
    assert rows(t["patients"], "resource_id", "city", "race", "has_synthetic_identifier", "ssn_in_test_range", "names_digit_suffixed") == [("pat", "Elm", "r", True, True, True)]
    assert "999-1" not in str(t["patients"].collect()) and "Lark5" not in str(t["patients"].collect())
    assert rows(t["encounters"], "patient_id", "class_code", "start") == [("pat", "AMB", "2020-01-01T10:00:00Z")]
    assert rows(t["claims"], "claim_type", "total", "currency") == [("professional", 12.35, "XTS")]
    assert rows(t["claim_items"], "claim_id", "sequence", "code", "net") == [("clm", 1, "a", None), ("clm", 2, "d0120", 12.345)]
    assert rows(t["organizations"], "resource_type", "name", "synthetic_id") == [("Organization", "Elm Clinic", "clinic-7")]
    assert rows(t["observations"], "code", "value_number", "patient_id")[0] == ("no system", 1.0, "nobody")
    assert sorted(r["entries"] for r in t["bundles"].collect()) == [1, 4, 4]


def test_references_and_issues(staged, rows):
    _, t = staged
    refs = {(r["target"], r["kind"], r["resolved"]) for r in t["references"].collect()}
    assert refs == {("urn:uuid:pat", "bundle_urn", True), (f"Organization?identifier={SYN}|clinic-7", "conditional_identifier", True), ("#cov", "contained", True), ("urn:uuid:nobody", "bundle_urn", False), ("urn:uuid:clm", "bundle_urn", True)}
    found = {(r["kind"], r["detail"]) for r in t["issues"].collect()}
    assert {("not_a_bundle", ""), ("entry_without_resource", "entry 2"), ("entry_without_resource", "entry 3"), ("missing_id", "entry 1"), ("coding_without_system_or_code", "code.coding[]"), ("unparseable_date", "effectiveDateTime=01/02/2020"), ("missing_required", "insurer")} <= found
    assert sum(r["kind"] == "not_a_bundle" for r in t["issues"].collect()) == 2
    assert sum(r["kind"] == "coding_without_system_or_code" for r in t["issues"].collect()) == 2
    assert gates.references_resolve(t["references"]).count() == 1
    assert gates.synthetic_only(t["patients"]).count() == 0
    assert gates.claims_match(t["claims"], t["claim_items"], t["eobs"]).count() == 0
    assert gates.bundles_intact(t["resources"], {"Patient": t["patients"], "Organization": t["organizations"]}, t["issues"]).count() == 3


def test_mapping_and_reports(spark, staged, rows):
    _, t = staged
    m = {(r["resource_type"], r["path"]): (r["occurrences"], r["mapped"]) for r in t["mapping"].collect()}
    assert m[("Patient", "maritalStatus.text")] == (1, False) and m[("Patient", "name[].given[]")] == (1, True) and m[("Claim", "item[].net.value")] == (1, True)
    s = {r["resource_type"]: r for r in marts.summary(t["resources"], t["mapping"], t["issues"]).collect()}
    assert s["Patient"]["modelled"] and s["Patient"]["resources"] == 1 and 0 < s["Patient"]["mapped_value_share"] < 1
    assert s["Observation"]["structural_issues"] >= 3
    assert rows(marts.claim_totals(t["claims"], t["claim_items"])) == [("professional", 1, 2, 1, 0, 1, 0, 0, 1235, 1235)]
    lines = marts.claim_lines(t["claim_items"], t["claims"], t["organizations"])
    assert rows(lines, "sequence", "provider_name") == [(1, "Elm Clinic"), (2, "Elm Clinic")]
    codes = spark.createDataFrame([("D0120", "h1", "CDT"), ("D0120", "h2", "CDT"), ("A", "h1", "HCPCS_II")], "code string, hospital_id string, code_family string")
    b = {r["code_system"]: r for r in marts.code_bridge(lines, codes).collect()}
    assert (b[marts.SHARED_SYSTEM]["lines_with_a_price_file_code"], b[marts.SHARED_SYSTEM]["hospitals_with_those_codes"]) == (1, 2)
    assert b[SYN]["codes_with_a_price_file_code"] == 0


def test_no_bundles_give_empty_tables(spark, tmp_path):
    entries = bundles.read_bundles(spark, f"{tmp_path}/*.json")
    for name, df in clinical.stage(entries).items():
        assert df.count() == 0, name


def test_declared_paths_are_what_is_read():
    m = clinical.mapped_paths()
    assert set(m) == set(clinical.TABLE_OF)
    assert "performedPeriod.start" in m["Procedure"] and "clinicalStatus.coding[].code" in m["Condition"]
