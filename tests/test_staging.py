import json

import pytest
from pyspark.sql import functions as F

from rateloom.operators import staging
from rateloom.sources import landing, records

HEAD = "hospital_name,last_updated_on,version,location_name,hospital_address,license_number|zz,type_2_npi,To the best of its knowledge and belief this is true,attester_name"
META = "Elm Hill,2025-01-02,3.0.0,Elm Hill|Elm Hill East,1 Oak St ZZ 00001|2 Oak St ZZ 00002,77,9000000001|9000000002,true,A. Person"
COLUMNS = ["description", "code | 1", "Code|1| type", "setting", "modifiers", "drug_unit_of_measurement", "drug_type_of_measurement", "standard_charge|gross", "standard_charge | discounted_cash", "payer_name", "plan_name", "standard_charge|negotiated_dollar", "standard_charge|negotiated_percentage", "standard_charge|negotiated_algorithm", "median_amount", "10th_percentile", "90th_percentile", "count", "standard_charge|methodology", "standard_charge|min", "standard_charge|max", "additional_generic_notes", "house_column"]


def line(**kw):
    cells = dict(zip(COLUMNS, [""] * len(COLUMNS))) | kw
    return ",".join(cells.values())


@pytest.fixture
def tall(tmp_path):
    body = [
        line(description="first", **{"code | 1": "a4216", "Code|1| type": "cpt", "setting": "Outpatient", "standard_charge|gross": "10.50", "count": "0", "house_column": "x"}),
        line(description="second", **{"setting": "nowhere", "standard_charge|gross": "$12", "code | 1": "99213"}),
        "a,b,c",
        "",
        line(description='"two\nlines"', **{"standard_charge|gross": "-1"}),
    ]
    f = tmp_path / "tall.csv"
    f.write_bytes(landing.BOM + "\n".join([HEAD, META, ",".join(COLUMNS), *body]).encode() + b"\n")
    return f


def test_tall_file_is_staged_whole(spark, tall, tmp_path, rows):
    landed = landing.land("elm-hill", tall, tmp_path / "root", fixes=("mrf_url_missing_scheme",))
    got = staging.stage_file(spark, landed, "csv_tall", str(tmp_path / "staged"))
    assert got == {"records_read": 4, "charge_rows": 3, "quarantined_rows": 1}
    read = lambda n: staging.read_staged(spark, str(tmp_path / "staged"), n)
    charges = read("charges")
    assert rows(charges, "source_locator", "description", "setting", "gross_charge") == [("r4", "first", "outpatient", 10.5), ("r5", "second", None, None), ("r8", "two\nlines", None, -1.0)]
    assert json.loads(charges.where("source_locator = 'r4'").first()["unmapped_json"]) == {"house_column": "x"}
    assert rows(read("codes"), "code_seq", "code", "declared_type") == [(1, "99213", None), (1, "A4216", "CPT")]
    q = read("quarantine").first()
    assert (q["source_locator"], q["reason"], json.loads(q["raw_json"])) == ("r6", "ragged_row", ["a", "b", "c"])
    drift = {(r["kind"], r["column"]): (r["n"], r["first_locator"]) for r in read("drift").collect()}
    assert drift[("blank_row", "")] == (1, "r7")
    assert drift[("unparseable_numeric", "standard_charge|gross")] == (1, "r5")
    assert drift[("nonpositive_numeric", "standard_charge|gross")] == (1, "r8")
    assert drift[("invalid_enum", "setting")] == (1, "r5")
    assert drift[("code_type_pair_incomplete", "code|1")] == (1, "r5")
    assert {k for k, _ in drift} >= {"utf8_bom_stripped", "unmapped_column", "discovery_mrf_url_missing_scheme", "ragged_row"}
    f = read("file").first()
    assert (f["license_state"], f["location_names"], f["type_2_npis"], f["attestation"]) == ("ZZ", ["Elm Hill", "Elm Hill East"], ["9000000001", "9000000002"], "true")


def test_restaging_replaces_and_empty_reads(spark, tall, tmp_path):
    landed = landing.land("elm-hill", tall, tmp_path / "root")
    out = str(tmp_path / "staged")
    for _ in range(2):
        staging.stage_file(spark, landed, "csv_tall", out)
    assert staging.read_staged(spark, out, "charges").count() == 3
    assert staging.read_staged(spark, out, "modifiers").count() == 0
    assert staging.read_staged(spark, str(tmp_path / "none"), "charges").count() == 0


def test_truncated_tall_file(spark, tmp_path):
    f = tmp_path / "short.csv"
    f.write_text(HEAD + "\n")
    out = str(tmp_path / "staged")
    assert staging.stage_file(spark, landing.land("s", f, tmp_path / "root"), "csv_tall", out)["records_read"] == 0
    kinds = {r["kind"] for r in staging.read_staged(spark, out, "drift").collect()}
    assert "truncated_header" in kinds and "missing_required_meta" in kinds


DOC = {
    "standard_charge_information": [
        {"description": "one", "drug_information": {"unit": "2", "type": "ML"}, "code_information": [{"code": "X1", "type": "CDM"}, {"code": "", "type": "CPT"}], "odd": 1, "standard_charges": [{"setting": "both", "gross_charge": "12.50", "minimum": True, "extra": [1], "payers_information": [{"payer_name": "P", "plan_name": "Q", "standard_charge_dollar": 5, "methodology": "Other"}, {"payer_name": "R", "plan_name": "S", "weird": None}]}, {"setting": "inpatient", "modifier_code": ["50", "RT"], "gross_charge": 7}]},
        "no object",
        {"description": "none", "standard_charges": []},
        {"standard_charges": ["x", {"setting": "both"}]},
    ],
    "hospital_name": "Elm", "last_updated_on": "2025-01-02", "version": "3.0.0", "location_name": "Elm", "hospital_address": ["1 Oak"], "type_2_npi": ["9"], "attestation": {"confirm_attestation": True, "attester_name": "A"}, "license_information": {"state": "zz", "license_number": "7"}, "surprise": {"a": 1},
    "modifier_information": [{"code": "50", "description": "d", "modifier_payer_information": [{"payer_name": "P", "plan_name": "Q", "description": "e"}]}, {"code": "RT", "description": "f"}],
}


@pytest.mark.parametrize("first", [True, False])
def test_json_file_is_staged_whole(spark, tmp_path, rows, first):
    doc = DOC if first else dict(reversed(list(DOC.items())))
    f = tmp_path / "f.json"
    f.write_text(("﻿" if first else "") + json.dumps(doc))
    out = str(tmp_path / "staged")
    got = staging.stage_file(spark, landing.land("elm", f, tmp_path / "root"), "json", out)
    assert got == {"records_read": 7, "charge_rows": 4, "quarantined_rows": 3}
    read = lambda n: staging.read_staged(spark, out, n)
    c = read("charges")
    assert rows(c, "source_locator", "payer_name", "gross_charge", "negotiated_dollar", "modifiers") == [("i0.s0.p0", "P", 12.5, 5.0, None), ("i0.s0.p1", "R", 12.5, None, None), ("i0.s1.p-", None, 7.0, None, "50|RT"), ("i3.s1.p-", None, None, None, None)]
    assert json.loads(c.where("source_locator = 'i0.s0.p1'").first()["unmapped_json"]) == {"item.odd": 1, "standard_charges.extra": [1], "payers_information.weird": None}
    assert c.where("source_locator = 'i0.s0.p0'").first()["drug_unit_of_measurement"] == 2.0
    assert rows(read("codes"), "code_seq", "code") == [(1, "X1")]
    assert rows(read("quarantine"), "source_locator", "reason") == [("i1", "item_unmappable"), ("i2", "item_unmappable"), ("i3.s0", "standard_charge_unmappable")]
    n = {(r["kind"], r["column"]): r["n"] for r in read("drift").collect()}
    assert n[("unmapped_field", "item.odd")] == 1 and n[("unmapped_field", "standard_charges.extra")] == 1 and n[("unmapped_field", "payers_information.weird")] == 1
    assert n[("numeric_encoded_as_string", "gross_charge")] == 2 and n[("numeric_encoded_as_string", "unit")] == 1
    assert n[("unparseable_numeric", "minimum")] == 2
    assert n[("missing_required_field", "item.description")] == 1 and n[("unmapped_meta_column", "surprise")] == 1
    assert rows(read("modifiers"), "modifier_locator", "code", "payer_name") == [("m0.p0", "50", "P"), ("m1.p-".replace("-", "0"), "RT", None)]
    row = read("file").first()
    assert (row["license_state"], row["attestation"], row["location_names"]) == ("ZZ", "true", ["Elm"])


def test_split_object_keeps_items_apart():
    text = '{"a": [1, {"b": "x]"} , "y"], "meta": {"k": [1]}, "n": -1.5e3}'
    for step in (1, 3, 7, 1000):
        pos = [0]

        def read(_n, step=step, pos=pos):
            part = text[pos[0] : pos[0] + step]
            pos[0] += len(part)
            return part

        got = [(k, n, p, json.loads(j)) for k, n, p, j in records.split_object(read, "a")]
        assert got == [("item", "a", 0, 1), ("item", "a", 1, {"b": "x]"}), ("item", "a", 2, "y"), ("member", "meta", 0, {"k": [1]}), ("member", "n", 0, -1500.0)]


@pytest.mark.parametrize("text,last", [("[1]", "no_object"), ('{"a": {"x": 1}}', "no_array"), ('{"a": [1, {"b": 2', "broken"), ("", "no_object"), ('{"a": [1 2]}', "broken")])
def test_split_object_of_faulty_files(text, last):
    parts = iter([text, ""])
    got = list(records.split_object(lambda n: next(parts, ""), "a"))
    assert got[-1][0] == last


def test_index_files_and_landing(tmp_path):
    text = "location-name: Elm\r\nsource-page-url: elm.invalid/p\r\nmrf-url: elm.invalid/f.csv\r\n\r\nlocation-name: Oak\r\nmrf-url: https://oak.invalid/g.json\r\ncontact: x\r\n\r\nlocation-name: none\r\n"
    found = landing.parse_index(text)
    assert [(x.name, x.url, x.page, x.fixes) for x in found] == [("Elm", "https://elm.invalid/f.csv", "https://elm.invalid/p", ("mrf_url_missing_scheme", "source_page_url_missing_scheme")), ("Oak", "https://oak.invalid/g.json", None, ())]
    assert landing.find_location(found, " oAK ").name == "Oak" and landing.find_location(found, "ash") is None
    f = tmp_path / "a.csv"
    f.write_text("x")
    one, two = landing.land("h", f, tmp_path / "r"), landing.land("h", f, tmp_path / "r")
    assert one == two and one.sha256[:16] in one.path
    assert landing.filename_of("https://h.invalid/a%20b.csv?x=1") == "a b.csv"
    assert landing.filename_of("https://h.invalid/x", 'Content-Disposition: attachment; filename="q.csv"\r\n') == "q.csv"


def test_downloads_are_tried_again_for_broken_networks_only(tmp_path):
    class Done:
        def __init__(self, code):
            self.returncode, self.stdout = code, "200"

    for codes, want in (([92, 0], 200), ([0], 200), ([22], None), ([6, 6], None)):
        left = list(codes)
        run = lambda *a, **k: Done(left.pop(0))  # noqa: B023, E731
        if want:
            assert landing.download("u", tmp_path / "o", run=run, sleep=lambda s: None) == want
        else:
            with pytest.raises(RuntimeError):
                landing.download("u", tmp_path / "o", run=run, sleep=lambda s: None)
        assert not left


def test_numbers_of_variants(spark):
    from rateloom.functions.numbers import variant_number

    data = [("1.5",), ('"1.5"',), ("true",), ("null",), ('"nan"',), ("[1]",), ('" 7 "',), (None,)]
    df = spark.createDataFrame(data, "j string").select("j", variant_number(F.try_parse_json("j")).alias("n"))
    got = {r["j"]: (r["n"]["value"], r["n"]["ok"], r["n"]["as_text"]) for r in df.collect()}
    assert got == {"1.5": (1.5, True, False), '"1.5"': (1.5, True, True), "true": (None, False, False), "null": (None, True, False), '"nan"': (None, False, False), "[1]": (None, False, False), '" 7 "': (7.0, True, True), None: (None, True, False)}
