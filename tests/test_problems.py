"""The problem operators against row-at-a-time versions, on test data and on hand-made odd cases."""

import datetime as dt
import json
import math
import random
import struct
from collections import Counter

import brute
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from rateloom.operators import cdc_store, drift, nested, quantiles, quarantine, snapshots
from rateloom.plans import materialize, skew
from rateloom.queries import problems


def plain(df):
    def value(v):
        return v.asDict() if hasattr(v, "asDict") else v

    return [{k: value(v) for k, v in r.asDict().items()} for r in df.collect()]


def read(spark, name):
    return plain(spark.read.parquet(f"{DATA}/{name}.parquet"))


BRUTE = {
    "p1_found": (brute.p1, ["hpt_csv_records"]),
    "p2_found": (brute.p2, ["nppes_full", "file_log"]),
    "p3_found": (brute.p3, ["nppes_full", "file_log"]),
    "p4_found": (brute.p4, ["hpt_json_rows", "stg_hpt__files"]),
    "p5_found": (brute.p5, ["fct_standard_charges"]),
    "p6_found": (brute.p6, ["nested_records"]),
    "p7_found": (brute.p7, ["provider_history", "nppes_changes", "file_log"]),
}


@pytest.mark.parametrize("name", BRUTE)
def test_found_equals_brute_force(spark, name):
    f, tables = BRUTE[name]
    want = Counter(f(*[read(spark, t) for t in tables]))
    got = Counter(tuple(r) for r in problems.QUERIES[name](spark, DATA).collect())
    assert got == want and sum(got.values()) > 0


@pytest.mark.parametrize("name", BRUTE)
def test_empty_tables_give_no_rows(spark, name, tmp_path):
    for t in BRUTE[name][1]:
        spark.read.parquet(f"{DATA}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert problems.QUERIES[name](spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", BRUTE)
def test_extra_columns_and_nulls_do_no_harm(spark, name, tmp_path):
    """Columns with the names used inside, and a row of nothing but nulls in every table."""
    extra = ["seq", "bucket", "_r", "_n", "_names", "value", "member", "path", "kind_", "salt", "_salt", "n", "_at", "day", "entity", "tokens", "_bits", "_v"]
    f, tables = BRUTE[name]
    for t in tables:
        df = spark.read.parquet(f"{DATA}/{t}.parquet")
        df = df.unionByName(spark.createDataFrame([tuple([None] * len(df.columns))], df.schema))
        for c in extra:
            if c not in df.columns:
                df = df.withColumn(c, F.lit("clash"))
        df.write.parquet(f"{tmp_path}/{t}.parquet")
    want = Counter(f(*[read(spark, t) for t in tables]))
    got = Counter(tuple(r) for r in problems.QUERIES[name](spark, str(tmp_path)).collect())
    assert got == want


# ---------------------------------------------------------------- 1

RECORD = "record_no long, source_sha256 string, hospital_id string, raw_record string"


def found(spark, records, header="Setting,COUNT,standard_charge | gross,note"):
    rows = [(3, "f", "h", header), *[(4 + i, "f", "h", r) for i, r in enumerate(records)]]
    df = spark.createDataFrame(rows, RECORD)
    got = {r["record_no"] - 4: r["reason"] for r in quarantine.reclassify(quarantine.read_permissive(df)).collect()}
    as_dicts = [dict(zip(("record_no", "source_sha256", "hospital_id", "raw_record"), r)) for r in rows]
    assert {(("f"), k + 4, v) for k, v in got.items()} == brute.p1(as_dicts)
    return got


def test_reasons_of_odd_records(spark):
    cases = {
        "inpatient,0,1.5,x": None, "": None, " , ,": None, '"","","",""': None, None: None, ",,,,,,,": None,
        'inpatient,0,1.5,"x': "broken_quoting", 'a"b,0,1,': "broken_quoting", '"a" ,0,1,': "broken_quoting", '"a"b",0,1,': "broken_quoting", ' "a",0,1,x': "broken_quoting", '"': "broken_quoting",
        "both,0,1.5": "column_count", "both,0,1.5,x,y": "column_count", 'both,0,1.5,"x,y"': None, 'both,0,1.5,"x\ny ""q"""': None, '"both","0","1.5",""""': None,
        "nowhere,0,1.5,x": "invalid_value", "BOTH,1 Through 10,1e3,x": None, "both,5,1,x": "invalid_value", "both,11,1,": None, "both,10,1,": "invalid_value", "both,011,1,": None, "both,00,1,": "invalid_value", "both,11.0,1,": "invalid_value",
        "both,0,$1,": "invalid_value", "both,0,nan,": "invalid_value", "both,0,1_0,": "invalid_value", "both,0,+.5E-3,": None, "both,0,1.,": None, "both,0,., ": "invalid_value", "both,0, 7 ,": None, "both,0,1d,": "invalid_value",
        "both,0," + "9" * 200_000 + "x,": "invalid_value", '"' + 'a""' * 50_000 + '",0,1,': "invalid_value", "both,0,1," + "y" * 300_000: None,
    }
    got = found(spark, list(cases))
    assert {c: got.get(i) for i, c in enumerate(cases)} == cases


def test_cells_may_hold_any_sign(spark):
    signs = ["\ufdd0", "\ufdd1", "\ufdd10", "\ufdd1\ufdd0,1", "\x01", "a"]
    records = [f'both,0,1.5,"{x}{y}"' for x in signs for y in signs] + ["both,0,1.5,\ufdd0\ufdd1", "both,0,1.5,\ufdd0,\ufdd1", "nowhere\ufdd0,0,1,x"]
    got = found(spark, records)
    assert got == {len(signs) ** 2 + 1: "column_count", len(signs) ** 2 + 2: "invalid_value"}
    cells = spark.createDataFrame([(r,) for r in records[:-3]], "r string").select("r", quarantine.cells_of(quarantine.quote_pieces(F.col("r"))).alias("c")).collect()
    assert all(x["c"] == brute.split_record(x["r"])[1] for x in cells)


def test_quoting_equals_a_character_machine(spark):
    rnd = random.Random(5)
    found(spark, ["".join(rnd.choice('aa"",,\n 1') for _ in range(rnd.randrange(14))) for _ in range(3_000)], "a,b,c")


def test_file_without_header_and_repeated_records(spark):
    df = spark.createDataFrame([(4, "f", "h", "a,b"), (4, "f", "h", "a,b"), (5, "f", "h", ""), (None, "f", "h", "x"), (4, None, "h", "x")], RECORD)
    got = {(r["source_sha256"], r["record_no"], r["reason"]) for r in quarantine.reclassify(quarantine.read_permissive(df)).collect()}
    assert got == {("f", 4, "column_count"), (None, 4, "column_count")}


def test_valid_rows_are_typed(spark):
    df = spark.createDataFrame([(3, "f", "h", "﻿count,Setting,standard_charge| gross"), (4, "f", "h", '0,BOTH," 1e2 "'), (4, "f", "h", '0,BOTH," 1e2 "'), (5, "f", "h", "5,both,1")], RECORD)
    rows = quarantine.valid_rows(quarantine.read_permissive(df)).collect()
    assert [(r["record_no"], r["count"], r["setting"], r["standard_charge_gross"], r["payer_name"]) for r in rows] == [(4, "0", "both", 100.0, None)]


# ---------------------------------------------------------------- 2 and 3

FULL = "source_file string, npi string, " + ", ".join(f"{f} {'array<string>' if f == 'taxonomy_codes' else 'string'}" for f in brute.FIELDS) + ", last_update_date string"
LOG = "seq int, source_file string, kind string, coverage_end date, outcome string"


def snapshot_tables(spark, rows):
    """rows: (file number, npi, city, update date, deactivation, reactivation, codes)."""
    data = []
    for f, npi, city, day, off, on, codes in rows:
        r = dict.fromkeys(brute.FIELDS) | {"practice_city": city, "deactivation_date": off, "reactivation_date": on, "taxonomy_codes": codes}
        data.append((f"f{f}", npi, *[r[c] for c in brute.FIELDS], day))
    log = [(10 - i, f"f{i}", "full", dt.date(2025, i, 1), "rejected_schema" if i == 9 else "applied") for i in range(1, 10)] + [(11, "f1", "full", dt.date(2025, 1, 1), "applied")]
    return spark.createDataFrame(data, FULL), spark.createDataFrame(log, LOG)


def both(spark, rows):
    df, log = snapshot_tables(spark, rows)
    files = snapshots.applied_files(log, df)
    snaps = snapshots.canonical_snapshots(df, files)
    names = {r["seq"]: r["source_file"] for r in files.collect()}
    changes = {(names[r["seq"]], r["npi"], r["change_kind"]) for r in snapshots.snapshot_changes(snaps, files).collect()}
    hist = {(r["npi"], r["version"], r["valid_from"].isoformat(), r["valid_to"].isoformat() if r["valid_to"] else "", r["status"]) for r in snapshots.attribute_history(snaps, files).collect()}
    a, b = plain(df), plain(log)
    assert changes == brute.p2(a, b)
    assert hist == brute.p3(a, b)
    return changes, hist


def test_snapshots_of_odd_rows(spark):
    n = None
    rows = [
        (1, "1", "A", "1/5/2024", n, n, ["x"]), (1, "1", "OLD", "", n, n, n), (2, " 1 ", " A", "01/05/2024", "", n, ["x", "", n]), (3, "1", "B", "1/4/2024", n, n, n), (4, "1", "B", "1/6/2024", n, n, ["x"]),
        (1, "2", "A", "1/1/2024", n, n, n), (3, "2", "A", "1/1/2024", n, n, []), (4, "2", "A", "1/1/2024", "2/1/2024", n, n), (5, "2", "A", "1/1/2024", "2/1/2024", "2/1/2024", n),
        (1, "3", "A", "5/5/2024", n, n, n), (2, "3", "B", "1/1/2024", n, n, n), (4, "3", "C", "1/1/2024", n, n, n), (5, "3", "A", "5/5/2024", n, n, n),
        (2, "4", n, n, n, n, ["b", "a"]), (3, "4", "", n, n, n, ["a", "b"]), (4, "4", "x" * 100_000, n, n, n, n), (9, "5", "A", n, n, n, n), (1, n, "A", n, n, n, n), (1, " ", "A", n, n, n, n),
        (3, "6", "A", "1/1/2024", n, n, n), (4, "6", "A", "1/1/2024", n, n, n), (4, "6", "A", "1/1/2024", n, n, n),
    ]
    changes, hist = both(spark, rows)
    assert ("f3", "4", "changed") in changes and not any(k[1] == "5" for k in changes)
    assert sorted(h[1:] for h in hist if h[0] == "2")[1] == (2, "2025-02-01", "2025-03-01", "absent_from_full")


def test_snapshots_of_random_rows(spark):
    rnd = random.Random(7)
    rows = [(f, str(k), rnd.choice("AB"), rnd.choice(["", "1/1/2024", "01/2/2024"]), None, None, None) for k in range(400) for f in range(1, 6) if rnd.random() < 0.7]
    both(spark, rows)


def test_a_row_without_a_date_is_never_stale(spark):
    _, hist = both(spark, [(1, "1", "A", "1/1/2024", None, None, None), (2, "1", "B", None, None, None, None), (3, "1", "C", "2/1/2024", None, None, None), (4, "1", "D", "1/15/2024", None, None, None)])
    assert sorted(h[1:4] for h in hist) == [(1, "2025-01-01", "2025-02-01"), (2, "2025-02-01", "2025-03-01"), (3, "2025-03-01", "")]


def test_changed_fields_are_named(spark):
    df, log = snapshot_tables(spark, [(1, "1", "A", None, None, None, ["x"]), (2, "1", "B", None, None, None, ["y"])])
    files = snapshots.applied_files(log, df)
    r = snapshots.snapshot_changes(snapshots.canonical_snapshots(df, files), files).first()
    assert r["changed_fields"] == ["practice_city", "taxonomy_codes"]


# ---------------------------------------------------------------- 4

LINES = "hospital_id string, source_sha256 string, line_no long, line_key string, row_json string"


def schema_tables(spark, files):
    rows = [("h", f"s{i}", n, str(n), j) for i, lines in enumerate(files) for n, j in enumerate(lines)]
    listed = [(f"s{i}", f"2024-01-{i + 1:02d}" if i % 2 else f"1/{i + 1}/2024") for i in range(len(files))] + [("s0", None)]
    return spark.createDataFrame(rows, LINES), spark.createDataFrame(listed, "source_sha256 string, last_updated_on string")


def test_schema_changes_of_odd_lines(spark):
    files = [
        ['{"A | B": 1, "old": "x1", "t": 1, "same": null, "flag": true}', '{"a|b": 2, "old": "x2", "t": 2, "flag": false}', "no json", "[1]", "null"],
        ['{"a|b": "1", "new": "x1", "t": 1.0, "same": {"k": 1}, "flag": true}', '{"a|b": "2", "new": "x2", "t": null}', None],
        ['{"new": "x1", "other": 1}', '{"new": "x2", "other": 2}'],
        ['{"NEW": "x1", "moved": 1.0}', '{"new": "x2", "moved": 9}', '{"extra": [1]}'],
        [],
        ['{"z": 1}'],
    ]
    rows, listed = schema_tables(spark, files)
    got = {(r["source_sha256"], r["kind"], r["column_name"], r["new_name"]) for r in drift.schema_changes(rows, listed).collect()}
    usable = []
    for r in plain(rows):
        try:
            if isinstance(json.loads(r["row_json"] or ""), dict):
                usable.append(r)
        except ValueError:
            pass
    # s5 follows s3: a file without lines has no place
    assert got == brute.p4(usable, plain(listed))
    assert ("s1", "renamed", "old", "new") in got and ("s1", "retyped", "a|b", "") in got and ("s3", "renamed", "other", "moved") in got


def test_unlike_names_are_matched_by_values_and_kept_one_to_one():
    old = [("payer", "string", None), ("gross", "number", None), ("note", "string", None)]
    new = [("payer", "string", None), ("chargemaster", "number", None), ("net", "number", None)]
    got = drift.flood(old, new, {("gross", "chargemaster"): 0.9, ("gross", "net"): 0.1})
    assert [g[:2] for g in got][:1] == [("gross", "chargemaster")] and len({g[0] for g in got}) == len(got) == len({g[1] for g in got})


def flat(t):
    return t.withColumn("value", F.coalesce(F.col("number").cast("string"), F.col("flag").cast("string"), "value"))


def test_members_of_a_schema_text():
    text = "OBJECT<``: BIGINT, `A:B<c>, d`: NUMBER, `a | b`: DECIMAL(3,1), arr: ARRAY<OBJECT<u: BIGINT, `x>`: VOID>>, n: VOID, o: OBJECT<k: ARRAY<VARIANT>, `q``z`: BIGINT>, t: BOOLEAN, x: STRING>"
    assert [m[:2] for m in drift.members_of(text)] == [("", "number"), ("A:B<c>, d", "number"), ("a | b", "number"), ("arr", "array"), ("n", None), ("o", "object"), ("t", "boolean"), ("x", "string")]
    assert drift.members_of(text)[5][2].startswith("OBJECT<k") and drift.members_of("OBJECT<>") == ()


def test_lines_in_one_table(spark, rows):
    data, listed = schema_tables(spark, [['{"old": "5", "x": 1}', '{"old": "6"}'], ['{"mid": "5"}', '{"mid": "6"}'], ['{"last": 5}', '{"last": 6}']])
    changes = drift.schema_changes(data, listed)
    t = flat(drift.consistent_table(data, listed, changes))
    assert rows(t.where("source_sha256 = 's0'"), "column_name", "column_type", "value") == [("last", "number", "5.0"), ("last", "number", "6.0"), ("x", "number", "1.0")] or rows(t.where("source_sha256 = 's0'"), "column_name") == [("mid",), ("mid",), ("x",)]


def test_lines_of_unplaced_files_are_in_the_table(spark, rows):
    data, listed = schema_tables(spark, [['{"old": 5}', '{"old": 6}'], ['{"last": 5}', '{"last": 6}']])
    more = [("h", "undated", 0, "0", '{"OLD | x": "7", "old": "8"}'), ("h", "undated", 1, "1", "no json"), ("h", "unlisted", 0, "0", '{"last": "9"}'), (None, "s9", 0, "0", '{"last": true}'), (None, None, 0, "0", '{"a": 1}'), ("g", "s0", 0, "0", '{"old": "1"}')]
    data = data.unionByName(spark.createDataFrame(more, LINES))
    listed = listed.unionByName(spark.createDataFrame([("undated", None), ("s9", "2024-03-01")], listed.schema))
    t = flat(drift.consistent_table(data, listed, drift.schema_changes(data, listed)))
    want = [("h", "s0", 0, "last", "number", "5.0"), ("h", "s0", 1, "last", "number", "6.0"), ("h", "s1", 0, "last", "number", "5.0"), ("h", "s1", 1, "last", "number", "6.0"), ("h", "undated", 0, "old|x", "string", "7"), ("h", "undated", 0, "old", "string", "8")]
    # a line that is no JSON object has no members
    want += [("h", "unlisted", 0, "last", "string", "9"), (None, "s9", 0, "last", "boolean", "true"), (None, None, 0, "a", "number", "1.0"), ("g", "s0", 0, "old", "string", "1")]
    assert rows(t, "hospital_id", "source_sha256", "line_no", "column_name", "column_type", "value") == sorted(want, key=repr)


# ---------------------------------------------------------------- 5


def signed_bits(x):
    b = struct.unpack("<Q", struct.pack("<d", abs(x)))[0]
    return -b if x < 0 else b


def test_bits_keep_the_order_and_come_back(spark):
    rnd = random.Random(1)
    values = [0.0, -0.0, 1.0, -1.0, 0.1, 1e308, -1e308, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, math.inf, -math.inf, 0.5, 2.0, math.nextafter(2, 0), math.nextafter(2, 3), 1.7976931348623157e308]
    values += [struct.unpack("<d", struct.pack("<Q", rnd.getrandbits(64)))[0] for _ in range(20_000)]
    values = [v for v in values if not math.isnan(v)]
    df = quantiles.with_ordered_bits(spark.createDataFrame([(v,) for v in values], "x double"), F.col("x"), "b")
    df = df.select("x", "b", quantiles.from_bits(F.col("b")).alias("y"))
    for r in df.collect():
        assert r["b"] == signed_bits(r["x"]) and r["y"] == r["x"], r


@pytest.mark.parametrize("exact", [True, False])
def test_percentiles_of_odd_groups(spark, exact):
    import numpy as np

    rnd = np.random.default_rng(3)
    groups = {"a": rnd.lognormal(5, 2, 500), "b": np.array([7.0]), "c": np.repeat(3.25, 40), "d": np.concatenate([-rnd.random(50), rnd.random(51)]), None: np.arange(10.0), "e": np.array([1e-310, 1e300])}
    data = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("a", None), ("a", math.nan), ("f", None)]
    df = spark.createDataFrame(data, "g string, x double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    if exact:
        got = quantiles.radix_percentiles(df, ["g"], "x", probs)
    else:
        half = [quantiles.radix_summary(df.where(F.pmod(F.xxhash64("x"), F.lit(2)) == k), ["g"], "x") for k in (0, 1)]
        got = quantiles.summary_percentiles(quantiles.merge_summaries(*half), ["g"], probs)
    rows = {r["g"]: r for r in got.collect()}
    assert set(rows) == set(groups)
    for g, vs in groups.items():
        assert rows[g]["n"] == len(vs)
        for p in probs:
            want, have = float(np.quantile(vs, p)), rows[g][quantiles.name_of(p)]
            assert have == pytest.approx(want, rel=1e-12 if exact else 2.0**-20, abs=1e-300 if exact else 1e-6), (g, p)


def test_rates_count_each_charge_once(spark, rows):
    t = dt.datetime(2025, 1, 1)
    data = [("c1", "h", " Pay ", 5.0, t), ("c1", "h", "pay", 5.0, t), ("c2", "h", None, 5.0, t), ("c3", "h", "p", 999999999.0, t), ("c4", "h", "p", -1.0, t), ("c5", "h", "p", math.nan, t), ("c6", "h", "p", None, t), (None, "h", "p", 1.0, t)]
    df = spark.createDataFrame(data, "charge_id string, hospital_id string, payer_name string, negotiated_rate double, loaded_at timestamp")
    assert rows(problems.rates(df), "payer", "negotiated_rate") == [("pay", 5.0), (None, 5.0)]


# ---------------------------------------------------------------- 6


def test_references_and_payers_of_odd_bodies(spark):
    bodies = [
        ("fhir_bundle", '{"resourceType":"Bundle","link":{"reference":"L"},"entry":{"resource":{"resourceType":"P","id":"1","a":[[{"reference":"r"}],{"reference":7},{"reference":null},{"reference":["x"]}],"reference":"own"}}}'),
        ("fhir_bundle", '{"resourceType":"Bundle","entry":[{"resource":{"resourceType":"P","contained":[{"resourceType":"Q","id":"2","s":{"reference":"#"}}],"t":{"\\u0072eference":"esc\\/aped \\ud800"}}}]}'),
        ("fhir_bundle", '{"resourceType":"Patient","id":"root","x":{"reference":"r"}}'), ("fhir_bundle", '[{"reference":"list"}]'), ("fhir_bundle", '{"a":{"reference":"cut'), ("fhir_bundle", None), ("fhir_bundle", ""), ("fhir_bundle", "NaN"), ("fhir_bundle", '{"x": NaN}'), ("fhir_bundle", "\"{\\\"reference\\\": \\\"text\\\"}\""),
        ("hpt_file", '{"modifier_information":{"code":"50","modifier_payer_information":{"payer_name":"P"}}}'), ("hpt_file", '{"modifier_information":[{"code":null,"modifier_payer_information":[{"payer_name":"P"},{"payer_name":""},{"payer_name":null},{}]},{"modifier_payer_information":null},{"code":"x"}]}'), ("hpt_file", '{"other":{"modifier_information":[{"modifier_payer_information":[{"payer_name":"no"}]}]}}'), ("hpt_file", "{}"),
    ]
    df = spark.createDataFrame([(i, k, b) for i, (k, b) in enumerate(bodies)] + [(100, *bodies[0]), (101, *bodies[0])], "record_id long, record_kind string, body string")
    got = Counter((r["record_id"], r["owner"], r["path"], r["item_value"]) for part in (nested.references(df.where("record_kind = 'fhir_bundle'")), nested.modifier_payers(df.where("record_kind = 'hpt_file'"))) for r in part.collect())
    want = Counter({tuple(x.replace("\ud800", "�") if isinstance(x, str) else x for x in k): v for k, v in brute.p6(plain(df)).items()})
    assert got == want and got[(100, "1", "entry.resource.a[0][0].reference", "r")] == 1


@pytest.mark.parametrize("text", ["1", ' {"a": [1, 2.5e3, "x\\n", null, true, {}], "b": {"c": []}} ', "[[[[]]]]", '"s"', "{}", '{"a":1,}', "[1,]", "[1 2]", '{"a" 1}', '{1:2}', "", "01", "[", "tru", '"\x01"', "1 1", '{"a":1}}', "-", "1.", '{"a":tru}'])
def test_iterative_parser_equals_the_recursive_one(text):
    try:
        want = json.loads(text)
    except ValueError:
        for read in (nested.parse_iteratively, nested.stream):
            with pytest.raises(ValueError):
                read(text)
    else:
        assert nested.parse_iteratively(text) == want


def test_nesting_beyond_the_recursive_parser(spark):
    depth = 50_000
    body = '{"resourceType":"Bundle","e":' + '{"a":' * depth + '{"reference":"deep"}' + "}" * depth + "}"
    r = nested.references(spark.createDataFrame([(1, body)], "record_id long, body string")).collect()
    assert len(r) == 1 and r[0]["item_value"] == "deep" and r[0]["path"].count(".a") == depth


def test_flat_tables_keep_their_parents(spark, rows):
    bodies = [
        '{"orders":[{"id":"o1","lines":[{"sku":"a","qty":1},{"sku":"b"}]},{"id":"o2","lines":{"sku":"c","tags":["t"]}}]}',
        '{"orders":{"lines":[{},{"qty":{"n":1}},[{"sku":7}],null,3],"id":"lone"},"lines":[{"sku":"no"}]}',
        '{"orders":[]}', '{"orders":null}', '{"orders":[{}]}', "[1", None,
    ]
    t = nested.json_triples(spark.createDataFrame(list(enumerate(bodies)), "record_id int, body string"), "record_id", "body", containers=True)
    assert rows(nested.table_of(t, "record_id", "orders.lines", ["sku", "qty"])) == sorted([
        (0, "orders[0].lines[0]", "orders[0]", 0, "a", "1"), (0, "orders[0].lines[1]", "orders[0]", 1, "b", None), (0, "orders[1].lines", "orders[1]", None, "c", None),
        (1, "orders.lines[0]", "orders", 0, None, None), (1, "orders.lines[1]", "orders", 1, None, None), (1, "orders.lines[2][0]", "orders", 0, "7", None),
    ], key=repr)
    assert rows(nested.table_of(t, "record_id", "orders", ["id"]), "record_id", "row_path", "parent_path", "id") == sorted([(0, "orders[0]", "", "o1"), (0, "orders[1]", "", "o2"), (1, "orders", "", "lone"), (4, "orders[0]", "", None)], key=repr)
    assert rows(nested.table_of(t, "record_id", "orders.lines", ["sku"], ("sku",)).where("record_id = 1"), "sku") == [(None,)] * 3


def tree_triples(v, path="", pattern="", ordinals=(), name="", parent=None):
    """Triples from a parsed tree, recursively."""
    if isinstance(v, dict):
        for k, x in v.items():
            dot = "." if path else ""
            yield from tree_triples(x, f"{path}{dot}{k}", f"{pattern}{dot}{k}", ordinals, k, path)
    elif isinstance(v, list):
        for i, x in enumerate(v):
            yield from tree_triples(x, f"{path}[{i}]", pattern + "[]", (*ordinals, i), name, parent)
    else:
        yield path, pattern, list(ordinals), name, None if v is None else v if isinstance(v, str) else json.dumps(v), parent


def test_stream_equals_the_tree():
    rnd = random.Random(11)

    def value(depth):
        k = rnd.randrange(9 if depth < 4 else 6)
        if k > 6:
            return {rnd.choice('ab"\\é. ') * rnd.randint(1, 2): value(depth + 1) for _ in range(rnd.randrange(4))}
        if k == 6:
            return [value(depth + 1) for _ in range(rnd.randrange(4))]
        return rnd.choice([None, True, False, 0, -1, 2.5, 'x"\n\\', "", "漢"])

    for _ in range(2_000):
        v = value(0)
        text = json.dumps(v, ensure_ascii=rnd.random() < 0.5, indent=rnd.choice([None, 1]))
        assert [t[:5] + (t[6],) for t in nested.stream(text)] == list(tree_triples(v)), text
        cut = text[: rnd.randrange(len(text))]
        try:
            json.loads(cut)
        except ValueError:
            with pytest.raises(ValueError):
                nested.stream(cut)
    assert [t[0:5:4] for t in nested.stream('{"a":{"b":1,"c":2},"d":3,"a":{"b":4},"d":[5]}')] == [("a.b", "4"), ("d[0]", "5")]


# ---------------------------------------------------------------- 7

CHANGE = "change_id long, source_file string, line_no long, npi string, change_type string, last_update_date date, " + ", ".join(f"{a} string" for a in brute.ATTRS)
HISTORY = "npi string, version int, status string, last_update_date date, is_current boolean, " + ", ".join(f"{a} string" for a in brute.ATTRS)


def change_tables(spark, base, changes):
    day = lambda n: dt.date(2025, 1, 1) + dt.timedelta(n)
    h = [(k, 1, s, day(d), True, *[None] * 2, "BASE", *[None] * 3) for k, s, d in base]
    c = [(i + 1, f"w{f}", ln, k, t, day(d), None, None, city, None, None, None) for i, (f, ln, k, t, d, city) in enumerate(changes)]
    log = [(i, f"w{i}", "weekly", day(10 * i), "superseded_by_full" if i == 9 else "applied") for i in range(1, 10)]
    return spark.createDataFrame(h, HISTORY), spark.createDataFrame(c, CHANGE), spark.createDataFrame(log, LOG)


def applied(spark, base, changes, chunk=None):
    history, feed, log = change_tables(spark, base, changes)
    store = cdc_store.BucketStore(spark, materialize.scratch_path(spark, "test-store"))
    store.create(cdc_store.current_rows(history), "npi", 4)
    got = {(r["npi"], r["status"], r["change_id"], r["practice_city_change_id"]) for r in cdc_store.apply_changes(store, feed, log).collect()}
    assert got == brute.p7(plain(history), plain(feed), plain(log))
    return got, store


def test_changes_in_any_order(spark, monkeypatch):
    monkeypatch.setattr(cdc_store, "CHUNK_LINES", 2)
    base = [("1", "active", 0), ("2", "deactivated", 0), ("3", "absent_from_full", 5)]
    changes = [
        (2, 1, "1", "update", 3, "B"), (1, 1, " 1", " UPDATE ", 3, "B "), (1, 2, "1", "deactivate", 4, None), (1, 3, "1", "update", 5, "C"), (3, 1, "1", "reactivate", 6, None), (3, 2, "1", "reactivate", 7, "D"),
        (1, 4, "2", "update", 1, "X"), (1, 5, "2", "reactivate", 2, None), (1, 6, "2", "insert", 2, None), (1, 7, "3", "reactivate", 4, "OLD"), (1, 8, "3", "reactivate", 5, ""),
        (1, 9, "4", "update", 1, "N"), (1, 10, "4", "reactivate", 1, "N"), (1, 11, "4", "insert", 2, "N"), (1, 12, "4", "insert", 2, "N"), (9, 1, "4", "deactivate", 3, None), (1, 13, "5", "nonsense", 1, "Q"), (1, 14, "5", "deactivate", 1, None), (1, 15, "6", "insert", 1, None), (1, 16, "6", "deactivate", 1, None),
    ]
    got, store = applied(spark, base, changes)
    assert ("4", "active", 14, 14) in got and ("6", "deactivated", 20, 19) in got and not any(g[0] == "5" for g in got)
    m = store.manifest()
    assert m["version"] == 1 and store.read().where("npi = '2'").first()["practice_city"] is None
    untouched = set(map(str, range(4))) - set(map(str, m["touched"]))
    first = {v for k, v in m["files"].items() if k in untouched}
    assert len(first) <= 1


def test_random_changes(spark):
    rnd = random.Random(9)
    kinds = ["insert", "update", "deactivate", "reactivate", "update", "odd"]
    changes = [(rnd.randint(1, 3), n, str(rnd.randrange(300)), rnd.choice(kinds), rnd.randrange(4), rnd.choice([None, "A", "B"])) for n in range(2_500)]
    applied(spark, [(str(k), rnd.choice(["active", "deactivated"]), rnd.randrange(2)) for k in range(150)], changes)


def test_a_hot_key_with_many_changes(spark):
    n = 6_000
    df = spark.range(n).select((F.col("id") + 1).alias("change_id"), F.lit("w1").alias("source_file"), F.col("id").alias("line_no"), F.when(F.col("id") % 3 < 2, "hot").otherwise(F.col("id").cast("string")).alias("npi"), F.element_at(F.array(*map(F.lit, ["insert", "update", "deactivate", "reactivate"])), (F.xxhash64("id") % 4 + 4).cast("int") % 4 + 1).alias("change_type"), F.expr("date'2025-01-01' + cast(id % 50 as int)").alias("last_update_date"), *[F.lit(None).cast("string").alias(a) if a != "practice_city" else F.concat(F.lit("C"), F.col("id").cast("string")).alias(a) for a in brute.ATTRS])
    history, _, log = change_tables(spark, [("hot", "active", 0)], [(1, 1, "1", "insert", 1, None)])
    store = cdc_store.BucketStore(spark, materialize.scratch_path(spark, "test-store"))
    store.create(cdc_store.current_rows(history), "npi", 4)
    got = {(r["npi"], r["status"], r["change_id"], r["practice_city_change_id"]) for r in cdc_store.apply_changes(store, df, log).collect()}
    assert got == brute.p7(plain(history), plain(df), plain(log))


def test_a_second_writer_is_told(spark):
    _, store = applied(spark, [("1", "active", 0)], [(1, 1, "1", "update", 1, "A")])
    seen = store.manifest()
    store.versions.commit(seen)
    with pytest.raises(cdc_store.ConflictError):
        store.versions.commit(seen)


def test_a_run_that_dies_changes_nothing(spark, monkeypatch):
    history, feed, log = change_tables(spark, [("1", "active", 0), ("2", "active", 0)], [(1, 1, "1", "update", 1, "A"), (1, 2, "3", "insert", 1, "B")])
    store = cdc_store.BucketStore(spark, materialize.scratch_path(spark, "test-store"))
    store.create(cdc_store.current_rows(history), "npi", 4)
    before = sorted(map(tuple, store.read().collect()))
    for step in ("_write_log", "_write", "versions"):
        with monkeypatch.context() as mp:
            def dies(*_, **__):
                raise RuntimeError("killed")

            mp.setattr(store.versions, "commit", dies) if step == "versions" else mp.setattr(store, step, dies)
            with pytest.raises(RuntimeError):
                cdc_store.apply_changes(store, feed, log)
        assert store.manifest()["version"] == 0 and sorted(map(tuple, store.read().collect())) == before
    assert {(r["npi"], r["change_id"]) for r in cdc_store.apply_changes(store, feed, log).collect()} == {("1", 1), ("3", 2)}


def test_any_cut_into_batches_gives_the_same_table(spark, monkeypatch):
    monkeypatch.setattr(cdc_store, "MOST_LOGS", 2)
    rnd = random.Random(3)
    kinds = ["insert", "update", "deactivate", "reactivate", "update"]
    changes = [(rnd.randint(1, 3), n, str(rnd.randrange(25)), rnd.choice(kinds), rnd.randrange(6), rnd.choice([None, "A", "B"])) for n in range(200)] + [(1, 900, "1", "update", 5, "LAST"), (1, 901, "1", "update", 2, "LATE")]
    changes += changes[:30]
    history, feed, log = change_tables(spark, [(str(k), rnd.choice(["active", "deactivated"]), rnd.randrange(3)) for k in range(12)], changes)
    tables = []
    for cut in (1, 4):
        store = cdc_store.BucketStore(spark, materialize.scratch_path(spark, "test-store"))
        store.create(cdc_store.current_rows(history), "npi", 4)
        for b in range(cut):
            part = feed.where(F.pmod(F.xxhash64("change_id"), F.lit(cut)) == b)
            got = {r["npi"] for r in cdc_store.apply_changes(store, part, log, batch=b).collect()}
            assert cdc_store.apply_changes(store, part, log, batch=b).count() == 0
        tables.append(sorted((r["npi"], r["status"], r["practice_city"], r["change_id"], r["practice_city_change_id"], r["last_update_date"]) for r in store.read().collect()))
    assert tables[0] == tables[1] and len(store.manifest()["log"]) <= 3
    assert {(t[0], t[1], t[3], t[4]) for t in tables[0] if t[3]} == brute.p7(plain(history), plain(feed), plain(log))
    old = store.manifest()
    store.rebucket(7)
    assert sorted((r["npi"], r["status"], r["practice_city"], r["change_id"], r["practice_city_change_id"], r["last_update_date"]) for r in store.read().collect()) == tables[0] and store.manifest()["version"] == old["version"] + 1
    cdc_store.apply_changes(store, feed.limit(3), log, batch=99)
    assert sorted((r["npi"], r["status"], r["practice_city"], r["change_id"], r["practice_city_change_id"], r["last_update_date"]) for r in store.read().collect()) == tables[0]


# ---------------------------------------------------------------- plans


def test_salted_join_equals_a_join(spark, rows):
    left = spark.range(3_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("k"), "id").unionByName(spark.createDataFrame([(None, 1)], "k string, id long"))
    right = left.where("k is not null").select("k").distinct().withColumn("v", F.length("k"))
    for how in ("inner", "left", "left_semi"):
        got = skew.salted_join(left, right, ["k"], F.col("id"), how, fan=8, least=100)
        assert rows(got) == rows(left.join(right, "k", how))
    assert [k for (k,) in skew.hot_keys(left, ["k"], share=0.2, least=100)] == ["hot"]


def test_written_tables_go_to_the_shared_folder(spark):
    path = materialize.scratch_path(spark, "texts")
    assert path.startswith(materialize.shared_dir(spark))
    assert materialize.create_text(spark, f"{path}/x/y.txt", "a") and not materialize.create_text(spark, f"{path}/x/y.txt", "b")
    assert materialize.read_text(spark, f"{path}/x/y.txt") == "a" and materialize.read_text(spark, f"{path}/none") is None
