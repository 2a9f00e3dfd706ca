import datetime as dt
import json

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from rateloom import analysis, api, cli, gates, publish, release, report
from rateloom.marts import prices
from rateloom.operators import cdc_store
from rateloom.operators import relational as R
from rateloom.streaming import registry as streaming


@pytest.fixture
def tables(spark):
    charges = spark.createDataFrame([("c1", "i1", "h", "s", 100.25, 80.0, "P", "Q", "both", "x"), ("c2", "i1", "h", "s", 50.0, None, "P", None, None, "y"), ("c3", "i2", "g", "s", 30.0, 30.0, None, "Q", "both", None)], "charge_id string, item_id string, hospital_id string, source_sha256 string, gross_charge double, negotiated_rate double, payer_name string, plan_name string, setting string, description string").withColumn("discounted_cash", F.col("gross_charge"))
    codes = spark.createDataFrame([("i1", "h", 1, "99213", "CPT", "CPT_CAT_I"), ("i1", "h", 2, "X", "CDM", None), ("i2", "g", 1, "99213", "CPT", "CPT_CAT_I")], "item_id string, hospital_id string, code_seq long, code string, declared_type string, code_family string")
    history = spark.createDataFrame([("1", 1, dt.date(2020, 1, 1), dt.date(2021, 1, 1), False), ("1", 2, dt.date(2021, 1, 1), None, True), ("2", 1, dt.date(2020, 1, 1), None, True)], "npi string, version int, valid_from date, valid_to date, is_current boolean")
    files = spark.createDataFrame([("h", "s", "H", 3, 3, 0), ("g", "s", "G", 0, 0, 0)], "hospital_id string, source_sha256 string, hospital_name string, records_read long, charge_rows long, quarantined_rows long")
    drift = spark.createDataFrame([("h", "s", "blank_row", "", 2, "r4", None)], "hospital_id string, source_sha256 string, kind string, column string, n long, first_locator string, sample_value string")
    agg = prices.price_summary(charges, codes).withColumn("rate_basis", F.lit("dollar"))
    return {"fct_standard_charges": charges, "dim_charge_codes": codes, "dim_provider_history": history, "agg_code_prices": agg, "files": files, "rpt_source_conformance": prices.conformance(drift, files)}


def test_release_is_reproducible_and_tampering_shows(spark, tables, tmp_path):
    one = release.export(spark, tables, tmp_path / "a", {"x": 1})
    two = release.export(spark, tables, tmp_path / "b", {"x": 1})
    assert one["fingerprint"] == two["fingerprint"] and release.verify(spark, tmp_path / "a") == []
    values = json.loads((tmp_path / "a/check_values.json").read_text())["derived"]
    assert (values["charge_x_code_rows"], values["charges_to_codes_fanout"], values["gross_charge_sum_cents"], values["provider_history_max_version"]) == (5, 1.6667, 18025, 2)
    assert release.release(tmp_path / "a", tmp_path / "rel") and release.release(tmp_path / "b", tmp_path / "rel") is None
    changed = json.loads((tmp_path / "a/check_values.json").read_text())
    changed["derived"]["charges"] = 4
    (tmp_path / "a/check_values.json").write_text(json.dumps(changed))
    assert len(release.verify(spark, tmp_path / "a")) == 2
    part = next((tmp_path / "b/fct_standard_charges").glob("*.parquet"))
    data = bytearray(part.read_bytes())
    data[len(data) // 2] ^= 255
    part.write_bytes(bytes(data))
    assert any("differs" in x for x in release.verify(spark, tmp_path / "b"))
    part.unlink()
    assert any("missing" in x for x in release.verify(spark, tmp_path / "b"))


def test_release_refuses_repeated_keys_and_overlaps(spark, tables, tmp_path):
    for name, extra in (("dim_charge_codes", tables["dim_charge_codes"].limit(1)), ("dim_provider_history", spark.createDataFrame([("2", 2, dt.date(2020, 6, 1), None, False)], tables["dim_provider_history"].schema))):
        with pytest.raises(RuntimeError):
            release.export(spark, tables | {name: tables[name].unionByName(extra)}, tmp_path / "x", {})


def test_large_tables_keep_their_order_over_files(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("seq"), F.lit("x").alias("v"))
    files = release.write_table(df, ("seq",), tmp_path, "t", 300)
    got = [r["seq"] for f in files for r in spark.read.parquet(f"file://{tmp_path / f['file']}").collect()]
    assert len(files) > 1 and got == list(range(1000))


def test_publish_swaps_and_compares(spark, tables, tmp_path):
    two = {k: tables[k] for k in ("fct_standard_charges", "files")}
    assert not any(publish.publish(spark, two, tmp_path / "served").values())
    assert not any(publish.publish(spark, {"files": tables["files"]}, tmp_path / "served").values())
    assert [p.name for p in (tmp_path / "served").iterdir()] == ["files"]
    assert publish.parity(tables["files"], tables["files"].withColumn("records_read", F.col("records_read") + 1))
    bad = spark.range(1).select(F.raise_error(F.lit("no")).cast("string").alias("x"))
    with pytest.raises(Exception):
        publish.publish(spark, {"files": bad}, tmp_path / "served")
    assert (tmp_path / "served/files").exists() and publish.close(1.0, 1.0 + 1e-12) and not publish.close(None, 0)


def test_read_functions(spark, tables, tmp_path, rows):
    release.export(spark, tables, tmp_path / "r", {})
    r = api.Release(spark, tmp_path / "r")
    assert r.health()["status"] == "ok" and [x["hospital_id"] for x in r.hospitals().collect()] == ["g", "h"]
    assert r.prices("99213").count() == 3 and r.prices(" 99213 ", "g").count() == 1 and r.prices("' or 1=1 --").count() == 0
    assert [x["charge_id"] for x in r.charges("99213").collect()] == ["c3", "c1", "c2"] and r.charges("99213", limit=1, offset=1).first()["charge_id"] == "c1"
    assert r.conformance("h").count() == 1 and r.detail("files", "h").count() == 1
    for bad in (lambda: r.charges("x", limit=0), lambda: r.charges("x", limit=1001), lambda: r.prices("x", rate_basis="none")):
        with pytest.raises(api.Invalid):
            bad()
    with pytest.raises(api.NotFound):
        r.detail("files", "nobody")


def test_gates_fire_on_planted_faults(spark, tables):
    h, c, k = tables["dim_provider_history"], tables["fct_standard_charges"], tables["dim_charge_codes"]
    row = lambda *v: spark.createDataFrame([v], h.schema)
    clean = {"grain": gates.grain(c, ["charge_id"]), "codes": gates.grain(k, ["item_id", "code_seq"]), "current": gates.one_current_version(h, "npi"), "dense": gates.versions_dense(h, "npi"), "valid": gates.intervals_valid(h), "gaps": gates.history_gaps(h, "npi"), "overlaps": gates.history_overlaps(h, "npi"), "types": gates.safe_types(c), "related": gates.relationship(k, "item_id", c, "item_id"), "kinds": gates.accepted(k, "declared_type", ["CPT", "CDM"]), "there": gates.not_null(c, "charge_id", "item_id"), "ids": gates.matches(h, "npi", "[0-9]")}
    assert set(gates.run_gates(clean).values()) == {0}
    planted = {
        "grain": gates.grain(c.unionByName(c.limit(1)), ["charge_id"]), "null keys": gates.grain(c.withColumn("charge_id", F.lit(None).cast("string")), ["charge_id"]), "current": gates.one_current_version(h.unionByName(row("2", 2, dt.date(2022, 1, 1), None, True)), "npi"), "dense": gates.versions_dense(h.unionByName(row("3", 2, None, None, True)), "npi"), "valid": gates.intervals_valid(row("1", 1, dt.date(2021, 1, 1), dt.date(2020, 1, 1), False)), "gaps": gates.history_gaps(h.unionByName(row("1", 3, dt.date(2022, 1, 1), None, True)), "npi"), "overlaps": gates.history_overlaps(h.unionByName(row("1", 3, dt.date(2020, 6, 1), None, True)), "npi"),
        "types": gates.safe_types(c.withColumn("d", F.lit(1).cast("decimal(38,0)"))), "related": gates.relationship(k, "item_id", c.where("item_id = 'i1'"), "item_id"), "kinds": gates.accepted(k, "declared_type", ["CPT"]), "there": gates.not_null(c, "payer_name"), "ids": gates.matches(h, "npi", "[1]"), "last line": gates.matches(spark.createDataFrame([("1\n",)], "npi string"), "npi", "[0-9]"),
        "kept": gates.rows_kept(tables["files"], c), "share": gates.quarantine_share(spark.createDataFrame([(100, 2)], "records_read long, quarantined_rows long")), "seq": gates.dense(spark.createDataFrame([(2,), (3,)], "seq int"), "seq"),
    }
    for name, g in planted.items():
        assert g.count() > 0, name
    with pytest.raises(gates.GateError, match="grain"):
        gates.run_gates({"grain": planted["grain"], "ok": clean["codes"]})
    assert gates.quarantine_share(spark.createDataFrame([(100, 1)], "records_read long, quarantined_rows long")).count() == 0
    assert gates.dense(spark.createDataFrame([(1,), (2,)], "seq int"), "seq").count() == 0
    near = spark.createDataFrame([("a", 250.0)], "k string, v double")
    for v, n in ((250.004, 0), (250.01, 1), (None, 1)):
        assert gates.summary_matches_lines(near, spark.createDataFrame([("a", v)], "k string, v double"), ["k"], ["v"]).count() == n


def test_analysis_blocks(spark, tables, rows):
    charges, codes = tables["fct_standard_charges"], tables["dim_charge_codes"]
    got = analysis.comparable(charges, codes, "CPT_CAT_I", without=spark.createDataFrame([("i2",), (None,)], "item_id string"))
    assert rows(got, "charge_id") == [("c1",), ("c2",)]
    m = analysis.per_code(analysis.comparable(charges, codes, "CPT_CAT_I"))
    assert rows(analysis.between(m, "gross", 2), "code", "ratio") == [("99213", 75.125 / 30)]
    assert rows(analysis.ranks(m, "gross", 2)) == [("g", 0, 1), ("h", 1, 0)]
    assert analysis.distribution(analysis.between(m, "gross", 2)).first()["at_least_2"] == 1
    assert rows(analysis.contracted(analysis.payer_rates(charges.join(codes.select("item_id", "code"), "item_id")), "h", "g"), "code", "a", "b") == [("99213", 80.0, 30.0)]
    assert rows(analysis.list_equals_rate(charges), "hospital_id", "rows") == [("g", 1)]
    assert rows(R.with_total(charges, "hospital_id", [F.count(F.lit(1)).alias("n")])) == [("ALL", 3), ("g", 1), ("h", 2)]
    text = report.markdown(charges.select("charge_id", "payer_name").orderBy("charge_id"), "Charges", 2)
    assert text.startswith("## Charges") and "| c1 | P |" in text and "More than 2 rows." in text
    assert report.threshold_sensitivity(spark.createDataFrame([(0.9,), (0.96,)], "s double"), "s").first() == (2, 2, 1)


def test_stream_applies_each_batch_once(spark, tmp_path):
    changes, log = spark.read.parquet(f"{DATA}/nppes_changes.parquet"), spark.read.parquet(f"{DATA}/file_log.parquet")
    base = cdc_store.current_rows(spark.read.parquet(f"{DATA}/provider_history.parquet"))
    log.write.parquet(f"{tmp_path}/log")
    stores = {}
    for name in ("whole", "stream"):
        stores[name] = cdc_store.BucketStore(spark, f"file://{tmp_path}/{name}")
        stores[name].create(base, "npi", 4)
    cdc_store.apply_changes(stores["whole"], changes, log)
    changes.write.parquet(f"{tmp_path}/feed")
    for _ in range(2):
        q = streaming.start(spark, f"{tmp_path}/feed", changes.schema, f"file://{tmp_path}/stream", f"{tmp_path}/log", f"{tmp_path}/ck")
        q.awaitTermination()
    assert stores["stream"].manifest()["version"] == 1
    assert not streaming.apply_batch(stores["stream"], log, changes, 0)
    a, b = (sorted(map(repr, s.read().select("npi", "status", "change_id", "practice_city").collect())) for s in stores.values())
    assert a == b
    now = dt.datetime(2025, 1, 2, 12)
    for age, n in ((1, 0), (40, 1)):
        assert streaming.stale_ledger(spark.createDataFrame([(now - dt.timedelta(hours=age),)], "applied_at timestamp"), now).count() == n


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(cli, "_spark", lambda: spark)
    head = "hospital_name,last_updated_on,version,location_name,hospital_address,type_2_npi,To the best of its knowledge and belief x,license_number|zz\nElm,2025-01-01,3.0.0,Elm,1 Oak,9000000001,true,1\n"
    from rateloom.operators.quarantine import TALL_SCHEMA

    cols = [r.name for r in TALL_SCHEMA if r.name != "billing_class"] + ["code|1", "code|1|type"]
    good = tmp_path / "good.csv"
    good.write_text(head + ",".join(cols) + "\n" + ",".join("5.0" if r.kind == "number" else "x" if r.kind == "text" else "" for r in TALL_SCHEMA if r.name != "billing_class") + ",99213,CPT\n")
    root = str(tmp_path / "data")
    assert cli.main(["stage", "elm", str(good), "--root", root]) == 0
    assert cli.main(["gates", "--root", root]) == 0
    assert cli.main(["export", str(tmp_path / "out"), "--root", root]) == 0 and cli.main(["verify", str(tmp_path / "out")]) == 0
    assert cli.main(["publish", str(tmp_path / "out"), str(tmp_path / "served")]) == 0
    bad = tmp_path / "bad.csv"
    bad.write_text(good.read_text().replace("3.0.0", "2.2.0") + "a,b\n")
    assert cli.main(["stage", "elm", str(bad), "--root", root]) == 0 and cli.main(["gates", "--root", root]) == 1
    assert "template" in capsys.readouterr().err
    assert cli.main(["query", "paging", DATA, str(tmp_path / "q")]) == 0 and cli.main(["query", "none", DATA, "x"]) == 2 and cli.main(["nonsense"]) == 2
