"""Disclosed identifiers against the registry: normalised names and addresses, as-of status, similarity.

The verdicts and tiers of a reconciliation are rules of its domain and are left out; the evidence
they rest on is here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import jaro_winkler
from ..functions.text import addr_key, any_date, is_hospital_taxonomy, norm_name, npi_format_ok, npi_luhn_ok, zip5_of
from ..operators.relational import as_of


def identity(files: DataFrame) -> DataFrame:
    """By hospital and file: distinct normalised names, address keys, ZIP codes, disclosed identifiers."""
    # a file that is listed twice says the same, but for the notation of its date
    f = files.groupBy("hospital_id", "source_sha256").agg(F.min(F.struct("hospital_name", "last_updated_on", "location_names", "hospital_addresses", "type_2_npis")).alias("_f")).select("hospital_id", "source_sha256", "_f.*")
    addresses = F.coalesce("hospital_addresses", F.array().cast("array<string>"))
    names = F.array_compact(F.array_distinct(F.transform(F.concat(F.array("hospital_name"), F.coalesce("location_names", F.array().cast("array<string>"))), norm_name)))
    return f.select(
        "hospital_id", "source_sha256", "hospital_name", "last_updated_on", names.alias("ref_names"), F.array_compact(F.array_distinct(F.transform(addresses, lambda a: addr_key(a, zip5_of(a))))).alias("ref_addr_keys"), F.array_compact(F.array_distinct(F.transform(addresses, zip5_of))).alias("ref_zips"), F.col("type_2_npis").alias("disclosed_npis"),
    )


def resolution(ident: DataFrame, current: DataFrame, history: DataFrame) -> DataFrame:
    """Each disclosed identifier with its registry row, status on the file's date and the evidence of a match.

    The similarity is computed after the join on the identifier, once for each pair of names.
    """
    d = ident.withColumn("npi", F.explode("disclosed_npis")).withColumn("file_date", any_date(F.col("last_updated_on"))).drop("disclosed_npis")
    d = as_of(d, history, "npi", "file_date", carry=["status"]).withColumnRenamed("status", "status_as_of_file_date")
    p = current.select("npi", "status", "entity_type", F.col("org_name").alias("registry_name"), "primary_taxonomy", F.col("practice_address_1").alias("registry_address"), F.left("practice_postal", F.lit(5)).alias("registry_zip5"), F.lit(True).alias("_in"))
    j = d.join(p, "npi", "left")
    names = j.select("hospital_id", "source_sha256", "npi", norm_name(F.col("registry_name")).alias("_name"), F.explode("ref_names").alias("_ref")).where("_name is not null").distinct()
    scored = names.withColumn("_s", jaro_winkler(F.col("_name"), F.col("_ref")))
    best = scored.groupBy("hospital_id", "source_sha256", "npi").agg(F.max("_s").alias("name_similarity"))
    j = j.join(best, ["hospital_id", "source_sha256", "npi"], "left")
    member = lambda arr, x: F.coalesce(F.array_contains(arr, x), F.lit(False))
    return j.select(
        "hospital_id", "source_sha256", "npi", "file_date", npi_format_ok(F.col("npi")).alias("format_ok"), npi_luhn_ok(F.col("npi")).alias("check_digit_ok"), F.coalesce("_in", F.lit(False)).alias("in_registry"), "status", "status_as_of_file_date", "entity_type", "registry_name", "primary_taxonomy",
        F.coalesce(is_hospital_taxonomy(F.col("primary_taxonomy")), F.lit(False)).alias("hospital_taxonomy"), "registry_address", "registry_zip5", "name_similarity", member("ref_addr_keys", addr_key(F.col("registry_address"), F.col("registry_zip5"))).alias("address_match"), member("ref_zips", F.col("registry_zip5")).alias("zip_match"),
    )


def candidates(ident: DataFrame, current: DataFrame, least: float = 0.8, hospitals_only: bool = True) -> DataFrame:
    """Registry rows in a hospital's ZIP codes that match its address or, at least by `least`, one of its names.

    The array of ZIP codes is exploded into an equi-join; similarity is computed on what that leaves.
    """
    zips = ident.select("hospital_id", "ref_names", "ref_addr_keys", "disclosed_npis", F.explode("ref_zips").alias("zip5")).where("zip5 <> ''")
    p = current.where("status = 'active' and entity_type = '2'").where(is_hospital_taxonomy(F.col("primary_taxonomy")) if hospitals_only else F.lit(True)).select("npi", "org_name", "primary_taxonomy", "practice_address_1", F.left("practice_postal", F.lit(5)).alias("zip5"))
    j = zips.join(p, "zip5").withColumn("_key", addr_key(F.col("practice_address_1"), F.col("zip5")))
    j = j.withColumn("address_match", F.coalesce(F.array_contains("ref_addr_keys", F.col("_key")), F.lit(False))).withColumn("disclosed", F.coalesce(F.array_contains("disclosed_npis", F.col("npi")), F.lit(False)))
    s = j.withColumn("_ref", F.explode_outer("ref_names")).withColumn("_s", jaro_winkler(norm_name(F.col("org_name")), F.col("_ref")))
    best = s.groupBy("hospital_id", "npi", "org_name", "primary_taxonomy", "practice_address_1", "zip5").agg(F.max("_s").alias("name_similarity"), F.max("address_match").alias("address_match"), F.max("disclosed").alias("disclosed"))
    return best.where((F.col("name_similarity") >= least) | F.col("address_match"))
