"""Reports over the clinical tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.clinical import SYNTHETIC_SYSTEM
from ..operators.relational import ratio

#: The one code system that claims and price files share.
SHARED_SYSTEM, SHARED_FAMILY = "http://www.ada.org/cdt", "CDT"


def claim_lines(items: DataFrame, claims: DataFrame, organizations: DataFrame) -> DataFrame:
    c = claims.select(F.col("resource_id").alias("claim_id"), "patient_id", "claim_type", "created", "provider_ref", F.col("total").alias("claim_total"), "currency")
    o = organizations.where("resource_type = 'Organization' and synthetic_id is not null").select(F.concat(F.lit(f"Organization?identifier={SYNTHETIC_SYSTEM}|"), "synthetic_id").alias("provider_ref"), F.col("name").alias("provider_name")).dropDuplicates(["provider_ref"])
    return items.join(c, "claim_id").join(o, "provider_ref", "left").select("claim_id", "sequence", "patient_id", "claim_type", "created", "code_system", "code", "display", "net", "claim_total", "currency", "provider_name")


def claim_totals(claims: DataFrame, items: DataFrame) -> DataFrame:
    """Headers against lines in whole cents, by claim type."""
    lines = items.groupBy(F.col("claim_id").alias("resource_id")).agg(F.count(F.lit(1)).alias("lines"), F.count("net").alias("priced"), F.sum(F.round(F.col("net") * 100).cast("long")).alias("cents"))
    c = claims.select("resource_id", "claim_type", F.round(F.col("total") * 100).cast("long").alias("head")).join(lines, "resource_id", "left")
    priced = F.col("priced") > 0
    return c.groupBy("claim_type").agg(
        F.count(F.lit(1)).alias("claims"), F.coalesce(F.sum("lines"), F.lit(0)).alias("lines"), F.coalesce(F.sum("priced"), F.lit(0)).alias("priced_lines"), F.count_if(~F.coalesce(priced, F.lit(False))).alias("claims_without_priced_lines"),
        *[F.count_if(priced & cond).alias(n) for n, cond in (("header_equals_lines", F.col("head") == F.col("cents")), ("header_above_lines", F.col("head") > F.col("cents")), ("header_below_lines", F.col("head") < F.col("cents")))],
        F.coalesce(F.sum("head"), F.lit(0)).alias("header_cents"), F.coalesce(F.sum("cents"), F.lit(0)).alias("lines_cents"),
    )


def code_bridge(lines: DataFrame, codes: DataFrame) -> DataFrame:
    """By code system: lines, codes, and those that a price file has too."""
    price = codes.where(F.col("code_family") == SHARED_FAMILY).select(F.upper("code").alias("_code"), "hospital_id").distinct()
    shared = lines.where(F.col("code_system") == SHARED_SYSTEM).join(price, F.upper("code") == F.col("_code"))
    hits = shared.groupBy("code_system").agg(F.countDistinct(F.struct("claim_id", "sequence")).alias("lines_with_a_price_file_code"), F.countDistinct("code").alias("codes_with_a_price_file_code"), F.countDistinct("hospital_id").alias("hospitals_with_those_codes"))
    all_lines = lines.groupBy("code_system").agg(F.count(F.lit(1)).alias("claim_lines"), F.countDistinct("code").alias("distinct_codes"))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in hits.columns[1:]]
    return all_lines.join(hits, "code_system", "left").select("code_system", "claim_lines", "distinct_codes", F.when(F.col("code_system") == SHARED_SYSTEM, SHARED_FAMILY).alias("shared_with_price_files"), *zero)


def summary(resources: DataFrame, mapping: DataFrame, issues: DataFrame) -> DataFrame:
    """By type: resources, whether modelled, paths seen and read, share of values read, issues."""
    r = resources.groupBy("resource_type").agg(F.count(F.lit(1)).alias("resources"))
    m = mapping.groupBy("resource_type").agg(F.bool_or("modelled_type").alias("modelled"), F.count(F.lit(1)).alias("leaf_paths"), F.count_if("mapped").alias("mapped_paths"), F.sum("occurrences").alias("_all"), F.sum(F.when(F.col("mapped"), F.col("occurrences"))).alias("_read"))
    i = issues.groupBy("resource_type").agg(F.count(F.lit(1)).alias("structural_issues"))
    j = r.join(m, "resource_type", "left").join(i, "resource_type", "left")
    return j.select("resource_type", "resources", F.coalesce("modelled", F.lit(False)).alias("modelled"), "leaf_paths", F.coalesce("mapped_paths", F.lit(0)).alias("mapped_paths"), ratio(F.coalesce("_read", F.lit(0)), F.col("_all"), 4).alias("mapped_value_share"), F.coalesce("structural_issues", F.lit(0)).alias("structural_issues"))
