"""Tables over staged price files: the fact, its codes, a summary of prices, what did not conform."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.relational import first_by, ratio, renumber
from ..plans.skew import small_join


def standard_charges(charges: DataFrame, files: DataFrame) -> DataFrame:
    """Each charge with its file's name and date; of a file that is listed twice the least of each."""
    f = files.groupBy("hospital_id", "source_sha256").agg(F.min("hospital_name").alias("hospital_name"), F.min("last_updated_on").alias("source_last_updated_on"))
    return small_join(charges.drop("count_raw"), f, ["hospital_id", "source_sha256"])


def price_summary(charges: DataFrame, codes: DataFrame, keys: tuple[str, ...] = ("hospital_id", "code_family", "code", "setting")) -> DataFrame:
    """Counts and percentiles by code and setting; a missing setting is `unspecified`. Codes are made distinct before the fan-out.

    A group holds the rates of one code at one hospital, which its payers and plans bound; percentiles of whole hospitals
    are for quantiles.radix_percentiles.
    """
    family = F.coalesce("code_family", "declared_type") if "code_family" in codes.columns else F.col("declared_type")
    k = codes.where("code is not null").select("item_id", "code", family.alias("code_family")).distinct()
    j = charges.withColumn("setting", F.coalesce("setting", F.lit("unspecified"))).join(k, "item_id")
    q = lambda c, p: F.percentile(c, F.lit(p))
    return j.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("charge_rows"), F.countDistinct(F.concat("payer_name", F.lit("|"), "plan_name")).alias("payer_plans"), F.min("negotiated_rate").alias("rate_min"), q("negotiated_rate", 0.25).alias("rate_p25"), q("negotiated_rate", 0.5).alias("rate_median"), q("negotiated_rate", 0.75).alias("rate_p75"), F.max("negotiated_rate").alias("rate_max"),
        F.median("gross_charge").alias("gross_median"), F.median("discounted_cash").alias("cash_median"), F.min("description").alias("example_description"),
    )


def conformance(drift: DataFrame, files: DataFrame) -> DataFrame:
    """Drift by file with its share of the records read."""
    f = files.groupBy("hospital_id", "source_sha256").agg(F.min("hospital_name").alias("hospital_name"), F.max("records_read").alias("records_read"))
    j = small_join(drift, f, ["hospital_id", "source_sha256"])
    return j.select("hospital_id", "hospital_name", "source_sha256", "kind", "column", "n", ratio(F.col("n"), F.col("records_read"), 6).alias("share_of_records"), "first_locator", "sample_value")


def file_log(ledger: DataFrame) -> DataFrame:
    """The first application of each file, renumbered without gaps."""
    first = first_by(ledger, ["source_file"], [F.asc("seq")])
    return renumber(first, ["seq"])


def modifiers(staged: DataFrame) -> DataFrame:
    return staged.select("hospital_id", "code", "setting", "payer_name", "plan_name", "payer_description")
