"""Statistics of price variation over charges and codes, each block one DataFrame.

Which rows are comparable is a parameter (a filter and a set of excluded items), so no rule of the
domain is built in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .operators.quantiles import radix_percentiles
from .operators.relational import histogram, ratio


def comparable(charges: DataFrame, codes: DataFrame, family: str, where: Column | None = None, without: DataFrame | None = None) -> DataFrame:
    """Charges with each distinct code of a family; `without` lists item_ids to leave out, its nulls are ignored."""
    k = codes.where(F.col("code_family") == family).select("item_id", "code").distinct()
    if without is not None:
        k = k.join(without.select("item_id"), "item_id", "left_anti")
    rows = charges.join(k, "item_id")
    return rows if where is None else rows.where(where)


def per_code(rows: DataFrame) -> DataFrame:
    return rows.groupBy("hospital_id", "code").agg(F.median("gross_charge").alias("gross"), F.median("discounted_cash").alias("cash"), F.count(F.lit(1)).alias("rows"))


def payer_rates(rows: DataFrame) -> DataFrame:
    return rows.where("negotiated_rate > 0").groupBy("hospital_id", "code", "payer_name").agg(F.median("negotiated_rate").alias("rate"))


def between(medians: DataFrame, value: str, hospitals: int) -> DataFrame:
    """Highest over lowest value by code, of codes that exactly so many hospitals have."""
    return medians.where(F.col(value) > 0).groupBy("code").agg(F.count(F.lit(1)).alias("_h"), (F.max(value) / F.min(value)).alias("ratio")).where(F.col("_h") == hospitals).drop("_h")


def distribution(ratios: DataFrame, column: str = "ratio") -> DataFrame:
    """Count, quartiles, 90th percentile and how many reach two and three."""
    q = lambda p: F.round(F.percentile(column, F.lit(p)), 6)
    return ratios.agg(F.count(F.lit(1)).alias("codes"), q(0.25).alias("p25"), q(0.5).alias("median"), q(0.75).alias("p75"), q(0.9).alias("p90"), F.count_if(F.col(column) >= 2).alias("at_least_2"), F.count_if(F.col(column) >= 3).alias("at_least_3"))


def ranks(medians: DataFrame, value: str, hospitals: int) -> DataFrame:
    """How often each hospital is the dearest and the cheapest among codes that all have."""
    w = Window.partitionBy("code")
    r = medians.where(F.col(value) > 0).withColumn("_n", F.count(F.lit(1)).over(w)).where(F.col("_n") == hospitals).withColumn("_r", F.rank().over(w.orderBy(F.desc(value))))
    return r.groupBy("hospital_id").agg(F.count_if(F.col("_r") == 1).alias("highest"), F.count_if(F.col("_r") == hospitals).alias("lowest"))


def within(rates: DataFrame, least_payers: int = 3) -> DataFrame:
    """Spread of payers' rates within a hospital, by code."""
    return rates.groupBy("hospital_id", "code").agg(F.count(F.lit(1)).alias("payers"), (F.max("rate") / F.min("rate")).alias("ratio")).where(F.col("payers") >= least_payers)


def contracted(rates: DataFrame, a: str, b: str) -> DataFrame:
    """Codes contracted at two hospitals: the median of payers' rates at each, side by side."""
    m = rates.groupBy("code").pivot("hospital_id", [a, b]).agg(F.median("rate"))
    return m.where(F.col(f"`{a}`").isNotNull() & F.col(f"`{b}`").isNotNull()).select("code", F.col(f"`{a}`").alias("a"), F.col(f"`{b}`").alias("b"), ratio(F.col(f"`{a}`"), F.col(f"`{b}`"), 6).alias("ratio"))


def cash_policy(charges: DataFrame) -> DataFrame:
    ok = charges.where("gross_charge > 0 and discounted_cash is not null")
    mid = radix_percentiles(ok.select("hospital_id", (F.col("discounted_cash") / F.col("gross_charge")).alias("_ratio")), ["hospital_id"], "_ratio", [0.5])
    same = ok.groupBy("hospital_id").agg(F.round(F.avg((F.col("discounted_cash") == F.col("gross_charge")).cast("double")), 6).alias("share_equal"))
    return same.join(mid.select(F.col("hospital_id").alias("_h"), F.round("p50", 6).alias("cash_to_gross")), F.col("hospital_id").eqNullSafe(F.col("_h"))).select("hospital_id", "cash_to_gross", "share_equal")


def list_equals_rate(charges: DataFrame) -> DataFrame:
    """Rates that are the list price, by hospital and payer."""
    return charges.where("negotiated_rate = gross_charge").groupBy("hospital_id", "payer_name").agg(F.count(F.lit(1)).alias("rows"))


#: Edges of the histogram of ratios.
EDGES = (1.0, 1.25, 1.5, 1.75, 2.0, 2.5, 3.0, 4.0, 5.0, 10.0)


def ratio_histogram(ratios: DataFrame) -> DataFrame:
    return histogram(ratios, "ratio", EDGES)
