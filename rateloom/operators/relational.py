"""Joins, windows and aggregates that the pipelines share, as functions from DataFrames to DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN_END = "9999-12-31"


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row for each key, the first in the order, which must be total for a defined result."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows of each key; Spark limits each group before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def renumber(df: DataFrame, order: Sequence[str], name: str = "seq") -> DataFrame:
    """Dense numbers 1, 2, 3 over a small table (a ledger), in one task."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("int"))


def as_of(facts: DataFrame, history: DataFrame, key: str, at: str, start: str = "valid_from", end: str = "valid_to", carry: Sequence[str] = ()) -> DataFrame:
    """Each fact with the version valid at its time, in [start, end); null where there is none.

    Equality on the key with a range predicate on top; adaptive execution splits a key with a large
    part of the facts. Intervals of a key must not overlap; a null time matches nothing.
    """
    low, high = F.lit("0001-01-01").cast("date"), F.lit(OPEN_END).cast("date")
    h = history.select(F.col(key).alias("_hkey"), F.coalesce(F.col(start), low).alias("_from"), F.coalesce(F.col(end), high).alias("_to"), *[F.col(c).alias(f"_h_{c}") for c in carry])
    j = facts.join(h, (F.col(key) == F.col("_hkey")) & (F.col(at) >= F.col("_from")) & (F.col(at) < F.col("_to")), "left")
    return j.select(*[facts[c] for c in facts.columns], *[F.col(f"_h_{c}").alias(c) for c in carry])


def overlapping(history: DataFrame, key: str, order: str, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Versions that begin before an earlier version of their key has ended: (key, order).

    A running maximum of the ends replaces the self-join, so the work of a key is linear in its versions.
    """
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ends = F.max(F.coalesce(F.col(end), F.lit(OPEN_END).cast("date"))).over(w)
    real = F.col(start).isNull() | (F.col(start) < F.coalesce(F.col(end), F.lit(OPEN_END).cast("date")))
    return history.where(real).withColumn("_ends", ends).where(F.col(start) < F.col("_ends")).select(key, order)


def overlap_pairs(history: DataFrame, key: str, order: str, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Pairs (key, a, b) of overlapping versions; quadratic in the versions of a key, which are few."""
    cols = lambda p: history.select(F.col(key).alias(key), F.col(order).alias(p), F.col(start).alias(f"_s{p}"), F.coalesce(F.col(end), F.lit(OPEN_END).cast("date")).alias(f"_e{p}"))
    j = cols("a").join(cols("b"), key).where("a < b and _sa < _eb and _sb < _ea")
    return j.select(key, "a", "b")


def membership(left: DataFrame, array: str, right: DataFrame, key: str) -> DataFrame:
    """Join on array membership as an equi-join of the distinct elements; nulls are no element."""
    flat = left.withColumn(key, F.explode(F.array_distinct(F.filter(array, lambda x: x.isNotNull()))))
    return flat.join(right, key)


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str], values: Sequence[str], tolerance: float = 0.005) -> DataFrame:
    """Rows in which two tables of equal keys differ: on one side only, null against value, or beyond the tolerance. Null keys are equal."""
    left = a.select(*[F.col(k).alias(f"_a_{k}") for k in keys], *[F.col(v).alias(f"{v}_a") for v in values], F.lit(1).alias("_in_a"))
    right = b.select(*[F.col(k).alias(f"_b_{k}") for k in keys], *[F.col(v).alias(f"{v}_b") for v in values], F.lit(1).alias("_in_b"))
    on = reduce(lambda x, y: x & y, [F.col(f"_a_{k}").eqNullSafe(F.col(f"_b_{k}")) for k in keys])
    j = left.join(right, on, "full")
    differs = [(F.col(f"{v}_a").isNull() != F.col(f"{v}_b").isNull()) | F.coalesce(F.abs(F.col(f"{v}_a") - F.col(f"{v}_b")) > tolerance, F.lit(False)) for v in values]
    problem = F.when(F.col("_in_b").isNull(), "left_only").when(F.col("_in_a").isNull(), "right_only").when(reduce(lambda x, y: x | y, differs), "differs")
    return j.withColumn("problem", problem).where("problem is not null").select(*[F.coalesce(f"_a_{k}", f"_b_{k}").alias(k) for k in keys], *[c for v in values for c in (f"{v}_a", f"{v}_b")], "problem")


def with_total(df: DataFrame, key: str, aggregates: Sequence[Column], label: str = "ALL") -> DataFrame:
    """Grouped aggregates and one row over all, in one pass. A null key stays null."""
    r = df.rollup(key).agg(F.grouping(key).alias("_all"), *aggregates)
    return r.withColumn(key, F.when(F.col("_all") == 1, label).otherwise(F.col(key))).drop("_all")


def ratio(a: Column, b: Column, digits: int) -> Column:
    """a / b as a double, null on a zero denominator."""
    return F.round(a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0)), digits)


def histogram(df: DataFrame, value: str, edges: Sequence[float]) -> DataFrame:
    """Counts in half-open bins [edge, next), below the first and from the last on; bin is the number of edges at or below the value."""
    b = reduce(lambda x, y: x + y, [(F.col(value) >= F.lit(float(e))).cast("int") for e in edges])
    return df.where(F.col(value).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def first_seen(df: DataFrame, keys: Sequence[str], order: Column, locator: str, sample: str) -> DataFrame:
    """How often each key occurs, with the locator and sample (200 characters at most) of its first occurrence."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min_by(locator, order).alias("first_locator"), F.min_by(F.left(F.col(sample).cast("string"), F.lit(200)), order).alias("sample_value"))


def cents(col: Column) -> Column:
    """Sum of amounts in whole cents, the same whatever the order of addition."""
    return F.sum(F.round(col * 100).cast("long"))


def page(df: DataFrame, order: Sequence[Column], limit: int, offset: int = 0, most: int = 1000) -> DataFrame:
    """A page of a totally ordered result; limit is kept between 1 and most."""
    return df.orderBy(*order).offset(max(offset, 0)).limit(min(max(limit, 1), most))
