"""Gates: each returns the offending rows; any row fails a run.

Generic ones take any table; the rest check what must hold between tables of the pipelines. Null keys
are equal to each other, as in grouping. An empty table passes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .operators.relational import overlapping, reconcile


class GateError(AssertionError):
    """Gates that returned rows, with how many."""


def run_gates(gates: dict[str, Callable[[], DataFrame] | DataFrame], most: int = 5) -> dict[str, int]:
    """Evaluate gates; raises GateError naming those that fired, with up to `most` of their rows."""
    fired = {}
    shown = []
    for name, g in gates.items():
        df = g() if callable(g) else g
        n = df.count()
        if n:
            fired[name] = n
            shown.append(f"{name}: {n} rows, as {[r.asDict() for r in df.limit(most).collect()]}")
    if fired:
        raise GateError("; ".join(shown))
    return {name: 0 for name in gates}


# ---------------------------------------------------------------- generic


def grain(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def unique(df: DataFrame, column: str) -> DataFrame:
    return grain(df.where(F.col(column).isNotNull()), [column])


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.where(F.greatest(*[F.col(c).isNull().cast("int") for c in columns], F.lit(0)) == 1)


def accepted(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list; null is accepted."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))


def relationship(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Non-null values without a parent."""
    p = parent.select(F.col(key).alias("_key")).distinct()
    return child.where(F.col(column).isNotNull()).join(p, F.col(column) == F.col("_key"), "left_anti")


def matches(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).rlike(rf"^(?:{pattern})\z"))


def safe_types(df: DataFrame) -> DataFrame:
    """Columns of types that other readers of Parquet do not take: variants, intervals, wide decimals, nulls."""
    bad = [(n, t) for n, t in df.dtypes if t in ("variant", "void") or t.startswith("interval") or (t.startswith("decimal(") and int(t[8:].split(",")[0]) > 18)]
    return df.sparkSession.createDataFrame(bad, "column string, type string")


def dense(df: DataFrame, column: str) -> DataFrame:
    """One row if the numbers are not 1 to n, each once."""
    s = df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(column).alias("d"), F.min(column).alias("low"), F.max(column).alias("high"))
    return s.where("n > 0 and (n <> d or low <> 1 or high <> n)")


# ---------------------------------------------------------------- history


def one_current_version(history: DataFrame, key: str) -> DataFrame:
    return history.groupBy(key).agg(F.count_if("is_current").alias("current")).where("current <> 1")


def versions_dense(history: DataFrame, key: str) -> DataFrame:
    return history.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("version").alias("d"), F.min("version").alias("low"), F.max("version").alias("high")).where("n <> d or low <> 1 or high <> n")


def intervals_valid(history: DataFrame) -> DataFrame:
    """Versions that end before they begin, current ones with an end, others without."""
    return history.where("valid_to < valid_from or (is_current and valid_to is not null) or (not is_current and valid_to is null)")


def history_gaps(history: DataFrame, key: str) -> DataFrame:
    """Versions whose end is not the next one's begin; null is equal to null."""
    w = Window.partitionBy(key).orderBy("version")
    h = history.select(key, "version", "valid_to", F.lead("valid_from").over(w).alias("_next"), F.lead("version").over(w).alias("_nv"))
    return h.where(F.col("_nv").isNotNull() & ~F.col("valid_to").eqNullSafe(F.col("_next"))).select(key, "version")


def history_overlaps(history: DataFrame, key: str) -> DataFrame:
    return overlapping(history, key, "version")


def no_outcome(log: DataFrame, outcome: str = "rejected_schema") -> DataFrame:
    return log.where(F.col("outcome") == outcome)


# ---------------------------------------------------------------- price files


def rows_kept(files: DataFrame, charges: DataFrame) -> DataFrame:
    """Files whose records read, charges, set-aside and published rows do not add up, or that have none."""
    out = charges.groupBy("hospital_id", "source_sha256").agg(F.count(F.lit(1)).alias("published"))
    j = files.join(out, ["hospital_id", "source_sha256"], "left").withColumn("published", F.coalesce("published", F.lit(0)))
    return j.where("records_read <> charge_rows + quarantined_rows or charge_rows <> published or records_read = 0")


def quarantine_share(files: DataFrame, most: float = 0.01) -> DataFrame:
    return files.where(F.col("quarantined_rows") > F.col("records_read") * most)


def required_present(drift: DataFrame) -> DataFrame:
    return drift.where(F.col("kind").isin("missing_required_column", "missing_required_meta"))


def summary_matches_lines(summary: DataFrame, lines: DataFrame, keys: Sequence[str], values: Sequence[str], tolerance: float = 0.005) -> DataFrame:
    """Both directions: rows on one side only, or values beyond the tolerance."""
    return reconcile(summary, lines, keys, values, tolerance)


# ---------------------------------------------------------------- clinical bundles


def references_resolve(references: DataFrame) -> DataFrame:
    return references.where(~F.col("resolved")).groupBy("resource_type", "kind").agg(F.count(F.lit(1)).alias("n"), F.min("target").alias("example"))


def bundles_intact(resources: DataFrame, tables: dict[str, DataFrame], issues: DataFrame) -> DataFrame:
    """Envelope issues, types whose rows were lost, resources listed twice within a bundle."""
    part = lambda df, name: df.select(F.lit(name).alias("problem"), F.col("what").cast("string"), F.col("n").cast("long"))
    out = part(issues.where(F.col("kind").isin("not_a_bundle", "entry_without_resource", "missing_id")).groupBy(F.col("kind").alias("what")).agg(F.count(F.lit(1)).alias("n")), "envelope")
    for rtype, t in tables.items():
        kept = t.where(F.col("resource_type") == rtype) if "resource_type" in t.columns else t
        n = resources.where(F.col("resource_type") == rtype).agg(F.count(F.lit(1)).alias("a")).crossJoin(kept.agg(F.count(F.lit(1)).alias("b"))).where("a <> b")
        out = out.unionByName(part(n.select(F.lit(rtype).alias("what"), (F.col("a") - F.col("b")).alias("n")), "rows_lost"))
    twice = resources.where("resource_id is not null").groupBy("resource_type", "resource_id", "bundle_sha256").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return out.unionByName(part(twice.select(F.concat("resource_type", F.lit("/"), "resource_id").alias("what"), "n"), "listed_twice"))


def claims_match(claims: DataFrame, items: DataFrame, eobs: DataFrame) -> DataFrame:
    """Claims without lines or explanation, lines or explanations without claim, repeated ids, differing totals."""
    c = claims.select(F.col("resource_id").alias("claim_id"), F.col("total").alias("claim_total"))
    part = lambda df, name: df.select(F.lit(name).alias("problem"), "claim_id")
    e = eobs.where("claim_id is not null")
    both = c.join(e.select("claim_id", "total_amount"), "claim_id")
    out = part(c.join(items, "claim_id", "left_anti"), "claim_without_lines")
    out = out.unionByName(part(items.join(c, "claim_id", "left_anti"), "line_without_claim"))
    out = out.unionByName(part(c.join(e, "claim_id", "left_anti"), "claim_without_explanation"))
    out = out.unionByName(part(e.join(c, "claim_id", "left_anti"), "explanation_without_claim"))
    out = out.unionByName(part(c.groupBy("claim_id").count().where("count > 1"), "claim_twice"))
    return out.unionByName(part(both.where(F.abs(F.col("claim_total") - F.col("total_amount")) > 0.005), "totals_differ"))


def synthetic_only(patients: DataFrame) -> DataFrame:
    """Patients that lack a mark of being synthetic."""
    return patients.where("not has_synthetic_identifier or ssn_in_test_range is false or not names_digit_suffixed")
