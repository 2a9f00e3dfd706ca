"""A served copy of tables: written beside the served one, swapped in whole, compared by aggregates.

The target is a directory of Parquet tables or, where a JDBC driver is at hand, a database schema. Counts must agree
exactly, floating sums within a relative 1e-9.
"""

from __future__ import annotations

import math
import shutil
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def metrics(df: DataFrame) -> dict:
    """Rows, and for each column the non-null values and, of numbers, the sum."""
    cols = [F.count(F.lit(1)).alias("rows")]
    for c, t in df.dtypes:
        cols.append(F.count(c).alias(f"{c}#count"))
        if t in ("int", "bigint", "double", "float"):
            cols.append(F.sum(c).alias(f"{c}#sum"))
    return df.agg(*cols).first().asDict()


def close(a, b) -> bool:
    if a is None or b is None:
        return a is b
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-6) if isinstance(a, float) or isinstance(b, float) else a == b


def parity(a: DataFrame, b: DataFrame) -> list[str]:
    x, y = metrics(a), metrics(b)
    return [f"{k}: {x.get(k)} against {y.get(k)}" for k in sorted({*x, *y}) if not close(x.get(k), y.get(k))]


def publish(spark: SparkSession, tables: dict[str, DataFrame], target: Path) -> dict[str, list[str]]:
    """Swap a new copy in; returns the differences found by table, all empty if it is right. A failed write leaves the served copy."""
    target = Path(target)
    aside = target.parent / f".{target.name}-{uuid.uuid4().hex}"
    try:
        for name, df in tables.items():
            df.write.parquet(f"file://{aside}/{name}")
    except BaseException:
        shutil.rmtree(aside, ignore_errors=True)
        raise
    old = target.parent / f".{target.name}-old"
    shutil.rmtree(old, ignore_errors=True)
    if target.exists():
        target.rename(old)
    aside.rename(target)
    shutil.rmtree(old, ignore_errors=True)
    return {n: parity(df, spark.read.parquet(f"file://{target}/{n}")) for n, df in tables.items()}


def publish_jdbc(tables: dict[str, DataFrame], url: str, properties: dict, schema: str = "published") -> None:
    """Write all tables into <schema>_new; the swap of schemas is the database's own statement, given by swap_sql."""
    for name, df in tables.items():
        df.write.jdbc(url, f"{schema}_new.{name}", mode="overwrite", properties=properties)


def swap_sql(schema: str = "published") -> str:
    return f"BEGIN; DROP SCHEMA IF EXISTS {schema} CASCADE; ALTER SCHEMA {schema}_new RENAME TO {schema}; COMMIT;"
