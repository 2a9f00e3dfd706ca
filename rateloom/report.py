"""Small results as Markdown tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators.relational import top_k

#: Rows of a report table at most; reports are for reading.
MOST_ROWS = 1_000


def markdown(df: DataFrame, title: str, most: int = MOST_ROWS) -> str:
    """A titled table; a last line says how many rows were left out."""
    rows = df.limit(most + 1).collect()
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    lines = [f"## {title}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    lines += ["| " + " | ".join(cell(v) for v in r) + " |" for r in rows[:most]]
    return "\n".join([*lines, *(["", f"More than {most} rows."] if len(rows) > most else []), ""])


def unmapped_top(mapping: DataFrame, k: int = 3) -> DataFrame:
    """The most frequent paths that are not read, by type."""
    return top_k(mapping.where(~F.col("mapped")), ["resource_type"], [F.desc("occurrences"), F.asc("path")], k).orderBy("resource_type", F.desc("occurrences"), "path")


def threshold_sensitivity(scored: DataFrame, column: str, thresholds: tuple[float, ...] = (0.85, 0.9, 0.95)) -> DataFrame:
    """How many rows reach each threshold."""
    return scored.agg(*[F.count_if(F.col(column) >= t).alias(f"at_least_{t:g}".replace(".", "_")) for t in thresholds])
