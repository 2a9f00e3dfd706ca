"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot from this share of the rows on, so there are at most 1 / HOT_SHARE hot keys, whatever the size.
HOT_SHARE = 1 / 200
#: Rows below which a table is never worth salting.
HOT_ROWS = 50_000
#: Parts into which a hot key is split.
FAN = 64
#: Rows up to which a side may be broadcast; checked before each use.
BROADCAST_ROWS = 10_000


def null_safe(left: DataFrame, right: DataFrame, on: list[str], right_names: list[str]) -> Column:
    pairs = [left[a].eqNullSafe(right[b]) for a, b in zip(on, right_names)]
    return reduce(lambda x, y: x & y, pairs)


def hot_keys(df: DataFrame, on: list[str], share: float = HOT_SHARE, least: int = HOT_ROWS) -> list[tuple]:
    """Keys with more than share of all rows; at most 1 / share of them, so the list is bounded."""
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    total = df.count()
    limit = max(total * share, least)
    if total <= limit:
        return []
    return [tuple(r[c] for c in on) for r in counts.where(F.col("_n") > F.lit(limit)).limit(int(1 / share) + 1).collect()]


def salted_join(left: DataFrame, right: DataFrame, on: list[str], spread: Column, how: str = "inner", fan: int = FAN, share: float = HOT_SHARE, least: int = HOT_ROWS, hot: list[tuple] | None = None) -> DataFrame:
    """left join right where left may be skewed on the key and right has few rows for each key.

    Hot keys are given or found by a pre-aggregated count; their left rows are spread over `fan` parts by
    `spread` (any column that varies within a key) and their right rows are repeated `fan` times.
    All other keys are joined as they are. how: inner, left or left_semi. Null keys match nothing.
    """
    hot = hot_keys(left, on, share, least) if hot is None else hot
    if not hot:
        return left.join(right, on, how)
    is_hot = reduce(lambda a, b: a | b, [reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(on, key)]) for key in hot])
    salt = F.pmod(F.xxhash64(spread), F.lit(fan)).cast("int")
    many = left.withColumn("_salt", F.when(is_hot, salt).otherwise(F.lit(0)))
    few = right.withColumn("_salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(fan - 1))).otherwise(F.array(F.lit(0)))))
    return many.join(few, [*on, "_salt"], how).drop("_salt")


def small_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast right only if it has at most `rows` rows, which is counted first; else a shuffled join."""
    few = right.limit(rows + 1).count() <= rows
    return left.join(F.broadcast(right) if few else right, on, how)
