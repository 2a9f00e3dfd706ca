"""Jaro-Winkler similarity, batch by batch over Arrow.

Either text empty gives 0, null gives null. Matches are found greedily from left to right within half
the longer length less one; the bonus for a common prefix of at most four applies above 0.7 only.
Spark has no such function. Use it after the equi-join that limits the pairs.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

BOOST_FROM, PREFIX, SCALE = 0.7, 4, 0.1


def jaro_winkler_value(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken = bytearray(len(b))
    mine = []
    for i, ch in enumerate(a):
        j = b.find(ch, max(0, i - reach), i + reach + 1)
        while j >= 0 and taken[j]:
            j = b.find(ch, j + 1, i + reach + 1)
        if j >= 0:
            taken[j] = 1
            mine.append(ch)
    m = len(mine)
    if not m:
        return 0.0
    other = [ch for ch, t in zip(b, taken) if t]
    swaps = sum(x != y for x, y in zip(mine, other)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    if jaro <= BOOST_FROM:
        return jaro
    common = 0
    for x, y in zip(a[:PREFIX], b[:PREFIX]):
        if x != y:
            break
        common += 1
    return jaro + SCALE * common * (1 - jaro)


def _batch(a: pd.Series, b: pd.Series) -> pd.Series:
    memo: dict[tuple[str, str], float] = {}
    out = []
    for x, y in zip(a, b):
        if x is None or y is None:
            out.append(None)
            continue
        v = memo.get((x, y))
        if v is None:
            v = memo[(x, y)] = jaro_winkler_value(x, y)
        out.append(v)
    return pd.Series(out, dtype="float64")


def jaro_winkler(a: Column, b: Column) -> Column:
    return pandas_udf(_batch, DoubleType())(a, b)
