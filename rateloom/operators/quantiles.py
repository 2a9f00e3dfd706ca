"""Problem 5: percentiles of very large numeric columns by radix selection.

A double becomes an integer of the same order; the digits of that integer are counted from the most
significant on, and only the digit that holds a target rank is followed. Every pass is a grouped count
with partial aggregation, so no group is ever gathered in one task, and the counts of portions add up.
After all 64 bits the order statistic is exact; after the first 32 bits it is within a relative error
of 2**-20, the bound of a stored summary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.materialize import materialize
from ..plans.skew import HOT_ROWS, HOT_SHARE, salted_join

#: Bits of each digit, most significant first.
DIGITS = (16, 16, 16, 16)
#: Bits that a stored summary keeps: sign, exponent and 20 bits of the fraction.
SUMMARY_BITS = 32
_MIN_NORMAL = 2.0**-1022


def with_ordered_bits(df: DataFrame, value: Column, name: str = "_bits") -> DataFrame:
    """df with the integer whose order is that of the doubles: their bit pattern for x >= 0, the negated one of |x| below.

    Arithmetic only, so it stays in generated code: powers of two are exact, hence so are exponent and
    fraction. It is put down in steps, each of which is evaluated once a row. NaN gives null; both zeros give 0.
    """
    x, e, p, top = (F.col(f"_{name}_{c}") for c in "xept")
    step = df.withColumn(f"_{name}_v", value).withColumn(f"_{name}_x", F.abs(f"_{name}_v"))
    # a logarithm is off by less than one: the power below or above is the right one then
    step = step.withColumn(f"_{name}_e", F.greatest(F.least(F.floor(F.log2(x)), F.lit(1023)), F.lit(-1022))).withColumn(f"_{name}_p", F.pow(F.lit(2.0), e))
    step = step.withColumn(f"_{name}_t", F.when((p > x) & (e > -1022), -1).when((e < 1023) & (p * 2.0 <= x), 1).otherwise(0))
    power = F.when(top == 0, p).when(top == 1, p * 2.0).otherwise(p / 2.0)
    normal = (e + top + 1023) * F.lit(1 << 52) + ((x / power - 1.0) * F.lit(float(1 << 52))).cast("long")
    tiny = (x * F.lit(2.0**537) * F.lit(2.0**537)).cast("long")
    bits = F.when(x == float("inf"), F.lit(2047 << 52)).when(x == 0.0, F.lit(0)).when(x < _MIN_NORMAL, tiny).otherwise(normal)
    v = F.col(f"_{name}_v")
    step = step.withColumn(name, F.when(~F.isnan(v), F.when(v < 0, -bits).otherwise(bits)).cast("long"))
    return step.drop(*[f"_{name}_{c}" for c in "vxept"])


def from_bits(bits: Column) -> Column:
    """The inverse of with_ordered_bits."""
    a = F.abs(bits)
    exp, frac = F.shiftright(a, 52), a.bitwiseAND(F.lit((1 << 52) - 1)).cast("double")
    normal = (1.0 + frac * F.lit(2.0**-52)) * F.pow(F.lit(2.0), exp - 1023)
    x = F.when(exp == 2047, F.lit(float("inf"))).when(exp == 0, frac * F.lit(2.0**-537) * F.lit(2.0**-537)).otherwise(normal)
    return F.when(bits < 0, -x).otherwise(x)


def _with_bits(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    x = F.col(value).cast("double")
    rows = df.where(x.isNotNull() & ~F.isnan(x)).select(*groups, x.alias("_value"))
    return with_ordered_bits(rows, F.col("_value")).select(*groups, "_bits")


def value_counts(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """(groups, _bits, _n): how often each value occurs; null and NaN are left out, null groups are groups."""
    return _with_bits(df, groups, value).groupBy(*groups, "_bits").agg(F.count(F.lit(1)).alias("_n"))


def radix_summary(df: DataFrame, groups: list[str], value: str, bits: int = SUMMARY_BITS) -> DataFrame:
    """A mergeable summary (groups, digit, n): counts of the values' leading bits. Merge by union and merge_summaries."""
    digits = _with_bits(df, groups, value).select(*groups, F.shiftright("_bits", 64 - bits).alias("digit"))
    return digits.groupBy(*groups, "digit").agg(F.count(F.lit(1)).alias("n"))


def merge_summaries(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    keys = [c for c in out.columns if c != "n"]
    return out.groupBy(*keys).agg(F.sum("n").alias("n"))


def summary_percentiles(summary: DataFrame, groups: list[str], probs: list[float], bits: int = SUMMARY_BITS) -> DataFrame:
    """(groups, n, one column a probability) from a summary; relative error at most 2**-(bits - 12)."""
    lo = F.shiftleft("digit", 64 - bits)
    counts = materialize(summary.select(*groups, lo.alias("_bits"), F.col("n").alias("_n")), "summary")
    sizes = materialize(_targets(counts, groups, probs), "summary-sizes")
    # what the summary does not keep need not be looked for
    digits = tuple(d for i, d in enumerate(DIGITS) if sum(DIGITS[:i]) < bits)
    return _interpolated(_select(counts, groups, sizes, digits, "summary"), sizes, groups, probs)


def radix_percentiles(df: DataFrame, groups: list[str], value: str, probs: list[float], digits: tuple[int, ...] = DIGITS) -> DataFrame:
    """(groups, n, p<prob>...): interpolated percentiles of each group, exact with all 64 bits.

    Null and NaN values are left out, a group without values has no row. Column names are p50 for 0.5
    and p99_9 for 0.999.
    """
    counts = materialize(value_counts(df, groups, value), "radix")
    sizes = materialize(_targets(counts, groups, probs), "radix-sizes")
    return _interpolated(_select(counts, groups, sizes, digits, "radix"), sizes, groups, probs)


def name_of(prob: float) -> str:
    return "p" + f"{100 * prob:g}".replace(".", "_")


def _targets(counts: DataFrame, groups: list[str], probs: list[float]) -> DataFrame:
    """(groups, _size, _ranks): the zero-based ranks to find, two for each probability, without repeats."""
    sizes = counts.groupBy(*groups).agg(F.sum("_n").alias("_size"))
    at = [F.lit(p) * (F.col("_size") - 1) for p in probs]
    return sizes.withColumn("_ranks", F.array_distinct(F.array(*[f(a).cast("long") for a in at for f in (F.floor, F.ceil)])))


def _select(counts: DataFrame, groups: list[str], sizes: DataFrame, digits: tuple[int, ...], label: str | None) -> DataFrame:
    """(groups, _rank, _bits): the value at each target rank, found digit by digit."""
    keys = [f"_g{i}" for i in range(len(groups))]
    # grouping keys may be null; joins compare them with a marker beside a filled value
    fill = lambda c: F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n"))
    rows = counts.select(*[fill(g).alias(k) for g, k in zip(groups, keys)], "_bits", "_n")
    todo = sizes.select(*groups, *[fill(g).alias(k) for g, k in zip(groups, keys)], F.explode("_ranks").alias("_rank")).withColumn("_left", F.col("_rank"))
    names = todo.select(*groups, *keys, "_rank")
    limit = max(HOT_ROWS, (sizes.agg(F.sum("_size")).first()[0] or 0) * HOT_SHARE) if label else 0
    prefix, used = None, 0
    todo = todo.select(*keys, "_rank", "_left")
    for width in digits:
        used += width
        digit = F.shiftright("_bits", 64 - used)
        if prefix is None:
            # every target of a group looks at the same histogram: counted once a group, not once a rank
            hist = rows.groupBy(*keys, digit.alias("_digit")).agg(F.sum("_n").alias("_m"))
            run = Window.partitionBy(*keys).orderBy("_digit")
            hist = hist.withColumn("_upto", F.sum("_m").over(run))
            found = hist.join(todo, keys).where((F.col("_left") < F.col("_upto")) & (F.col("_left") >= F.col("_upto") - F.col("_m")))
        else:
            wanted = todo.select(*keys, "_prefix").distinct()
            # a hot bin holds more than HOT_SHARE of all values, so there are at most 1 / HOT_SHARE bins with ranks in them
            hot = [tuple(r) for r in todo.where(F.col("_in_bin") > F.lit(limit)).select(*keys, "_prefix").distinct().collect()] if label else []
            rows = salted_join(rows.withColumn("_prefix", F.shiftright("_bits", 64 - prefix)), wanted, [*keys, "_prefix"], F.col("_bits"), "left_semi", hot=hot)
            if label and prefix == digits[0]:
                rows = materialize(rows, f"{label}-followed")
            hist = rows.groupBy(*keys, "_prefix", digit.alias("_digit")).agg(F.sum("_n").alias("_m"))
            run = Window.partitionBy(*keys, "_prefix").orderBy("_digit")
            hist = hist.withColumn("_upto", F.sum("_m").over(run))
            found = hist.join(todo, [*keys, "_prefix"]).where((F.col("_left") < F.col("_upto")) & (F.col("_left") >= F.col("_upto") - F.col("_m")))
        todo = found.select(*keys, "_rank", (F.col("_left") - (F.col("_upto") - F.col("_m"))).alias("_left"), F.col("_digit").alias("_prefix"), F.col("_m").alias("_in_bin"))
        if label and used < sum(digits):
            todo = materialize(todo, f"{label}-ranks")
            rows = rows.drop("_prefix")
        prefix = used
    return names.join(todo.select(*keys, "_rank", F.shiftleft("_prefix", 64 - used).alias("_bits")), [*keys, "_rank"]).select(*groups, "_rank", "_bits")


def _interpolated(found: DataFrame, sizes: DataFrame, groups: list[str], probs: list[float]) -> DataFrame:
    sizes = sizes.select(*groups, F.col("_size").alias("n"))
    at = found.groupBy(*groups).agg(F.map_from_entries(F.collect_list(F.struct("_rank", from_bits(F.col("_bits")).alias("v")))).alias("_at"))
    on = None
    for g in groups:
        c = sizes[g].eqNullSafe(at[g])
        on = c if on is None else on & c
    both = sizes.crossJoin(at) if on is None else sizes.join(at, on)
    cols = []
    for p in probs:
        pos = F.lit(p) * (F.col("n") - 1)
        low, high = F.element_at("_at", F.floor(pos).cast("long")), F.element_at("_at", F.ceil(pos).cast("long"))
        cols.append((low + (high - low) * (pos - F.floor(pos))).alias(name_of(p)))
    return both.select(*[sizes[g] for g in groups], "n", *cols)
