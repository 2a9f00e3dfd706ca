"""Problem 9: mixing sources to target weights by entropy balancing.

Rates w are sought that stay as close to 1 as the entropy allows while each source reaches its target
number of tokens and no document exceeds its source's repeats: minimise sum w log w - w subject to
sum over a source of w * t = target and w <= cap. In the dual each source has one multiplier, w =
min(cap, exp(lambda * t / mean)), and the convex dual is solved by Newton iterations. Each iteration
aggregates gradient and curvature over all documents, which are reduced to counts of token lengths
first; a rate depends on nothing but source and length, so this is exact. The multipliers are a table
of one row a source, stepped by column expressions; none of it passes through the driver. Rates are then
rounded to copies by a hash of the document, which keeps the expected tokens.

A source that cannot reach its target even with every document at its cap has no finite multiplier: the
iterations drive its rates up to the cap, and it ends saturated, short of its target. That end state is
what makes it infeasible.

Defined results: documents of a source without target keep rate 0 but count in the total; so do those
without source. Null and empty texts have no tokens. With targets missing or null share, a source's
target is 0. Repeats below 0 or null count as 0. A target listed twice counts once, with its largest values.
"""

from __future__ import annotations

import base64
import functools
import os
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..plans.materialize import materialize
from ..plans.skew import BROADCAST_ROWS, hot_keys, salted_join, small_join

#: Folder of the public tokenizers' files and the vocabulary used; a parameter of every operator here.
TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
# Fixed value: the pre-tokenisation pattern that belongs to the vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Relative error of a source's tokens at which its iterations end, and rounds after which one that is still open is
#: reported as not converged; a bracket halves or triples in every round, so none gets there.
TOLERANCE, ROUNDS = 1e-6, 200


@functools.lru_cache(maxsize=2)
def _encoder(path: str):
    """The tokenizer of a vocabulary file, read once a worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("counts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def token_counts(documents: DataFrame, text: str = "text", folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """documents with `tokens` in place of the text; the text is read by the tokenizer's workers and goes no further.

    The vocabulary is read where the driver runs and sent to the executors.
    """
    rest = [f for f in documents.schema.fields if f.name not in (text, "tokens")]
    documents.sparkSession.sparkContext.addFile(os.path.join(folder, vocabulary))

    def run(batches):
        import pyarrow as pa
        from pyspark import SparkFiles

        encode = _encoder(SparkFiles.get(vocabulary))
        for b in batches:
            n = [len(encode(t)) if t else 0 for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n, pa.int64())], names=[*b.schema.names[:-1], "tokens"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)
    return documents.select(*[f.name for f in rest], text).mapInArrow(run, f"{schema + ', ' if rest else ''}tokens bigint")


def _rate(lam: Column, tokens: Column, mean: Column, cap: Column) -> Column:
    """exp(lambda * t / mean), at most cap; the exponent is bounded so that it stays a number."""
    return F.when(cap <= 0, 0.0).otherwise(F.least(F.exp(F.least(F.greatest(lam * tokens / mean, F.lit(-700.0)), F.lit(700.0))), cap))


def balance(counts: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_tokens, tokens, cap, lambda, mean, reached, rounds, converged, feasible): the dual solved for each source.

    counts: (source, tokens) of all documents. targets: (source, target_share, max_repeats). converged: the
    iterations ended, at the target or saturated below it; feasible: not saturated below it.
    """
    lengths = materialize(counts.groupBy("source", "tokens").agg(F.count(F.lit(1)).alias("n")), "token-lengths")
    total = lengths.agg(F.sum(F.col("tokens") * F.col("n"))).first()[0] or 0
    lengths = lengths.where("tokens > 0 and source is not null")
    goal = targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("share"), F.max("max_repeats").alias("cap"))
    sums = lengths.groupBy("source").agg(F.sum(F.col("tokens") * F.col("n")).alias("t"), F.sum("n").alias("docs"))
    none = F.lit(None).cast("double")
    start = goal.join(sums, "source", "left").select(
        "source", (F.coalesce("share", F.lit(0.0)) * total).alias("want"), F.greatest(F.coalesce("cap", F.lit(0)), F.lit(0)).cast("double").alias("cap"), F.coalesce("t", F.lit(0)).alias("t"), F.coalesce(F.col("t") / F.col("docs"), F.lit(1.0)).alias("mean"),
        F.lit(0.0).alias("lam"), none.alias("lo"), none.alias("hi"), F.lit(0.0).alias("reached"), F.lit(0).alias("rounds"), F.lit("open").alias("status"),
    )
    # a source without a token has nothing to step on: its first round is its last
    state = materialize(start.where("t > 0").unionByName(_newton(start.where("t = 0").withColumns({"g": F.lit(0.0), "h": F.lit(0.0)}))), "multipliers")
    few = state.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    hot = [] if few else hot_keys(lengths, ["source"])
    ended = [state.where("status <> 'open'")]
    for _ in range(ROUNDS):
        now = state.where("status = 'open'")
        j = lengths.join(F.broadcast(now), "source") if few else salted_join(lengths, now, ["source"], F.col("tokens"), hot=hot)
        w = _rate(F.col("lam"), F.col("tokens"), F.col("mean"), F.col("cap"))
        mass = F.col("w") * F.col("tokens") * F.col("n")
        bent = F.when(F.col("w") < F.col("cap"), mass * F.col("tokens") / F.col("mean")).otherwise(0.0)
        keep = ("want", "cap", "t", "mean", "lam", "lo", "hi", "reached", "rounds", "status")
        got = j.withColumn("w", w).groupBy("source").agg(F.sum(mass).alias("g"), F.sum(bent).alias("h"), *[F.first(c).alias(c) for c in keep])
        seen = Observation()
        state = materialize(_newton(got).observe(seen, F.count_if(F.col("status") == "open").alias("open")), "multipliers")
        ended.append(state.where("status <> 'open'"))
        if not seen.get["open"]:
            break
    else:
        ended.append(state.where("status = 'open'"))
    state = reduce(DataFrame.unionByName, ended)
    # the exact comparison confirms what the end state says
    short = (F.col("status") == "saturated") & (F.col("t") * F.col("cap") < F.col("want"))
    return state.select("source", F.col("want").alias("target_tokens"), F.col("t").alias("tokens"), "cap", F.col("lam").alias("lambda"), "mean", "reached", "rounds", (F.col("status") != "open").alias("converged"), (~short).alias("feasible"))


def _newton(state: DataFrame) -> DataFrame:
    """One safeguarded Newton step of each source with its gradient sum g and curvature h.

    The gradient is monotone in the multiplier, so a bracket is kept: a step that leaves it halves it; where one
    end is still unknown, the multiplier grows threefold.
    """
    lam, lo, hi = F.col("lam"), F.col("lo"), F.col("hi")
    s = state.withColumn("gap", F.col("g") - F.col("want"))
    full = F.col("g") >= F.col("cap") * F.col("t") * (1 - TOLERANCE)
    status = F.when(F.abs("gap") <= TOLERANCE * F.greatest("want", F.lit(1.0)), "converged").when((F.col("gap") < 0) & full, "saturated").otherwise("open")
    s = s.withColumns({"status": status, "lo": F.when(F.col("gap") < 0, lam).otherwise(lo), "hi": F.when(F.col("gap") > 0, lam).otherwise(hi)})
    far = 2 * (1 + F.abs("lam"))
    step = lam - F.col("gap") / F.nullif("h", F.lit(0.0))
    inside = F.coalesce((lo.isNull() | (step > lo)) & (hi.isNull() | (step < hi)) & (F.abs(step - lam) <= far), F.lit(False))
    moved = F.when(inside, step).when(lo.isNotNull() & hi.isNotNull(), (lo + hi) / 2).otherwise(lam + F.when(F.col("gap") < 0, far).otherwise(-far))
    return s.select("source", "want", "cap", "t", "mean", F.when(F.col("status") == "open", moved).otherwise(lam).alias("lam"), "lo", "hi", F.col("g").alias("reached"), (F.col("rounds") + 1).alias("rounds"), "status")


def copies(counts: DataFrame, solved: DataFrame, key: str) -> DataFrame:
    """counts with rate and copies: whole copies, and one more where the document's hash is below the fraction."""
    s = solved.select("source", "lambda", "mean", "cap")
    own = [c for c in counts.columns if c not in ("lambda", "mean", "cap", "rate", "copies")]
    j = small_join(counts.select(*own), s, ["source"], "left")
    rate = F.when(F.col("tokens") > 0, F.coalesce(_rate(F.col("lambda"), F.col("tokens"), F.col("mean"), F.col("cap")), F.lit(0.0))).otherwise(0.0)
    even = (F.pmod(F.xxhash64(F.col(key), F.lit("mix")), F.lit(1 << 30)) + 0.5) / float(1 << 30)
    j = j.withColumn("rate", rate)
    whole = F.floor("rate")
    return j.withColumn("copies", (whole + F.when(even < F.col("rate") - whole, 1).otherwise(0)).cast("int")).drop("lambda", "mean", "cap")


def shares(mixed: DataFrame, solved: DataFrame) -> DataFrame:
    """Per source: what was asked and what the rounded copies give, as tokens and shares of the mixture."""
    got = mixed.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("mixed_tokens"), F.max("copies").alias("most_copies"))
    r = solved.join(got, "source", "left").withColumn("mixed_tokens", F.coalesce("mixed_tokens", F.lit(0)))
    asked, given = r.agg(F.sum("target_tokens"), F.sum("mixed_tokens")).first()
    share = lambda c, t: (F.col(c) / F.lit(float(t))) if t else F.lit(0.0)
    return r.select("source", "tokens", "target_tokens", share("target_tokens", asked).alias("target_share"), "mixed_tokens", share("mixed_tokens", given).alias("actual_share"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"), "rounds", "converged", "feasible")
