"""The queries of problems 8 to 10 over the tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.materialize import materialize
from ..session import table
from . import leak, mix, reading


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leak.find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def _mixture(spark: SparkSession, d: str):
    docs = table(spark, d, "documents").select("doc_id", "source", "text")
    counts = materialize(mix.token_counts(docs), "token-counts")
    return counts, mix.balance(counts.select("source", "tokens"), table(spark, d, "mix_targets"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Sources whose iterations ended saturated, short of their target."""
    return _mixture(spark, d)[1].where("not feasible").select("source")


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual share of each source in the rounded mixture."""
    counts, solved = _mixture(spark, d)
    return mix.shares(mix.copies(counts, solved, "doc_id"), solved)


def p9_copies(spark: SparkSession, d: str) -> DataFrame:
    """How often each document goes into the mixture."""
    counts, solved = _mixture(spark, d)
    return mix.copies(counts, solved, "doc_id").select("doc_id", "source", "tokens", "copies")


#: The stated rule: least words, words to the sentence and letters to the word.
WORDS, LONG_SENTENCE, LONG_WORD = 40, 18, 6.5


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents from the level on that prose of the rule cannot be below, by the fitted curve; the stated rule then checks each."""
    levels = reading.reading_levels(table(spark, d, "documents"), table(spark, d, "reading_labels"))
    exact = (F.col("words") >= WORDS) & (F.col("words") >= LONG_SENTENCE * F.col("sentences")) & (F.col("letters") >= LONG_WORD * F.col("words"))
    return levels.demanding(LONG_SENTENCE, LONG_WORD).where(exact).select("doc_id")


def p10_levels(spark: SparkSession, d: str) -> DataFrame:
    """The reading level of every document."""
    return reading.reading_levels(table(spark, d, "documents"), table(spark, d, "reading_labels")).rows.select("doc_id", "words", "bits", "sentence_bits", "level")


QUERIES = {f.__name__: f for f in (p8_found, p9_found, p9_shares, p9_copies, p10_found, p10_levels)}

ORACLES = {
    # no source is near its limit, so characters stand for tokens
    "p9_found": """with t as (select source, sum(length(text)) as n from documents group by 1), m as (select source, max(target_share) as share, greatest(coalesce(max(max_repeats), 0), 0) as cap from mix_targets where source is not null group by 1)
select m.source from m left join t on t.source = m.source where coalesce(t.n, 0) * m.cap < m.share * (select sum(length(text)) from documents)""",
}
