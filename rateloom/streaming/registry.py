"""Change feeds as streams: each micro-batch is applied to a bucketed store, once.

The store's manifest carries the number of the last applied batch and is committed with its rows, so a batch that is
replayed after a failure at any moment changes nothing. The store keeps all changes: a late one takes its place in
the order whichever batch brings it, and the state is that of one delivery of all batches. There is no watermark, for the
state never expires.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.cdc_store import BucketStore, apply_changes


def apply_batch(store: BucketStore, log: DataFrame, changes: DataFrame, batch: int, key: str = "npi") -> bool:
    """Apply one batch; False where it was applied before."""
    if batch <= store.manifest()["batch"]:
        return False
    apply_changes(store, changes, log, key, batch)
    return True


def start(spark: SparkSession, source: str, schema, store_path: str, log_path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Stream Parquet change files as they appear; once takes what is there and ends."""
    feed = spark.readStream.schema(schema).parquet(source)

    def run(batch: DataFrame, n: int) -> None:
        s = batch.sparkSession
        apply_batch(BucketStore(s, store_path), s.read.parquet(log_path), batch, n)

    writer = feed.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()


def stale_ledger(ledger: DataFrame, now, hours: int = 26) -> DataFrame:
    """One row if the newest entry of a ledger (applied_at) is older than so many hours, or there is none."""
    newest = ledger.agg(F.max("applied_at").alias("newest"))
    return newest.where(F.col("newest").isNull() | (F.col("newest") < F.lit(now) - F.expr(f"interval {int(hours)} hours")))
