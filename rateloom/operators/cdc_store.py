"""Problem 7: applying a stream of inserts, updates and deletes.

A table is kept as buckets by the hash of its key, in numbered manifests that name the files of each
bucket. Applying changes is copy-on-write: the changes are routed by the same hash and added to the table's log of
changes, only touched buckets are read and sort-merged with the net effect on each key, replacement files
are written beside the old ones, and the next manifest makes them the table. A reader sees one manifest or the next, never
a mixture; a run that dies leaves files no manifest names.

The rows the table began with stay, and with them every change since: a touched bucket is what its first rows become by all
changes of its log in their order. So a change may arrive any time after those that follow it, and however a feed is
cut into batches, the table ends the same. The manifest also has the number of the last batch: one that is applied again
changes nothing.

Order within a key does not need the key's changes in one task: what a run of changes does to a key
is a function of whether it was known and live, and such functions compose. Changes are summarised by
chunks of a key, the chunks' summaries are scanned, and each chunk is then evaluated with the state
it starts from.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import clean
from ..plans.materialize import ConflictError as ConflictError
from ..plans.materialize import Manifests
from ..plans.skew import small_join

# What a change may set.
ATTRIBUTES = ("org_name", "practice_address_1", "practice_city", "practice_state", "practice_postal", "primary_taxonomy")
#: Lines of a delivered file that make up one chunk of a key.
CHUNK_LINES = 1024
#: Bytes of a bucket's input at which buckets are sized, and the least and most of them; a table that has outgrown its buckets is given others by rebucket().
BUCKET_BYTES, LEAST_BUCKETS, MOST_BUCKETS = 128 << 20, 16, 65_536
#: Additions to the log after which they are written together.
MOST_LOGS = 32


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class BucketStore:
    """A bucketed table under a path of the shared file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.versions = Manifests(spark, path)

    def manifest(self) -> dict | None:
        return self.versions.latest()

    def _write(self, rows: DataFrame, touched: int) -> str:
        """One file a bucket, written by the task that holds the bucket; rows has one row a key."""
        where = f"{self.path}/data-{uuid.uuid4().hex}"
        rows.repartition(min(max(touched, 1), 4096), "bucket").write.partitionBy("bucket").parquet(where)
        return where

    def _write_log(self, changes: DataFrame) -> str:
        """Changes by bucket; one that holds a large part of them is split over tasks and files."""
        where = f"{self.path}/log-{uuid.uuid4().hex}"
        changes.hint("rebalance", F.col("bucket")).write.partitionBy("bucket").parquet(where)
        return where

    def create(self, rows: DataFrame, key: str, buckets: int | None = None) -> dict:
        """Write the first version. buckets: by the plan's size estimate unless given."""
        if buckets is None:
            size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
            buckets = max(LEAST_BUCKETS, min(MOST_BUCKETS, size // BUCKET_BYTES + 1))
        where = self._write(rows.withColumn("bucket", bucket_of(key, buckets)), buckets)
        files = {str(b): where for b in range(buckets)}
        return self.versions.commit({"key": key, "buckets": buckets, "schema": rows.schema.json(), "files": files, "first_schema": rows.schema.json(), "first": where, "log": [], "log_schema": None, "batch": -1})

    def _parts(self, places: dict[str, list[int] | None], schema: str) -> DataFrame:
        """The rows of some buckets (None: all) of written folders."""
        kind = StructType.fromJson(json.loads(schema)).add("bucket", "integer")
        parts = []
        for where, buckets in sorted(places.items()):
            part = self.spark.read.schema(kind).parquet(where)
            parts.append(part if buckets is None else part.where(F.col("bucket").isin(buckets)))
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], kind)

    def read(self, only: list[int] | None = None, manifest: dict | None = None) -> DataFrame:
        """All rows, or those of some buckets, of the current or a given manifest."""
        m = manifest or self.manifest()
        places: dict[str, list[int] | None] = {}
        for b, where in m["files"].items():
            if only is None or int(b) in only:
                places.setdefault(where, []).append(int(b))
        return self._parts(places, m["schema"])

    def apply(self, changes: DataFrame, merge, again, batch: int | None = None) -> dict:
        """Copy-on-write of the buckets that the changes' keys fall into; the new manifest, with the `touched` buckets.

        again(log) makes the union of changes what one delivery of them would be; merge(rows, log) gives
        the buckets' rows from their first rows and that, with the table's columns or more. Changes new in this apply
        have `_fresh`. At most `buckets` numbers reach the driver.
        """
        m = self.manifest()
        if batch is not None and batch <= m["batch"]:
            return dict(m, touched=[])
        routed = changes.withColumn("bucket", bucket_of(m["key"], m["buckets"]))
        schema = changes.schema.json()
        added = self._write_log(routed)
        fresh = self._parts({added: None}, schema)
        touched = sorted(r[0] for r in fresh.select("bucket").distinct().collect())
        if not touched:
            return dict(self.versions.commit(dict(m, batch=batch)), touched=[]) if batch is not None else dict(m, touched=[])
        log = fresh.withColumn("_fresh", F.lit(True))
        if m["log"]:
            log = again(log.unionByName(self._parts({p: touched for p in m["log"]}, m["log_schema"]).withColumn("_fresh", F.lit(False))))
        rows = merge(self._parts({m["first"]: touched}, m["first_schema"]), log)
        where = self._write(rows, len(touched))
        logs = [*m["log"], added]
        if len(logs) > MOST_LOGS:
            logs = [self._write_log(self._parts({p: None for p in logs}, schema))]
        new = dict(m, touched=touched, files=m["files"] | {str(b): where for b in touched}, log=logs, log_schema=schema)
        out = rows.drop("bucket").schema
        if {f.name for f in out.fields} != {f["name"] for f in json.loads(m["schema"])["fields"]}:
            new["schema"] = out.json()
        if batch is not None:
            new["batch"] = batch
        return self.versions.commit(new)

    def rebucket(self, buckets: int) -> dict:
        """The same table in another number of buckets, for one that has outgrown them."""
        m = self.manifest()
        route = lambda df: df.drop("bucket").withColumn("bucket", bucket_of(m["key"], buckets))
        where = self._write(route(self.read(manifest=m)), buckets)
        first = self._write(route(self._parts({m["first"]: None}, m["first_schema"])), buckets)
        logs = [self._write_log(route(self._parts({p: None for p in m["log"]}, m["log_schema"])))] if m["log"] else []
        return self.versions.commit(dict(m, buckets=buckets, files={str(b): where for b in range(buckets)}, first=first, log=logs))


def ordered_changes(changes: DataFrame, log: DataFrame, attributes: tuple[str, ...] = ATTRIBUTES, key: str = "npi") -> DataFrame:
    """Changes of applied files, cleaned, each repeated one once, with `_at`, their place in the order.

    Of changes equal in key, type, date and all attributes the earliest in the order counts. Blank
    attributes are null. Changes without key or date have no place and are dropped; equal places go by
    change_id.
    """
    done = log.where(F.lower(F.trim("outcome")) == "applied").groupBy("source_file").agg(F.max("coverage_end").alias("coverage_end"))
    c = small_join(changes.select("change_id", "source_file", "line_no", key, "change_type", "last_update_date", *attributes), done, ["source_file"])
    same = [clean(F.col(key)).alias(key), F.lower(clean(F.col("change_type"))).alias("change_type"), F.col("last_update_date").alias("day"), *[clean(F.col(a)).alias(a) for a in attributes]]
    c = c.select(*same, F.struct("last_update_date", "coverage_end", "line_no", "change_id").alias("_at")).where(f"{key} is not null and day is not null")
    return c.groupBy(key, "change_type", "day", *attributes).agg(F.min("_at").alias("_at"))


def once(log: DataFrame, attributes: tuple[str, ...] = ATTRIBUTES, key: str = "npi") -> DataFrame:
    """Changes of several deliveries, each repeated one once, as ordered_changes gives those of one."""
    first = F.min(F.struct("_at", ~F.col("_fresh"))).alias("_f")
    same = log.groupBy(key, "bucket", "change_type", "day", *attributes).agg(first)
    return same.select(key, "bucket", "change_type", "day", *attributes, F.col("_f._at").alias("_at"), (~F.col("_f.col2")).alias("_fresh"))


def net_effects(ordered: DataFrame, base: DataFrame, key: str = "npi", attributes: tuple[str, ...] = ATTRIBUTES) -> DataFrame:
    """One row for each key on which some change took effect: live, change_id, fresh (one of this delivery did), and for each attribute (value, set by).

    base: key, live, since (the current row's date; earlier changes are dropped). insert makes live
    and sets all; update sets its non-null ones if live; deactivate ends life if live; reactivate
    makes a known, not live key live and sets its non-null ones.
    """
    ordered = ordered if "_fresh" in ordered.columns else ordered.withColumn("_fresh", F.lit(True))
    rows = ordered.withColumn("_chunk", F.struct(F.col("_at.last_update_date").alias("d"), F.col("_at.coverage_end").alias("e"), F.floor(F.col("_at.line_no") / CHUNK_LINES).alias("b")))
    turn = F.when(F.col("change_type").isin("insert", "reactivate"), True).when(F.col("change_type") == "deactivate", False)
    rows = rows.withColumn("_turn", turn).withColumn("_new", F.col("change_type") == "insert")
    # what a chunk does: does it make the key known, and how does it leave a known one; a chunk has one date,
    # so the base is met by chunks, and the rows of a key never come together
    chunks = rows.groupBy(key, "_chunk").agg(F.max("_new").alias("_c_new"), F.max_by("_turn", F.when(F.col("_turn").isNotNull(), F.col("_at"))).alias("_c_turn"))
    chunks = chunks.join(base.select(key, F.col("live").alias("_live"), F.col("since").alias("_since")), key, "left")
    chunks = chunks.where(F.col("_since").isNull() | (F.col("_chunk.d") >= F.col("_since")))
    before = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("_known0", F.col("_live").isNotNull() | F.coalesce(F.max("_c_new").over(before), F.lit(False))).withColumn("_live0", F.coalesce(F.last("_c_turn", True).over(before), F.col("_live"), F.lit(False)))
    rows = rows.join(chunks.select(key, "_chunk", "_known0", "_live0"), [key, "_chunk"])
    within = Window.partitionBy(key, "_chunk").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    known = F.col("_known0") | F.coalesce(F.max("_new").over(within), F.lit(False))
    rows = rows.withColumn("_known", known).withColumn("_alive", F.coalesce(F.last("_turn", True).over(within), F.col("_live0")) & F.col("_known"))
    kind = F.col("change_type")
    works = F.when(kind == "insert", True).when(kind.isin("update", "deactivate"), F.col("_alive")).when(kind == "reactivate", F.col("_known") & ~F.col("_alive")).otherwise(False)
    took = rows.where(works)
    sets = {a: (kind == "insert") | (kind.isin("update", "reactivate") & F.col(a).isNotNull()) for a in attributes}
    at = F.col("_at")
    return took.groupBy(key).agg(
        F.max(F.struct(at, kind.alias("k"))).alias("_last"),
        F.max("_fresh").alias("fresh"),
        *[F.max(F.when(sets[a], F.struct(at.alias("at"), F.col(a).alias("v")))).alias(f"_set_{a}") for a in attributes],
    ).select(key, (F.col("_last.k") != "deactivate").alias("live"), F.col("_last._at.change_id").alias("change_id"), F.col("_last._at.last_update_date").alias("day"), "fresh", *[F.col(f"_set_{a}") for a in attributes])


def merge_net(base: DataFrame, net: DataFrame, key: str = "npi", attributes: tuple[str, ...] = ATTRIBUTES) -> DataFrame:
    """Sort-merge of touched buckets with the net effects: each base row changed or kept, new keys added.

    Adds change_id, for each attribute <attribute>_change_id (0: never changed), and fresh: a change of the last
    apply took effect.
    """
    n = net.select("bucket", key, F.col("live").alias("_n_live"), F.col("change_id").alias("_n_id"), F.col("day").alias("_n_day"), F.col("fresh").alias("_n_fresh"), *[f"_set_{a}" for a in attributes])
    j = base.hint("merge").join(n.hint("merge"), ["bucket", key], "full")
    hit = F.col("_n_id").isNotNull()
    cols = []
    for c in base.columns:
        if c in ("bucket", key):
            continue
        if c in attributes:
            cols.append(F.when(F.col(f"_set_{c}").isNotNull(), F.col(f"_set_{c}.v")).otherwise(F.col(c)).alias(c))
        elif c == "status":
            cols.append(F.when(hit, F.when(F.col("_n_live"), "active").otherwise("deactivated")).otherwise(F.col(c)).alias(c))
        elif c == "last_update_date":
            cols.append(F.coalesce("_n_day", c).alias(c))
        else:
            cols.append(F.col(c))
    cols.append(F.coalesce("_n_id", F.lit(0)).alias("change_id"))
    for a in attributes:
        cols.append(F.coalesce(F.col(f"_set_{a}.at.change_id"), F.lit(0)).alias(f"{a}_change_id"))
    return j.select(key, *cols, F.coalesce("_n_fresh", F.lit(False)).alias("fresh"), "bucket")


def current_rows(history: DataFrame, key: str = "npi", attributes: tuple[str, ...] = ATTRIBUTES) -> DataFrame:
    """The current row of each key; of several the highest version. Blank values are null."""
    cur = history.where("is_current").select(clean(F.col(key)).alias(key), F.struct("version", "status", "last_update_date", *[clean(F.col(a)).alias(a) for a in attributes]).alias("r")).where(f"{key} is not null")
    return cur.groupBy(key).agg(F.max("r").alias("r")).select(key, "r.status", "r.last_update_date", *[f"r.{a}" for a in attributes])


def apply_changes(store: BucketStore, changes: DataFrame, log: DataFrame, key: str = "npi", batch: int | None = None) -> DataFrame:
    """Apply a feed to a store made of current_rows; returns the rows on which one of its changes took effect."""

    def merge(first: DataFrame, ordered: DataFrame) -> DataFrame:
        base = first.select(key, (F.lower(F.trim("status")) == "active").alias("live"), F.col("last_update_date").alias("since"))
        net = net_effects(ordered, base, key)
        return merge_net(first, net.withColumn("bucket", bucket_of(key, buckets)), key)

    buckets = store.manifest()["buckets"]
    m = store.apply(ordered_changes(changes, log, key=key), merge, lambda u: once(u, key=key), batch)
    rows = store.read(m["touched"], m) if m["touched"] else store.read([], m)
    if "fresh" not in rows.columns:
        rows = rows.withColumns({"fresh": F.lit(False), "change_id": F.lit(0).cast("long"), **{f"{a}_change_id": F.lit(0).cast("long") for a in ATTRIBUTES}})
    return rows.where("fresh")
