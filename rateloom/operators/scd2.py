"""Type-2 history by change data capture from full and weekly files.

A file is applied as a whole: deduplicated, resolved against the current versions, classified, and
committed. The state is a set of tables under a path: closed versions, which are only appended to,
and the current ones, which are rewritten; a numbered manifest with the ledger names them and its appearance is the
commit, so a run that dies changes nothing. Applying a file again changes nothing.

Differences from a literal reading of the sources that would break the history's own rules: a key that was
absent and comes back opens a version at the later of its effective date and its absence, as a
reactivation; a version that is closed by a record without any date ends with the file's coverage.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..plans.materialize import Manifests, hadoop_fs
from ..sources.registry import ATTRIBUTES, BESIDE, row_hash
from .relational import first_by

ABSENT = "absent_from_full"
COUNTS = {"inserted": "insert", "updated": "update", "deactivated": "deactivate", "reactivated": "reactivate", "unchanged": "unchanged", "stale_skipped": "stale"}
_TYPES = {"enumeration_date": "date", "deactivation_date": "date", "reactivation_date": "date", "last_update_date": "date", "certification_date": "date", "taxonomy_codes": "array<string>"}
HISTORY_SCHEMA = "npi string, version int, " + ", ".join(f"{c} {_TYPES.get(c, 'string')}" for c in (*ATTRIBUTES, *BESIDE)) + ", effective_date date, row_hash string, status string, change_type string, valid_from date, valid_to date, is_current boolean, source_file string, file_end date"


@dataclass
class Staged:
    """A typed file with what is known of it."""

    name: str
    kind: str
    coverage_start: dt.date
    coverage_end: dt.date
    rows: DataFrame | None
    drift: list[tuple[str, str, int]] = field(default_factory=list)


def dedupe_incoming(rows: DataFrame, by: tuple[str, ...] = ("npi",)) -> DataFrame:
    """One row a key: the latest effective date, then the smallest hash."""
    return first_by(rows.where("npi is not null"), list(by), [F.desc_nulls_last("effective_date"), F.asc("row_hash")])


def resolve(incoming: DataFrame, current: DataFrame) -> DataFrame:
    """Incoming rows beside the current version; a stub keeps the known attributes and takes only the deactivation."""
    cur = current.select("npi", *[F.col(c).alias(f"c_{c}") for c in (*ATTRIBUTES, *BESIDE, "version", "row_hash", "effective_date", "status", "valid_from", "file_end")])
    j = incoming.drop("row_hash").join(cur, "npi", "left")
    cols = []
    for c in (*ATTRIBUTES, *BESIDE):
        held = F.col(f"c_{c}")
        if c == "deactivation_date":
            cols.append(F.col(c))
        elif c == "deactivation_reason":
            cols.append(F.when(F.col("is_stub"), F.coalesce(F.col(c), held)).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.when(F.col("is_stub"), held).otherwise(F.col(c)).alias(c))
    r = j.select("npi", *cols, "effective_date", "c_version", "c_row_hash", "c_effective_date", "c_status", "c_valid_from", "c_file_end")
    off = F.col("deactivation_date").isNotNull() & (F.col("reactivation_date").isNull() | (F.col("reactivation_date") < F.col("deactivation_date")))
    return r.withColumns({"row_hash": row_hash(), "status": F.when(off, "deactivated").otherwise("active")})


def classify(resolved: DataFrame, coverage_end: dt.date) -> DataFrame:
    """insert, stale, unchanged, deactivate, reactivate or update for each incoming key."""
    same = F.col("row_hash") == F.col("c_row_hash")
    older = F.col("effective_date") < F.col("c_effective_date")
    outdated = (F.col("effective_date") == F.col("c_effective_date")) & ~same & (F.lit(coverage_end) < F.col("c_file_end"))
    kind = (
        F.when(F.col("c_version").isNull(), "insert")
        .when(older, "stale")
        .when(outdated, "stale")
        .when(same & (F.col("status") == F.col("c_status")), "unchanged")
        .when((F.col("status") == "deactivated") & (F.col("c_status") != "deactivated"), "deactivate")
        .when((F.col("status") == "active") & F.col("c_status").isin("deactivated", ABSENT), "reactivate")
        .otherwise("update")
    )
    return resolved.withColumn("change_type", kind)


def gone(current: DataFrame, incoming: DataFrame, coverage_end: dt.date) -> DataFrame:
    """Current versions that a full file no longer lists and that are not younger than it."""
    known = current.where((F.col("status") != ABSENT) & (F.coalesce("valid_from", F.lit("1900-01-01").cast("date")) <= F.lit(coverage_end)))
    return known.join(incoming.select("npi"), "npi", "left_anti")


def superseded(log: DataFrame) -> DataFrame:
    """Weekly files of a log, and whether a full file applied before covers them; null before the first."""
    before = Window.orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    latest = F.max(F.when((F.col("kind") == "full") & (F.col("outcome") == "applied"), F.col("coverage_end"))).over(before)
    return log.withColumn("_full", latest).where("kind = 'weekly'").select("source_file", "coverage_end", (F.col("coverage_end") <= F.col("_full")).alias("superseded"))


class HistoryStore:
    """The state under a path of the shared file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.versions = Manifests(spark, path)

    def manifest(self) -> dict:
        return self.versions.latest() or {"closed": [], "current": None, "ledger": [], "drift": []}

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], HISTORY_SCHEMA)
        return self.spark.read.schema(HISTORY_SCHEMA).parquet(*paths)

    def current(self) -> DataFrame:
        m = self.manifest()
        return self._read([m["current"]] if m["current"] else [])

    def history(self) -> DataFrame:
        m = self.manifest()
        return self._read([*m["closed"], *([m["current"]] if m["current"] else [])]).drop("file_end")

    def ledger(self) -> DataFrame:
        schema = "seq int, source_file string, kind string, coverage_start date, coverage_end date, rows bigint, inserted bigint, updated bigint, deactivated bigint, reactivated bigint, unchanged bigint, stale_skipped bigint, absent_from_full bigint, outcome string"
        day = lambda v: dt.date.fromisoformat(v) if v else None
        names = [f.name for f in StructType.fromDDL(schema).fields]
        rows = [tuple(day(r.get(c)) if c.startswith("coverage") else r.get(c) for c in names) for r in self.manifest()["ledger"]]
        return self.spark.createDataFrame(rows, schema)

    def drift(self) -> DataFrame:
        return self.spark.createDataFrame([tuple(x) for x in self.manifest()["drift"]], "source_file string, kind string, column string, n bigint")

    def applied(self) -> set[str]:
        return {r["source_file"] for r in self.manifest()["ledger"] if r["outcome"] in ("applied", "superseded_by_full")}

    def _commit(self, m: dict) -> None:
        self.versions.commit(m)

    def apply(self, s: Staged) -> dict:
        """Merge one file; returns its ledger row."""
        m = self.manifest()
        entry = {"seq": max([r["seq"] for r in m["ledger"]], default=0) + 1, "source_file": s.name, "kind": s.kind, "coverage_start": s.coverage_start.isoformat(), "coverage_end": s.coverage_end.isoformat()}
        m["drift"] = [d for d in m["drift"] if d[0] != s.name] + [[s.name, *d] for d in s.drift]
        fulls = [r["coverage_end"] for r in m["ledger"] if r["kind"] == "full" and r["outcome"] == "applied"]
        if any(d[0] == "missing_required_column" for d in s.drift):
            entry["outcome"] = "rejected_schema"
        elif s.kind == "weekly" and fulls and entry["coverage_end"] <= max(fulls):
            entry |= {"rows": s.rows.count(), "outcome": "superseded_by_full"}
        else:
            entry |= self._merge(m, s) | {"outcome": "applied"}
        m["ledger"].append(entry)
        self._commit(m)
        self._clear()
        return entry

    def _clear(self) -> None:
        """Drop the scratch tables of applied files."""
        fs, found = hadoop_fs(self.spark, f"{self.path}/work-*")
        for s in fs.globStatus(found) or []:
            fs.delete(s.getPath(), True)

    def _merge(self, m: dict, s: Staged) -> dict:
        tag = uuid.uuid4().hex
        # what follows is read several times: it is written once, beside the state
        incoming = self._keep(dedupe_incoming(s.rows), f"work-{tag}/incoming")
        current = self._read([m["current"]] if m["current"] else [])
        changes = self._keep(classify(resolve(incoming, current), s.coverage_end), f"work-{tag}/changes")
        counts = {r["change_type"]: r["count"] for r in changes.groupBy("change_type").count().collect()}
        act = changes.where(F.col("change_type").isin("insert", "update", "deactivate", "reactivate"))
        start = F.when(F.col("c_status") == ABSENT, F.greatest("effective_date", "c_valid_from")).otherwise(F.coalesce("effective_date", F.when(F.col("c_version").isNotNull(), F.lit(s.coverage_end))))
        opened = act.select("npi", (F.coalesce("c_version", F.lit(0)) + 1).alias("version"), *ATTRIBUTES, *BESIDE, "effective_date", "row_hash", "status", "change_type", start.alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_current"), F.lit(s.name).alias("source_file"), F.lit(s.coverage_end).alias("file_end"))
        ends = opened.select("npi", F.col("valid_from").alias("_end"))
        absent = 0
        if s.kind == "full":
            lost = self._keep(gone(current, incoming, s.coverage_end), f"work-{tag}/gone")
            absent = lost.count()
            stones = lost.withColumns({"version": F.col("version") + 1, "status": F.lit(ABSENT), "change_type": F.lit(ABSENT), "valid_from": F.lit(s.coverage_end), "source_file": F.lit(s.name), "file_end": F.lit(s.coverage_end)})
            opened = opened.unionByName(stones)
            ends = ends.unionByName(lost.select("npi", F.lit(s.coverage_end).alias("_end")))
        columns = [f.name for f in StructType.fromDDL(HISTORY_SCHEMA).fields]
        kept = current.join(ends, "npi", "left_anti").select(*columns)
        closed = current.join(ends, "npi").withColumns({"is_current": F.lit(False), "valid_to": F.col("_end")}).select(*columns)
        now, past = f"{self.path}/current-{tag}", f"{self.path}/closed-{tag}"
        kept.unionByName(opened.select(*columns)).write.parquet(now)
        closed.write.parquet(past)
        m["current"] = now
        m["closed"] = [*m["closed"], past]
        rows = s.rows.count()
        return {"rows": rows} | {k: counts.get(v, 0) for k, v in COUNTS.items()} | {ABSENT: absent}

    def _keep(self, df: DataFrame, where: str) -> DataFrame:
        path = f"{self.path}/{where}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def sync_order(names: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The newest full file of a listing, then the weekly ones by their start date; (name, kind) pairs."""
    from ..sources.registry import _WEEKLY

    def month(name: str) -> tuple[int, int]:
        parts = name.split("_")
        months = [dt.date(2000, i, 1).strftime("%B") for i in range(1, 13)]
        return int(parts[4]), months.index(parts[3]) if parts[3] in months else 0

    fulls = sorted((n for n in names if n[1] == "full"), key=lambda n: month(n[0]))
    weeklies = [n for n in names if n[1] == "weekly" and _WEEKLY.search(n[0])]
    start = lambda n: (n[0].split("_")[3][4:], n[0].split("_")[3][:4])  # noqa: E731  # mmddyy
    return fulls[-1:] + sorted(weeklies, key=start)


def sync(store: HistoryStore, deliveries: list[tuple[str, str]], stage, reapply: bool = False) -> list[dict]:
    """Apply deliveries that are not applied yet, in order; stage(name, kind) gives the Staged file."""
    done = set() if reapply else store.applied()
    return [store.apply(stage(name, kind)) for name, kind in sync_order(deliveries) if name not in done]


def stage_archive(spark: SparkSession, path: str, kind: str) -> Staged:
    """Open an archive: check its header, type its rows, count what is wrong with them."""
    from ..sources import registry

    start, end, _, header = registry.peek(path)
    drift = registry.header_drift(header)
    name = path.rsplit("/", 1)[-1]
    if any(d[0] == "missing_required_column" for d in drift):
        return Staged(name, kind, start, end, None, drift)
    rows = registry.typed(registry.read_archive(spark, path))
    return Staged(name, kind, start, end, rows, drift + registry.file_drift(rows))
