"""Problems 2 and 3: what changed between full snapshots, and the history of changing attributes.

Both start from `canonical_snapshots`: one row for each key and snapshot, attributes trimmed with
blank as null, dates as dates, arrays without blank entries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean, us_date
from ..plans.skew import small_join

# The attributes of a registry row in their order.
ATTRIBUTES = ("entity_type", "org_name", "last_name", "first_name", "credential", "practice_address_1", "practice_city", "practice_state", "practice_postal", "enumeration_date", "deactivation_date", "reactivation_date", "primary_taxonomy", "taxonomy_codes")
DATES = ("enumeration_date", "deactivation_date", "reactivation_date")
LISTS = ("taxonomy_codes",)
_PRESENT = "\x00present"


def applied_files(log: DataFrame, rows: DataFrame, file: str = "source_file") -> DataFrame:
    """The applied snapshots that rows holds, numbered by coverage_end: (file, seq, coverage_end).

    A file logged twice counts once. The ledger has one row for each delivery, so numbering it takes
    one small task.
    """
    done = log.where(F.lower(F.trim("outcome")) == "applied").groupBy(file).agg(F.max("coverage_end").alias("coverage_end"))
    held = rows.select(file).distinct()
    order = Window.orderBy("coverage_end", file)
    return done.join(held, file, "left_semi").where(F.col("coverage_end").isNotNull()).select(file, F.row_number().over(order).alias("seq"), "coverage_end")


def canonical_field(name: str) -> Column:
    if name in LISTS:
        kept = F.filter(F.transform(name, clean), lambda x: x.isNotNull())
        return F.nullif(F.array_join(kept, "\x01"), F.lit(""))
    if name in DATES:
        return F.coalesce(F.date_format(us_date(F.col(name)), "yyyy-MM-dd"), clean(F.col(name)))
    return clean(F.col(name))


def canonical_snapshots(rows: DataFrame, files: DataFrame, key: str = "npi", file: str = "source_file", updated: str = "last_update_date", fields: tuple[str, ...] = ATTRIBUTES) -> DataFrame:
    """(seq, coverage_end, key, updated, fields...): of several rows of a key in a snapshot the latest.

    A blank update date is null, which is the earliest; rows tied on it say the same, else the greatest row
    counts, so the result is defined. Rows without a key are dropped. The choice is an aggregate with partial
    aggregation, so a key with very many rows in a snapshot is reduced before the shuffle.
    """
    placed = small_join(rows.select(file, key, updated, *fields), files, [file])
    best = placed.select("seq", "coverage_end", clean(F.col(key)).alias(key), F.struct(us_date(F.col(updated)).alias(updated), *[canonical_field(f).alias(f) for f in fields]).alias("_r")).where(F.col(key).isNotNull())
    return best.groupBy(key, "seq").agg(F.max("_r").alias("_r"), F.max("coverage_end").alias("coverage_end")).select("seq", "coverage_end", key, "_r.*")


def snapshot_changes(snapshots: DataFrame, files: DataFrame, key: str = "npi", fields: tuple[str, ...] = ATTRIBUTES) -> DataFrame:
    """(seq, key, change_kind, changed_fields) between consecutive snapshots; seq is the later one.

    snapshots has one row for each key and seq; files (seq, coverage_end) counts 1, 2, 3 without gaps. Rows are
    unpivoted into key-field-value cells plus a marker of the key's presence, with sign +1 as part of
    the later and -1 as part of the earlier side of a pair. Equal cells cancel; what is left over
    classifies the row. All of it follows one repartitioning by key: no cell is shuffled.

    A row that is all the same on both sides would cancel cell by cell, so it makes none; one without a
    counterpart is told by its marker and makes no other. A key has at most one row a snapshot, which bounds the window.
    """
    last = files.agg(F.max("seq").alias("_last"))
    by_key = Window.partitionBy(key).orderBy("seq")
    rows = snapshots.select(key, "seq", F.struct(*fields).alias("_row")).repartition(key)
    near = lambda f, step: F.when(f("seq").over(by_key) == F.col("seq") + step, f("_row").over(by_key))
    rows = rows.withColumn("_before", near(F.lag, -1)).withColumn("_after", near(F.lead, 1)).crossJoin(F.broadcast(last))
    side = lambda other, pair, sign: F.when((pair > 1) & (pair <= F.col("_last")) & ~other.eqNullSafe(F.col("_row")), F.struct(pair.alias("pair"), F.lit(sign).alias("sign"), other.isNotNull().alias("both")))
    sides = F.filter(F.array(side(F.col("_before"), F.col("seq"), 1), side(F.col("_after"), F.col("seq") + 1, -1)), lambda x: x.isNotNull())
    marker = F.struct(F.lit(_PRESENT).alias("field"), F.lit(None).cast("string").alias("value"))
    cells = F.array(marker, *[F.struct(F.lit(f).alias("field"), F.col(f"_row.{f}").alias("value")) for f in fields])
    signed = rows.select(key, F.explode(sides).alias("_s"), "_row").select(key, "_s.pair", "_s.sign", F.explode(F.when(F.col("_s.both"), cells).otherwise(F.array(marker))).alias("_c")).select(key, "pair", "sign", "_c.field", "_c.value")
    left = signed.groupBy(key, "pair", "field", "value").agg(F.sum("sign").alias("n")).where("n <> 0")
    present = F.max(F.when(F.col("field") == _PRESENT, F.col("n")))
    kinds = left.groupBy(key, "pair").agg(present.alias("_m"), F.array_sort(F.collect_set(F.when(F.col("field") != _PRESENT, F.col("field")))).alias("_f"))
    kind = F.when(F.col("_m").isNull(), "changed").when(F.col("_m") > 0, "added").otherwise("removed")
    return kinds.select(F.col("pair").alias("seq"), key, kind.alias("change_kind"), F.when(F.col("_m").isNull(), F.col("_f")).otherwise(F.array().cast("array<string>")).alias("changed_fields"))


def status_of() -> Column:
    gone, back = F.try_to_date("deactivation_date", "yyyy-MM-dd"), F.try_to_date("reactivation_date", "yyyy-MM-dd")
    return F.when(gone.isNotNull() & (back.isNull() | (back < gone)), "deactivated").otherwise("active")


def attribute_history(snapshots: DataFrame, files: DataFrame, key: str = "npi", updated: str = "last_update_date", fields: tuple[str, ...] = ATTRIBUTES, carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, version, valid_from, valid_to, status, change_type, carry...): a version for each change event.

    snapshots as of canonical_snapshots, files (seq, coverage_end) as of applied_files. A row older than one the key had in an earlier snapshot is
    stale: it stands for whatever was held before, a version or an absence. A row without a date is older than none. Consecutive snapshots are
    compared in one null-safe full outer join on key and pair; inserted, changed and deleted keys
    become events, and lead over a key's events gives valid_to (null while open). A key has at most one row
    a snapshot, so no window grows beyond the number of snapshots.
    """
    by_key = Window.partitionBy(key).orderBy("seq")
    hashed = F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)
    rows = snapshots.select("seq", key, F.col(updated).alias("_day"), F.struct(hashed.alias("hash"), status_of().alias("status"), *carry).alias("_held"))
    rows = rows.withColumn("_stale", F.coalesce(F.col("_day") < F.max("_day").over(by_key.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False)))
    rows = rows.withColumn("_run", F.sum(F.when(F.col("seq") == F.lag("seq").over(by_key) + 1, 0).otherwise(1)).over(by_key))
    fresh = F.last(F.when(~F.col("_stale"), F.col("_held")), ignorenulls=True).over(Window.partitionBy(key, "_run").orderBy("seq"))
    rows = rows.withColumn("_held", fresh).where(F.col("_held").isNotNull()).select(key, "seq", "_held")
    ends = files.select("seq", F.col("coverage_end").alias("valid_from"))
    before = rows.select(F.col(key).alias("_k1"), (F.col("seq") + 1).alias("_p1"), F.col("_held").alias("_old"))
    after = rows.select(F.col(key).alias("_k2"), F.col("seq").alias("_p2"), F.col("_held").alias("_new"))
    both = before.join(after, F.col("_k1").eqNullSafe(F.col("_k2")) & F.col("_p1").eqNullSafe(F.col("_p2")), "full")
    kind = F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "absent_from_full").when(~F.col("_old.hash").eqNullSafe(F.col("_new.hash")), "update")
    events = both.select(F.coalesce("_k1", "_k2").alias(key), F.coalesce("_p1", "_p2").alias("seq"), kind.alias("change_type"), F.coalesce("_new.status", F.lit("absent_from_full")).alias("status"), *[F.coalesce(F.col(f"_new.{c}"), F.col(f"_old.{c}")).alias(c) for c in carry]).where("change_type is not null")
    events = small_join(events, ends, ["seq"])
    return events.select(key, F.row_number().over(by_key).alias("version"), "valid_from", F.lead("valid_from").over(by_key).alias("valid_to"), "status", "change_type", *carry)
