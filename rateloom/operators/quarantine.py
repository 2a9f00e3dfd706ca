"""Problem 1: rows that fail to parse.

Delimited records are read permissively under an explicit schema: every record becomes a typed row,
cells that do not fit become null and the raw text is retained in `_corrupt_record`. The corrupt rows
are then reclassified by quoting, cell count and cast checks. Each file has its own header, which is
why the reader is composed of column expressions instead of one CSV scan with one schema; no record
leaves the JVM.

Defined results: a null or empty record, or one of blank cells only, is no case. A file without a
header record has no columns, so its other records are set aside as `column_count`. Rows without a
record number are no data records. Repeated records count once. Columns of the input beyond the
named ones are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import norm_header, strip
from ..plans.skew import salted_join

#: Stands for a separating comma while quoted commas are told apart, and the sign by which a text is told that has it.
_SEP, _ESC = "\ufdd0", "\ufdd1"
#: Possessive, so that a long cell of digits is read once.
NUMBER = r"^[+-]?(?:[0-9]++(?:\.[0-9]*+)?|\.[0-9]++)(?:[eE][+-]?[0-9]++)?\z"


@dataclass(frozen=True)
class Rule:
    """One column of the explicit schema. kind: text, number, count, or enum with its allowed values."""

    name: str
    kind: str = "text"
    allowed: tuple[str, ...] = ()


# Columns of the tall price-file template and what they may hold.
TALL_SCHEMA = (
    Rule("description"),
    Rule("setting", "enum", ("inpatient", "outpatient", "both")),
    Rule("modifiers"),
    Rule("drug_unit_of_measurement", "number"),
    Rule("drug_type_of_measurement"),
    Rule("billing_class", "enum", ("facility", "professional", "both")),
    Rule("standard_charge|gross", "number"),
    Rule("standard_charge|discounted_cash", "number"),
    Rule("payer_name"),
    Rule("plan_name"),
    Rule("standard_charge|negotiated_dollar", "number"),
    Rule("standard_charge|negotiated_percentage", "number"),
    Rule("standard_charge|negotiated_algorithm"),
    Rule("median_amount", "number"),
    Rule("10th_percentile", "number"),
    Rule("90th_percentile", "number"),
    Rule("count", "count"),
    Rule("standard_charge|methodology", "enum", ("case rate", "fee schedule", "percent of total billed charges", "per diem", "other")),
    Rule("standard_charge|min", "number"),
    Rule("standard_charge|max", "number"),
    Rule("additional_generic_notes"),
)


def quote_pieces(raw: Column) -> Column:
    """The record cut at its quote signs: even pieces lie outside quotes, odd ones inside."""
    return F.split(raw, '"', -1)


def well_quoted(pieces: Column) -> Column:
    """Whether each cell is free of quote signs or wholly enclosed in them with inner ones doubled.

    An outer piece between two quote signs must be empty (a doubled sign) or begin and end with a
    comma; the first must end with one, the last begin with one. Linear, without regex backtracking.
    """
    def bad(x: Column, i: Column) -> Column:
        return (i % 2 == 1) & (x != "") & ~(x.startswith(",") & x.endswith(","))

    n = F.size(pieces)
    # the lambda sees nothing but its element: an array named in it would be made anew for each one
    inner = F.transform(F.slice(pieces, F.lit(2), F.greatest(n - 2, F.lit(0))), bad)
    first, last = F.get(pieces, F.lit(0)), F.element_at(pieces, -1)
    edges = ((first == "") | first.endswith(",")) & ((last == "") | last.startswith(","))
    return (n == 1) | ((n % 2 == 1) & edges & ~F.exists(inner, lambda b: b))


def cells_of(pieces: Column) -> Column:
    """The unquoted cells of a well-quoted record, whatever signs they hold."""
    swap = lambda x, *pairs: F.replace(swap(x, *pairs[:-1]), *map(F.lit, pairs[-1])) if pairs else x

    def cut(parts: Column) -> Column:
        marked = F.array_join(F.transform(parts, lambda x, i: F.when(i % 2 == 0, F.replace(x, F.lit(","), F.lit(_SEP))).otherwise(x)), '"')
        return F.transform(F.split(marked, _SEP, -1), lambda c: F.when(c.startswith('"'), F.replace(F.substr(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c))

    text = F.array_join(pieces, "")
    apart = F.transform(pieces, lambda x: swap(x, (_ESC, _ESC + "1"), (_SEP, _ESC + "0")))
    back = F.transform(cut(apart), lambda c: swap(c, (_ESC + "0", _SEP), (_ESC + "1", _ESC)))
    return F.when(text.contains(_SEP) | text.contains(_ESC), back).otherwise(cut(pieces))


def castable(value: Column, kind: Column, schema: tuple[Rule, ...]) -> Column:
    """Whether a cell fits its column. kind: a rule's index in the schema as text, or null for free text."""
    v = F.lower(strip(value))
    from_eleven = v.rlike(r"^0*+(?:1[1-9]|[2-9][0-9]|[1-9][0-9]{2,})\z")
    ok = F.when(kind == "number", v.rlike(NUMBER)).when(kind == "count", v.isin("0", "1 through 10") | from_eleven)
    for r in schema:
        if r.kind == "enum":
            ok = ok.when(kind == r.name, v.isin(*r.allowed))
    return value.isNull() | (v == "") | F.coalesce(ok, F.lit(True))


def _kind(name: Column, schema: tuple[Rule, ...]) -> Column:
    out = F.lit(None).cast("string")
    for r in schema:
        if r.kind != "text":
            out = F.when(name == r.name, F.lit(r.name if r.kind == "enum" else r.kind)).otherwise(out)
    return out


def headers(records: DataFrame, header_no: int = 3, schema: tuple[Rule, ...] = TALL_SCHEMA, file: str = "source_sha256") -> DataFrame:
    """Per file the normalised column names and the kind of each position."""
    head = records.where(F.col("record_no") == header_no).groupBy(file).agg(F.min("raw_record").alias("_h"))
    named = head.select(file, F.transform(cells_of(quote_pieces(F.col("_h"))), norm_header).alias("_names"))
    return named.select(file, "_names", F.transform("_names", lambda n: _kind(n, schema)).alias("_kinds"))


def read_permissive(records: DataFrame, header_no: int = 3, schema: tuple[Rule, ...] = TALL_SCHEMA, file: str = "source_sha256", carry: tuple[str, ...] = ("hospital_id",)) -> DataFrame:
    """All data records as typed rows; the raw text of those that do not fit is in `_corrupt_record`.

    Also keeps `_quoted`, `_counted` and `_cast`, the outcome of the three checks, for reclassify().
    The record table may be skewed by file: hot files are salted before their header is joined on.
    """
    data = records.where(F.col("record_no") > header_no).select(file, "record_no", *carry, "raw_record")
    data = salted_join(data, headers(records, header_no, schema, file), [file], F.col("record_no"), "left")
    data = data.withColumn("_pieces", quote_pieces(F.coalesce("raw_record", F.lit(""))))
    data = data.withColumn("_quoted", well_quoted(F.col("_pieces"))).withColumn("_cells", F.when(F.col("_quoted"), cells_of(F.col("_pieces"))))
    data = data.where(~F.col("_quoted") | F.exists("_cells", lambda c: strip(c) != ""))
    data = data.withColumn("_counted", F.col("_names").isNotNull() & (F.size("_cells") == F.size("_names")))
    pairs = F.arrays_zip(F.col("_cells").alias("c"), F.col("_kinds").alias("k"))
    data = data.withColumn("_cast", F.when(F.col("_quoted") & F.col("_counted"), ~F.exists(pairs, lambda z: z["k"].isNotNull() & ~castable(z["c"], z["k"], schema))))
    fits = F.coalesce(F.col("_quoted") & F.col("_counted") & F.col("_cast"), F.lit(False))
    typed = []
    for r in schema:
        cell = F.nullif(strip(F.get("_cells", F.array_position("_names", r.name).cast("int") - 1)), F.lit(""))
        cell = F.when(F.col("_quoted") & F.col("_counted"), cell)
        name = r.name.replace("|", "_")
        if r.kind == "number":
            cell = F.when(cell.rlike(NUMBER), cell).try_cast("double")
        elif r.kind == "enum":
            cell = F.when(F.lower(cell).isin(*r.allowed), F.lower(cell))
        typed.append(cell.alias(name))
    return data.select(file, "record_no", *carry, *typed, F.when(~fits, F.coalesce("raw_record", F.lit(""))).alias("_corrupt_record"), "_quoted", "_counted", "_cast")


def reclassify(rows: DataFrame, file: str = "source_sha256") -> DataFrame:
    """Each corrupt record once with the first reason that applies."""
    reason = F.when(~F.col("_quoted"), "broken_quoting").when(~F.col("_counted"), "column_count").otherwise("invalid_value")
    bad = rows.where(F.col("_corrupt_record").isNotNull()).withColumn("reason", reason)
    return bad.groupBy(file, "record_no").agg(F.min_by("reason", F.when(F.col("reason") == "broken_quoting", 0).when(F.col("reason") == "column_count", 1).otherwise(2)).alias("reason"), F.min("_corrupt_record").alias("raw_record"))


def valid_rows(rows: DataFrame, file: str = "source_sha256") -> DataFrame:
    """The rows that load, each record once."""
    return rows.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record", "_quoted", "_counted", "_cast").dropDuplicates([file, "record_no"])
