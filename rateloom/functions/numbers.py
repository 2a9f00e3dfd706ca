"""Numbers as they are written: bare decimals only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import full_match, strip

DECIMAL = r"[+-]?(?:[0-9]++(?:\.[0-9]*+)?|\.[0-9]++)(?:[eE][+-]?[0-9]++)?"


def parse_number(col: Column) -> Column:
    """struct(value, ok): blank is null and ok; currency and thousands signs, nan, inf and '_' are not ok."""
    v = strip(col)
    blank = col.isNull() | (v == "")
    good = full_match(v, DECIMAL)
    return F.struct(F.when(~blank & good, v).try_cast("double").alias("value"), F.coalesce(blank | good, F.lit(True)).alias("ok"))


def variant_number(v: Column) -> Column:
    """struct(value, ok, as_text) of a variant: a boolean is no number, a numeric text is one and marked."""
    kind = F.schema_of_variant(v)
    absent = v.isNull() | (kind == "VOID")
    text = F.try_variant_get(v, "$", "string")
    is_text = kind == "STRING"
    parsed = parse_number(F.when(is_text, text))
    number = F.when(is_text, parsed["value"]).when(kind.isin("BOOLEAN") | kind.startswith("ARRAY") | kind.startswith("OBJECT"), None).otherwise(F.try_variant_get(v, "$", "double"))
    value = F.when(~absent, number)
    return F.struct(value.alias("value"), (absent | value.isNotNull()).alias("ok"), F.coalesce(is_text & value.isNotNull(), F.lit(False)).alias("as_text"))


def variant_text(v: Column) -> Column:
    """The trimmed text of a variant's value, blank and JSON null as null; numbers and booleans as written in JSON."""
    return F.nullif(strip(F.try_variant_get(v, "$", "string")), F.lit(""))
