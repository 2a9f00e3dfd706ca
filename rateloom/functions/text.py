"""Text columns: trimming, enumerations, names and addresses, identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that count as blanks around a value.
BLANKS = " \t\r\n\x0b\x0c ﻿"


def strip(col: Column) -> Column:
    return F.trim(col, F.lit(BLANKS))


def clean(col: Column) -> Column:
    """Trimmed, with blank as null."""
    return F.nullif(strip(col), F.lit(""))


def fold(col: Column) -> Column:
    """Trimmed lower case, with blank as null."""
    return F.lower(clean(col))


def full_match(col: Column, pattern: str) -> Column:
    """Whole-string match; \\z because Java's $ also matches before a last line break."""
    return col.rlike(rf"^(?:{pattern})\z")


def norm_enum(col: Column, allowed: list[str], upper: bool = False) -> Column:
    """struct(value, valid): blank gives (null, true), a value outside the list (null, false)."""
    v = strip(col)
    v = F.upper(v) if upper else F.lower(v)
    blank = col.isNull() | (v == "")
    ok = v.isin(allowed)
    return F.struct(F.when(~blank & ok, v).alias("value"), F.coalesce(blank | ok, F.lit(True)).alias("valid"))


def us_date(col: Column) -> Column:
    """month/day/year, padded or not; null where it is no date."""
    return F.try_to_date(strip(col), "M/d/yyyy")


def any_date(col: Column) -> Column:
    """ISO or month/day/year."""
    v = strip(col)
    return F.coalesce(F.try_to_date(v, "yyyy-MM-dd"), F.try_to_date(v, "M/d/yyyy"))


def norm_header(col: Column) -> Column:
    """Column names without letter case, blanks around '|' or a byte order mark."""
    return F.regexp_replace(F.lower(strip(col)), r"(?<!\s)\s*+\|\s*+", "|")


# Words that a name is compared without.
FILLER_WORDS = ("THE", "OF", "AND", "INC", "LLC")


def norm_name(col: Column) -> Column:
    """Upper case, '&' as AND, other signs as blanks, filler words dropped, blanks collapsed."""
    plain = F.regexp_replace(F.replace(F.upper(col), F.lit("&"), F.lit(" AND ")), "[^A-Z0-9]+", " ")
    return F.array_join(F.filter(F.split(plain, " "), lambda w: ~w.isin("", *FILLER_WORDS)), " ")


def addr_tokens(col: Column) -> Column:
    return F.filter(F.split(F.trim(F.regexp_replace(F.upper(col), "[^A-Z0-9]+", " ")), " "), lambda t: t != "")


def addr_key(street: Column, zip5: Column) -> Column:
    """'<house number> <first token that is no direction> <zip5>'; null unless the first token is all digits."""
    tokens = addr_tokens(street)
    directions = ["N", "S", "E", "W", "NORTH", "SOUTH", "EAST", "WEST"]
    rest = F.filter(F.slice(tokens, F.lit(2), F.greatest(F.size(tokens), F.lit(1))), lambda t: ~t.isin(directions))
    first = F.get(tokens, F.lit(0))
    return F.when(full_match(first, "[0-9]+"), F.concat(first, F.lit(" "), F.coalesce(F.get(rest, F.lit(0)), F.lit("")), F.lit(" "), zip5))


def zip5_of(address: Column) -> Column:
    """The trailing five digits of an address; '' where there are none."""
    return F.regexp_extract(address, r"([0-9]{5})(-[0-9]{4})?\s*$", 1)


def npi_format_ok(col: Column) -> Column:
    return full_match(col, "[0-9]{10}")


def npi_luhn_ok(col: Column) -> Column:
    """Check digit over the prefix 80840 and the ten digits."""
    return npi_format_ok(col) & F.call_function("luhn_check", F.concat(F.lit("80840"), col))


def is_hospital_taxonomy(col: Column) -> Column:
    return F.left(col, F.lit(2)).isin("27", "28")


def split_multi(col: Column) -> Column:
    """A '|' list as an array without blanks."""
    return F.filter(F.transform(F.split(col, r"\|"), lambda t: F.trim(t)), lambda t: t != "")
