import pytest
from pyspark.sql import functions as F

from rateloom.functions import numbers, text
from rateloom.functions.similarity import jaro_winkler, jaro_winkler_value
from rateloom.operators import relational as R


@pytest.mark.parametrize("a,b,want", [("MARTHA", "MARHTA", 0.9611111111), ("ABCDEFGH", "ABCXYZQW", 0.5833333333), ("", "A", 0.0), ("", "", 0.0), ("A", "A", 1.0), ("DIXON", "DICKSONX", 0.8133333333), ("AB", "BA", 0.0)])
def test_jaro_winkler(a, b, want):
    assert jaro_winkler_value(a, b) == pytest.approx(want) and jaro_winkler_value(b, a) == pytest.approx(want)


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()["y"]


def test_similarity_of_nulls(spark):
    df = spark.createDataFrame([("A", None), (None, "A"), ("AB", "AB")], "a string, b string")
    assert [r[0] for r in df.select(jaro_winkler(F.col("a"), F.col("b"))).collect()] == [None, None, 1.0]


@pytest.mark.parametrize("raw,want", [("The Elm & Oak, Inc.", "ELM OAK"), ("A.B.C. LLC", "A B C"), ("", ""), (None, None), ("ANDOVER", "ANDOVER")])
def test_norm_name(spark, raw, want):
    assert one(spark, raw, text.norm_name) == want


@pytest.mark.parametrize("street,want", [("251 E. Huron St", "251 HURON 60611"), ("One Elm Way", None), ("12 N", "12  60611"), (None, None), ("", None)])
def test_addr_key(spark, street, want):
    assert one(spark, street, lambda c: text.addr_key(c, F.lit("60611"))) == want


@pytest.mark.parametrize("npi,ok", [("1234567893", True), ("1234567890", False), ("123456789", False), ("123456789x", False), ("1234567893\n", False)])
def test_npi_check_digit(spark, npi, ok):
    assert one(spark, npi, text.npi_luhn_ok) is ok


@pytest.mark.parametrize("raw,want", [(" Both ", ("both", True)), ("", (None, True)), (None, (None, True)), ("x", (None, False))])
def test_enum(spark, raw, want):
    assert tuple(one(spark, raw, lambda c: text.norm_enum(c, ["both"]))) == want


@pytest.mark.parametrize("raw,want", [(" 1.5 ", (1.5, True)), ("1e3", (1000.0, True)), (".5", (0.5, True)), ("5.", (5.0, True)), ("$1", (None, False)), ("1,000", (None, False)), ("nan", (None, False)), ("1_0", (None, False)), ("1d", (None, False)), ("", (None, True)), (None, (None, True)), ("1\n", (1.0, True))])
def test_number(spark, raw, want):
    assert tuple(one(spark, raw, numbers.parse_number)) == want


def test_dates_zip_and_lists(spark):
    assert str(one(spark, "1/5/2026", text.us_date)) == "2026-01-05" and one(spark, "13/45/2026", text.us_date) is None
    assert str(one(spark, "2026-01-05", text.any_date)) == "2026-01-05" and one(spark, "", text.any_date) is None
    assert one(spark, "1 Elm St, Town, ZZ 01234-5678 ", text.zip5_of) == "01234" and one(spark, "no", text.zip5_of) == ""
    assert one(spark, "a | |b", text.split_multi) == ["a", "b"] and one(spark, " A | B ", text.norm_header) == "a|b"


def test_reconcile_is_null_safe(spark, rows):
    a = spark.createDataFrame([(None, 1.0), ("x", None), ("y", 2.0)], "k string, v double")
    b = spark.createDataFrame([(None, 1.0), ("x", 1.0), ("z", 2.0)], "k string, v double")
    assert rows(R.reconcile(a, b, ["k"], ["v"]), "k", "problem") == [("x", "differs"), ("y", "left_only"), ("z", "right_only")]


def test_as_of_edges(spark, rows):
    h = spark.createDataFrame([("a", 1, "2020-01-01", "2020-02-01"), ("a", 2, "2020-02-01", None), ("b", 1, None, "2020-01-01")], "npi string, version int, f string, t string").selectExpr("npi", "version", "cast(f as date) valid_from", "cast(t as date) valid_to")
    f = spark.createDataFrame([(1, "a", "2020-02-01"), (2, "a", "2019-01-01"), (3, "b", "2019-12-31"), (4, "a", None), (5, None, "2020-01-01"), (6, "a", "9000-01-01")], "id int, npi string, d string").selectExpr("id", "npi", "cast(d as date) at")
    assert rows(R.as_of(f, h, "npi", "at", carry=["version"]), "id", "version") == [(1, 2), (2, None), (3, 1), (4, None), (5, None), (6, 2)]
