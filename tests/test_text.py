import pytest
from pyspark.sql import functions as F

from nearstop.functions import text
from nearstop.operators.rentals import short_zips, with_address


def value(spark, schema, row, expression):
    return spark.createDataFrame([row], schema).select(expression).first()[0]


@pytest.mark.parametrize("plz, district, state, expected", [
    ("44269", "Dortmund", "Nordrhein_Westfalen", "44269"),
    ("2625", "Bautzen_Kreis", "Sachsen", "02625"),
    ("4426", "Dortmund", "Nordrhein_Westfalen", "4426XX"),
    ("2100", "Harburg_Kreis", "Niedersachsen", "2100X"),
    ("1234", "Berlin", "Berlin", "1234"),
    ("8056", "Zwickau", None, "08056"),
    ("7890", None, "Baden_Württemberg", "7890X"),
    ("8527", "Plauen", "Sachsen", "8527X"),
    ("8468", "Vogtlandkreis", "Sachsen", "08468"),
    (None, "Zwickau", "Sachsen", None),
])
def test_repaired_zip(spark, plz, district, state, expected):
    expression = text.repaired_zip(F.col("p"), F.col("d"), F.col("s"))
    assert value(spark, "p string, d string, s string", (plz, district, state), expression) \
        == expected


@pytest.mark.parametrize("cell, expected", [
    ("49,048672", 49.048672), ("49.5", 49.5), ("", None), ("x", None), (None, None),
])
def test_decimal_comma(spark, cell, expected):
    found = value(spark, "c string", (cell,), text.decimal_comma(F.col("c")))
    assert found == (None if expected is None else pytest.approx(expected, abs=1e-5))


@pytest.mark.parametrize("plz, expected", [("4426X", "442"), ("12", "12"), (None, None)])
def test_zip_group(spark, plz, expected):
    assert value(spark, "c string", (plz,), text.zip_group(F.col("c"))) == expected


@pytest.mark.parametrize("cell, expected", [
    ("NA", None), ("N/A", None), ("NULL", None), ("nan", None), ("", None), (None, None),
    ("None", "None"), ("Na", "Na"), ("0", "0"),
])
def test_null_tokens(spark, cell, expected):
    assert value(spark, "c string", (cell,), text.null_token_to_null(F.col("c"))) == expected


ADDRESS = "scoutId int, streetPlain string, houseNumber string, geo_plz string, geo_krs string, " \
          "geo_bln string"


def test_address(spark):
    rows = [
        (1, "Karl_Str", "9-11a", "04229", "Leipzig", "Sachsen"),
        (2, "Burg", None, "04720", "Bautzen_Kreis", "Baden_Württemberg"),
    ]
    first, second = with_address(spark.createDataFrame(rows, ADDRESS)).orderBy("scoutId").collect()
    assert first.address_string == "Karl Str 9 11 , 04229, Leipzig, Sachsen"
    assert second.address_string is None
    assert (second.geo_krs, second.geo_bln) == ("Bautzen", "Baden Württemberg")


@pytest.mark.parametrize("street", [None, "", "NaN", "None", "NULL", "no_information"])
def test_unknown_street_is_dropped(spark, street):
    rows = [(1, street, "1", "04229", "Leipzig", "Sachsen")]
    assert with_address(spark.createDataFrame(rows, ADDRESS)).isEmpty()


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([("NaN", float("nan"), 1), ("a", 2.0, 2)], "t string, d double, n int")
    assert [tuple(r) for r in text.nan_to_null(df).orderBy("n").collect()] \
        == [(None, None, 1), ("a", 2.0, 2)]


def test_blank_becomes_null_where_asked(spark):
    df = spark.createDataFrame([("", "")], "a string, b string")
    assert tuple(text.blanks_to_null(df).first()) == (None, None)
    assert tuple(text.blanks_to_null(df, ["a"]).first()) == (None, "")


def test_short_zips_are_sorted(spark):
    rows = [
        (1, "1234", "b", "x"), (2, "123", "a", "y"), (3, "12345", "a", "a"), (5, "999", "a", "x"),
        (4, "999", "a", "x"),
    ]
    df = spark.createDataFrame(
        rows, "scoutId int, geo_plz string, geo_krs string, geo_bln string"
    )
    assert [r.scoutId for r in short_zips(df).collect()] == [4, 5, 2, 1]
