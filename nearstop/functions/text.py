"""Column expressions that repair zip codes, addresses and numbers."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Districts whose short zip codes lost a leading zero, and states and districts
# whose short zip codes lost their last digit.
LEADING_ZERO_DISTRICTS = ["Bautzen_Kreis", "Vogtlandkreis", "Zwickau"]
PADDED_STATES = ["Niedersachsen", "Nordrhein_Westfalen", "Baden_Württemberg"]
PADDED_DISTRICTS = ["Plauen", "Dortmund"]

# Cell texts that stand for a missing value.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
]

# Texts that mark a street as unknown.
UNKNOWN_STREET_MARKS = ["None", "NULL", "no_information"]

FULL_ZIP = "^[0-9]{5}"


def _hits(column: Column, words: list[str]) -> list[Column]:
    return [F.when(column.contains(word), 1).otherwise(0) for word in words]


def is_short_zip(plz: Column) -> Column:
    """True where the zip code does not start with five digits; null stays null."""
    return ~plz.rlike(FULL_ZIP)


def repaired_zip(plz: Column, district: Column, state: Column) -> Column:
    """Add the digits a short zip code lost; an unknown last digit becomes ``X``."""
    zeros = reduce(add, _hits(district, LEADING_ZERO_DISTRICTS))
    pads = reduce(add, _hits(state, PADDED_STATES) + _hits(district, PADDED_DISTRICTS))
    padded = F.concat(F.repeat(F.lit("0"), zeros), plz, F.repeat(F.lit("X"), pads))
    return F.when(is_short_zip(plz), padded).otherwise(plz)


def zip_group(plz: Column) -> Column:
    """The first three characters of a zip code."""
    return F.substring(plz, 1, 3)


def null_token_to_null(column: Column) -> Column:
    """Null where the text is one of ``NULL_TOKENS``."""
    return F.when(~column.isin(NULL_TOKENS), column)


def blank_to_null(column: Column) -> Column:
    return F.nullif(column, F.lit(""))


def is_nan_text(text: Column) -> Column:
    """True for a text that reads as NaN; a failing cast would cost far more per row."""
    return F.lower(F.trim(text)) == "nan"


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN, as a number or as text, into null in every column that can hold it."""
    changed = {}
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            changed[field.name] = F.when(~is_nan_text(column), column)
        elif isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            changed[field.name] = F.when(~F.isnan(column), column)
    return df.withColumns(changed)


def blanks_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Turn empty text into null in the given text columns, by default in all of them."""
    return df.replace("", None, columns)


def decimal_comma(column: Column) -> Column:
    """A number written with a decimal comma; null where it does not read as one."""
    return F.replace(blank_to_null(column), F.lit(","), F.lit(".")).try_cast("float")


def is_known_street(street: Column) -> Column:
    known = street.isNotNull() & (street != "") & ~is_nan_text(street)
    return reduce(lambda seen, mark: seen & ~street.contains(mark), UNKNOWN_STREET_MARKS, known)


def clean_street(street: Column) -> Column:
    return F.translate(street, "_", " ")


def clean_house_number(number: Column) -> Column:
    return F.regexp_replace(number, "[^0-9]", " ")


def clean_district(district: Column) -> Column:
    return F.translate(F.replace(district, F.lit("_Kreis"), F.lit("")), "_", " ")


def clean_state(state: Column) -> Column:
    return F.translate(state, "_", " ")


def address(street: Column, number: Column, plz: Column, district: Column, state: Column) -> Column:
    """``street number, zip, district, state``; null if any part is."""
    comma = F.lit(", ")
    return F.concat(street, F.lit(" "), number, comma, plz, comma, district, comma, state)


def address_zip_group(text: Column) -> Column:
    """The zip group of an address as ``address`` writes it; null if it has too few parts."""
    return zip_group(F.try_element_at(F.split(text, ", "), F.lit(-3)))
