"""Schemas and column lists of the input files and stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    BooleanType, DoubleType, IntegerType, StringType, StructField, StructType,
)


class SchemaMismatch(ValueError):
    """The columns of a table are not the ones its schema names."""


# Column names and types of the input files, in file order.
RENTAL = """
    regio1 string, serviceCharge double, heatingType string, telekomTvOffer string,
    telekomHybridUploadSpeed string, newlyConst boolean, balcony boolean, picturecount int,
    pricetrend double, telekomUploadSpeed string, totalRent double, yearConstructed double,
    scoutId int, noParkSpaces string, firingTypes string, hasKitchen boolean, geo_bln string,
    cellar boolean, yearConstructedRange double, baseRent double, houseNumber string,
    livingSpace string, geo_krs string, condition string, interiorQual string,
    petsAllowed string, street string, streetPlain string, lift boolean, baseRentRange int,
    typeOfFlat string, geo_plz string, noRooms string, thermalChar string, floor string,
    numberOfFloors double, noRoomsRange int, garden boolean, livingSpaceRange int,
    regio2 string, regio3 string, heatingCosts double, energyEfficiencyClass string,
    lastRefurbish double, electricityBasePrice double, electricityKwhPrice double, date string
"""
STATION = """
    SeqNo int, Type string, DHID string, Parent string, Name string, Latitude string,
    Longitude string, MunicipalityCode string, Municipality string, DistrictCode string,
    District string, Condition string, State string, Description string, Authority string,
    DelfiName string, TariffDHID string, TariffName string
"""
MAPPING_MUNICIPAL_ZIP = "MunicipalityCode string, Name string, PLZ string"
MAPPING_ZIP_COOR = "PLZ string, lat double, lng double"

# Free-text columns of the rental file that are read past.
RENTAL_DROPPED = ["description", "facilities"]

# Columns of the stored tables.
RENTAL_LOCATION = [
    "scoutId", "date", "regio1", "regio2", "regio3", "geo_bln", "geo_krs", "geo_plz",
    "street", "streetPlain", "houseNumber",
]
RENTAL_PRICE_AND_COST = [
    "scoutId", "date", "serviceCharge", "newlyConst", "pricetrend", "totalRent", "baseRent",
    "baseRentRange", "heatingCosts", "electricityBasePrice", "electricityKwhPrice",
]
RENTAL_FEATURE = [
    "scoutId", "date", "heatingType", "telekomTvOffer", "telekomHybridUploadSpeed",
    "telekomUploadSpeed", "balcony", "yearConstructed", "yearConstructedRange", "noParkSpaces",
    "firingTypes", "hasKitchen", "cellar", "livingSpace", "condition", "interiorQual",
    "petsAllowed", "lift", "typeOfFlat", "noRooms", "thermalChar", "floor", "numberOfFloors",
    "noRoomsRange", "garden", "livingSpaceRange", "energyEfficiencyClass", "lastRefurbish",
]
STATIONS = [
    "SeqNo", "Type", "DHID", "Parent", "Name", "Latitude", "Longitude", "MunicipalityCode",
    "Municipality",
]

_BY_NAME = {
    "RENTAL": RENTAL,
    "STATION": STATION,
    "MAPPING_MUNICIPAL_ZIP": MAPPING_MUNICIPAL_ZIP,
    "MAPPING_ZIP_COOR": MAPPING_ZIP_COOR,
}
_TYPES = {
    "string": StringType(), "int": IntegerType(), "double": DoubleType(), "boolean": BooleanType(),
}


def schema(name: str) -> StructType:
    """The schema called ``name``, in any letter case; needs no session."""
    if name.upper() not in _BY_NAME:
        raise ValueError(f"no schema is called {name!r}; known: {sorted(_BY_NAME)}")
    columns = (column.split() for column in _BY_NAME[name.upper()].split(","))
    return StructType([StructField(column, _TYPES[kind]) for column, kind in columns])


def require_columns(df: DataFrame, columns: list[str]) -> None:
    """Raise unless every one of ``columns`` is in ``df``."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise SchemaMismatch(f"missing columns: {missing}")


def require_same_columns(df: DataFrame, expected: StructType) -> None:
    """Raise unless ``df`` has exactly the columns of ``expected``, in any order."""
    differing = sorted(set(df.columns) ^ set(expected.names))
    if differing:
        raise SchemaMismatch(f"columns in only one of table and schema: {differing}")
