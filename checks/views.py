"""Input tables for the checks, derived from the test tables by expressions.

Each expression reads the same in Spark and DuckDB. Customers act as rental offers, parts as
stations (every fourth is a parent) and nations as municipalities and zip code centres.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nearstop.schemas import RENTAL_DROPPED, schema
from nearstop.sources.tables import spread


def text(number: str) -> str:
    return f"CAST({number} AS VARCHAR(12))"


ZIP_OF_NATION = f"lpad({text('1000 + n_nationkey * 3900')}, 5, '0')"

MAPPING = {
    "MunicipalityCode": f"lpad({text('1001000 + n_nationkey * 1001')}, 8, '0')",
    "Name": "n_name",
    "PLZ": f"CASE WHEN n_nationkey % 5 = 4 THEN NULL ELSE {ZIP_OF_NATION} END",
}

CENTRE = {
    "PLZ": ZIP_OF_NATION,
    "lat": "CAST(47000 + (n_nationkey * 1777) % 8000 AS DOUBLE) / 1000",
    "lng": "CAST(6000 + (n_nationkey * 2311) % 9000 AS DOUBLE) / 1000",
}


def _comma_degrees(whole: str, factor: int) -> str:
    fraction = f"lpad({text(f'(p_partkey * {factor}) % 1000000')}, 6, '0')"
    return f"CASE WHEN p_partkey % 97 = 0 THEN '' ELSE concat({text(whole)}, ',', {fraction}) END"


_PARENT_CODE = f"lpad({text('1001000 + CAST((p_partkey % 108) / 4 AS BIGINT) * 1001')}, 8, '0')"

STATION = {
    "SeqNo": "p_partkey",
    "Type": "CASE WHEN p_partkey % 4 = 0 THEN 'S' ELSE 'Q' END",
    "DHID": f"concat('de:', {text('p_partkey')})",
    "Parent": f"concat('de:', {text('p_partkey - p_partkey % 4')})",
    "Name": "p_name",
    "Latitude": _comma_degrees("47 + p_partkey % 8", 6151),
    "Longitude": _comma_degrees("6 + p_partkey % 9", 3571),
    "MunicipalityCode": f"CASE WHEN p_partkey % 4 = 0 THEN {_PARENT_CODE} ELSE '00000000' END",
    "Municipality": "CASE WHEN p_partkey % 4 = 0 THEN p_brand ELSE NULL END",
}

def _crowded(number: str, shift: int) -> dict[str, str]:
    """Places half of which lie within some 100 metres, in four groups of which one has a half."""
    return {
        "lat": f"CASE WHEN {number} % 2 = 0 THEN CAST(5100000 + ({number} * 7919) % 1000 AS DOUBLE) "
               f"/ 100000 ELSE CAST(47000 + ({number} * 7919 + {shift}) % 8000 AS DOUBLE) / 1000 END",
        "lng": f"CASE WHEN {number} % 2 = 0 THEN CAST(900000 + ({number} * 104729) % 1000 AS DOUBLE) "
               f"/ 100000 ELSE CAST(6000 + ({number} * 104729) % 9000 AS DOUBLE) / 1000 END",
        "zip_group": f"CASE WHEN {number} % 6 < 3 THEN '010' ELSE {text(f'100 + {number} % 3')} END",
    }


# Orders act as stations and zip code centres of dense groups, customers as offers among them.
DENSE_RENTAL = {"scoutId": "c_custkey", **_crowded("c_custkey", 3)}
_DENSE = _crowded("o_orderkey", 0)
DENSE_STATION = {
    "DHID": f"concat('de:', {text('o_orderkey')})",
    "Parent": f"concat('de:', {text('o_orderkey - o_orderkey % 4')})",
    "Name": "o_orderpriority",
    "Latitude": _DENSE["lat"],
    "Longitude": _DENSE["lng"],
    "ZIP_Group_Station": _DENSE["zip_group"],
}
DENSE_CENTRE = {
    "PLZ": f"lpad({text('o_orderkey')}, 10, '0')", "lat": _DENSE["lat"], "lng": _DENSE["lng"],
}

# The columns of the station file that no step uses.
STATION_FILE = STATION | {
    "DistrictCode": "CAST(NULL AS VARCHAR(12))",
    "District": "''",
    "Condition": "'Served'",
    "State": "'InOrder'",
    "Description": "concat(p_type, '; \"', p_name, '\"')",
    "Authority": "p_brand",
    "DelfiName": "'-'",
    "TariffDHID": "CAST(NULL AS VARCHAR(12))",
    "TariffName": "p_type",
}

_ZIP = text("1000 + c_nationkey * 3900 + c_custkey % 10")

RENTAL = {
    "scoutId": "c_custkey",
    "geo_plz": f"CASE WHEN c_custkey % 7 = 0 THEN substr({_ZIP}, 1, 4) ELSE {_ZIP} END",
    "geo_krs": (
        "CASE c_nationkey WHEN 0 THEN 'Bautzen_Kreis' WHEN 1 THEN 'Vogtlandkreis' "
        "WHEN 2 THEN 'Zwickau' WHEN 3 THEN 'Dortmund' WHEN 4 THEN 'Plauen' "
        f"ELSE concat('Ort_', {text('c_nationkey')}, '_Kreis') END"
    ),
    "geo_bln": (
        "CASE WHEN c_nationkey IN (3, 5, 6) THEN 'Nordrhein_Westfalen' "
        "WHEN c_nationkey IN (7, 8) THEN 'Niedersachsen' "
        "WHEN c_nationkey IN (9, 10) THEN 'Baden_Württemberg' ELSE 'Sachsen' END"
    ),
    "streetPlain": (
        "CASE c_custkey % 11 WHEN 0 THEN 'no_information' WHEN 1 THEN '' WHEN 2 THEN NULL "
        f"WHEN 3 THEN 'NaN' ELSE concat(c_mktsegment, '_Str_', {text('c_custkey % 50')}) END"
    ),
    "houseNumber": (
        "CASE c_custkey % 5 WHEN 0 THEN NULL "
        f"WHEN 1 THEN concat({text('c_custkey % 90')}, '-', {text('c_custkey % 90 + 2')}) "
        f"WHEN 2 THEN concat({text('c_custkey % 90')}, 'a') ELSE {text('c_custkey % 90')} END"
    ),
    "lat": "CAST(47000 + (c_custkey * 7919) % 8000 AS DOUBLE) / 1000",
    "lng": "CAST(6000 + (c_custkey * 104729) % 9000 AS DOUBLE) / 1000",
}

# An address as somebody writes it: a letter left out, one too many, two changed places, four wrong.
SLIPPED_ADDRESS = (
    "CASE scoutId % 5 WHEN 0 THEN concat(substr(address_string, 1, 3), substr(address_string, 5)) "
    "WHEN 1 THEN concat(substr(address_string, 1, 6), 'x', substr(address_string, 7)) "
    "WHEN 2 THEN replace(address_string, ' Str ', ' Srt ') "
    "WHEN 3 THEN concat('yyyy', substr(address_string, 5)) ELSE address_string END"
)

# Offers with a balance act as the places an address register knows.
KNOWN_PLACE = "c_acctbal >= 0"


def _rental_file() -> dict[str, str]:
    """All columns of the rental file as cell texts, with null tokens and line breaks."""
    cells = {}
    for n, field in enumerate(schema("RENTAL").fields):
        value = {
            "string": f"concat('{field.name} ', {text(f'(c_custkey + {n}) % 20')})",
            "int": text(f"(c_custkey * {n + 1}) % 1000"),
            "double": f"concat({text(f'(c_custkey * {n + 1}) % 1000')}, '.25')",
            "boolean": f"CASE WHEN (c_custkey + {n}) % 3 = 0 THEN 'TRUE' ELSE 'FALSE' END",
        }[field.dataType.simpleString()]
        cells[field.name] = (
            f"CASE (c_custkey + {n}) % 7 WHEN 0 THEN 'NA' WHEN 1 THEN '' ELSE {value} END"
        )
    cells["scoutId"] = text("c_custkey")
    cells |= {name: RENTAL[name] for name in RENTAL if name in cells and name != "scoutId"}
    for name in RENTAL_DROPPED:
        cells[name] = f"concat('{name}: \"', c_name, '\",', chr(10), c_mktsegment)"
    return cells


RENTAL_FILE = _rental_file()


def select_list(columns: dict[str, str]) -> list[str]:
    return [f"{expression} AS {name}" for name, expression in columns.items()]


def _view(
    spark: SparkSession, sf_dir: str, table: str, columns: dict[str, str], heavy: bool = False
) -> DataFrame:
    """A view as a table; ``heavy`` spreads it over all cores for work that pays for it."""
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return (spread(rows) if heavy else rows).selectExpr(*select_list(columns))


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "nation", MAPPING)


def centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "nation", CENTRE)


def stations(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    return _view(spark, sf_dir, "part", STATION, heavy)


def station_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "part", STATION_FILE)


def rentals(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    return _view(spark, sf_dir, "customer", RENTAL, heavy)


def dense_rentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "customer", DENSE_RENTAL, heavy=True)


def dense_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "orders", DENSE_STATION, heavy=True)


def dense_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "orders", DENSE_CENTRE, heavy=True)


def known_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").where(KNOWN_PLACE)
    return customers.selectExpr(*select_list(RENTAL))


def rental_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "customer", RENTAL_FILE)
