"""Every registered query against DuckDB on the same tables."""

import pytest

import __spark_entry__ as driver
from checks.oracle import ORACLE
from checks.queries import QUERIES
from tests.compare import FOLDER, duck_rows, spark_rows

SF = "sf0.01"



@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_duckdb(spark, name):
    found = spark_rows(QUERIES[name](spark, str(FOLDER / SF)))
    assert found == duck_rows(ORACLE[name], SF)


def test_row_ids_are_unique(spark):
    found = QUERIES["surrogate_id"](spark, str(FOLDER / SF)).collect()
    assert [tuple(r) for r in found] == [(1500, 1500)]


def test_every_oracle_has_a_query():
    assert set(ORACLE) == set(QUERIES)


def test_entry(spark):
    assert driver.entry(spark).columns == ["scoutId", "rank", "DHID", "Parent", "Name"]


def test_every_offer_with_stations_has_a_marker(spark):
    rows = QUERIES["map_all_features"](spark, str(FOLDER / SF)).select("scoutId", "role").collect()
    marked = [r.scoutId for r in rows if r.role == "rental"]
    assert len(marked) == len(set(marked))
    assert set(marked) == {r.scoutId for r in rows if r.role == "station"}
