"""Comparison of a Spark result with the DuckDB answer on the same tables."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

FOLDER = Path("/root/testdata")


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda n: columns[n])

    def plain(value):
        return "NaN" if isinstance(value, float) and math.isnan(value) else value

    return Counter(tuple(plain(row[n]) for n in order) for row in rows)


def duck_rows(sql: str, sf: str) -> tuple[list[str], Counter]:
    with duckdb.connect() as connection:
        for path in (FOLDER / sf).glob("*.parquet"):
            connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
        result = connection.execute(sql)
        columns = [column[0] for column in result.description]
        return sorted(columns), _rows(columns, result.fetchall())


def spark_rows(df) -> tuple[list[str], Counter]:
    return sorted(df.columns), _rows(df.columns, df.collect())
