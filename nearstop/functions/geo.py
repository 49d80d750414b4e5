"""Column expressions on points and boxes in degrees.

Distances stay squared: the order is the same and the values compare exactly. A box holds the
smallest and largest latitude and longitude of its points, so ``gap2`` is never above and
``span2`` never below the distance of any two points, also after rounding.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_located(lat: Column, lng: Column) -> Column:
    """True where both coordinates are finite numbers; never true for null or NaN."""
    return (F.abs(lat) < float("inf")) & (F.abs(lng) < float("inf"))


def distance2(lat_a: Column, lng_a: Column, lat_b: Column, lng_b: Column) -> Column:
    dlat, dlng = lat_a - lat_b, lng_a - lng_b
    return dlat * dlat + dlng * dlng


SIDES = ["_south", "_north", "_west", "_east"]


def box(lat: str, lng: str) -> list[Column]:
    """Aggregates that give the box around a group of points."""
    return [
        F.min(lat).alias("_south"), F.max(lat).alias("_north"),
        F.min(lng).alias("_west"), F.max(lng).alias("_east"),
    ]


def gap2(a, b) -> Column:
    """Squared smallest distance between two boxes, given as structs or frames of columns."""
    zero = F.lit(0.0)
    dlat = F.greatest(zero, b["_south"] - a["_north"], a["_south"] - b["_north"])
    dlng = F.greatest(zero, b["_west"] - a["_east"], a["_west"] - b["_east"])
    return dlat * dlat + dlng * dlng


def span2(a, b) -> Column:
    """Squared largest distance between two boxes."""
    dlat = F.greatest(a["_north"] - b["_south"], b["_north"] - a["_south"])
    dlng = F.greatest(a["_east"] - b["_west"], b["_east"] - a["_west"])
    return dlat * dlat + dlng * dlng


# Each level splits a cell four by four. Level 0 is one cell of 1,024 degrees, wide enough for any
# valid coordinate; cells only group points, so one outside merely lands in a border cell.
CELL_BITS = 40
SPLIT_BITS = 2
MAX_LEVEL = CELL_BITS // SPLIT_BITS


def grid(degrees: Column) -> Column:
    """Position of a coordinate on the finest grid."""
    inside = F.least(F.greatest(degrees, F.lit(-512.0)), F.lit(512.0))
    return F.floor((inside + 512) * 2 ** (CELL_BITS - 10)).cast("long")


def cell(position: str, level: int | str) -> Column:
    """Cell number at ``level``, which may be a column name."""
    return F.expr(f"shiftright({position}, cast({CELL_BITS} - {SPLIT_BITS} * {level} as int))")


def cell_width(level: int) -> int:
    """Positions on the finest grid that a cell at ``level`` spans along one axis."""
    return 1 << (CELL_BITS - SPLIT_BITS * level)


def parent_cell(name: str) -> Column:
    return F.shiftright(F.col(name), SPLIT_BITS)
