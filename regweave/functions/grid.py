"""Locator grid squares from coordinates, and the cell arithmetic behind them.

A 4-character cell is 2 degrees of longitude by 1 degree of latitude on a lattice
with its origin at (-180, -90): 180 columns by 180 rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_FIELD = "ABCDEFGHIJKLMNOPQR"
_SUB = "abcdefghijklmnopqrstuvwx"
CELL_LON = 2.0
CELL_LAT = 1.0
# A lattice has 180 x 180 cells, so any table keyed by cell has a proven bound.
MAX_CELLS = 180 * 180


def _shift(lat: Column, lon: Column) -> tuple[Column, Column]:
    east = F.least(F.greatest(lon + 180.0, F.lit(0.0)), F.lit(359.999999))
    north = F.least(F.greatest(lat + 90.0, F.lit(0.0)), F.lit(179.999999))
    return east, north


def _letter(alphabet: str, index: Column) -> Column:
    return F.substring(F.lit(alphabet), index.cast("int") + 1, F.lit(1))


def grid4(lat: Column, lon: Column) -> Column:
    """4-character locator; null when a coordinate is null."""
    east, north = _shift(lat, lon)
    return F.when(
        lat.isNotNull() & lon.isNotNull(),
        F.concat(
            _letter(_FIELD, F.floor(east / 20)),
            _letter(_FIELD, F.floor(north / 10)),
            F.floor((east % 20) / 2).cast("int").cast("string"),
            F.floor(north % 10).cast("int").cast("string"),
        ),
    )


def grid6(lat: Column, lon: Column) -> Column:
    """6-character locator for public landmarks."""
    east, north = _shift(lat, lon)
    return F.concat(
        grid4(lat, lon),
        _letter(_SUB, F.floor((east % 2) / 2 * 24)),
        _letter(_SUB, F.floor((north % 1) * 24)),
    )


def cell_label(column: Column, row: Column) -> Column:
    """Locator of a cell given by lattice column and row (0..179)."""
    return grid4(row + F.lit(-89.5), column * CELL_LON + F.lit(-179.0))
