"""Tables whose files follow the sky.

Rows carry their cell number and are range-sorted by it, so that every file and row
group covers a short run of cells. A search names the runs of cells that its cap touches as
plain comparisons on that column; the smallest and largest cell of a file or row group
tells the scan which of them it need not open.
"""

from __future__ import annotations

from math import asin, cos, degrees, floor, radians, sin

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.geometry import sky_cell
from skyloom.operators.sky import cone_search

CELL = "sky_cell"
CELL_DEG = 1.0
_ZONE = 1_000_000


def cell_number(ra: Column, dec: Column, h: float = CELL_DEG) -> Column:
    """The cell of a position as one number, zone by zone and along RA within a zone."""
    cell = sky_cell(ra, dec, h)
    return cell["zone"].cast("long") * _ZONE + cell["bucket"]


def write_by_cell(df: DataFrame, path: str, files: int | None = None, h: float = CELL_DEG, pos: tuple[str, str] = ("ra", "dec")) -> None:
    """Write ``df`` with its cell number, sorted by it into ``files`` files; a crowded cell spans several.

    Positions without a cell come first.
    """
    celled = df.withColumn(CELL, cell_number(F.col(pos[0]), F.col(pos[1]), h))
    order = [CELL, pos[1], pos[0]]
    dealt = celled.repartitionByRange(files, *order) if files else celled.repartitionByRange(*order)
    dealt.sortWithinPartitions(*order).write.parquet(path)


def _buckets(zone: int, h: float) -> int:
    """``zone_buckets`` of one zone, as a number."""
    low = zone * h - 90.0
    edge = min(max(abs(low), abs(low + h)), 89.9)
    return max(1, floor(cos(radians(edge)) * (360.0 / h)))


def cap_cells(ra: float, dec: float, radius_deg: float, h: float = CELL_DEG) -> list[tuple[int, int]]:
    """Runs of cell numbers (first, last) that a cap touches: one or two per zone."""
    r = radius_deg * (1 + 1e-9) + 1e-9
    top = max(int(180.0 / h + 1e-9) - 1, 0)
    zone = lambda d: max(0, min(top, floor((d + 90.0) / h)))
    polar = abs(dec) + r >= 90.0
    half = 180.0 if polar else degrees(asin(min(1.0, sin(radians(r)) / cos(radians(dec))))) + 1e-9
    runs = []
    for z in range(zone(dec - r), zone(dec + r) + 1):
        n = _buckets(z, h)
        # a bucket more on each side, so that rounding never loses a cell
        first, last = floor((ra - half) * n / 360.0 - 1e-6), floor((ra + half) * n / 360.0 + 1e-6)
        if last - first + 1 >= n:
            runs.append((z * _ZONE, z * _ZONE + n - 1))
            continue
        first, last = first % n, last % n
        runs += [(z * _ZONE + first, z * _ZONE + last)] if first <= last else [(z * _ZONE, z * _ZONE + last), (z * _ZONE + first, z * _ZONE + n - 1)]
    return runs


def in_runs(runs: list[tuple[int, int]]) -> Column:
    """Plain comparisons on the cell number, which reach the scan."""
    out = F.lit(False)
    for first, last in sorted(runs):
        out = out | F.col(CELL).between(first, last)
    return out


def cone_search_by_cell(table: DataFrame, ra: float, dec: float, radius_deg: float, h: float = CELL_DEG, pos: tuple[str, str] = ("ra", "dec")) -> DataFrame:
    """C2 on a table of ``write_by_cell``: files and row groups of other cells are not read."""
    return cone_search(table.filter(in_runs(cap_cells(ra, dec, radius_deg, h))), ra, dec, radius_deg, pos).drop(CELL)

