"""Sky and pixel geometry as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sky_distance(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Great-circle separation in degrees (haversine)."""
    sd = F.sin(F.radians(dec2 - dec1) / 2)
    sr = F.sin(F.radians(ra2 - ra1) / 2)
    h = sd * sd + F.cos(F.radians(dec1)) * F.cos(F.radians(dec2)) * sr * sr
    return F.degrees(F.asin(F.sqrt(F.least(F.lit(1.0), h))) * 2)


def unit_vector(ra: Column, dec: Column) -> tuple[Column, Column, Column]:
    r, d = F.radians(ra), F.radians(dec)
    return F.cos(d) * F.cos(r), F.cos(d) * F.sin(r), F.sin(d)


def zone_of(dec: Column, h: float) -> Column:
    """Declination zone of height ``h`` degrees; the pole falls in the last one."""
    top = max(int(180.0 / h + 1e-9) - 1, 0)
    return F.greatest(F.lit(0), F.least(F.lit(top), F.floor((dec + 90.0) / h).cast("int")))


def zone_buckets(zone: Column, h: float) -> Column:
    """RA buckets in a zone, so that a bucket is at least ``h`` degrees wide on the sky."""
    low = zone * h - 90.0
    edge = F.least(F.greatest(F.abs(low), F.abs(low + h)), F.lit(89.9))
    return F.greatest(F.lit(1), F.floor(F.cos(F.radians(edge)) * (360.0 / h)).cast("int"))


def bucket_at(ra: Column, buckets: Column) -> Column:
    """Unwrapped bucket number of an RA that may lie outside 0..360."""
    return F.floor(ra * buckets / 360.0).cast("int")


def sky_cell(ra: Column, dec: Column, h: float) -> Column:
    """The (zone, bucket) cell of a position."""
    zone = zone_of(dec, h)
    n = zone_buckets(zone, h)
    ra_norm = F.pmod(ra, F.lit(360.0))
    return F.struct(zone.alias("zone"), F.least(bucket_at(ra_norm, n), n - 1).alias("bucket"))


def edge_normals(corners: list[tuple[Column, Column]]) -> list[tuple[Column, Column, Column]]:
    """Normals of the great circles through neighbouring corners."""
    vs = [unit_vector(r, d) for r, d in corners]
    return [
        (ay * bz - az * by, az * bx - ax * bz, ax * by - ay * bx)
        for (ax, ay, az), (bx, by, bz) in zip(vs, vs[1:] + vs[:1])
    ]


def inside_edges(ra: Column, dec: Column, normals: list[tuple[Column, Column, Column]]) -> Column:
    """Point on one side of all great circles, either winding; edges count as inside."""
    px, py, pz = unit_vector(ra, dec)
    sides = [nx * px + ny * py + nz * pz for nx, ny, nz in normals]
    return (F.least(*sides) >= 0) | (F.greatest(*sides) <= 0)


def inside_polygon(ra: Column, dec: Column, corners: list[tuple[Column, Column]]) -> Column:
    """Point inside a convex polygon with great-circle edges."""
    return inside_edges(ra, dec, edge_normals(corners))


def pix2world(x: Column, y: Column, wcs: dict[str, Column]) -> Column:
    """C11: pixel (1-based) to sky through a linear tangent-plane solution without distortion."""
    dx, dy = x - wcs["crpix1"], y - wcs["crpix2"]
    xi = F.radians(wcs["cd11"] * dx + wcs["cd12"] * dy)
    eta = F.radians(wcs["cd21"] * dx + wcs["cd22"] * dy)
    ra0, dec0 = F.radians(wcs["crval1"]), F.radians(wcs["crval2"])
    base = F.cos(dec0) - eta * F.sin(dec0)
    ra = ra0 + F.atan2(xi, base)
    dec = F.atan2(F.sin(dec0) + eta * F.cos(dec0), F.sqrt(xi * xi + base * base))
    return F.struct(F.pmod(F.degrees(ra), F.lit(360.0)).alias("ra"), F.degrees(dec).alias("dec"))


def world2pix(ra: Column, dec: Column, wcs: dict[str, Column]) -> Column:
    """C11: sky to pixel (1-based); null for points not on the near hemisphere."""
    r, d = F.radians(ra - wcs["crval1"]), F.radians(dec)
    dec0 = F.radians(wcs["crval2"])
    depth = F.sin(dec0) * F.sin(d) + F.cos(dec0) * F.cos(d) * F.cos(r)
    depth = F.when(depth > 0, depth)
    xi = F.degrees(F.cos(d) * F.sin(r) / depth)
    eta = F.degrees((F.cos(dec0) * F.sin(d) - F.sin(dec0) * F.cos(d) * F.cos(r)) / depth)
    det = wcs["cd11"] * wcs["cd22"] - wcs["cd12"] * wcs["cd21"]
    x = F.try_divide(wcs["cd22"] * xi - wcs["cd12"] * eta, det) + wcs["crpix1"]
    y = F.try_divide(wcs["cd11"] * eta - wcs["cd21"] * xi, det) + wcs["crpix2"]
    return F.struct(x.alias("x"), y.alias("y"))


def pixel_scale(cd11: Column, cd12: Column, cd21: Column, cd22: Column) -> Column:
    """Pixel size along both axes in arcsec."""
    return F.struct(
        (F.sqrt(cd11 * cd11 + cd21 * cd21) * 3600).alias("scale1"),
        (F.sqrt(cd12 * cd12 + cd22 * cd22) * 3600).alias("scale2"),
    )


def _quadrant_area(x: Column, y: Column, r: float) -> Column:
    """Signed area of the disc of radius ``r`` over the rectangle from the origin to (x, y)."""
    ax, ay = F.least(F.abs(x), F.lit(r)), F.least(F.abs(y), F.lit(r))
    root = lambda t: F.sqrt(F.greatest(F.lit(0.0), r * r - t * t))
    segment = lambda t: (t * root(t) + F.asin(F.least(F.lit(1.0), t / r)) * (r * r)) / 2
    cross = root(ay)
    curved = ay * cross + segment(ax) - segment(cross)
    area = F.when(ax * ax + ay * ay <= r * r, ax * ay).otherwise(curved)
    return F.signum(x) * F.signum(y) * area


def circle_pixel_overlap(dx: Column, dy: Column, r: float) -> Column:
    """Area shared by a circle of radius ``r`` and the unit pixel centred at offset (dx, dy)."""
    x0, x1, y0, y1 = dx - 0.5, dx + 0.5, dy - 0.5, dy + 0.5
    area = (
        _quadrant_area(x1, y1, r) - _quadrant_area(x0, y1, r)
        - _quadrant_area(x1, y0, r) + _quadrant_area(x0, y0, r)
    )
    return F.greatest(F.lit(0.0), area)
