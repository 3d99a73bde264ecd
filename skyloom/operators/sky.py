"""Joins on the sphere.

A cone join is an equi-join on (declination zone, RA bucket): the left side has
exactly one cell per row, the right side is copied to every cell its cap touches,
so each pair meets once. A crowded cell, on either side, is split by the adaptive
skew join, which goes by the measured sizes of the shuffled partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyloom import constants as K
from skyloom.functions.geometry import (
    bucket_at, edge_normals, inside_edges, sky_cell, sky_distance, zone_buckets, zone_of,
)

_CELL = ["_zone", "_bucket"]


def touched_cells(df: DataFrame, ra: str, dec: str, radius: float, h: float) -> DataFrame:
    """One copy of each row per cell that a cap of ``radius`` around it touches."""
    r = F.lit(radius * (1 + 1e-9) + 1e-12)  # a hair more, so that rounding never loses a cell
    zones = F.sequence(zone_of(F.col(dec) - r, h), zone_of(F.col(dec) + r, h))
    half = F.degrees(F.asin(F.least(F.lit(1.0), F.sin(F.radians(r)) / F.cos(F.radians(F.col(dec))))))
    polar = F.abs(F.col(dec)) + r >= 90.0
    ra_norm = F.pmod(F.col(ra), F.lit(360.0))
    first, last = bucket_at(ra_norm - half, F.col("_n")), bucket_at(ra_norm + half, F.col("_n"))
    first = F.when(polar, F.lit(0)).otherwise(first)
    last = F.when(polar, F.col("_n") - 1).otherwise(F.least(last, first + F.col("_n") - 1))
    return (
        df.withColumn("_zone", F.explode(zones))
        .withColumn("_n", zone_buckets(F.col("_zone"), h))
        .withColumn("_bucket", F.explode(F.sequence(first, last)))
        .withColumn("_bucket", F.pmod(F.col("_bucket"), F.col("_n")))
        .drop("_n")
    )


def cone_join(
    a: DataFrame, b: DataFrame, radius_deg: float, how: str = "inner",
    a_pos: tuple[str, str] = ("ra", "dec"), b_pos: tuple[str, str] = ("ra", "dec"),
    b_prefix: str = "b_", sep: str = "sep_deg", cell_deg: float | None = None,
) -> DataFrame:
    """Every pair within ``radius_deg`` (inclusive); ``how`` is inner, left or left_semi.

    Put the larger table on the left: only the right one is copied to neighbouring
    cells. All right columns get ``b_prefix``.
    """
    h = cell_deg or min(4 * radius_deg, 90.0)
    if h < radius_deg:
        raise ValueError("cell_deg must not be smaller than the radius")
    right = b.select([F.col(c).alias(f"{b_prefix}{c}") for c in b.columns])
    clash = set(right.columns) & set(a.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}; choose another b_prefix")
    ra_a, dec_a = a_pos
    ra_b, dec_b = (f"{b_prefix}{c}" for c in b_pos)
    cell = sky_cell(F.col(ra_a), F.col(dec_a), h)
    left = a.withColumns({"_zone": cell["zone"], "_bucket": cell["bucket"]})
    right = touched_cells(right, ra_b, dec_b, radius_deg, h)
    keys = list(_CELL)
    right = right.select([F.col(c).alias(f"_r{c}") if c in keys else F.col(c) for c in right.columns])
    distance = sky_distance(F.col(ra_a), F.col(dec_a), F.col(ra_b), F.col(dec_b))
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_r{k}"))
    # cheap declination test first, trigonometry only for what passes
    cond = cond & (F.abs(F.col(dec_a) - F.col(dec_b)) <= radius_deg * (1 + 1e-9)) & (distance <= radius_deg)
    joined = left.join(right, cond, how)
    if how == "left_semi":
        return joined.drop(*keys)
    return joined.drop(*keys, *[f"_r{k}" for k in keys]).withColumn(sep, distance)


def cone_search(df: DataFrame, ra: float, dec: float, radius_deg: float, pos: tuple[str, str] = ("ra", "dec")) -> DataFrame:
    """Rows within ``radius_deg`` of one point. The bounding box is plain column
    comparisons, so it reaches the scan."""
    from math import asin, cos, degrees, radians, sin

    ra_c, dec_c = F.col(pos[0]), F.col(pos[1])
    pad = radius_deg * 1e-9 + 1e-12
    out = df.filter(dec_c.between(dec - radius_deg - pad, dec + radius_deg + pad))
    ra = ra % 360.0
    if abs(dec) + radius_deg < 90.0:
        half = degrees(asin(min(1.0, sin(radians(radius_deg)) / cos(radians(dec))))) + pad
        lo, hi = ra - half, ra + half
        if lo >= 0 and hi < 360:
            out = out.filter(ra_c.between(lo, hi))
        else:
            out = out.filter((ra_c >= lo % 360.0) | (ra_c <= hi % 360.0))
    return out.filter(sky_distance(ra_c, dec_c, F.lit(ra), F.lit(dec)) <= radius_deg)


def polygon_join(
    points: DataFrame, images: DataFrame, prefilter_deg: float = K.FOOTPRINT_RADIUS_DEG,
    b_prefix: str = "image_", **cone,
) -> DataFrame:
    """C4: points inside four-cornered footprints (``ra1..dec4`` around the centre ``ra, dec``).

    ``prefilter_deg`` must reach from a centre to its corners. Images of one footprint are looked
    at once: points meet the different footprints, and the images join what was found.
    """
    corners = [(F.col(f"ra{i}"), F.col(f"dec{i}")) for i in (1, 2, 3, 4)]
    names = [[f"_n{i}{a}" for a in "xyz"] for i in range(4)]
    # the edges are worked out once per footprint, not once per pair
    edges = {n: value for row, normal in zip(names, edge_normals(corners)) for n, value in zip(row, normal)}
    shape = ["ra", "dec", *[f"{a}{i}" for i in (1, 2, 3, 4) for a in ("ra", "dec")]]
    near = cone_join(
        points, images.select(*shape).distinct().withColumns(edges), prefilter_deg, b_prefix=b_prefix, sep="_sep",
        cell_deg=2 * prefilter_deg, **cone
    )
    normals = [tuple(F.col(f"{b_prefix}{n}") for n in row) for row in names]
    hits = near.filter(inside_edges(F.col("ra"), F.col("dec"), normals)).drop("_sep", *[f"{b_prefix}{n}" for n in edges])
    of = images.select([F.col(c).alias(f"{b_prefix}{c}") for c in images.columns])
    return hits.join(of, [f"{b_prefix}{c}" for c in shape]).select(*points.columns, *of.columns)


def polygon_contains_catalog(images: DataFrame, catalog: DataFrame, cols: list[str], **kwargs) -> DataFrame:
    """Catalog stars inside image footprints."""
    keep = images.select("id", "ra", "dec", *[f"{a}{i}" for i in (1, 2, 3, 4) for a in ("ra", "dec")])
    hits = polygon_join(catalog.select(*dict.fromkeys([*cols, "ra", "dec"])), keep, **kwargs)
    return hits.select("image_id", *cols)


def nearest_match(
    a: DataFrame, b: DataFrame, max_deg: float, a_id: str = "id", b_id: str = "id",
    b_prefix: str = "b_", inclusive: bool = False, **cone,
) -> DataFrame:
    """The nearest right row per left row, if closer than ``max_deg``; lowest id on ties.

    The running minimum is combined on the map side, so a left row with very many
    neighbours is no burden; only ids and positions of the left side are shuffled.
    """
    pairs = cone_join(a.select(a_id, "ra", "dec"), b, max_deg, b_prefix=b_prefix, sep="sep_deg", **cone)
    if not inclusive:
        pairs = pairs.filter(F.col("sep_deg") < max_deg)
    others = [c for c in pairs.columns if c.startswith(b_prefix) and c != f"{b_prefix}{b_id}"]
    best = pairs.groupBy(a_id).agg(
        F.min(F.struct("sep_deg", f"{b_prefix}{b_id}")).alias("_best"),
        *[F.min_by(c, F.struct("sep_deg", f"{b_prefix}{b_id}")).alias(c) for c in others],
    )
    best = best.select(a_id, "_best.*", *others)
    return a.join(best, a_id)


def neighbors_ranked(
    sources: DataFrame, catalog: DataFrame, radius_deg: float = K.NEIGHBOR_RADIUS_DEG,
    source_id: str = "id", catalog_id: str = "objid", **cone,
) -> DataFrame:
    """All catalog neighbours of each source with ``rank`` by distance and ``sep`` in arcsec.

    Columns: ``sid``, every catalog column, ``rank``, ``sep``.
    """
    pairs = cone_join(
        catalog, sources.select(F.col(source_id).alias("sid"), "ra", "dec"), radius_deg, b_prefix="s_",
        sep="_sep", **cone,
    )
    pairs = pairs.withColumn("sep", F.col("_sep") * 3600).withColumnRenamed("s_sid", "sid").drop("s_ra", "s_dec", "_sep")
    # the sky bounds how many neighbours a cap of this size holds
    return pairs.withColumn("rank", F.rank().over(Window.partitionBy("sid").orderBy("sep")))


def catalog_scan(
    catalog: DataFrame, points: DataFrame, radius_deg: float, cols: list[str], where=None, point_id: str = "id",
    **cone,
) -> DataFrame:
    """Cone query of many points against a catalog table, keeping ``cols`` of matching rows."""
    if where is not None:
        catalog = catalog.filter(where)
    hits = cone_join(
        catalog.select(*dict.fromkeys([*cols, "ra", "dec"])), points.select(F.col(point_id).alias("pid"), "ra", "dec"),
        radius_deg, b_prefix="_p_", sep="sep_deg", **cone,
    )
    return hits.select(F.col("_p_pid").alias("point_id"), *cols, "sep_deg")

