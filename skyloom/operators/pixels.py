"""Pixel-table operators (H1-H14). Pixels are rows ``(image_id, x, y, value[, rms, mask])``, 0-based.

Stamps around positions are read through strips: short runs of one image row. A
position meets its box as a few strips instead of one row per pixel. Apertures and whole
images meet as tiles: squares of pixels packed into one array each, before they are shuffled.
"""

from __future__ import annotations

from math import pi, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom import constants as K
from skyloom.functions.geometry import circle_pixel_overlap
from skyloom.operators.aggregates import mad
from skyloom.operators.filters import is_bad
from skyloom.operators.skew import null_safe_join
from skyloom.session import store

STRIP = 64
APERTURE_TILE = 16
TILE = 32


def bad_pixel(mask: Column) -> Column:
    """H1: unusable for science."""
    return is_bad(mask)


def _saturated(saturate: Column | float | None) -> Column:
    if saturate is None:
        return F.lit(False)
    level = F.lit(saturate) if isinstance(saturate, (int, float)) else saturate
    return F.coalesce(F.col("value") >= level * K.SATURATION_FRACTION, F.lit(False))


def weight_map(pixels: DataFrame, saturate: Column | float | None = None) -> DataFrame:
    """H2: adds ``weight``, the inverse variance; 0 on bad and saturated pixels."""
    dead = bad_pixel(F.col("mask")) | _saturated(saturate)
    return pixels.withColumn("weight", F.when(dead, 0.0).otherwise(F.try_divide(F.lit(1.0), F.col("rms") * F.col("rms"))))


def rms_map(pixels: DataFrame, saturate: Column | float | None = None) -> DataFrame:
    """H3: ``rms`` from ``weight``; a very large value on bad and saturated pixels."""
    dead = bad_pixel(F.col("mask")) | _saturated(saturate)
    rms = F.when(dead, F.lit(sqrt(K.BIG_RMS_SQUARED))).otherwise(F.try_divide(F.lit(1.0), F.sqrt("weight")))
    return pixels.withColumn("rms", rms)


def false_weight(pixels: DataFrame, border: int = K.MASK_BORDER, science: bool = True) -> DataFrame:
    """H4: 0/1 weight; science images also lose a border."""
    good = ~bad_pixel(F.col("mask"))
    if not science:
        return pixels.withColumn("false_weight", good.cast("int"))
    size = pixels.groupBy("image_id").agg(F.max("x").alias("_mx"), F.max("y").alias("_my"))
    inside = F.col("x").between(border, F.col("_mx") - border) & F.col("y").between(border, F.col("_my") - border)
    sized = pixels.join(size, ["image_id"])
    return sized.withColumn("false_weight", (good & inside).cast("int")).drop("_mx", "_my")


def tiles(pixels: DataFrame, keys: list[str], cols: list[str], size: int = TILE) -> DataFrame:
    """One row per image and tile: ``keys``, ``_ty``, ``_tx`` and ``_px``, an array with a place for every pixel of the tile.

    A pixel is a struct of ``cols``, a missing one is null. Pixels are packed before the
    shuffle, which moves arrays. A pixel may be listed once per image.
    """
    place = F.pmod("y", F.lit(size)) * size + F.pmod("x", F.lit(size))
    packed = pixels.groupBy(*keys, F.floor(F.col("y") / size).alias("_ty"), F.floor(F.col("x") / size).alias("_tx")).agg(
        F.array_sort(F.collect_list(F.struct(place.cast("int").alias("at"), F.struct(*[F.col(c) for c in cols]).alias("p")))).alias("_run"))
    kind = ", ".join(f"`{c}`: {pixels.schema[c].dataType.simpleString()}" for c in cols)
    run, n = F.col("_run"), F.size("_run")

    def gap(count: Column) -> Column:
        return F.array_repeat(F.lit(None).cast(f"struct<{kind}>"), count.cast("int"))

    following = lambda i: F.when(i + 1 < n, F.get(run, i + 1)["at"]).otherwise(F.lit(size * size))
    spread = F.flatten(F.transform(run, lambda e, i: F.concat(F.array(e["p"]), gap(following(i) - e["at"] - 1))))
    full = F.when(n == size * size, F.transform(run, lambda e: e["p"])).otherwise(F.concat(gap(F.get(run, F.lit(0))["at"]), spread))
    return packed.select(*keys, "_ty", "_tx", full.alias("_px"))


def paired_pixels(sci: DataFrame, ref: DataFrame, ref_key: str, cols: list[str], size: int = TILE) -> DataFrame:
    """The pixels of ``sci`` with ``_ref``, a struct of ``cols`` of the same pixel of their reference; tiles are joined."""
    keys = ["image_id", ref_key]
    own = [c for c in sci.columns if c not in (*keys, "x", "y")]
    a = tiles(sci, keys, own, size)
    b = tiles(ref, ["image_id"], cols, size).select(F.col("image_id").alias(ref_key), "_ty", "_tx", F.col("_px").alias("_ref_px"))
    both = F.zip_with("_px", "_ref_px", lambda p, q: F.when(p.isNotNull() & q.isNotNull(), F.struct(p.alias("p"), q.alias("q"))))
    found = a.join(b, [ref_key, "_ty", "_tx"]).select(*keys, "_ty", "_tx", F.posexplode(both).alias("_at", "_pair")).filter("_pair is not null")
    place = {"x": F.col("_tx") * size + F.col("_at") % size, "y": F.col("_ty") * size + F.floor(F.col("_at") / size)}

    def column(c: str) -> Column:
        if c in place:
            return place[c].cast(sci.schema[c].dataType).alias(c)
        return F.col(c) if c in keys else F.col(f"_pair.p.`{c}`").alias(c)

    return found.select(*[column(c) for c in sci.columns], F.col("_pair.q").alias("_ref"))


def mask_union(sci: DataFrame, ref: DataFrame, ref_key: str) -> DataFrame:
    """H5: OR of the science mask and the mask of its reference, pixel by pixel.

    ``sci`` carries ``ref_key``, the id under which ``ref`` lists its pixels; both are joined as tiles.
    """
    both = paired_pixels(sci, ref, ref_key, ["mask"])
    return both.withColumn("mask", F.col("mask").bitwiseOR(F.col("_ref.mask"))).drop("_ref")


def flag_bit(mask: Column, where: Column, bit: int) -> Column:
    """H5: set one bit of the mask (OR, so setting it twice is harmless)."""
    return F.when(where, mask.bitwiseOR(F.lit(1 << bit))).otherwise(mask)


def background_stats(
    pixels: DataFrame, keys: list[str] = ["image_id"], nsigma: float = 10.0,
    fraction: float | None = None, seed: int = 0,
) -> DataFrame:
    """H6: median background, robust sigma and the lower limit of unmasked pixels per image.

    ``fraction`` estimates them from a random sample.
    """
    clean = pixels.filter(F.col("mask") == 0)
    if fraction is not None:
        clean = clean.sample(fraction, seed)
    stats = mad(clean, keys, "value")
    return stats.withColumnRenamed("median", "bkg").withColumn("low", F.col("bkg") - F.col("sigma") * nsigma)


def stack_combine(
    pixels: DataFrame, mode: str = "clipped", keys: list[str] = ["grp", "x", "y"], clip: float = 4.0,
    ampfrac: float = 0.3, background: float = 0.0, mask_mode: str = "and",
) -> DataFrame:
    """H7: combine aligned frames per output pixel.

    ``mode``: mean, weighted, median, or clipped (weighted mean of the frames within
    ``clip`` rms + ``ampfrac`` of the median). Masks are combined with ``and`` for
    stacks and ``or`` for alignment; a pixel without weight gets the no-data bit.
    Frames carry ``value`` (already scaled), ``weight``, ``rms`` and ``mask``.
    """
    merged = F.bit_and("mask") if mask_mode == "and" else F.bit_or("mask")
    value, weight = F.col("value"), F.col("weight")
    if mode not in ("mean", "weighted", "median", "clipped"):
        raise ValueError(f"unknown mode {mode!r}")
    # one grouping does it all: an output pixel has one row per input, some hundred at most
    center = F.percentile(F.when(~F.isnan(value.cast("double")), value), F.lit(0.5))
    aggs = {
        "mean": [F.avg(value).alias("_value")],
        "weighted": [F.try_divide(F.sum(value * weight), F.sum(weight)).alias("_value")],
        "median": [center.alias("_value")],
        "clipped": [center.alias("_center"), F.collect_list(F.struct("value", "weight", "rms")).alias("_frames")],
    }[mode]
    stacked = pixels.groupBy(*keys).agg(*aggs, F.sum(weight).alias("weight"), F.count(F.lit(1)).alias("n_frames"), merged.alias("mask"))
    if mode == "clipped":
        near = lambda f: F.abs(f["value"] - F.col("_center")) <= f["rms"] * clip + F.abs("_center") * ampfrac
        total = lambda part: F.aggregate("_kept", F.lit(0.0), lambda acc, f: acc + F.coalesce(part(f), F.lit(0.0)))
        stacked = stacked.withColumn("_kept", F.filter("_frames", near))
        mean = F.try_divide(total(lambda f: f["value"] * f["weight"]), total(lambda f: f["weight"].cast("double")))
        stacked = stacked.withColumn("_value", F.coalesce(mean, F.col("_center")))
    stacked = stacked.select(*keys, (F.col("_value") + background).alias("value"), "weight", "n_frames", "mask")
    return stacked.withColumn("mask", flag_bit(F.col("mask"), F.col("weight") == 0, K.BIT_NO_DATA))


def difference_image(sci: DataFrame, ref: DataFrame, ref_key: str, masked_value: float = 1e-30) -> DataFrame:
    """H8: aligned science minus reference; rms in quadrature, masks united.

    ``sci`` carries ``ref_key``. A difference equal to ``masked_value`` marks a pixel
    that the subtraction masked. Both sides are joined as tiles.
    """
    both = paired_pixels(sci, ref, ref_key, ["value", "rms", "mask"])
    value = F.col("value") - F.col("_ref.value")
    rms = F.sqrt(F.col("rms") * F.col("rms") + F.col("_ref.rms") * F.col("_ref.rms"))
    mask = flag_bit(F.col("mask").bitwiseOR(F.col("_ref.mask")), value == masked_value, K.BIT_SUBTRACTION_MASKED)
    return both.select(
        *[c for c in sci.columns if c not in ("value", "rms", "mask")],
        value.alias("value"), rms.alias("rms"), mask.alias("mask"),
    )


def suspicious_pixels(pixels: DataFrame, nsig: float = 5.0) -> DataFrame:
    """H9: pixels below ``-nsig`` sigma with one above ``+nsig`` among their 3x3 neighbours.

    Only pixels beyond the threshold go into the neighbour join.
    """
    stats = mad(pixels, ["image_id"], "value", 1.48)
    level = pixels.select("image_id", "x", "y", "value").join(stats, ["image_id"])
    level = level.withColumn("_s", F.try_divide(F.col("value") - F.col("median"), F.col("sigma")))
    # few pixels are that far out; both sides of the neighbour join read this small table
    level = store(level.filter(F.abs("_s") > nsig).select("image_id", "x", "y", "_s"))
    low = level.filter(F.col("_s") < -nsig).select("image_id", "x", "y")
    steps = F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    around = level.filter(F.col("_s") > nsig).withColumn("_d", F.explode(steps)).select(
        "image_id", (F.col("x") + F.col("_d.dx")).alias("x"), (F.col("y") + F.col("_d.dy")).alias("y")
    ).distinct()
    return low.join(around, ["image_id", "x", "y"], "left_semi")


def negative_pixel_cut(
    det: DataFrame, pixels: DataFrame, size: int = 11, nsig: float = 5.0
) -> DataFrame:
    """H9: drop detections with a suspicious pixel in their ``size`` x ``size`` box.

    ``x_image, y_image`` are 1-based; the box is clipped at the image edge. Pixels
    and boxes meet by tiles of the box size: a box touches at most four.
    """
    half = size // 2
    # images without a detection left are not looked at
    wanted = pixels.join(det.select("image_id").distinct(), "image_id", "left_semi")
    bad = suspicious_pixels(wanted, nsig).select(
        F.col("image_id").alias("_img"), F.col("x").alias("_px"), F.col("y").alias("_py"),
        F.floor(F.col("x") / size).alias("_btx"), F.floor(F.col("y") / size).alias("_bty"),
    )
    cx, cy = (F.bround(F.col(c), 0).cast("int") - 1 for c in ("x_image", "y_image"))
    tiles = lambda c: F.sequence(F.floor((c - half) / size), F.floor((c + half) / size))
    boxes = (
        det.select("id", "image_id", cx.alias("_cx"), cy.alias("_cy"))
        .withColumn("_tx", F.explode(tiles(F.col("_cx"))))
        .withColumn("_ty", F.explode(tiles(F.col("_cy"))))
    )
    cond = (
        (F.col("image_id") == F.col("_img")) & (F.col("_tx") == F.col("_btx")) & (F.col("_ty") == F.col("_bty"))
        & F.col("_px").between(F.col("_cx") - half, F.col("_cx") + half)
        & F.col("_py").between(F.col("_cy") - half, F.col("_cy") + half)
    )
    rejected = boxes.join(bad, cond, "left_semi").select("id").distinct()
    return det.join(rejected, "id", "left_anti")


def strips(pixels: DataFrame, cols: list[str], width: int = STRIP) -> DataFrame:
    """Runs of at most ``width`` neighbouring pixels of one image row, in x order."""
    return pixels.groupBy("image_id", "y", F.floor(F.col("x") / width).cast("int").alias("_tile")).agg(
        F.sort_array(F.collect_list(F.struct("x", *cols))).alias("_run")
    )


def box_strips(pixels: DataFrame, boxes: DataFrame, cols: list[str], width: int = STRIP, how: str = "inner") -> DataFrame:
    """Strips ``_run`` that cross each box ``(id, image_id, x0, x1, y0, y1)``, whole; one row per image row and tile.

    With ``how="left"`` the tiles without pixels come too.
    """
    rows = boxes.withColumn("y", F.explode(F.sequence("y0", "y1"))).withColumn(
        "_tile", F.explode(F.sequence(F.floor(F.col("x0") / width).cast("int"), F.floor(F.col("x1") / width).cast("int")))
    )
    at = ["image_id", "y", "_tile"]
    near = pixels.select("image_id", F.col("x").cast("int").alias("x"), F.col("y").cast("int").alias("y"), *cols)
    near = near.withColumn("_tile", F.floor(F.col("x") / width).cast("int"))
    # only pixels of strips that a box touches are packed
    near = near.join(rows.select(*at).distinct(), at, "left_semi")
    return rows.join(strips(near, cols, width), at, how)


def box_pixels(pixels: DataFrame, boxes: DataFrame, cols: list[str], size: int = APERTURE_TILE) -> DataFrame:
    """The pixels ``x, y`` and ``cols`` in each box ``(id, image_id, x0, x1, y0, y1)``, next to the box's other columns.

    Only a box's part among the pixels, which are 0-based, is looked at. It meets them by square tiles: a box smaller
    than a tile is sent four times at most, and once where it lies within one.
    """
    at = ["image_id", "_ty", "_tx"]
    first, tile = (lambda c: F.greatest(c, F.lit(0))), (lambda c: F.floor(c / size).cast("int"))
    met = boxes.filter("x1 >= 0 and y1 >= 0").withColumn("_ty", F.explode(F.sequence(tile(first("y0")), tile(F.col("y1")))))
    met = met.withColumn("_tx", F.explode(F.sequence(tile(first("x0")), tile(F.col("x1")))))
    near = pixels.select("image_id", F.col("x").cast("int").alias("x"), F.col("y").cast("int").alias("y"), *cols)
    near = near.withColumns({"_ty": tile(F.col("y")), "_tx": tile(F.col("x"))})
    # only pixels of tiles that a box touches are packed
    near = near.join(met.select(*at).distinct(), at, "left_semi")
    packed = near.groupBy(*at).agg(F.sort_array(F.collect_list(F.struct("y", "x", *cols))).alias("_run"))
    found = met.join(packed, at).select(*boxes.columns, F.explode("_run").alias("_p"))
    found = found.filter(F.col("_p.x").between(F.col("x0"), F.col("x1")) & F.col("_p.y").between(F.col("y0"), F.col("y1")))
    return found.select(*boxes.columns, "_p.*")


def _circle_box(positions: DataFrame, r: float) -> DataFrame:
    edge = lambda c, s: (F.floor(F.col(c) - r + 0.5) if s < 0 else F.ceil(F.col(c) + r + 0.5) - 1).cast("int")
    return positions.select(
        "id", "image_id", F.col("x").alias("cx"), F.col("y").alias("cy"),
        edge("x", -1).alias("x0"), edge("x", 1).alias("x1"), edge("y", -1).alias("y0"), edge("y", 1).alias("y1"),
    )


def _aperture_weight(r: float, method: str, subpixels: int, edge: bool) -> Column:
    dx, dy = F.col("x") - F.col("cx"), F.col("y") - F.col("cy")
    inside = lambda u, v: (u * u + v * v <= r * r) if edge else (u * u + v * v < r * r)
    if method == "center":
        return F.when(inside(dx, dy), 1.0).otherwise(0.0)
    if method == "exact":
        return circle_pixel_overlap(dx, dy, r)
    if method == "subpixel":
        offs = [(k + 0.5) / subpixels - 0.5 for k in range(subpixels)]
        hits = F.lit(0.0)
        for u in offs:
            for v in offs:
                hits = hits + F.when(inside(dx + u, dy + v), 1.0).otherwise(0.0)
        return hits / float(subpixels * subpixels)
    raise ValueError(f"unknown method {method!r}")


def aperture_photometry(
    pixels: DataFrame, positions: DataFrame, r: float = K.APERTURE_RADIUS_PIX, method: str = "exact",
    subpixels: int = 5, edge: bool = False, sums: dict[str, Column] | None = None,
) -> DataFrame:
    """Flux, error and flags at positions ``(id, image_id, x, y)``.

    ``method``: exact overlap, ``center`` (pixel centre inside; ``edge`` counts the
    circle itself) or ``subpixel``. ``flags`` is the OR over the aperture's bounding
    box. ``sums`` replaces the summed columns. Positions without any pixel are left out.
    """
    weight = _aperture_weight(r, method, subpixels, edge)
    cells = box_pixels(pixels, _circle_box(positions, r), ["value", "rms", "mask"]).withColumn("w", weight)
    w = F.col("w")
    aggs = sums or {
        "flux": F.sum(F.col("value") * w),
        "fluxerr": F.sqrt(F.sum(F.col("rms") * F.col("rms") * w)),
        "flags": F.bit_or("mask"),
    }
    return cells.groupBy("id").agg(*[c.alias(n) for n, c in aggs.items()])


def aperture_mean_rms(
    pixels: DataFrame, positions: DataFrame, r: float = K.QUALITY_RADIUS_PIX, method: str = "exact"
) -> DataFrame:
    """``rmscut`` (summed rms over the circle's area) and ``bpmcut`` (bad area) per position."""
    sums = {
        "rmscut": F.sum(F.col("rms") * F.col("w")) / (pi * r * r),
        "bpmcut": F.sum(bad_pixel(F.col("mask")).cast("double") * F.col("w")),
    }
    return aperture_photometry(pixels, positions, r, method, sums=sums)


def cutout(
    pixels: DataFrame, positions: DataFrame, size: int = K.CUTOUT_SIZE, fill: float = 0.0, stamps: dict[str, str] | None = None
) -> DataFrame:
    """(id, image_id, stamp): ``size`` rows of ``size`` values around the nearest pixel, filled outside.

    ``stamps`` names several stamps of one box and the column each is cut from, e.g. aligned images as columns
    of one pixel row; pixels and boxes are then gone through once for all of them.
    """
    stamps = {"stamp": "value"} if stamps is None else stamps
    half = size // 2
    x, y = F.floor(F.col("x") + 0.5).cast("int"), F.floor(F.col("y") + 0.5).cast("int")
    place = ["image_id", "x0", "y0"]
    placed = positions.select("id", "image_id", (x - half).alias("x0"), (y - half).alias("y0"))
    # positions on one pixel share their stamp: each different box is cut once
    boxes = placed.select(*place).distinct().withColumns({"x1": F.col("x0") + size - 1, "y1": F.col("y0") + size - 1})
    # each row of a box is one piece per tile, padded on its own, so that every piece is there
    lo, hi = F.greatest("x0", F.col("_tile") * STRIP), F.least(F.col("x1"), F.col("_tile") * STRIP + (STRIP - 1))
    cut = box_strips(pixels, boxes, list(dict.fromkeys(stamps.values())), how="left").select(
        *place, (F.col("y") - F.col("y0")).alias("dy"), "_tile", lo.alias("lo"), hi.alias("hi"),
        F.filter("_run", lambda p: p["x"].between(F.col("x0"), F.col("x1"))).alias("_cut"),
    )
    length = F.col("hi") - F.col("lo") + 1

    def piece(value: str) -> Column:
        padded = F.transform(
            F.sequence("lo", "hi"),
            lambda at: F.coalesce(F.get(F.filter("_cut", lambda p: p["x"] == at), F.lit(0))[value].cast("double"), F.lit(fill)),
        )
        return (
            F.when(F.col("_cut").isNull(), F.array_repeat(F.lit(fill), length))
            .when(F.size("_cut") == length, F.transform("_cut", lambda p: p[value].cast("double")))
            .otherwise(padded)
        )

    pieces = cut.select(*place, F.struct("dy", "_tile", *[piece(value).alias(f"v{i}") for i, value in enumerate(stamps.values())]).alias("_piece"))
    rows = pieces.groupBy(*place).agg(F.sort_array(F.collect_list("_piece")).alias("_rows"))
    per_line = (F.size("_rows") / size).cast("int")

    def stamp(i: int) -> Column:
        line = lambda dy: F.flatten(F.transform(F.slice("_rows", dy * per_line + 1, per_line), lambda p: p[f"v{i}"]))
        return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), line)

    done = rows.select(*place, *[stamp(i).alias(name) for i, name in enumerate(stamps)])
    return null_safe_join(placed, done, place).select("id", "image_id", *stamps)


def triplet_normalize(stamps: DataFrame) -> DataFrame:
    """``new``, ``ref`` and ``sub`` stamps over their L2 norm; NaN where the norm is zero."""
    names = ("new", "ref", "sub")
    # the norm is a column of its own: inside the lambda it would be summed up again for every value
    norms = {f"_norm_{c}": F.sqrt(F.aggregate(F.flatten(c), F.lit(0.0), lambda acc, v: acc + v * v)) for c in names}

    def scaled(c: str) -> Column:
        norm = F.col(f"_norm_{c}")
        return F.transform(c, lambda row: F.transform(row, lambda v: F.when(norm > 0, v / norm).otherwise(float("nan"))))

    return stamps.withColumns(norms).withColumns({c: scaled(c) for c in names}).drop(*norms)


def stamp_type(image_type: Column) -> Column:
    """Kind of stamp by image class."""
    return F.when(image_type.isin("sesub", "mesub"), "sub").when(image_type == "ref", "ref").otherwise("new")


def triplets(stamps: DataFrame) -> DataFrame:
    """(id, new, ref, sub) from rows (id, type, stamp)."""
    pick = lambda t: F.max(F.when(F.col("type") == t, F.col("stamp"))).alias(t)
    return stamps.groupBy("id").agg(*[pick(t) for t in ("new", "ref", "sub")])


