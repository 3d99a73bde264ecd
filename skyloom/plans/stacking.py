"""Stacks and differences on aligned pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom import constants as K
from skyloom.functions.naming import sub_name
from skyloom.functions.photometry import fluxscale
from skyloom.functions.times import jd_to_mjd
from skyloom.operators.aggregates import assert_same_properties
from skyloom.operators.pixels import difference_image, stack_combine
from skyloom.operators.relational import overlapping_subtractions
from skyloom.operators.tables import upsert


def _frames(bridge: DataFrame, images: DataFrame, pixels: DataFrame) -> DataFrame:
    """Pixels of every input with its stack id, scaled to the common zeropoint."""
    inputs = bridge.select("coadd_id", F.col("image_id").alias("id")).join(images.select("id", "magzp"), ["id"]).select(F.col("id").alias("image_id"), "coadd_id", fluxscale(F.col("magzp")).alias("_scale"))
    return pixels.join(inputs, ["image_id"]).withColumns({
        "value": F.col("value") * F.col("_scale"),
        "rms": F.col("rms") * F.col("_scale"),
        "weight": F.try_divide(F.col("weight"), F.col("_scale") * F.col("_scale")),
    }).drop("_scale")


def build_stack(
    bridge: DataFrame, images: DataFrame, pixels: DataFrame, mode: str = "clipped",
    background: float = K.STACK_BACKGROUND,
) -> tuple[DataFrame, DataFrame]:
    """Stack pixels and stack rows (key, median MJD, number of inputs).

    ``bridge(coadd_id, image_id)`` is also the lineage record. Reading raises when a
    stack mixes partition keys or an input has no pixels with a mask.
    """
    rows = bridge.select("coadd_id", F.col("image_id").alias("id")).join(images, ["id"])
    rows = assert_same_properties(rows, "coadd_id")
    masked = pixels.filter(F.col("mask").isNotNull()).select(F.col("image_id").alias("id")).distinct()
    unmasked = rows.join(masked.withColumn("_ok", F.lit(True)), "id", "left")
    message = F.concat(F.lit("no mask for image "), F.col("id").cast("string"))
    rows = unmasked.filter(F.when(F.col("_ok").isNull(), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))).drop("_ok")
    rows = rows.withColumn("mjd", jd_to_mjd(F.col("obsjd")))
    meta = rows.groupBy("coadd_id").agg(
        *[F.min(c).alias(c) for c in K.GROUP_KEY], F.count(F.lit(1)).alias("n_inputs"),
        F.percentile("mjd", F.lit(0.5)).alias("mjd"),  # some hundred inputs at most
    )
    stacked = stack_combine(_frames(bridge, images, pixels), mode, ["coadd_id", "x", "y"], background=background)
    return stacked, meta


def register_stacks(known: DataFrame, made: DataFrame, now) -> DataFrame:
    """Stack rows with a stack of the same basename updated, not repeated."""
    return upsert(known, made, "basename", now)


def subtract(
    images: DataFrame, refs: DataFrame, sci_pixels: DataFrame, ref_pixels: DataFrame, existing: DataFrame, version: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Difference pixels, difference rows and failures.

    Images that already have a difference against their reference are left alone;
    images without a reference or without pixels fail with a reason. A difference
    inherits seeing, zeropoint and aperture correction.
    """
    key = list(K.GROUP_KEY)
    ref = refs.filter(F.col("version") == version).groupBy(*key).agg(
        F.min_by(F.struct(F.col("id").alias("reference_image_id"), F.col("basename").alias("_ref_name")), "id").alias("_r")
    ).select(*key, "_r.*")
    paired = images.join(ref, key, "left")
    done = existing.select(F.col("target_image_id").alias("id"), "reference_image_id")
    todo = paired.join(done, ["id", "reference_image_id"], "left_anti")
    have = sci_pixels.select(F.col("image_id").alias("id")).distinct().withColumn("_pixels", F.lit(True))
    todo = todo.join(have, "id", "left")
    reason = F.when(F.col("reference_image_id").isNull(), "no reference").when(F.col("_pixels").isNull(), "no pixels")
    todo = todo.withColumn("reason", reason)
    failures = todo.filter("reason is not null").select(F.col("id").alias("target_image_id"), "reference_image_id", "reason")
    ok = todo.filter("reason is null")
    rows = ok.select(
        F.col("id").alias("target_image_id"), "reference_image_id",
        sub_name(F.col("basename"), F.col("_ref_name")).alias("basename"), *key,
        *[c for c in ("seeing", "magzp", "apcor", "obsjd") if c in images.columns],
    )
    sci = sci_pixels.join(ok.select(F.col("id").alias("image_id"), "reference_image_id"), ["image_id"])
    return difference_image(sci, ref_pixels, "reference_image_id"), rows, failures


def stack_subtraction(
    bridge: DataFrame, subs: DataFrame, images: DataFrame, sub_pixels: DataFrame, mode: str = "clipped",
) -> DataFrame:
    """Combined difference pixels of each (stack, reference) whose differences cover all inputs.

    ``images`` gives the zeropoint of each difference by ``id``.
    """
    rows = overlapping_subtractions(bridge, subs).select(
        F.col("sub_id").alias("image_id"), F.col("coadd_id").alias("stack_id"), "reference_image_id"
    )
    zp = images.select(F.col("id").alias("image_id"), fluxscale(F.col("magzp")).alias("_scale"))
    frames = sub_pixels.join(rows.join(zp, "image_id"), ["image_id"]).withColumns({
        "value": F.col("value") * F.col("_scale"),
        "rms": F.col("rms") * F.col("_scale"),
        "weight": F.try_divide(F.col("weight"), F.col("_scale") * F.col("_scale")),
    }).drop("_scale")
    return stack_combine(frames, mode, ["stack_id", "reference_image_id", "x", "y"])
