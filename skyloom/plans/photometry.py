"""Forced photometry of sources on difference images."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom import constants as K
from skyloom.functions.geometry import world2pix
from skyloom.functions.naming import filtercode
from skyloom.operators.pixels import aperture_photometry
from skyloom.operators.relational import photometry_todo
from skyloom.operators.tables import merge_photometry, update_from_join
from skyloom.session import store

WCS = ("crpix1", "crpix2", "crval1", "crval2", "cd11", "cd12", "cd21", "cd22")


def place_sources(todo: DataFrame, images: DataFrame) -> DataFrame:
    """0-based pixel positions of (image_id, source_id, ra, dec) rows through each image's linear solution."""
    solved = todo.join(images.select(F.col("id").alias("image_id"), *WCS), ["image_id"])
    pix = world2pix(F.col("ra"), F.col("dec"), {c: F.col(c) for c in WCS})
    return solved.withColumn("_p", pix).select(
        "image_id", "source_id", "ra", "dec", (F.col("_p.x") - 1).alias("x"), (F.col("_p.y") - 1).alias("y")
    )


def measure(positions: DataFrame, pixels: DataFrame, images: DataFrame, r: float = K.APERTURE_RADIUS_PIX,
            method: str = "exact") -> DataFrame:
    """New ``forcedphotometry`` rows for positions ``(image_id, source_id, ra, dec, x, y)``."""
    named = positions.withColumn("id", F.struct("image_id", "source_id"))
    flux = aperture_photometry(pixels, named.select("id", "image_id", "x", "y"), r, method)
    rows = named.select("id", "image_id", "source_id", "ra", "dec").join(flux, "id").drop("id")
    meta = images.select(
        F.col("id").alias("image_id"), (F.col("magzp") + F.col("apcor")).alias("zp"),
        filtercode(F.col("filter")).alias("filtercode"), "obsjd",
    )
    return rows.join(meta, ["image_id"]).select(
        "source_id", "image_id", "flux", "fluxerr", "flags", "ra", "dec", "zp", "filtercode", "obsjd"
    )


def force_photometry(
    todo: DataFrame, pixels: DataFrame, images: DataFrame, phot: DataFrame, sources: DataFrame,
    r: float = K.APERTURE_RADIUS_PIX, method: str = "exact",
) -> DataFrame:
    """Existing photometry plus new measurements of the work list."""
    fresh = measure(place_sources(todo, images), pixels, images, r, method)
    return merge_photometry(phot, fresh, images, sources)


def photometry_run(
    images: DataFrame, sources: DataFrame, pixels: DataFrame, phot: DataFrame, det: DataFrame,
    r: float = K.APERTURE_RADIUS_PIX, method: str = "exact", prefilter_deg: float = K.FOOTPRINT_RADIUS_DEG,
) -> tuple[DataFrame, DataFrame]:
    """P11 from footprints to ready detections: (photometry, detections).

    Sources inside an image's footprint without a measurement there are placed on its
    pixels, measured and merged; detections on the images worked become ready.
    ``images`` carries centre, corners, linear solution, zeropoint, filter and epoch.
    """
    todo = store(photometry_todo(images, sources, phot, prefilter_deg=prefilter_deg))
    measured = force_photometry(todo, pixels, images, phot, sources, r, method)
    worked = det.join(todo.select("image_id").distinct(), "image_id", "left_semi")
    return measured, mark_alert_ready(det, worked)


def mark_alert_ready(det: DataFrame, done: DataFrame) -> DataFrame:
    """Detections of finished jobs become ready for alerts. ``done(id)``."""
    return update_from_join(det, done.select("id").withColumn("alert_ready", F.lit(True)), "id", ["alert_ready"])
