"""From object catalogs to kept detections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom import constants as K
from skyloom.operators.filters import detection_cuts, is_bad, kill_flagged, rb_cut, too_many_detections
from skyloom.operators.pixels import aperture_mean_rms, negative_pixel_cut
from skyloom.operators.skew import exact_quantile
from skyloom.session import store


def with_pixel_quality(catalog: DataFrame, pixels: DataFrame) -> DataFrame:
    """Adds ``rmscut``, ``bpmcut`` (H11) and the image's ``median_rms`` over good pixels."""
    positions = catalog.select("id", "image_id", F.col("x_image").alias("x"), F.col("y_image").alias("y"))
    wanted = pixels.join(catalog.select("image_id").distinct(), "image_id", "left_semi")
    medians = exact_quantile(wanted.filter(~is_bad(F.col("mask"))), ["image_id"], "rms", 0.5, "median_rms")
    out = catalog.join(aperture_mean_rms(pixels, positions), "id", "left")
    return out.join(medians, ["image_id"], "left")


def filter_detections(
    catalog: DataFrame, pixels: DataFrame, max_rows: int = K.MAX_DETECTIONS
) -> tuple[DataFrame, DataFrame]:
    """All quality cuts; returns kept detections and failed images.

    A row is kept when it passes every cut, so the cuts that look at the row alone go
    first and only what they leave is measured on the pixels. ``catalog`` carries the
    real/bogus score ``rb`` of each object (see ``score_batches``); for the counts
    after each cut in the documented order use ``with_pixel_quality`` and ``cut_funnel``.
    """
    good = rb_cut(detection_cuts(kill_flagged(catalog), with_pixels=False).filter("goodcut"))
    # both are read for the images wanted, the boxes and the rows themselves
    good = store(detection_cuts(with_pixel_quality(store(good), pixels)).filter("goodcut"))
    # read for the counts, the kept rows and the failures
    return too_many_detections(store(negative_pixel_cut(good, pixels)), max_rows)
