"""Row filters and the detection quality cascade."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom import constants as K



def reference_candidates(
    images: DataFrame, fields=K.ACTIVE_FIELDS, seeing=(1.7, 2.5), maglimit=(19.2, 22.0),
    before: str | None = "2020-01-01", after: str | None = None,
) -> DataFrame:
    """B1: images good enough for a reference; all bounds are exclusive."""
    cond = (
        (F.col("infobits") == 0)
        & (F.col("seeing") > seeing[0]) & (F.col("seeing") < seeing[1])
        & (F.col("maglimit") > maglimit[0]) & (F.col("maglimit") < maglimit[1])
    )
    if fields is not None:
        cond = cond & F.col("field").isin(*fields)
    if before is not None:
        cond = cond & (F.col("obsdate") < F.lit(before).cast("timestamp_ntz"))
    if after is not None:
        cond = cond & (F.col("obsdate") >= F.lit(after).cast("timestamp_ntz"))
    return images.filter(cond)


def science_candidates(
    images: DataFrame, gid: int = 2, max_seeing: float = 4.0, min_maglimit: float = 19.0,
    after_name: str | None = "ztf_20200107", field: int | None = None,
) -> DataFrame:
    """B2: images to subtract; names are compared as text."""
    out = images.filter(
        (F.col("ipac_gid") == gid) & (F.col("seeing") < max_seeing) & (F.col("maglimit") > min_maglimit)
    )
    if after_name is not None:
        out = out.filter(F.col("basename") > after_name)
    return out if field is None else out.filter(F.col("field") == field)


def stack_candidates(
    images: DataFrame, max_seeing: float = 4.0, min_maglimit: float = 19.2, after_day: int | None = 20200107000000
) -> DataFrame:
    """Images that may enter a 7-day stack."""
    out = images.filter((F.col("seeing") < max_seeing) & (F.col("maglimit") > min_maglimit))
    return out if after_day is None else out.filter(F.col("filefracday") > after_day)


def is_bad(mask: Column, bad: int = K.BAD_SUM) -> Column:
    return mask.bitwiseAND(F.lit(bad)) > 0


def kill_flagged(catalog: DataFrame, bad: int = K.BAD_SUM) -> DataFrame:
    """Drop objects on bad pixels or with a weight flag."""
    return catalog.filter((F.col("imaflags_iso").bitwiseAND(F.lit(bad)) == 0) & (F.col("flags_weight") == 0))


# (name, condition that rejects), in the order in which the cuts are counted
def cut_conditions(with_pixels: bool = True) -> list[tuple[str, Column]]:
    c = F.col
    cuts = [
        ("imaflags", is_bad(c("imaflags_iso"))),
        ("flags", c("flags") > 2),
        ("elongation", F.try_divide(c("a_image"), c("b_image")) > 2.0),
        ("fwhm", F.try_divide(c("fwhm_image"), c("seeing")) > 2.0),
        ("sharp", c("fwhm_image") < c("seeing") * 0.8),
    ]
    if with_pixels:
        cuts += [("bpm", c("bpmcut") > 0), ("rms", c("rmscut") > c("median_rms") * 1.1)]
    return cuts + [("snr", F.try_divide(c("flux"), c("fluxerr")) < 5.0)]


def detection_cuts(catalog: DataFrame, with_pixels: bool = True) -> DataFrame:
    """Adds ``failed_at`` (first cut that rejects the row, else null) and ``goodcut``.

    With pixels, the catalog carries ``bpmcut``, ``rmscut`` (H11) and ``median_rms``.
    """
    first = F.coalesce(*[F.when(cond, F.lit(name)) for name, cond in cut_conditions(with_pixels)])
    return catalog.withColumn("failed_at", first).withColumn("goodcut", F.col("failed_at").isNull())


def rb_cut(catalog: DataFrame, cuts: dict[int, float] = K.RB_CUT) -> DataFrame:
    """Keep rows at or above the real/bogus limit of their filter."""
    limit = F.create_map(*[F.lit(v) for pair in cuts.items() for v in pair])
    return catalog.filter(F.col("rb") >= F.try_element_at(limit, F.col("fid")))


def unscored_rb(goodcut: Column, rb: Column) -> Column:
    """Rows rejected before scoring carry a fixed score."""
    return F.when(goodcut, rb).otherwise(F.lit(K.RB_UNSCORED))


def too_many_detections(det: DataFrame, max_rows: int = K.MAX_DETECTIONS) -> tuple[DataFrame, DataFrame]:
    """Split off images with more than ``max_rows`` detections.

    Returns the kept detections and one failure row ``(image_id, n, reason)`` per image.
    Counts are combined before the shuffle.
    """
    counts = det.groupBy("image_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max_rows)
    reason = F.format_string(f"Error: %d detections (>{max_rows})", "n")
    failures = counts.select("image_id", "n", reason.alias("reason"))
    return det.join(counts.select("image_id"), ["image_id"], "left_anti"), failures


def calibrator_filter(catalog: DataFrame, kind: str) -> DataFrame:
    """Stars fit for measuring the seeing, from a ``gaia`` or ``sdss`` table."""
    if kind == "gaia":
        return catalog.filter((F.col("parallax") > 0) & (F.col("phot_g_mean_mag") > 16))
    if kind == "sdss":
        return catalog.filter((F.col("probpsf") > 0.9) & (F.col("psfmag_r") < 19) & (F.col("psfmag_r") > 16))
    raise ValueError(f"unknown calibrator kind {kind!r}")


def null_or_false(flag: Column) -> Column:
    """True for null and for false."""
    return ~F.coalesce(flag, F.lit(False))


def cut_funnel(catalog: DataFrame, keys: list[str], with_pixels: bool = True) -> DataFrame:
    """Survivors after each cut, per group."""
    conds = cut_conditions(with_pixels)
    alive, counts = F.lit(True), [F.count(F.lit(1)).alias("n_total")]
    for name, cond in conds:
        alive = alive & ~F.coalesce(cond, F.lit(False))
        counts.append(F.count_if(alive).alias(f"after_{name}"))
    return catalog.groupBy(*keys).agg(*counts)


