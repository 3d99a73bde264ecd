"""Grouped statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom import constants as K
from skyloom.functions.photometry import snr
from skyloom.functions.times import jd_to_mjd
from skyloom.operators.relational import KEY, interval_bins, new_bins
from skyloom.operators.skew import collect_parts, exact_quantile, median_and_deviation
from skyloom.operators.sky import nearest_match


def source_score(det: DataFrame, realbogus: DataFrame) -> DataFrame:
    """Summed real/bogus score per source."""
    rows = det.filter("source_id is not null").select(F.col("id").alias("detection_id"), "source_id")
    return rows.join(realbogus, "detection_id").groupBy("source_id").agg(F.sum("rb_score").alias("score"))


def _epochs(bridge: DataFrame, images: DataFrame, *cols: str) -> DataFrame:
    rows = bridge.select("coadd_id", F.col("image_id").alias("id"))
    return rows.join(images.select("id", *cols), ["id"])


def reference_span(bridge: DataFrame, images: DataFrame) -> DataFrame:
    """First and last Julian date and number of frames of each reference."""
    return _epochs(bridge, images, "obsjd").groupBy("coadd_id").agg(
        F.min("obsjd").alias("jdstartref"), F.max("obsjd").alias("jdendref"), F.count("id").alias("nframesref")
    )


def stack_span(bridge: DataFrame, images: DataFrame) -> DataFrame:
    """First and last MJD of each stack."""
    return _epochs(bridge, images, "obsjd").groupBy("coadd_id").agg(
        jd_to_mjd(F.min("obsjd")).alias("min_mjd"), jd_to_mjd(F.max("obsjd")).alias("max_mjd")
    )


def stack_median_mjd(bridge: DataFrame, images: DataFrame) -> DataFrame:
    """Interpolated median MJD of each stack (a stack has at most some hundred frames)."""
    rows = _epochs(bridge, images, "obsjd").withColumn("mjd", jd_to_mjd(F.col("obsjd")))
    return rows.groupBy("coadd_id").agg(F.percentile("mjd", F.lit(0.5)).alias("median_mjd"))


def stack_summary(bridge: DataFrame, images: DataFrame, more: dict[str, Column] | None = None) -> DataFrame:
    """E5: start, end, median JD, frame count and total exposure of each stack.

    ``more`` adds aggregates over the stack's images; one pass gives them all.
    """
    rows = bridge.select("coadd_id", F.col("image_id").alias("id")).join(images, ["id"])
    return rows.groupBy("coadd_id").agg(
        F.min("obsjd").alias("jdstartstack"), F.max("obsjd").alias("jdendstack"),
        F.count("id").alias("nframesstack"), F.sum("exptime").alias("exptime"),
        F.percentile("obsjd", F.lit(0.5)).alias("jdmed"), *[value.alias(name) for name, value in (more or {}).items()],
    )


def seeing_estimate(
    catalog: DataFrame, stars: DataFrame, fallback: DataFrame, max_deg: float = 1.0 / 3600.0,
    strict: bool = True,
) -> DataFrame:
    """Median FWHM per image of objects matched to calibrator stars.

    Images without a match in ``stars`` use ``fallback``; ``strict`` raises for an
    image with neither. ``catalog(id, image_id, ra, dec, fwhm_image)``;
    the star tables carry ``id, ra, dec``.
    """
    rows = catalog.select("id", "image_id", "ra", "dec", "fwhm_image")
    found = None
    for n, table in enumerate((stars, fallback)):
        pos = table.select("id", "ra", "dec")
        hits = nearest_match(rows, pos, max_deg).select("id", "image_id", "fwhm_image")
        med = exact_quantile(hits, ["image_id"], "fwhm_image", 0.5, f"seeing{n}")
        found = med if found is None else found.join(med, "image_id", "full")
    images = catalog.select("image_id").distinct().join(found, "image_id", "left")
    seeing = F.coalesce("seeing0", "seeing1")
    if strict:
        error = F.raise_error(F.concat(F.lit("no calibrators on image "), F.col("image_id").cast("string")))
        seeing = F.coalesce(seeing, error.cast("double"))
    return images.select("image_id", seeing.alias("seeing"))


def mad(
    df: DataFrame, keys: list[str], value: str, scale: float = 1.4826
) -> DataFrame:
    """Median and scaled median absolute deviation per group, from two scans."""
    found = median_and_deviation(df, keys, value, "median", "_mad")
    return found.withColumn("sigma", F.col("_mad") * scale).drop("_mad")


def bit_or_flags(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """OR of the mask bits per group."""
    return pixels.groupBy(*keys).agg(F.bit_or("mask").alias("flags"))


def _stack_inputs(images: DataFrame, subs: DataFrame, refs: DataFrame, version: str, until: str | None, days: int) -> DataFrame:
    """Binned images that have a difference against a reference of ``version``."""
    good = refs.filter(F.col("version") == version).select(F.col("id").alias("reference_image_id"))
    done = subs.join(good, "reference_image_id", "left_semi").select(F.col("target_image_id").alias("id"))
    keys = [*KEY, "binleft", "binright"]
    return interval_bins(images.select("id", *KEY, "obsdate"), until, days=days).join(done, "id").select(*keys, "id")


def stack_members(
    images: DataFrame, subs: DataFrame, refs: DataFrame, version: str, until: str | None = None,
    days: int = K.STACK_DAYS, min_size: int = 2,
) -> DataFrame:
    """One row per (stack, input image): the long form of a stack's target list.

    Expects the B3 cuts to be applied. A list column would hold a whole bin in one
    row; ``stack_targets`` packs it when the file format needs it.
    """
    rows = _stack_inputs(images, subs, refs, version, until, days)
    keys = [*KEY, "binleft", "binright"]
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") >= min_size)
    return rows.join(sizes, keys)


def stacks_to_build(
    images: DataFrame, subs: DataFrame, refs: DataFrame, coadds: DataFrame, version: str,
    until: str | None = None, days: int = K.STACK_DAYS, min_size: int = 2,
) -> DataFrame:
    """E9 with D9: new stacks with their size, first and last input."""
    rows = _stack_inputs(images, subs, refs, version, until, days)
    plan = rows.groupBy(*KEY, "binleft", "binright").agg(
        F.count(F.lit(1)).alias("size"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    ).filter(F.col("size") >= min_size)
    return new_bins(plan, coadds)


def stack_targets(members: DataFrame, size: int = 10_000) -> DataFrame:
    """Input id arrays per stack, in parts of at most ``size`` ids."""
    return collect_parts(members, [*KEY, "binleft", "binright"], ["id"], F.col("id"), size, "target")


def best_detection(det: DataFrame, group: str = "source_id", cols: list[str] | None = None) -> DataFrame:
    """The detection with the highest signal to noise per group; lowest id on ties."""
    cols = [c for c in (cols or det.columns) if c != group]
    order = F.struct(F.coalesce(snr(F.col("flux"), F.col("fluxerr")), F.lit(float("-inf"))), -F.col("id"))
    return det.filter(F.col(group).isNotNull()).groupBy(group).agg(*[F.max_by(c, order).alias(c) for c in cols])


def detection_counts(history: DataFrame, keys: list[str]) -> DataFrame:
    """Number, first and last JD of earlier detections."""
    return history.groupBy(*keys).agg(
        F.count("mjd").alias("ndethist"),
        (F.min("mjd") + K.MJD_TO_JD).alias("jdstarthist"),
        (F.max("mjd") + K.MJD_TO_JD).alias("jdendhist"),
    )


def distinct_names(matches: DataFrame, key: str, name: str, size: int = 10_000) -> DataFrame:
    """Sorted, comma-joined distinct names per key, in parts of at most ``size`` names.

    Duplicates go before anything is collected; nearly every key has part 0 only.
    """
    unique = matches.filter(F.col(name).isNotNull()).select(key, name).distinct()
    parts = collect_parts(unique, [key], [name], F.col(name), size, "_names")
    return parts.select(key, "part", F.array_join("_names", ",").alias("names"))


def mixed_groups(df: DataFrame, group: str, cols: list[str] = KEY) -> DataFrame:
    """Groups whose members differ in any of ``cols``.

    Smallest against largest value, and nulls beside values: no distinct set is built up.
    """
    differs = F.lit(False)
    for c in cols:
        some_null = (F.count(c) > 0) & (F.count(c) < F.count(F.lit(1)))
        differs = differs | F.coalesce(F.min(c) != F.max(c), F.lit(False)) | some_null
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), differs.alias("_mixed")).filter("_mixed").drop("_mixed")


def assert_same_properties(df: DataFrame, group: str, cols: list[str] = KEY) -> DataFrame:
    """The frame itself; reading it raises for a group that mixes properties."""
    bad = mixed_groups(df, group, cols).select(group, F.lit(True).alias("_bad"))
    checked = df.join(bad, [group], "left")
    message = F.concat(F.lit("images of one stack must share " + ", ".join(cols) + ": group "), F.col(group).cast("string"))
    return checked.filter(F.when(F.col("_bad"), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))).drop("_bad")


def high_water(images: DataFrame) -> DataFrame:
    """The newest image's JD and night number (one row)."""
    order = F.struct("obsjd", "nid")
    return images.agg(F.max("obsjd").alias("obsjd"), F.max_by("nid", order).alias("nid"))


