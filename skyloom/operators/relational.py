"""Anti-joins, bridges and history joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom import constants as K
from skyloom.functions.times import HALF_SECOND_DAYS, jd_to_mjd, wall_micros
from skyloom.operators.filters import null_or_false
from skyloom.operators.sky import polygon_join


KEY = list(K.GROUP_KEY)


def images_needing_reference(images: DataFrame, refs: DataFrame, version: str) -> DataFrame:
    """Images whose (field, ccdid, qid, fid) has no reference of ``version``."""
    have = refs.filter(F.col("version") == version).select(*KEY).distinct()
    return images.join(have, KEY, "left_anti")


def images_to_subtract(
    images: DataFrame, copies: DataFrame, refs: DataFrame, subs: DataFrame, failed: DataFrame, jobs: DataFrame,
    version: str, distinct: bool = True,
) -> DataFrame:
    """Archived images with a reference that are neither subtracted, failed nor in a running job.

    ``copies(product_id, archive_path)``; ``subs``, ``failed`` and ``jobs`` list
    ``target_image_id``. An image with several copies or references repeats unless
    ``distinct``, which keeps its smallest path.
    """
    have = refs.filter(F.col("version") == version).select(*KEY)
    paths = copies.select(F.col("product_id").alias("id"), "archive_path")
    if distinct:
        have = have.distinct()
        paths = paths.groupBy("id").agg(F.min("archive_path").alias("archive_path"))
    out = images
    for taken in (subs, failed, jobs):
        out = out.join(taken.select(F.col("target_image_id").alias("id")), "id", "left_anti")
    return out.join(paths, "id").join(have, KEY)


def photometry_todo(images: DataFrame, sources: DataFrame, phot: DataFrame, **polygon) -> DataFrame:
    """(image_id, source_id) pairs where a source lies in a footprint without photometry yet."""
    corners = [f"{a}{i}" for i in (1, 2, 3, 4) for a in ("ra", "dec")]
    inside = polygon_join(
        sources.select(F.col("id").alias("source_id"), "ra", "dec"), images.select("id", "ra", "dec", *corners), **polygon
    ).select("image_id", "source_id", "ra", "dec")
    return inside.join(phot.select("image_id", "source_id"), ["image_id", "source_id"], "left_anti")


def detections_needing_alert(det: DataFrame, alerts: DataFrame, need_source: bool = False) -> DataFrame:
    """Detections without an alert that are ready (or, in the variant, have a source)."""
    ready = F.col("source_id").isNotNull() if need_source else F.coalesce("alert_ready", F.lit(False))
    return det.filter(ready).join(alerts.select(F.col("detection_id").alias("id")), "id", "left_anti")


def detections_needing_photometry(det: DataFrame, alerts: DataFrame) -> DataFrame:
    """Detections that trigger an alert but are not ready and have none."""
    waiting = det.filter(F.coalesce("triggers_alert", F.lit(False)) & null_or_false(F.col("alert_ready")))
    return waiting.join(alerts.select(F.col("detection_id").alias("id")), "id", "left_anti")


def images_without_copy(images: DataFrame, copies: DataFrame, fields=None) -> DataFrame:
    """Images (of some fields) with no file copy."""
    out = images if fields is None else images.filter(F.col("field").isin(*fields))
    return out.join(copies.select(F.col("product_id").alias("id")), "id", "left_anti")


def tape_only_copies(files: DataFrame, tape: DataFrame, http: DataFrame) -> DataFrame:
    """Files on tape but not on disk; filter 3 is never fetched from tape."""
    on_tape = tape.select(F.col("product_id").alias("id"), "archive_id", "member_name")
    out = files.filter(F.col("fid") != 3).join(on_tape, "id")
    return out.join(http.select(F.col("product_id").alias("id")), "id", "left_anti")


def new_bins(plan: DataFrame, coadds: DataFrame) -> DataFrame:
    """Planned stacks that do not exist yet."""
    keys = [*KEY, "binleft", "binright"]
    return plan.join(coadds.select(*keys), keys, "left_anti")


def overlapping_subtractions(bridge: DataFrame, subs: DataFrame, require_complete: bool = True) -> DataFrame:
    """Single-epoch differences of each stack's inputs, per reference.

    ``bridge(coadd_id, image_id)``, ``subs(id, target_image_id, reference_image_id)``.
    With ``require_complete`` only (stack, reference) sets covering every input stay;
    ``incomplete_stacks`` lists the others.
    """
    rows = _stack_subs(bridge, subs)
    if not require_complete:
        return rows
    full = _coverage(bridge, rows).filter(F.col("n_subs") == F.col("n_inputs"))
    return rows.join(full.select("coadd_id", "reference_image_id"), ["coadd_id", "reference_image_id"], "left_semi")


def incomplete_stacks(bridge: DataFrame, subs: DataFrame) -> DataFrame:
    """(stack, reference) sets whose differences do not cover all inputs, with both counts."""
    return _coverage(bridge, _stack_subs(bridge, subs)).filter(F.col("n_subs") != F.col("n_inputs"))


def _stack_subs(bridge: DataFrame, subs: DataFrame) -> DataFrame:
    by_image = subs.select(F.col("target_image_id").alias("image_id"), F.col("id").alias("sub_id"), "reference_image_id")
    return bridge.select("coadd_id", "image_id").join(by_image, "image_id")


def _coverage(bridge: DataFrame, rows: DataFrame) -> DataFrame:
    inputs = bridge.groupBy("coadd_id").agg(F.count(F.lit(1)).alias("n_inputs"))
    got = rows.groupBy("coadd_id", "reference_image_id").agg(F.count(F.lit(1)).alias("n_subs"))
    return got.join(inputs, "coadd_id")


def bin_columns(obsdate: Column, origin: str = K.STACK_ORIGIN, days: int = K.STACK_DAYS):
    """Edges of the left-open, right-closed bin of a time, by arithmetic instead of a range join."""
    width = days * 86_400_000_000
    start = F.lit(origin).cast("timestamp_ntz")
    number = F.ceil((wall_micros(obsdate) - wall_micros(start)) / F.lit(width)).cast("long") - 1
    left = F.timestamp_add("DAY", (number * days).cast("int"), start)
    right = F.timestamp_add("DAY", ((number + 1) * days).cast("int"), start)
    return number, left, right


def interval_bins(
    images: DataFrame, until: str | None = None, origin: str = K.STACK_ORIGIN, days: int = K.STACK_DAYS
) -> DataFrame:
    """Images with the complete bin ``binleft < obsdate <= binright`` they fall in.

    ``until`` is the planning time: bins that end after it are not complete.
    """
    number, left, right = bin_columns(F.col("obsdate"), origin, days)
    out = images.withColumns({"bin": number, "binleft": left, "binright": right}).filter(F.col("bin") >= 0)
    return out if until is None else out.filter(F.col("binright") <= F.lit(until).cast("timestamp_ntz"))


def reference_inputs(refs: DataFrame, bridge: DataFrame, images: DataFrame) -> DataFrame:
    """Science images that went into each reference."""
    ids = refs.select(F.col("id").alias("coadd_id"))
    rows = bridge.select("coadd_id", F.col("image_id").alias("id")).join(ids, "coadd_id", "left_semi")
    return rows.join(images, ["id"]).withColumnRenamed("coadd_id", "reference_id")


def history_single(det: DataFrame, subs: DataFrame, images: DataFrame) -> DataFrame:
    """(source_id, detection_id, mjd) of single-epoch detections."""
    epochs = subs.select(F.col("id").alias("image_id"), F.col("target_image_id")).join(
        images.select(F.col("id").alias("target_image_id"), jd_to_mjd(F.col("obsjd")).alias("mjd")), "target_image_id"
    ).select("image_id", "mjd")
    own = det.filter("source_id is not null").select("source_id", F.col("id").alias("detection_id"), "image_id")
    return own.join(epochs, ["image_id"]).select("source_id", "detection_id", "mjd")


def history_stack(
    det: DataFrame, subs: DataFrame, bridge: DataFrame, images: DataFrame, epochs: DataFrame | None = None
) -> DataFrame:
    """(source_id, stack_id, min_mjd, max_mjd), once per stack on which a source was seen.

    ``epochs(coadd_id, min_mjd, max_mjd)`` saves a pass over the lineage if it is at hand.
    """
    if epochs is None:
        rows = bridge.select("coadd_id", F.col("image_id").alias("id"))
        rows = rows.join(images.select("id", jd_to_mjd(F.col("obsjd")).alias("mjd")), ["id"])
        epochs = rows.groupBy("coadd_id").agg(F.min("mjd").alias("min_mjd"), F.max("mjd").alias("max_mjd"))
    spans = subs.select(F.col("id").alias("image_id"), F.col("target_image_id").alias("coadd_id")).join(epochs, "coadd_id")
    own = det.filter("source_id is not null").select("source_id", "image_id").distinct()
    return own.join(spans, ["image_id"]).select(
        "source_id", F.col("coadd_id").alias("stack_id"), "min_mjd", "max_mjd"
    ).distinct()


def before_epoch(mjd: Column, epoch: Column, tol_s: float = 0.0) -> Column:
    """Strictly before an epoch, or, with a tolerance, not after epoch + ``tol_s`` seconds."""
    if tol_s:
        return mjd <= epoch + tol_s * 2 * HALF_SECOND_DAYS
    return mjd < epoch


def navigate(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str) -> DataFrame:
    """Child rows of the given parents."""
    return child.join(parent.select(F.col(parent_key).alias(child_key)).distinct(), child_key, "left_semi")


def members(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is listed; lists of any size come as a DataFrame, never as SQL text."""
    return df.join(keys.select(on), on, "left_semi")
