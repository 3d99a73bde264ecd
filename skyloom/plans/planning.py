"""Work planning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom import constants as K
from skyloom.operators import ranking
from skyloom.operators.aggregates import stacks_to_build
from skyloom.operators.filters import reference_candidates, science_candidates, stack_candidates
from skyloom.operators.relational import images_needing_reference, images_to_subtract, tape_only_copies
from skyloom.operators.tables import locate, remaining_ids


def plan_references(images: DataFrame, refs: DataFrame, version: str, n: int = K.REFERENCE_MAX_IMAGES,
                    n_min: int = K.REFERENCE_MIN_IMAGES, **cuts) -> DataFrame:
    """Inputs of every reference that can be made now."""
    good = reference_candidates(images, **cuts)
    return ranking.reference_plan(images_needing_reference(good, refs, version), version, n, n_min)


def plan_stacks(images: DataFrame, subs: DataFrame, refs: DataFrame, coadds: DataFrame, version: str,
                until: str | None = None, **cuts) -> DataFrame:
    """Stacks to build (E9); order by size with ``order_by_size`` when listing them."""
    return stacks_to_build(stack_candidates(images, **cuts), subs, refs, coadds, version, until)


def plan_night(images: DataFrame, copies: DataFrame, refs: DataFrame, subs: DataFrame, failed: DataFrame,
               jobs: DataFrame, version: str, size: int = K.JOB_SIZE, **cuts) -> DataFrame:
    """P10: images to subtract over all fields, newest name first, in near-equal jobs of at most ``size``.

    The number of jobs is ceil(rows / size); no row count reaches the driver.
    """
    todo = images_to_subtract(science_candidates(images, **cuts), copies, refs, subs, failed, jobs, version)
    rows = ranking.number_rows(todo, F.col("basename").desc(), "id", name="_row", total="_total")
    n = F.greatest(F.lit(1), F.ceil(F.col("_total") / size))
    small, extra = F.floor(F.col("_total") / n), F.pmod(F.col("_total"), n)
    head = extra * (small + 1)
    job = F.when(F.col("_row") < head, F.floor(F.col("_row") / (small + 1))).otherwise(
        extra + F.floor(F.try_divide(F.col("_row") - head, small))
    )
    return rows.withColumn("job", job.cast("int")).drop("_row", "_total")


def plan_retrieval(ids: DataFrame, files: DataFrame, tape: DataFrame, http: DataFrame, archives: DataFrame,
                   n_jobs: int = K.RETRIEVAL_JOBS) -> DataFrame:
    """(id, location, job): tape files by their archive's job, then disk, then the remote archive.

    ``archives(path, tape, position)`` lists the tape archives.
    """
    wanted = files.join(ids.select("id"), "id", "left_semi")
    on_tape = tape_only_copies(wanted, tape, http).select("id", F.col("archive_id").alias("path"))
    jobs = ranking.round_robin_plan(archives.join(on_tape.select("path"), "path", "left_semi"), n_jobs)
    on_disk = http.select(F.col("product_id").alias("id"))
    # a file's job comes along in the grouping that locates it
    return locate(ids, on_tape.join(jobs.select("path", "job"), "path", "left"), on_disk, carry=["job"])


def download_list(ids: DataFrame, tape: DataFrame, http: DataFrame) -> DataFrame:
    """Ids that neither tape nor disk can serve."""
    return remaining_ids(ids, tape, http)
