"""Ranking, top-k and work plans."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom import constants as K
from skyloom.functions.naming import parse_basename, ref_name
from skyloom.functions.photometry import snr
from skyloom.operators.relational import KEY, images_needing_reference
from skyloom.operators.skew import number_rows


def deepest_images(
    images: DataFrame, refs: DataFrame, masks: DataFrame, version: str, n: int = K.REFERENCE_MAX_IMAGES
) -> DataFrame:
    """the ``n`` deepest images per key that lacks a reference, with their masks.

    Ties share a rank. The rank limit is applied on the map side too, so a hot key
    never gathers in one task.
    """
    todo = images_needing_reference(images, refs, version)
    depth = Window.partitionBy(*KEY).orderBy(F.col("maglimit").desc())
    best = todo.withColumn("rank", F.rank().over(depth)).filter(F.col("rank") <= n)
    return best.join(masks.select(F.col("parent_image_id").alias("id"), F.col("id").alias("mask_id")), "id")


def reference_plan(
    images: DataFrame, version: str, n: int = K.REFERENCE_MAX_IMAGES, n_min: int = K.REFERENCE_MIN_IMAGES
) -> DataFrame:
    """inputs of new references: the ``n`` deepest per key, if there are at least ``n_min``."""
    depth = Window.partitionBy(*KEY).orderBy(F.col("maglimit").desc(), "id")
    top = images.withColumn("row", F.row_number().over(depth)).filter(F.col("row") <= n)
    enough = top.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_inputs")).filter(F.col("n_inputs") >= n_min)
    name = ref_name(*[F.col(c) for c in KEY], version)
    return top.join(enough, KEY).withColumn("basename", name).select(*KEY, "basename", "id", "row", "n_inputs")


def update_source_position(sources: DataFrame, det: DataFrame) -> DataFrame:
    """move each source to its best detection; sources without detections stay.

    Sources may carry the signal to noise and id of their best detection so far
    (``best_snr``, ``best_id``, null if there is none): only a better one moves them then.
    """
    value = F.coalesce(snr(F.col("flux"), F.col("fluxerr")), F.lit(float("-inf")))
    best = det.filter("source_id is not null").groupBy("source_id").agg(
        F.max_by(F.struct("ra", "dec", value.alias("best_snr"), F.col("id").alias("best_id")), F.struct(value, -F.col("id"))).alias("_pos")
    )
    moved = sources.join(best.withColumnRenamed("source_id", "id"), "id", "left")
    better = F.col("_pos").isNotNull()
    carried = [c for c in ("best_snr", "best_id") if c in sources.columns]
    if len(carried) == 2:
        held, new = F.coalesce("best_snr", F.lit(float("-inf"))), F.col("_pos.best_snr")
        lower_id = (new == held) & (F.col("_pos.best_id") < F.col("best_id"))
        better = better & (F.col("best_id").isNull() | (new > held) | lower_id)
    return moved.withColumn("_better", better).withColumns(
        {c: F.when(F.col("_better"), F.coalesce(F.col(f"_pos.{c}"), F.col(c))).otherwise(F.col(c)) for c in ("ra", "dec", *carried)}
    ).select(*sources.columns)


def last_mjd(times: DataFrame) -> DataFrame:
    """time of each source's newest detection."""
    return times.groupBy("source_id").agg(F.max("mjd").alias("last_mjd"))


def closest_three(
    matches: DataFrame, keys: list[str], cols: dict[str, str], by: str = "sep", unique: str = "objid",
    fill: float | None = None, n: int = 3,
) -> DataFrame:
    """the ``n`` nearest matches per key side by side: ``cols`` maps column to output stem."""
    near = Window.partitionBy(*keys).orderBy(by, unique)
    top = matches.withColumn("_k", F.row_number().over(near)).filter(F.col("_k") <= n)
    # at most n rows per key are collected
    rows = top.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_k", *cols))).alias("_rows"))
    out = []
    for k in range(n):
        for col, stem in cols.items():
            value = F.get("_rows", F.lit(k))[col]
            out.append((F.coalesce(value, F.lit(fill)) if fill is not None else value).alias(f"{stem}{k + 1}"))
    return rows.select(*keys, *out)


def work_plan(df: DataFrame, n: int, *order: str | Column, name: str = "chunk") -> DataFrame:
    """``n`` contiguous, near-equal chunks (0-based); the first ``len % n`` get one row more.

    ``order`` must end in a unique column.
    """
    rows = number_rows(df, *order, name="_row", total="_total")
    small, extra = F.floor(F.col("_total") / n), F.col("_total") % n
    head = extra * (small + 1)
    chunk = F.when(F.col("_row") < head, F.floor(F.col("_row") / (small + 1))).otherwise(
        extra + F.floor(F.try_divide(F.col("_row") - head, small))
    )
    return rows.withColumn(name, chunk.cast("int")).drop("_row", "_total")


def chunk_count(rows: int, size: int = K.JOB_SIZE) -> int:
    return max(1, ceil(rows / size))


def fixed_batches(df: DataFrame, size: int, *order: str | Column, name: str = "chunk") -> DataFrame:
    """contiguous batches of ``size`` rows."""
    rows = number_rows(df, *order, name="_row")
    return rows.withColumn(name, F.floor(F.col("_row") / size).cast("int")).drop("_row")


def recursive_split(df: DataFrame, n: int, *order: str | Column, name: str = "chunk") -> DataFrame:
    """``n`` chunks cut off one after the other as ``remaining // chunks left``; extras go last."""
    rows = number_rows(df, *order, name="_row", total="_total")
    small, extra = F.floor(F.col("_total") / n), F.col("_total") % n
    plain = (F.lit(n) - extra) * small
    chunk = F.when(F.col("_row") < plain, F.floor(F.try_divide(F.col("_row"), small))).otherwise(
        F.lit(n) - extra + F.floor((F.col("_row") - plain) / (small + 1))
    )
    return rows.withColumn(name, chunk.cast("int")).drop("_row", "_total")


def round_robin_plan(archives: DataFrame, n: int = K.RETRIEVAL_JOBS) -> DataFrame:
    """F8: archives in tape order dealt to ``n`` jobs; the position is compared as text."""
    rows = number_rows(archives.withColumn("position", F.col("position").cast("string")), "tape", "position", "path",
                       name="row")
    return rows.withColumn("job", (F.col("row") % n).cast("int"))


def newest_first_limit(df: DataFrame, n: int, name: str = "basename") -> DataFrame:
    """the ``n`` newest rows by the time in their name (compared as text), then by name.

    The cut is found by counting, per day and then per time of the day it falls in, so no
    task holds ``n`` rows: newer rows are a filter, and only the rows of the very time of the
    cut are numbered by name. The result comes sorted.
    """
    if n <= 0:
        return df.limit(0)
    timed = df.withColumn("_time", parse_basename(F.col(name))["time"])
    order = [F.col("_time").desc_nulls_last(), F.col(name).desc_nulls_last()]
    newest = Window.orderBy(F.col("_at").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)

    def cut(rows: DataFrame, at: Column, wanted: int):
        """(value, rows before it) where the count from the newest on reaches ``wanted``."""
        counted = rows.groupBy(at.alias("_at")).agg(F.count(F.lit(1)).alias("_n")).withColumn("_upto", F.sum("_n").over(newest))
        reached = counted.filter(F.col("_upto") >= wanted).orderBy("_upto")
        return reached.select("_at", (F.col("_upto") - F.col("_n")).alias("_before")).first()

    day = F.substring("_time", 1, 8)
    last_day = cut(timed, day, n)
    if last_day is None:  # there are fewer
        return timed.orderBy(*order).drop("_time")
    last = cut(timed.filter(day.eqNullSafe(F.lit(last_day[0]))), F.col("_time"), n - last_day[1])
    newer = timed.filter("_time is not null" if last[0] is None else F.col("_time") > last[0])
    ties = timed.filter(F.col("_time").eqNullSafe(F.lit(last[0]))).withColumn("_tie", F.monotonically_increasing_id())
    ties = number_rows(ties, F.col(name).desc_nulls_last(), "_tie", name="_row").filter(F.col("_row") < n - last_day[1] - last[1])
    return newer.unionByName(ties.drop("_tie", "_row")).orderBy(*order).drop("_time")


def order_by_size(plan: DataFrame) -> DataFrame:
    """largest stacks first, key order inside."""
    return plan.orderBy(F.col("size").desc(), *KEY, "binleft")


