"""Set operations and table maintenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.functions.naming import archive_path, archive_url, dr8_url, relname, sdss_url
from skyloom.functions.times import jd_to_mjd, julian_day
from skyloom.session import store


def detection_times(
    det: DataFrame, single_subs: DataFrame, images: DataFrame, stack_subs: DataFrame, stacks: DataFrame
) -> DataFrame:
    """G1: (id, source_id, mjd) of associated detections, single-epoch and stacked together.

    A stack detection is dated by the integer Julian day of its bin's right edge.
    """
    own = det.filter("source_id is not null").select("id", "source_id", "image_id")
    single = single_subs.select(F.col("id").alias("image_id"), "target_image_id").join(
        images.select(F.col("id").alias("target_image_id"), jd_to_mjd(F.col("obsjd")).alias("mjd")), "target_image_id")
    day = jd_to_mjd(julian_day(F.col("binright")).cast("double"))
    multi = stack_subs.select(F.col("id").alias("image_id"), "target_image_id").join(
        stacks.select(F.col("id").alias("target_image_id"), day.alias("mjd")), "target_image_id")
    epochs = single.select("image_id", "mjd").unionByName(multi.select("image_id", "mjd"))
    return own.join(epochs, ["image_id"]).select("id", "source_id", "mjd")


def _listed(ids: DataFrame, lists: dict[str, DataFrame], key: str, carry: list[str] | None = None) -> DataFrame:
    """Each wanted id once, with a flag for each of ``lists`` that has it; a null id is on no list.

    One grouping, combined before the shuffle, instead of a join with each list: a task holds one
    small row per id and sorts nothing. ``carry`` are columns of the first list, the smallest value
    of each id.
    """
    first, carry = next(iter(lists), None), carry or []
    marks = lambda name: [F.lit(n == name).alias(n) for n in ("_wanted", *lists)] + [
        (F.col(c) if name == first else F.lit(None).cast(lists[first].schema[c].dataType)).alias(c) for c in carry]
    rows = ids.select(key, *marks("_wanted"))
    for name, part in lists.items():
        rows = rows.unionByName(part.filter(F.col(key).isNotNull()).select(key, *marks(name)))
    flags = [F.max(n).alias(n) for n in ("_wanted", *lists)]
    out = rows.groupBy(key).agg(*flags, *[F.min(c).alias(c) for c in carry]).filter("_wanted")
    return out.select(F.col(key).cast(ids.schema[key].dataType).alias(key), *lists, *carry)


def remaining_ids(ids: DataFrame, *found: DataFrame, key: str = "id") -> DataFrame:
    """Wanted ids that none of the ``found`` lists has."""
    lists = {f"_found{i}": part for i, part in enumerate(found)}
    out = _listed(ids, lists, key)
    for name in lists:
        out = out.filter(~F.col(name))
    return out.select(key)


def locate(ids: DataFrame, tape: DataFrame, http: DataFrame, key: str = "id", carry: list[str] | None = None) -> DataFrame:
    """Where to fetch each id from: tape before disk before the remote archive.

    ``carry`` adds columns of ``tape``, the smallest value of each id.
    """
    out = _listed(ids, {"_tape": tape, "_http": http}, key, carry)
    where = F.when(F.col("_tape"), "tape").when(F.col("_http"), "http").otherwise("remote").alias("location")
    return out.select(key, where, *(carry or []))


def upsert(base: DataFrame, updates: DataFrame, key: str | list[str], now: Column, modified: str = "modified") -> DataFrame:
    """Updates replace rows with the same key, one column or several, and add new ones.

    A null in an update keeps the old value; ``modified`` becomes ``now`` for rows
    that are new or really change. ``updates`` has at most one row per key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    values = [c for c in base.columns if c not in (*keys, modified)]
    new = updates.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in values if c in updates.columns], F.lit(True).alias("_hit"))
    old = base.withColumn("_old", F.lit(True))
    both = old.join(new, keys, "full")
    changed = F.col("_hit").isNotNull() & F.col("_old").isNull()
    out = {}
    for c in values:
        if c in updates.columns:
            fresh = F.col(f"_new_{c}")
            changed = changed | (fresh.isNotNull() & ~F.col(c).eqNullSafe(fresh))
            out[c] = F.coalesce(fresh, F.col(c))
        else:
            out[c] = F.col(c)
    out[modified] = F.when(changed, now).otherwise(F.col(modified))
    return both.select(*[out.get(c, F.col(c)).alias(c) for c in base.columns])


def rewrite_ranges(rows: DataFrame, path: str, part: str) -> None:
    """Replace the partitions ``part`` that occur in ``rows`` in the table at ``path``, and no others.

    The new files lie beside the old ones until all of them are written; a job that fails
    before leaves the table as it was.
    """
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)


def _touched(path: str, updates: DataFrame, part: str, schema: T.StructType) -> DataFrame:
    """The table's rows in the key ranges that ``updates`` falls into; other folders are not opened."""
    ranges = [r[0] for r in updates.select(part).distinct().collect()]  # key ranges of one update
    known = F.col(part).isin([r for r in ranges if r is not None])
    return updates.sparkSession.read.schema(schema).parquet(path).filter(known | F.col(part).isNull() if None in ranges else known)


def upsert_ranges(path: str, updates: DataFrame, key: str | list[str], part: str, schema: T.StructType, now: Column, modified: str = "modified") -> None:
    """G3 on a stored table partitioned by ``part``, a function of the key: only touched partitions are read and written.

    ``schema`` is that of the table, ``part`` included; ``updates`` carries ``part`` too.
    """
    updates = store(updates)
    old = _touched(path, updates, part, schema)
    # a row's range follows from its key, so it is the same on both sides
    rewrite_ranges(store(upsert(old, updates, key, now, modified)), path, part)


def merge_photometry_ranges(path: str, new: DataFrame, part: str, schema: T.StructType, images: DataFrame, sources: DataFrame) -> None:
    """G4 on a stored table partitioned by ``part``, a function of (source, image): only touched partitions are read and written."""
    new = store(new)
    rewrite_ranges(store(merge_photometry(_touched(path, new, part, schema), new, images, sources)), path, part)


def merge_photometry(old: DataFrame, new: DataFrame, images: DataFrame, sources: DataFrame) -> DataFrame:
    """Existing and new measurements; unique per (source, image), with both parents known.

    Reading the result raises when a pair occurs twice. Rows of unknown images or
    sources are not accepted. Write the result to a new path and switch to it.
    """
    accepted = new.join(images.select(F.col("id").alias("image_id")), ["image_id"], "left_semi")
    accepted = accepted.join(sources.select(F.col("id").alias("source_id")), ["source_id"], "left_semi")
    both = old.unionByName(accepted, allowMissingColumns=True)
    twice = both.groupBy("source_id", "image_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    checked = both.join(twice, ["source_id", "image_id"], "left")
    message = F.concat_ws(" ", F.lit("duplicate photometry of source"), "source_id", F.lit("on image"), F.col("image_id").cast("string"))
    ok = F.when(F.col("_n").isNotNull(), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return checked.filter(ok).drop("_n").select(*both.columns)


def update_from_join(base: DataFrame, updates: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """``cols`` taken from the matching update row where there is one."""
    new = updates.select(key, *[F.col(c).alias(f"_new_{c}") for c in cols], F.lit(True).alias("_hit"))
    both = base.join(new, [key], "left")
    return both.select(
        *[F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c) for c in base.columns]
    )


def not_in(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in a known list."""
    return df.join(known.select(key), key, "left_anti")


def publish_copies(products: DataFrame, copies: DataFrame, root: str, url_root: str) -> DataFrame:
    """Copy rows (product_id, archive_path, url) for products whose URL is not registered yet."""
    path = archive_path(root, relname(*[F.col(c) for c in ("field", "ccdid", "qid", "fid", "basename")]))
    rows = products.select(F.col("id").alias("product_id"), path.alias("archive_path"))
    rows = rows.withColumn("url", archive_url(F.col("archive_path"), root, url_root))
    return rows.join(copies.select("url"), "url", "left_anti").select("product_id", "archive_path", "url")


def record_failures(failures: DataFrame, refs: DataFrame, images: DataFrame, version: str) -> DataFrame:
    """(target_image_id, reference_image_id, reason) rows that keep images out of later plans."""
    key = ["field", "ccdid", "qid", "fid"]
    first = refs.filter(F.col("version") == version).groupBy(*key).agg(F.min("id").alias("reference_image_id"))
    rows = failures.select(F.col("image_id").alias("id"), "reason").join(images.select("id", *key), "id")
    return rows.join(first, key, "left").select(F.col("id").alias("target_image_id"), "reference_image_id", "reason")


def link_new_sources(sources: DataFrame) -> DataFrame:
    """Two linked thumbnails (survey cutout URLs) per new source."""
    sdss = sources.select(F.col("id").alias("source_id"), F.lit("sdss").alias("type"),
                          sdss_url(F.col("ra"), F.col("dec")).alias("public_url"))
    dr8 = sources.select(F.col("id").alias("source_id"), F.lit("dr8").alias("type"),
                         dr8_url(F.col("ra"), F.col("dec")).alias("public_url"))
    return sdss.unionByName(dr8)


def repoint_cutouts(thumbnails: DataFrame, best: DataFrame) -> DataFrame:
    """Cutouts of each source's best detection now belong to the source.

    ``best(detection_id, source_id)``.
    """
    return update_from_join(thumbnails, best, "detection_id", ["source_id"])
