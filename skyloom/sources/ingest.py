"""Reading tables and new metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.functions.naming import ipac_basename
from skyloom.operators.aggregates import high_water
from skyloom.sources.schemas import PHOTOMETRY_CSV, table_schema

# --- fixed values: metadata columns that are not kept; start of an empty archive
DROPPED = ("imgtype", "ipac_pub_date", "rcid")
FIRST_NID = 411


def scan_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A1: a declared table; a file that does not fit the schema fails when read."""
    return spark.read.schema(table_schema(name)).parquet(path)


def ingest_metadata_incremental(new: DataFrame, existing: DataFrame, key: str | list[str] = "basename") -> DataFrame:
    """A2: metadata rows from the newest known night on that are not known yet.

    Names are derived when the rows do not carry one, and compared with all known
    names. Where a name alone does not tell images apart, ``key`` lists it first and the
    other columns that do behind it. The newest night is one scalar subquery.
    """
    keys = [key] if isinstance(key, str) else list(key)
    mark = high_water(existing).select(F.coalesce("nid", F.lit(FIRST_NID))).scalar()
    rows = new.filter((F.col("nid") >= mark) & (F.col("ipac_gid") > 0)).drop(*DROPPED)
    if keys[0] not in rows.columns:
        name = ipac_basename(*[F.col(c) for c in ("filefracday", "field", "filtercode", "ccdid", "imgtypecode", "qid")],
                             "sciimg.fits")
        rows = rows.withColumn(keys[0], name)
    return rows.dropDuplicates(keys).join(existing.select(*keys), keys, "left_anti")


def derive_masks(images: DataFrame) -> DataFrame:
    """A3: one mask row per image, with its partition key, centre and corners."""
    carried = ["field", "ccdid", "qid", "fid", "ra", "dec"] + [f"{a}{i}" for i in (1, 2, 3, 4) for a in ("ra", "dec")]
    return images.select(
        F.col("id").alias("parent_image_id"),
        F.replace("basename", F.lit("sciimg"), F.lit("mskimg")).alias("basename"),
        *[c for c in carried if c in images.columns],
    )


def chunk_ranges(spark: SparkSession, lo: float, hi: float, width: float = 30) -> DataFrame:
    """A4: half-open fetch windows ``[lo, hi)`` of ``width`` that cover a span."""
    n = int((hi - lo) // width) + 1
    return spark.range(n).select(
        (F.col("id") * width + lo).cast("double").alias("lo"), ((F.col("id") + 1) * width + lo).cast("double").alias("hi")
    )


def load_photometry_csv(spark: SparkSession, path: str) -> DataFrame:
    """A5: forced photometry from CSV with a header, columns in fixed order."""
    return spark.read.csv(path, schema=PHOTOMETRY_CSV, header=True, enforceSchema=False, mode="FAILFAST")


def catalog_to_detections(catalog: DataFrame, only_good: bool = True, rb_version: str = "model") -> tuple[DataFrame, DataFrame]:
    """Detection rows and their real/bogus rows from an object catalog.

    ``catalog`` carries a unique ``id``, the columns below and ``goodcut`` (1/0 or boolean).
    """
    rows = catalog
    if only_good:
        rows = catalog.filter(F.col("goodcut").cast("int") == 1)
    shape = ["elongation", "a_image", "b_image", "fwhm_image", "x_image", "y_image"]
    det = rows.select(
        "id", "image_id",
        F.col("x_world").cast("double").alias("ra"), F.col("y_world").cast("double").alias("dec"),
        F.col("flux_aper").cast("double").alias("flux"), F.col("fluxerr_aper").cast("double").alias("fluxerr"),
        *[F.col(c).cast("double").alias(c) for c in shape],
        F.col("flags").cast("int").alias("flags"), F.col("imaflags_iso").cast("int").alias("imaflags_iso"),
        F.lit(True if only_good else None).cast("boolean").alias("goodcut"),
    )
    scores = rows.select(
        F.col("id").alias("detection_id"), F.col("rb").cast("double").alias("rb_score"), F.lit(rb_version).alias("rb_version")
    )
    return det, scores
