"""Domain frames derived from the given tables, and the same views as SQL text.

Each frame has a twin in ``VIEWS``; ``sql(...)`` puts the needed ones in front of a query.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.functions import naming
from skyloom.functions.times import ts_to_mjd
from skyloom.session import tune

VERSION = "v1"
SHIFT_DAYS = 8036  # moves the order dates to 2017 and later


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    tune(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def detections(spark, sf) -> DataFrame:
    """One detection per event; ``user_id`` is the true object."""
    return table(spark, sf, "events").selectExpr(
        "event_id AS id", "user_id",
        "((user_id * 137.50776405e0) % 360e0 + ((event_id % 7) - 3) * 1e-4 + 360e0) % 360e0 AS ra",
        "(user_id * 7.31e0) % 120e0 - 60e0 + ((event_id % 5) - 2) * 1e-4 AS dec",
        "value AS flux", "1e0 + (event_id % 5) AS fluxerr",
        "CAST(event_id % 3 + 1 AS INT) AS fid", "CAST(event_id % 4 AS INT) AS flags",
        "CASE WHEN event_id % 11 = 0 THEN 256 WHEN event_id % 13 = 0 THEN 2 ELSE 0 END AS imaflags_iso",
        "2e0 + (event_id % 9) * 0.3e0 AS a_image", "2e0 AS b_image",
        "1.5e0 + (event_id % 20) * 0.17e0 AS fwhm_image", "2e0 AS seeing",
        "(event_id * 0.6180339887e0) % 1e0 AS rb", "CAST(floor(event_id / 6) AS BIGINT) * 9 + event_id % 3 AS image_id",
        "CASE WHEN event_id % 17 = 0 THEN 1 ELSE 0 END AS flags_weight",
        "CASE WHEN user_id % 2 = 0 AND event_id % 3 = 0 THEN CONCAT('S', user_id) END AS source_id",
        "CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_id % 4 = 1 END AS alert_ready",
        "event_id % 3 <> 1 AS triggers_alert",
        "ts AS created_at",
    ).withColumn("mjd", ts_to_mjd(F.col("created_at")))


def sources(spark, sf) -> DataFrame:
    """Known sources: even objects only, so the others must be clustered."""
    return table(spark, sf, "events").select("user_id").distinct().filter("user_id % 2 = 0").selectExpr(
        "CONCAT('S', user_id) AS id", "user_id",
        "(user_id * 137.50776405e0) % 360e0 AS ra", "(user_id * 7.31e0) % 120e0 - 60e0 AS dec",
    )


def catalog(spark, sf) -> DataFrame:
    """Reference catalog: fourteen neighbours north of each object, 1.08 arcsec apart."""
    return table(spark, sf, "part").selectExpr(
        "p_partkey AS objid", "CAST(floor(p_partkey / 14) AS BIGINT) AS user_id",
        "(CAST(floor(p_partkey / 14) AS BIGINT) * 137.50776405e0) % 360e0 AS ra",
        "(CAST(floor(p_partkey / 14) AS BIGINT) * 7.31e0) % 120e0 - 60e0 + (p_partkey % 14) * 3e-4 + 1e-4 AS dec",
        "CASE WHEN p_type = 'SMALL' THEN 'PSF' ELSE 'REX' END AS type",
        "p_retailprice / 100e0 AS flux_g", "p_retailprice / 90e0 - 10e0 AS flux_r", "p_retailprice / 80e0 AS flux_z",
        "p_retailprice / 70e0 AS flux_w1", "p_retailprice / 60e0 AS flux_w2", "p_retailprice / 50e0 AS flux_w3",
        "p_retailprice / 40e0 AS flux_w4",
        "CAST(p_size - 25 AS DOUBLE) AS parallax", "10e0 + p_size * 0.3e0 AS phot_g_mean_mag",
        "10e0 + p_size * 0.3e0 AS gaia_phot_g_mean_mag",
        "(p_partkey % 9) / 20e0 AS fracmasked_g", "(p_partkey % 8) / 40e0 AS fracmasked_r", "0e0 AS fracmasked_z",
        "(p_partkey % 10) / 9e0 AS probpsf", "14e0 + p_size * 0.15e0 AS psfmag_r",
        "CASE WHEN p_partkey % 3 = 0 THEN -99e0 ELSE p_size / 100e0 END AS z_spec",
        "p_size / 80e0 AS z_phot_median", "p_size / 81e0 AS z_phot_mean", "0.1e0 AS z_phot_std",
        "p_size / 90e0 AS z_phot_l68", "p_size / 70e0 AS z_phot_u68",
        "p_size / 95e0 AS z_phot_l95", "p_size / 65e0 AS z_phot_u95", "p_size / 500e0 AS ebv",
        "p_name AS name",
    )


def images(spark, sf) -> DataFrame:
    """Science images, a hundred with a footprint around each object."""
    rows = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS id",
        "CAST(600 + CAST(floor(o_orderkey / 48) AS BIGINT) % 4 AS INT) AS field",
        "CAST(1 + o_orderkey % 4 AS INT) AS ccdid",
        "CAST(1 + CAST(floor(o_orderkey / 4) AS BIGINT) % 4 AS INT) AS qid",
        "CAST(1 + CAST(floor(o_orderkey / 16) AS BIGINT) % 3 AS INT) AS fid",
        f"timestampadd(DAY, {SHIFT_DAYS}, o_orderdate) AS obsdate",
        "1.2e0 + (o_orderkey % 31) * 0.1e0 AS seeing", "18e0 + o_totalprice % 5e0 AS maglimit",
        "CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS infobits", "30e0 + o_orderkey % 3 AS exptime",
        "CAST(o_orderkey % 3 AS INT) AS ipac_gid", "'o' AS imgtypecode",
        "(CAST(floor(o_orderkey / 100) AS BIGINT) * 137.50776405e0) % 360e0 AS ra", "(CAST(floor(o_orderkey / 100) AS BIGINT) * 7.31e0) % 120e0 - 60e0 AS dec",
        "26e0 + (o_orderkey % 7) * 0.1e0 AS magzp", "0.05e0 AS apcor", "CAST(floor(o_orderkey / 100) AS BIGINT) AS obj",
    )
    rows = rows.withColumns({
        "obsjd": ts_to_mjd(F.col("obsdate")) + 2400000.5,
        "filtercode": naming.band(F.col("fid")),
        "filefracday": F.date_format("obsdate", "yyyyMMdd").cast("long") * 1000000 + F.col("id") % 1000000,
        "kidx": F.expr("(field - 600) * 48 + (ccdid - 1) * 12 + (qid - 1) * 3 + (fid - 1)"),
    })
    rows = rows.withColumns({
        "nid": F.floor(F.col("obsjd") - 2457754.5).cast("int"),
        "basename": naming.ipac_basename(*[F.col(c) for c in ("filefracday", "field", "filtercode", "ccdid", "imgtypecode", "qid")],
                                         "sciimg.fits"),
        "stack_id": F.expr(f"5000000 + kidx * 100 + CAST(floor(datediff(CAST(obsdate AS DATE), DATE '2017-01-01') / 90) AS INT)"),
    })
    half = F.expr("0.3e0 / cos(radians(dec))")
    return rows.withColumns({
        "ra1": F.col("ra") - half, "dec1": F.col("dec") - 0.3, "ra2": F.col("ra") + half, "dec2": F.col("dec") - 0.3,
        "ra3": F.col("ra") + half, "dec3": F.col("dec") + 0.3, "ra4": F.col("ra") - half, "dec4": F.col("dec") + 0.3,
    })


def refs(spark, sf) -> DataFrame:
    """A reference for every second partition key."""
    return images(spark, sf).filter("kidx % 2 = 0").select("kidx", "field", "ccdid", "qid", "fid").distinct().selectExpr(
        "9000000 + kidx AS id", "field", "ccdid", "qid", "fid", f"'{VERSION}' AS version",
        "CONCAT('ref.', kidx, '.fits') AS basename",
    )


def subs(spark, sf) -> DataFrame:
    """Single-epoch differences."""
    return images(spark, sf).filter("id % 4 = 0").selectExpr(
        "1000000 + id AS id", "id AS target_image_id", "9000000 + kidx AS reference_image_id",
        "CONCAT('sub.', basename) AS basename", "field", "ccdid", "qid", "fid",
    )


def stack_bridge(spark, sf) -> DataFrame:
    return images(spark, sf).selectExpr("stack_id AS coadd_id", "id AS image_id")


def ref_bridge(spark, sf) -> DataFrame:
    return images(spark, sf).filter("id % 3 = 0").selectExpr("9000000 + kidx AS coadd_id", "id AS image_id")


def stacks(spark, sf) -> DataFrame:
    """Quarterly stacks with the right edge of their bin."""
    return images(spark, sf).groupBy("stack_id", "kidx").agg(F.count(F.lit(1)).alias("n")).selectExpr(
        "stack_id AS id", "kidx",
        "timestampadd(DAY, CAST(((stack_id - 5000000) % 100 + 1) * 90 AS INT), TIMESTAMP_NTZ '2017-01-01 00:00:00') AS binright",
    )


def stack_subs(spark, sf) -> DataFrame:
    return stacks(spark, sf).filter("id % 2 = 0").selectExpr(
        "2000000 + id AS id", "id AS target_image_id", "9000000 + kidx AS reference_image_id",
        "CONCAT('sub.stack.', id) AS basename",
        "CAST(600 + floor(kidx / 48) AS INT) AS field", "CAST(1 + floor(kidx % 48 / 12) AS INT) AS ccdid",
        "CAST(1 + floor(kidx % 12 / 3) AS INT) AS qid", "CAST(1 + kidx % 3 AS INT) AS fid",
    )


def placed_detections(spark, sf) -> DataFrame:
    """Detections on difference images (every fifth on a stack), all with a source."""
    det = detections(spark, sf).drop("image_id", "source_id")
    target = images(spark, sf).selectExpr("id AS iid", "stack_id")
    rows = det.withColumn("iid", F.expr("CAST(floor(id / 6) AS BIGINT) * 9 + id % 3")).join(target, "iid")
    image = F.expr("CASE WHEN id % 5 = 0 THEN 2000000 + stack_id ELSE 1000000 + iid - iid % 4 END")
    return rows.withColumns({
        "image_id": image, "source_id": F.concat(F.lit("S"), F.col("user_id")),
        "x_image": F.expr("1e0 + id % 3000"), "y_image": F.expr("1e0 + id % 2900"),
        "elongation": F.expr("a_image / b_image"),
    }).drop("iid", "stack_id")


def realbogus(spark, sf) -> DataFrame:
    return detections(spark, sf).selectExpr("id", "id AS detection_id", "rb AS rb_score", "'m1' AS rb_version")


def photometry(spark, sf) -> DataFrame:
    return table(spark, sf, "events").selectExpr(
        "event_id AS id", "CONCAT('S', user_id) AS source_id", "event_id AS image_id", "value AS flux",
        "1e0 + event_id % 5 AS fluxerr", "CAST(event_id % 4 AS INT) AS flags", "0e0 AS ra", "0e0 AS dec",
        "25e0 + (event_id % 4) * 0.1e0 AS zp", "CASE WHEN event_id % 2 = 0 THEN 'zg' ELSE 'zr' END AS filtercode",
        "2457754.75e0 + (event_id * 37) % 2400 AS obsjd",
    )


def pixels(spark, sf) -> DataFrame:
    """Each vector is an aligned 8x8 image; ``grp`` is its stack."""
    rows = table(spark, sf, "embeddings").select("vec_id", "label", F.posexplode("embedding").alias("pos", "v"))
    return rows.selectExpr(
        "vec_id AS image_id", "label AS grp", "CAST(pos % 8 AS INT) AS x", "CAST(floor(pos / 8) AS INT) AS y",
        "100e0 * CAST(v AS DOUBLE) AS value", "1e0 + (pos % 3) * 0.5e0 AS rms",
        "CASE WHEN (vec_id + pos) % 17 = 0 THEN 256 WHEN (vec_id + pos) % 19 = 0 THEN 2 ELSE 0 END AS mask",
    )


def pixel_positions(spark, sf) -> DataFrame:
    """Measuring positions on the pixel images, half a pixel apart."""
    n = table(spark, sf, "embeddings").select("vec_id")
    det = table(spark, sf, "events").selectExpr("event_id AS id", f"event_id % {n.count()} AS vec_id",
                                                "(event_id % 13) * 0.5e0 + 0.5e0 AS x", "(event_id % 11) * 0.5e0 + 1e0 AS y")
    return det.join(n, "vec_id").select("id", F.col("vec_id").alias("image_id"), "x", "y")



VIEWS = {
    "v_det": """SELECT *, epoch_us(created_at) / 86400e6 + 40587e0 AS mjd FROM (SELECT event_id AS id, user_id,
      ((user_id * 137.50776405e0) % 360e0 + ((event_id % 7) - 3) * 1e-4 + 360e0) % 360e0 AS ra,
      (user_id * 7.31e0) % 120e0 - 60e0 + ((event_id % 5) - 2) * 1e-4 AS dec,
      value AS flux, 1e0 + (event_id % 5) AS fluxerr,
      CAST(event_id % 3 + 1 AS INT) AS fid, CAST(event_id % 4 AS INT) AS flags,
      CASE WHEN event_id % 11 = 0 THEN 256 WHEN event_id % 13 = 0 THEN 2 ELSE 0 END AS imaflags_iso,
      2e0 + (event_id % 9) * 0.3e0 AS a_image, 2e0 AS b_image,
      1.5e0 + (event_id % 20) * 0.17e0 AS fwhm_image, 2e0 AS seeing,
      (event_id * 0.6180339887e0) % 1e0 AS rb, CAST(floor(event_id / 6) AS BIGINT) * 9 + event_id % 3 AS image_id,
      CASE WHEN event_id % 17 = 0 THEN 1 ELSE 0 END AS flags_weight,
      CASE WHEN user_id % 2 = 0 AND event_id % 3 = 0 THEN CONCAT('S', user_id) END AS source_id,
      CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_id % 4 = 1 END AS alert_ready,
      event_id % 3 <> 1 AS triggers_alert, ts AS created_at FROM events)""",
    "v_src": """SELECT CONCAT('S', user_id) AS id, user_id, (user_id * 137.50776405e0) % 360e0 AS ra,
      (user_id * 7.31e0) % 120e0 - 60e0 AS dec FROM (SELECT DISTINCT user_id FROM events) u WHERE user_id % 2 = 0""",
    "v_cat": """SELECT p_partkey AS objid, CAST(floor(p_partkey / 14) AS BIGINT) AS user_id,
      (CAST(floor(p_partkey / 14) AS BIGINT) * 137.50776405e0) % 360e0 AS ra,
      (CAST(floor(p_partkey / 14) AS BIGINT) * 7.31e0) % 120e0 - 60e0 + (p_partkey % 14) * 3e-4 + 1e-4 AS dec,
      CASE WHEN p_type = 'SMALL' THEN 'PSF' ELSE 'REX' END AS type,
      p_retailprice / 100e0 AS flux_g, p_retailprice / 90e0 - 10e0 AS flux_r, p_retailprice / 80e0 AS flux_z,
      p_retailprice / 70e0 AS flux_w1, p_retailprice / 60e0 AS flux_w2, p_retailprice / 50e0 AS flux_w3,
      p_retailprice / 40e0 AS flux_w4,
      CAST(p_size - 25 AS DOUBLE) AS parallax, 10e0 + p_size * 0.3e0 AS phot_g_mean_mag,
      10e0 + p_size * 0.3e0 AS gaia_phot_g_mean_mag,
      (p_partkey % 9) / 20e0 AS fracmasked_g, (p_partkey % 8) / 40e0 AS fracmasked_r, 0e0 AS fracmasked_z,
      (p_partkey % 10) / 9e0 AS probpsf, 14e0 + p_size * 0.15e0 AS psfmag_r,
      CASE WHEN p_partkey % 3 = 0 THEN -99e0 ELSE p_size / 100e0 END AS z_spec,
      p_size / 80e0 AS z_phot_median, p_size / 81e0 AS z_phot_mean, 0.1e0 AS z_phot_std,
      p_size / 90e0 AS z_phot_l68, p_size / 70e0 AS z_phot_u68,
      p_size / 95e0 AS z_phot_l95, p_size / 65e0 AS z_phot_u95, p_size / 500e0 AS ebv, p_name AS name FROM part""",
    "v_img0": f"""SELECT o_orderkey AS id, 600 + CAST(floor(o_orderkey / 48) AS BIGINT) % 4 AS field,
      1 + o_orderkey % 4 AS ccdid, 1 + CAST(floor(o_orderkey / 4) AS BIGINT) % 4 AS qid,
      1 + CAST(floor(o_orderkey / 16) AS BIGINT) % 3 AS fid,
      o_orderdate + INTERVAL {SHIFT_DAYS} DAY AS obsdate,
      1.2e0 + (o_orderkey % 31) * 0.1e0 AS seeing, 18e0 + o_totalprice % 5e0 AS maglimit,
      CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS infobits, 30e0 + o_orderkey % 3 AS exptime,
      CAST(o_orderkey % 3 AS INT) AS ipac_gid, 'o' AS imgtypecode,
      (CAST(floor(o_orderkey / 100) AS BIGINT) * 137.50776405e0) % 360e0 AS ra, (CAST(floor(o_orderkey / 100) AS BIGINT) * 7.31e0) % 120e0 - 60e0 AS dec,
      26e0 + (o_orderkey % 7) * 0.1e0 AS magzp, 0.05e0 AS apcor, CAST(floor(o_orderkey / 100) AS BIGINT) AS obj FROM orders""",
    "v_img1": """SELECT *, epoch_us(obsdate) / 86400e6 + 2440587.5e0 AS obsjd,
      CASE fid WHEN 1 THEN 'zg' WHEN 2 THEN 'zr' ELSE 'zi' END AS filtercode,
      CAST(strftime(obsdate, '%Y%m%d') AS BIGINT) * 1000000 + id % 1000000 AS filefracday,
      (field - 600) * 48 + (ccdid - 1) * 12 + (qid - 1) * 3 + (fid - 1) AS kidx FROM v_img0""",
    "v_img": """SELECT *, CAST(floor(obsjd - 2457754.5e0) AS INT) AS nid,
      CONCAT('ztf_', filefracday, '_', lpad(CAST(field AS VARCHAR), 6, '0'), '_', filtercode, '_c',
        lpad(CAST(ccdid AS VARCHAR), 2, '0'), '_o_q', qid, '_sciimg.fits') AS basename,
      5000000 + kidx * 100 + CAST(floor(date_diff('day', DATE '2017-01-01', CAST(obsdate AS DATE)) / 90) AS INT) AS stack_id,
      ra - 0.3e0 / cos(radians(dec)) AS ra1, dec - 0.3e0 AS dec1, ra + 0.3e0 / cos(radians(dec)) AS ra2, dec - 0.3e0 AS dec2,
      ra + 0.3e0 / cos(radians(dec)) AS ra3, dec + 0.3e0 AS dec3, ra - 0.3e0 / cos(radians(dec)) AS ra4, dec + 0.3e0 AS dec4
      FROM v_img1""",
    "v_ref": f"""SELECT DISTINCT 9000000 + kidx AS id, field, ccdid, qid, fid, '{VERSION}' AS version,
      CONCAT('ref.', kidx, '.fits') AS basename FROM v_img WHERE kidx % 2 = 0""",
    "v_sub": """SELECT 1000000 + id AS id, id AS target_image_id, 9000000 + kidx AS reference_image_id,
      CONCAT('sub.', basename) AS basename, field, ccdid, qid, fid FROM v_img WHERE id % 4 = 0""",
    "v_sbr": "SELECT stack_id AS coadd_id, id AS image_id FROM v_img",
    "v_rbr": "SELECT 9000000 + kidx AS coadd_id, id AS image_id FROM v_img WHERE id % 3 = 0",
    "v_stk": """SELECT stack_id AS id, kidx,
      TIMESTAMP '2017-01-01 00:00:00' + to_days(CAST(((stack_id - 5000000) % 100 + 1) * 90 AS INT)) AS binright
      FROM v_img GROUP BY stack_id, kidx""",
    "v_ssub": """SELECT 2000000 + id AS id, id AS target_image_id, 9000000 + kidx AS reference_image_id,
      CONCAT('sub.stack.', id) AS basename, CAST(600 + floor(kidx / 48) AS INT) AS field,
      CAST(1 + floor(kidx % 48 / 12) AS INT) AS ccdid, CAST(1 + floor(kidx % 12 / 3) AS INT) AS qid,
      CAST(1 + kidx % 3 AS INT) AS fid FROM v_stk WHERE id % 2 = 0""",
    "v_pdet": """SELECT d.* EXCLUDE (image_id, source_id), CASE WHEN d.id % 5 = 0 THEN 2000000 + i.stack_id
        ELSE 1000000 + i.id - i.id % 4 END AS image_id, CONCAT('S', d.user_id) AS source_id,
      1e0 + d.id % 3000 AS x_image, 1e0 + d.id % 2900 AS y_image, a_image / b_image AS elongation
      FROM v_det d JOIN v_img i ON i.id = CAST(floor(d.id / 6) AS BIGINT) * 9 + d.id % 3""",
    "v_rb": "SELECT id, id AS detection_id, rb AS rb_score, 'm1' AS rb_version FROM v_det",
    "v_phot": """SELECT event_id AS id, CONCAT('S', user_id) AS source_id, event_id AS image_id, value AS flux,
      1e0 + event_id % 5 AS fluxerr, CAST(event_id % 4 AS INT) AS flags, 0e0 AS ra, 0e0 AS dec,
      25e0 + (event_id % 4) * 0.1e0 AS zp, CASE WHEN event_id % 2 = 0 THEN 'zg' ELSE 'zr' END AS filtercode,
      2457754.75e0 + (event_id * 37) % 2400 AS obsjd FROM events""",
    "v_pix": """SELECT vec_id AS image_id, label AS grp, CAST(pos % 8 AS INT) AS x, CAST(floor(pos / 8) AS INT) AS y,
      100e0 * CAST(embedding[pos + 1] AS DOUBLE) AS value, 1e0 + (pos % 3) * 0.5e0 AS rms,
      CASE WHEN (vec_id + pos) % 17 = 0 THEN 256 WHEN (vec_id + pos) % 19 = 0 THEN 2 ELSE 0 END AS mask
      FROM (SELECT *, unnest(range(len(embedding))) AS pos FROM embeddings)""",
    "v_pos": """SELECT event_id AS id, vec_id AS image_id, (event_id % 13) * 0.5e0 + 0.5e0 AS x,
      (event_id % 11) * 0.5e0 + 1e0 AS y FROM events JOIN embeddings ON vec_id = event_id % (SELECT count(*) FROM embeddings)""",
}


def sql(query: str, extra: dict[str, str] | None = None) -> str:
    """The query with every view it needs, directly or through other views, as CTEs.

    ``extra`` adds query-local CTEs after the views.
    """
    extra = extra or {}
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(VIEWS[name])

    for text in (query, *extra.values()):
        visit(text)
    parts = [f"{n} AS ({VIEWS[n]})" for n in VIEWS if n in needed] + [f"{n} AS ({t})" for n, t in extra.items()]
    recursive = "RECURSIVE " if any("UNION" in t and n.startswith("r_") for n, t in extra.items()) else ""
    return f"WITH {recursive}{', '.join(parts)} {query}" if parts else query


def hav(ra1: str, dec1: str, ra2: str, dec2: str) -> str:
    """Haversine separation in degrees as SQL."""
    return (
        f"degrees(2 * asin(sqrt(least(1e0, pow(sin(radians({dec2} - {dec1}) / 2), 2) + "
        f"cos(radians({dec1})) * cos(radians({dec2})) * pow(sin(radians({ra2} - {ra1}) / 2), 2)))))"
    )


def near(a: str, b: str, r: str) -> str:
    """SQL join condition: rows of alias ``a`` and ``b`` within ``r`` degrees."""
    return f"{a}.dec BETWEEN {b}.dec - {r} AND {b}.dec + {r} AND {hav(f'{a}.ra', f'{a}.dec', f'{b}.ra', f'{b}.dec')} <= {r}"


R2 = "(2e0 / 3600e0)"
R15 = "(1.5e0 / 3600e0)"
R30 = "(30e0 / 3600e0)"
R1 = "(1e0 / 3600e0)"


def r6(*cols: str) -> list:
    """Round the named columns to six places."""
    return [F.round(c, 6).alias(c) for c in cols]
