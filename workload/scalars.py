"""Queries for column functions and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.functions import geometry, headers, naming, photometry, times
from skyloom.operators import filters, pixels
from workload import frames as W
from workload.frames import r6, sql

c = F.col
QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def add(name: str, fn, text: str | None = None, extra: dict[str, str] | None = None) -> None:
    QUERIES[name] = fn
    if text is not None:
        ORACLE[name] = sql(text, extra)


def on(frame, cols):
    """A query that projects columns of one frame."""
    return lambda spark, sf: frame(spark, sf).select("id" if frame is not W.catalog else c("objid").alias("id"), *cols())


# --- filters -------------------------------------------------------------------
add("reference_candidates",
    lambda s, d: filters.reference_candidates(W.images(s, d), fields=(600, 601, 602)).select("id"),
    """SELECT id FROM v_img WHERE field IN (600, 601, 602) AND infobits = 0 AND seeing > 1.7 AND seeing < 2.5
       AND maglimit > 19.2 AND maglimit < 22 AND obsdate < TIMESTAMP '2020-01-01'""")
add("science_candidates", lambda s, d: filters.science_candidates(W.images(s, d)).select("id", "basename"),
    "SELECT id, basename FROM v_img WHERE ipac_gid = 2 AND seeing < 4 AND maglimit > 19 AND basename > 'ztf_20200107'")
add("stack_candidates", lambda s, d: filters.stack_candidates(W.images(s, d)).select("id"),
    "SELECT id FROM v_img WHERE seeing < 4 AND maglimit > 19.2 AND filefracday > 20200107000000")
add("kill_flagged", lambda s, d: filters.kill_flagged(W.detections(s, d)).select("id"),
    "SELECT id FROM v_det WHERE (imaflags_iso & 198589) = 0 AND flags_weight = 0")

CUT_CASE = """CASE WHEN (imaflags_iso & 198589) > 0 THEN 'imaflags' WHEN flags > 2 THEN 'flags'
  WHEN a_image / b_image > 2 THEN 'elongation' WHEN fwhm_image / seeing > 2 THEN 'fwhm'
  WHEN fwhm_image < seeing * 0.8e0 THEN 'sharp' WHEN flux / fluxerr < 5 THEN 'snr' END"""
add("detection_cuts", lambda s, d: filters.detection_cuts(W.detections(s, d), with_pixels=False).select("id", "failed_at", "goodcut"),
    f"SELECT id, failed_at, failed_at IS NULL AS goodcut FROM (SELECT id, {CUT_CASE} AS failed_at FROM v_det) t")
add("cut_funnel", lambda s, d: filters.cut_funnel(W.detections(s, d), ["image_id"], with_pixels=False),
    f"""SELECT image_id, count(*) AS n_total, count(*) FILTER (k > 1) AS after_imaflags, count(*) FILTER (k > 2) AS after_flags,
        count(*) FILTER (k > 3) AS after_elongation, count(*) FILTER (k > 4) AS after_fwhm, count(*) FILTER (k > 5) AS after_sharp,
        count(*) FILTER (k > 6) AS after_snr FROM (SELECT image_id, CASE {CUT_CASE} WHEN 'imaflags' THEN 1 WHEN 'flags' THEN 2
        WHEN 'elongation' THEN 3 WHEN 'fwhm' THEN 4 WHEN 'sharp' THEN 5 WHEN 'snr' THEN 6 ELSE 7 END AS k FROM v_det) t GROUP BY image_id""")
add("rb_cut", lambda s, d: filters.rb_cut(W.detections(s, d)).select("id"),
    "SELECT id FROM v_det WHERE rb >= CASE fid WHEN 3 THEN 0.6 ELSE 0.3 END")
add("unscored_rb", lambda s, d: filters.detection_cuts(W.detections(s, d), with_pixels=False).select(
        "id", F.round(filters.unscored_rb(c("goodcut"), c("rb")), 6).alias("rb")),
    f"SELECT id, round(CASE WHEN failed_at IS NULL THEN rb ELSE -99e0 END, 6) AS rb FROM (SELECT id, rb, {CUT_CASE} AS failed_at FROM v_det) t")


def _crowded(spark, sf):
    det = W.detections(spark, sf).withColumn("image_id", F.expr("user_id % 40"))
    kept, failures = filters.too_many_detections(det, 250)
    good = kept.groupBy("image_id").agg(F.count(F.lit(1)).alias("n")).withColumn("reason", F.lit("kept"))
    return good.unionByName(failures)


add("too_many_detections", _crowded,
    """SELECT user_id % 40 AS image_id, count(*) AS n, CASE WHEN count(*) <= 250 THEN 'kept'
       ELSE CONCAT('Error: ', count(*), ' detections (>250)') END AS reason FROM v_det GROUP BY 1""")
add("calibrator_filter",
    lambda s, d: filters.calibrator_filter(W.catalog(s, d), "gaia").selectExpr("objid", "'gaia' AS kind").unionByName(
        filters.calibrator_filter(W.catalog(s, d), "sdss").selectExpr("objid", "'sdss' AS kind")),
    """SELECT objid, 'gaia' AS kind FROM v_cat WHERE parallax > 0 AND phot_g_mean_mag > 16
       UNION ALL SELECT objid, 'sdss' FROM v_cat WHERE probpsf > 0.9 AND psfmag_r < 19 AND psfmag_r > 16""")
add("null_filters", lambda s, d: W.detections(s, d).filter(filters.null_or_false(c("alert_ready"))).select(
        "id", c("source_id").isNull().alias("unassigned")),
    "SELECT id, source_id IS NULL AS unassigned FROM v_det WHERE NOT coalesce(alert_ready, false)")

# --- photometry -----------------------------------------------------------------
add("snr", on(W.detections, lambda: [F.round(photometry.snr(c("flux"), c("fluxerr") - 1), 6).alias("snr")]),
    "SELECT id, round(CASE WHEN fluxerr - 1 <> 0 THEN flux / (fluxerr - 1) END, 6) AS snr FROM v_det")
add("abmag", on(W.catalog, lambda: [F.round(photometry.abmag(c("flux_r")), 6).alias("mag")]),
    "SELECT objid AS id, round(CASE WHEN flux_r <= 0 THEN 0 ELSE -2.5e0 * log10(greatest(flux_r, 1e-300)) + 22.5e0 END, 6) AS mag FROM v_cat")
add("mag_unguarded", on(W.catalog, lambda: [F.round(photometry.mag_unguarded(c(f"flux_{b}")), 6).alias(f"{b}mag") for b in ("g", "r", "w1")]),
    "SELECT objid AS id, " + ", ".join(
        f"round(CASE WHEN flux_{b} > 0 THEN -2.5e0 * log10(flux_{b}) + 22.5e0 END, 6) AS {b}mag" for b in ("g", "r", "w1")) + " FROM v_cat")
add("calibrated_mag", on(W.photometry, lambda: [
        F.round(photometry.calibrated_mag(c("flux"), c("zp"), F.lit(0.05)), 6).alias("mag"),
        F.round(photometry.magerr(c("flux"), c("fluxerr")), 6).alias("magerr")]),
    """SELECT id, round(CASE WHEN flux > 0 THEN -2.5e0 * log10(flux) + zp + 0.05e0 END, 6) AS mag,
       round(CASE WHEN flux <> 0 THEN 1.08573620476e0 * fluxerr / flux END, 6) AS magerr FROM v_phot""")
add("lim_mag", on(W.photometry, lambda: [F.round(photometry.lim_mag(c("fluxerr"), c("zp")), 6).alias("lim_mag")]),
    "SELECT id, round(-2.5e0 * log10(5e0 * fluxerr) + zp, 6) AS lim_mag FROM v_phot")
add("fluxscale", on(W.images, lambda: [F.round(photometry.fluxscale(c("magzp")), 6).alias("fluxscale")]),
    "SELECT id, round(pow(10e0, -0.4e0 * (magzp - 25e0)), 6) AS fluxscale FROM v_img")
add("shape_ratios", on(W.detections, lambda: [
        F.round(photometry.shape_ratios(c("a_image"), c("b_image"), c("fwhm_image"))[n], 6).alias(n) for n in ("aimagerat", "bimagerat")]),
    "SELECT id, round(a_image / fwhm_image, 6) AS aimagerat, round(b_image / fwhm_image, 6) AS bimagerat FROM v_det")

# --- time -----------------------------------------------------------------------
add("jd_mjd", on(W.images, lambda: [F.round(times.jd_to_mjd(c("obsjd")), 6).alias("mjd"),
                                   F.round(times.mjd_to_jd(times.jd_to_mjd(c("obsjd"))), 6).alias("jd")]),
    "SELECT id, round(obsjd - 2400000.5e0, 6) AS mjd, round(obsjd, 6) AS jd FROM v_img")


def _header():
    """A header with one of three time keys, by id."""
    iso = F.date_format("created_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    key = F.expr("CASE id % 3 WHEN 0 THEN 'OBSMJD' WHEN 1 THEN 'OBSJD' ELSE 'DATE-OBS' END")
    value = F.expr("CASE id % 3 WHEN 0 THEN CAST(mjd AS STRING) WHEN 1 THEN CAST(mjd + 2400000.5e0 AS STRING) END")
    return F.create_map(key, F.coalesce(value, iso))


add("get_time", on(W.detections, lambda: [F.round(times.get_time(_header(), "mjd"), 5).alias("mjd"),
                                         F.round(times.get_time(_header(), "jd"), 5).alias("jd")]),
    "SELECT id, round(mjd, 5) AS mjd, round(mjd + 2400000.5e0, 5) AS jd FROM v_det")
add("julian_day", on(W.images, lambda: [times.julian_day(c("obsdate")).alias("day")]),
    "SELECT id, date_diff('day', DATE '1970-01-01', CAST(obsdate AS DATE)) + 2440588 AS day FROM v_img")
add("winsize", lambda s, d: W.stacks(s, d).select(
        "id", F.extract(F.lit("DAY"), times.winsize(F.lit("2017-01-01 00:00:00").cast("timestamp_ntz"), c("binright"))).alias("days")),
    "SELECT id, date_diff('day', TIMESTAMP '2017-01-01', binright) AS days FROM v_stk")

# --- names ------------------------------------------------------------------------
add("filter_codes", on(W.images, lambda: [naming.band(c("fid")).alias("band"), naming.filter_name(c("filtercode")).alias("name"),
                                         naming.filtercode(naming.filter_name(c("filtercode"))).alias("code")]),
    "SELECT id, filtercode AS band, CONCAT('ztf', right(filtercode, 1)) AS name, filtercode AS code FROM v_img")
add("rcid", on(W.images, lambda: [naming.rcid(c("ccdid"), c("qid")).alias("rcid")]),
    "SELECT id, (ccdid - 1) * 4 + qid - 1 AS rcid FROM v_img")
K4 = "field ccdid qid fid basename".split()
REL = "printf('%06d/c%02d/q%d/%s/%s', field, ccdid, qid, filtercode, basename)"
add("relname", on(W.images, lambda: [naming.relname(*map(c, K4)).alias("relname")]), f"SELECT id, {REL} AS relname FROM v_img")


def _paths():
    path = naming.archive_path("/archive/www/data", naming.relname(*map(c, K4)))
    return [path.alias("path"), naming.archive_url(path, "/archive/www", "https://example.org").alias("url"),
            naming.nested_target(path).alias("target"),
            naming.stamp_path("/archive/www", c("field"), c("ccdid"), c("qid"), c("fid"), c("id")).alias("stamp")]


add("archive_path_url", on(W.images, _paths),
    f"""SELECT id, CONCAT('/archive/www/data/', {REL}) AS path, CONCAT('https://example.org/data/', {REL}) AS url, {REL} AS target,
        printf('/archive/www/stamps/%06d/c%02d/q%d/%s/stamp.%d.jpg', field, ccdid, qid, filtercode, id) AS stamp FROM v_img""")
add("ipac_url", on(W.images, lambda: [naming.ipac_url(*map(c, "filefracday field filtercode ccdid imgtypecode qid".split()), "mskimg.fits").alias("url")]),
    """SELECT id, CONCAT('https://irsa.ipac.caltech.edu/ibe/data/ztf/products/sci/', filefracday // 10000000000, '/',
       lpad(CAST(filefracday // 1000000 % 10000 AS VARCHAR), 4, '0'), '/', lpad(CAST(filefracday % 1000000 AS VARCHAR), 6, '0'), '/',
       replace(basename, 'sciimg', 'mskimg')) AS url FROM v_img""")
add("product_names", on(W.images, lambda: [
        naming.sub_name(F.concat(F.lit("/d/"), c("basename")), F.concat(F.lit("/r/ref."), c("kidx"), F.lit(".fits"))).alias("sub"),
        naming.coadd_name(c("field"), c("ccdid"), c("qid"), c("fid"), F.lit("a"), F.lit("b")).alias("coadd"),
        naming.ref_name(c("field"), c("ccdid"), c("qid"), c("fid"), "v1").alias("ref"),
        naming.product_name(c("basename"), "rms").alias("rms")]),
    """SELECT id, CONCAT('/d/sub.', replace(basename, '.fits', ''), '_ref.', kidx, '.fits') AS sub,
       printf('%06d_c%02d_q%d_%s_a_b.coadd.fits', field, ccdid, qid, filtercode) AS coadd,
       printf('ref.%06d_c%02d_q%d_%s.v1.fits', field, ccdid, qid, filtercode) AS ref, replace(basename, '.fits', '.rms.fits') AS rms FROM v_img""")
add("parse_basename", lambda s, d: W.images(s, d).select("id", naming.parse_basename(c("basename")).alias("p")).select("id", "p.*"),
    "SELECT id, CAST(filefracday AS VARCHAR) AS time, field, filtercode AS band, ccdid, 'o' AS imgtype, qid FROM v_img")
add("survey_urls", lambda s, d: W.sources(s, d).select(
        "id", naming.sdss_url(F.floor("ra"), F.floor("dec")).alias("sdss"), naming.dr8_url(F.floor("ra"), F.floor("dec")).alias("dr8")),
    """SELECT id, CONCAT('http://skyservice.pha.jhu.edu/DR9/ImgCutout/getjpeg.aspx?ra=', CAST(floor(ra) AS BIGINT), '&dec=',
       CAST(floor(dec) AS BIGINT), '&scale=0.3&width=200&height=200&opt=G&query=&Grid=on') AS sdss,
       CONCAT('http://legacysurvey.org/viewer/jpeg-cutout?ra=', CAST(floor(ra) AS BIGINT), '&dec=', CAST(floor(dec) AS BIGINT),
       '&size=200&layer=dr8&pixscale=0.262&bands=grz') AS dr8 FROM v_src""")
add("sg_strip", on(W.sources, lambda: [naming.sg_strip(c("dec")).alias("strip")]),
    """SELECT id, CONCAT('hlsp_ps1-psc_ps1_gpc1_', CAST(floor(dec) AS BIGINT) + CASE WHEN dec >= 0 THEN 0 ELSE 1 END,
       '_multi_v1_cat.fits') AS strip FROM v_src""")
add("topic_name", on(W.detections, lambda: [naming.topic_name(F.when(c("id") % 5 == 0, "stack").otherwise("single"), c("created_at"), "sky", "news").alias("topic")]),
    """SELECT id, CONCAT('sky_', strftime(created_at, '%Y%m%d'), '_programid2_news', CASE WHEN id % 5 = 0 THEN '_stack' ELSE '' END) AS topic FROM v_det""")

# --- headers ------------------------------------------------------------------------


# header columns that get the id plus their place in the list
COUNTED = [n for n in headers.HEADER_COLUMNS if n not in ("obsjd", "seeing", "nid", "exptime")]
INTS = [n for n in COUNTED if headers.HEADER_COLUMNS[n][1] in ("int", "long")]
REALS = [n for n in COUNTED if n not in INTS]


def _header_extract(spark, sf):
    counted = "".join(f", '{headers.HEADER_COLUMNS[n][0]}', CAST(id + {k} AS STRING)" for k, n in enumerate(COUNTED))
    head = F.expr(f"""map('OBSJD', CAST(id * 0.5e0 AS STRING), 'SEEING', CAST(9e0 AS STRING), 'DBNID', CAST(nid + 1 AS STRING),
                     'FIELDID', CAST(field + 1 AS STRING), 'CCDID', CAST(ccdid AS STRING), 'QID', CAST(qid AS STRING),
                     'FILTERID', CAST(fid AS STRING), 'EXPTIME', CAST(id % 40 AS STRING), 'FILENAME', basename{counted})""")
    rows = W.images(spark, sf).withColumn("header", head).withColumns(
        {"seeing": F.expr("CASE WHEN id % 2 = 0 THEN seeing END"), "filtercode": F.expr("CASE WHEN id % 3 = 0 THEN filtercode END")})
    out = headers.header_extract(rows.drop("nid", "obsjd", "exptime", "filefracday", "imgtypecode", *COUNTED))
    return out.select("id", "field", "ccdid", "qid", "fid", "nid", "filtercode", "imgtypecode", "filefracday", *INTS,
                      *r6("seeing", "obsjd", "exptime", *REALS))


add("header_extract", _header_extract,
    """SELECT id, field + 1 AS field, ccdid, qid, fid, nid + 1 AS nid, filtercode, 'g' AS imgtypecode, filefracday,
       round(CASE WHEN id % 2 = 0 THEN seeing ELSE 9e0 END, 6) AS seeing, round(id * 0.5e0, 6) AS obsjd,
       round(CAST(id % 40 AS DOUBLE), 6) AS exptime, """
    + ", ".join(f"id + {k} AS {n}" if n in INTS else f"CAST(id + {k} AS DOUBLE) AS {n}" for k, n in enumerate(COUNTED)) + " FROM v_img")


def _scalars(spark, sf):
    head = F.expr("map('k', get_json_object(props, '$.k'), 'list', '[1, 2]', 'obj', props, 'none', CAST(NULL AS STRING))")
    kept = headers.header_scalars(head)
    return W.table(spark, sf, "events").select(
        c("event_id").alias("id"), F.array_join(F.sort_array(F.map_keys(kept)), ",").alias("keys"), F.try_element_at(kept, F.lit("k")).alias("k"))


add("header_scalars", _scalars, "SELECT event_id AS id, 'k' AS keys, json_extract_string(props, '$.k') AS k FROM events")


def _merge(spark, sf):
    base = F.expr("map('MAGZP', CAST(magzp AS STRING), 'CRVAL1', 'old', 'COMMENT', 'mine')")
    solved = F.expr("map('CRVAL1', CAST(id AS STRING), 'FLXSCALE', '2', 'COMMENT', 'theirs', 'CD1_1', '1')")
    m = headers.header_merge(base, solved)
    return W.images(spark, sf).select("id", F.try_element_at(m, F.lit("CRVAL1")).alias("crval1"),
                                      F.try_element_at(m, F.lit("COMMENT")).alias("comment"), F.size(m).alias("n"))


add("header_merge", _merge, "SELECT id, CAST(id AS VARCHAR) AS crval1, 'mine' AS comment, 4 AS n FROM v_img")


def _json(spark, sf):
    rows = W.detections(spark, sf).select("id", F.struct(
        "id", F.expr("CASE WHEN id % 2 = 0 THEN double('NaN') ELSE CAST(id AS DOUBLE) END").alias("v"),
        F.array(F.lit(1), F.lit(None).cast("int")).alias("a")).alias("s"))
    return rows.select("id", headers.json_encode(c("s"), rows.schema["s"].dataType).alias("json"))


add("json_encode", _json,
    """SELECT id, CONCAT('{"id":', id, ',"v":', CASE WHEN id % 2 = 0 THEN 'null' ELSE CONCAT(id, '.0') END, ',"a":[1,null]}') AS json FROM v_det""")
add("angle_changed", on(W.images, lambda: [headers.angle_changed(
        F.expr("CASE WHEN id % 10 = 0 THEN NULL ELSE ra END"), F.expr("ra * (1e0 + (id % 4) * 0.6e-5)")).alias("changed")]),
    """SELECT id, coalesce(abs(CASE WHEN id % 10 = 0 THEN NULL ELSE ra END - ra * (1e0 + (id % 4) * 0.6e-5)) > 1e-8 + 1e-5 * abs(ra * (1e0 + (id % 4) * 0.6e-5)), true) AS changed FROM v_img""")

# --- geometry -------------------------------------------------------------------------
add("sky_distance", lambda s, d: W.detections(s, d).select("id", F.round(geometry.sky_distance(
        c("ra"), c("dec"), F.lit(10.0), F.lit(20.0)), 6).alias("deg")),
    f"SELECT id, round({W.hav('ra', 'dec', '10e0', '20e0')}, 6) AS deg FROM v_det")
add("sky_cell", lambda s, d: W.detections(s, d).select("id", geometry.sky_cell(c("ra"), c("dec"), 0.5).alias("cell")).select("id", "cell.*"),
    """SELECT id, zone, least(CAST(floor(ra * n / 360e0) AS INT), n - 1) AS bucket FROM (SELECT *, greatest(1, CAST(floor(cos(radians(least(
       greatest(abs(zone * 0.5e0 - 90), abs(zone * 0.5e0 - 89.5e0)), 89.9e0))) * 720e0) AS INT)) AS n FROM (SELECT id, ra,
       greatest(0, least(359, CAST(floor((dec + 90e0) / 0.5e0) AS INT))) AS zone FROM v_det) a) b""")


def _wcs():
    return {"crpix1": F.lit(1500.5), "crpix2": F.lit(1500.5), "crval1": c("ra"), "crval2": c("dec"), "cd11": F.lit(-2.8e-4),
            "cd12": F.lit(1e-6), "cd21": F.lit(1e-6), "cd22": F.lit(2.8e-4)}


XI = "radians(-2.8e-4 * (id % 3000 - 1500.5e0) + 1e-6 * (id % 2900 - 1500.5e0))"
ETA = "radians(1e-6 * (id % 3000 - 1500.5e0) + 2.8e-4 * (id % 2900 - 1500.5e0))"
add("wcs_pix2world", lambda s, d: W.images(s, d).select("id", geometry.pix2world(
        (c("id") % 3000).cast("double"), (c("id") % 2900).cast("double"), _wcs()).alias("p")).select("id", F.round("p.ra", 6).alias("ra"), F.round("p.dec", 6).alias("dec")),
    f"""SELECT id, round((degrees(radians(ra) + atan2(xi, b)) + 360e0) % 360e0, 6) AS ra,
        round(degrees(atan2(sin(radians(dec)) + eta * cos(radians(dec)), sqrt(xi * xi + b * b))), 6) AS dec
        FROM (SELECT *, cos(radians(dec)) - eta * sin(radians(dec)) AS b FROM (SELECT id, ra, dec, {XI} AS xi, {ETA} AS eta FROM v_img) a) t""")


def _there_and_back(spark, sf):
    w = _wcs()
    rows = W.images(spark, sf).withColumn("p", geometry.pix2world((c("id") % 3000).cast("double"), (c("id") % 2900).cast("double"), w))
    return rows.select("id", geometry.world2pix(c("p.ra"), c("p.dec"), w).alias("q")).select("id", F.round("q.x", 5).alias("x"), F.round("q.y", 5).alias("y"))


add("wcs_world2pix", _there_and_back,
    "SELECT id, CAST(id % 3000 AS DOUBLE) AS x, CAST(id % 2900 AS DOUBLE) AS y FROM v_img")
add("pixel_scale", lambda s, d: W.images(s, d).select("id", geometry.pixel_scale(
        -2.8e-4 - c("id") * 1e-8, F.lit(1e-6), F.lit(2e-6), F.lit(2.8e-4)).alias("p")).select("id", F.round("p.scale1", 6).alias("scale1"), F.round("p.scale2", 6).alias("scale2")),
    """SELECT id, round(sqrt(pow(-2.8e-4 - id * 1e-8, 2) + pow(2e-6, 2)) * 3600, 6) AS scale1,
       round(sqrt(pow(1e-6, 2) + pow(2.8e-4, 2)) * 3600, 6) AS scale2 FROM v_img""")
add("bad_pixel", lambda s, d: W.pixels(s, d).select("image_id", "x", "y", pixels.bad_pixel(c("mask")).alias("bad")),
    "SELECT image_id, x, y, (mask & 198589) > 0 AS bad FROM v_pix")
