"""Names, paths and URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyloom.constants import BANDS

# --- fixed values: path and URL formats -------------------------------------
RELNAME_FORMAT = "%06d/c%02d/q%d/%s/%s"
STAMP_FORMAT = "stamps/%06d/c%02d/q%d/%s/stamp.%d.jpg"
IPAC_ROOT = "https://irsa.ipac.caltech.edu/ibe/data/ztf/products/sci/"
IPAC_FORMAT = "ztf_%s_%06d_%s_c%02d_%s_q%d_%s"
BASENAME_PATTERN = r"ztf_(\d+)_(\d+)_([a-z]+)_c(\d+)_([a-z])_q(\d+)"
SDSS_FORMAT = (
    "http://skyservice.pha.jhu.edu/DR9/ImgCutout/getjpeg.aspx"
    "?ra=%s&dec=%s&scale=0.3&width=200&height=200&opt=G&query=&Grid=on"
)
DR8_FORMAT = (
    "http://legacysurvey.org/viewer/jpeg-cutout?ra=%s&dec=%s&size=200&layer=dr8&pixscale=0.262&bands=grz"
)
SG_FORMAT = "hlsp_ps1-psc_ps1_gpc1_%d_multi_v1_cat.fits"


def band(fid: Column) -> Column:
    """Filter id to two-letter band."""
    out = F.lit(None).cast("string")
    for code, name in BANDS.items():
        out = F.when(fid == code, F.lit(name)).otherwise(out)
    return out


def filter_name(code: Column) -> Column:
    """``zg`` to ``ztfg``."""
    return F.concat(F.lit("ztf"), F.right(code, F.lit(1)))


def filtercode(name: Column) -> Column:
    """Any filter name to ``z`` plus its last letter."""
    return F.concat(F.lit("z"), F.right(name, F.lit(1)))


def rcid(ccdid: Column, qid: Column) -> Column:
    """Readout channel number."""
    return (ccdid - 1) * 4 + (qid - 1)


def relname(field: Column, ccdid: Column, qid: Column, fid: Column, basename: Column) -> Column:
    """Path of a product below any root."""
    return F.format_string(RELNAME_FORMAT, field, ccdid, qid, band(fid), basename)


def archive_path(root: str, rel: Column) -> Column:
    """B22"""
    return F.concat(F.lit(root.rstrip("/") + "/"), rel)


def archive_url(path: Column, root: str, url_root: str) -> Column:
    """The path with its root replaced by the public one."""
    return F.replace(path, F.lit(root), F.lit(url_root))


def nested_target(path: Column) -> Column:
    """The last five components of an archive path."""
    return F.substring_index(path, "/", -5)


def stamp_path(root: str, field: Column, ccdid: Column, qid: Column, fid: Column, stamp_id: Column) -> Column:
    """B22"""
    return F.concat(
        F.lit(root.rstrip("/") + "/"), F.format_string(STAMP_FORMAT, field, ccdid, qid, band(fid), stamp_id)
    )


def ipac_basename(
    filefracday: Column, field: Column, code: Column, ccdid: Column, imgtype: Column, qid: Column, suffix: str
) -> Column:
    day = filefracday.cast("string")
    return F.format_string(IPAC_FORMAT, day, field, code, ccdid, imgtype, qid, F.lit(suffix))


def ipac_url(
    filefracday: Column, field: Column, code: Column, ccdid: Column, imgtype: Column, qid: Column, suffix: str
) -> Column:
    """Archive URL with the date sliced out of ``filefracday``."""
    day = filefracday.cast("string")
    name = ipac_basename(filefracday, field, code, ccdid, imgtype, qid, suffix)
    folder = F.concat_ws("/", F.substring(day, 1, 4), F.substring(day, 5, 4), F.substring(day, 9, 100))
    return F.concat(F.lit(IPAC_ROOT), folder, F.lit("/"), name)


def sub_name(sci: Column, ref: Column) -> Column:
    """Difference image name from both parents, in the science image's folder."""
    folder = F.regexp_extract(sci, r"^(.*/)?[^/]*$", 1)
    stem = lambda c: F.regexp_extract(c, r"([^/]*)\.fits$", 1)
    return F.concat(folder, F.lit("sub."), stem(sci), F.lit("_"), stem(ref), F.lit(".fits"))


def coadd_name(field: Column, ccdid: Column, qid: Column, fid: Column, left: Column, right: Column) -> Column:
    """``left`` and ``right`` are the bin edges as text."""
    return F.format_string("%06d_c%02d_q%d_%s_%s_%s.coadd.fits", field, ccdid, qid, band(fid), left, right)


def ref_name(field: Column, ccdid: Column, qid: Column, fid: Column, version: str) -> Column:
    """B24"""
    return F.format_string("ref.%06d_c%02d_q%d_%s.%s.fits", field, ccdid, qid, band(fid), F.lit(version))


def product_name(basename: Column, kind: str) -> Column:
    """Sibling product of an image (``mask``, ``rms``, ``weight``)."""
    return F.regexp_replace(basename, r"\.fits$", f".{kind}.fits")


def parse_basename(name: Column) -> Column:
    """Struct of the parts of a science image name; null parts when it does not match."""
    part = lambda i: F.nullif(F.regexp_extract(name, BASENAME_PATTERN, i), F.lit(""))
    return F.struct(
        part(1).alias("time"),
        part(2).cast("int").alias("field"),
        part(3).alias("band"),
        part(4).cast("int").alias("ccdid"),
        part(5).alias("imgtype"),
        part(6).cast("int").alias("qid"),
    )


def sdss_url(ra: Column, dec: Column) -> Column:
    """B29"""
    return F.format_string(SDSS_FORMAT, ra.cast("string"), dec.cast("string"))


def dr8_url(ra: Column, dec: Column) -> Column:
    """B29"""
    return F.format_string(DR8_FORMAT, ra.cast("string"), dec.cast("string"))


def sg_strip(dec: Column) -> Column:
    """File of the one-degree declination strip, named by the edge nearer the equator."""
    low = F.floor(dec).cast("int")
    return F.format_string(SG_FORMAT, F.when(dec >= 0, low).otherwise(low + 1))


def topic_name(kind: Column, created: Column, survey: str = "survey", product: str = "alerts") -> Column:
    """Topic of an alert by type (``single`` or ``stack``) and creation date."""
    base = F.concat(
        F.lit(f"{survey}_"), F.date_format(created, "yyyyMMdd"), F.lit(f"_programid2_{product}")
    )
    return F.when(kind == "single", base).when(kind == "stack", F.concat(base, F.lit("_stack")))
