"""Declared table schemas and alert record schemas."""

from __future__ import annotations

from pyspark.sql import types as T

_CORNERS = " ".join(f"ra{i} double, dec{i} double," for i in (1, 2, 3, 4))
_BASE = "id long, basename string, type string, field int, qid int, fid int, ccdid int"
_AUDIT = "created_at timestamp_ntz, modified timestamp_ntz"

# --- fixed values: table columns ---------------------------------------------
TABLES = {
    "images": f"{_BASE}, {_AUDIT}",
    "calibratableimages": f"{_BASE}, ra double, dec double, {_CORNERS} header map<string,string>,"
    " header_comments map<string,string>",
    "scienceimages": f"{_BASE}, ra double, dec double, {_CORNERS} header map<string,string>,"
    " header_comments map<string,string>, filtercode string, obsjd double, infobits int, pid long, nid int,"
    " expid int, itid int, obsdate timestamp_ntz, seeing double, airmass double, moonillf double, moonesb double,"
    " maglimit double, crpix1 double, crpix2 double, crval1 double, crval2 double, cd11 double, cd12 double,"
    " cd21 double, cd22 double, ipac_gid int, imgtypecode string, exptime double, filefracday long",
    "referenceimages": f"{_BASE}, version string",
    "sciencecoadds": f"{_BASE}, binleft timestamp_ntz, binright timestamp_ntz",
    "singleepochsubtractions": f"{_BASE}, target_image_id long, reference_image_id long",
    "multiepochsubtractions": f"{_BASE}, target_image_id long, reference_image_id long",
    "maskimages": f"{_BASE}, parent_image_id long",
    "pipelinefitscatalogs": f"{_BASE}, image_id long",
    "pipelineregionfiles": f"{_BASE}, catalog_id long",
    "detections": "id long, ra double, dec double, x_image double, y_image double, elongation double,"
    " a_image double, b_image double, fwhm_image double, flags int, imaflags_iso int, goodcut boolean,"
    " triggers_alert boolean, triggers_phot boolean, alert_ready boolean, image_id long, source_id string,"
    f" flux double, fluxerr double, {_AUDIT}",
    "realbogus": "id long, rb_score double, rb_version string, detection_id long",
    "sources": "id string, ra double, dec double, offset double, redshift double, neighbor_info string,"
    f" altdata string, score double, accumulated_rb double, last_mjd double, transient boolean, varstar boolean,"
    f" is_roid boolean, {_AUDIT}",
    "forcedphotometry": "id long, flags int, ra double, dec double, image_id long, source_id string, flux double,"
    " fluxerr double, zp double, filtercode string, obsjd double",
    "thumbnails": "id long, type string, file_uri string, public_url string, origin string, bytes binary,"
    " image_id long, source_id string, detection_id long",
    "alerts": "id long, alert string, cutoutscience_id long, cutouttemplate_id long, cutoutdifference_id long,"
    " detection_id long, sent boolean, created_at timestamp_ntz",
    "httparchivecopies": "id long, product_id long, url string, archive_path string",
    "tapecopies": "id long, product_id long, archive_id string, member_name string",
    "tapearchives": "id string, size long",
    "jobs": "id long, status string, slurm_id string",
    "forcephotjobs": "id long, status string, slurm_id string, detection_file string, output_file string",
    "alertjobs": "id long, status string, slurm_id string",
    "failedsubtractions": "id long, target_image_id long, reference_image_id long, reason string",
    "job_images": "job_id long, image_id long",
    "stackedsubtraction_frames": "coadd_id long, image_id long",
    "coadd_images": "coadd_id long, image_id long",
}
THUMBNAIL_TYPES = ("new", "ref", "sub", "sdss", "dr8", "new_gz", "ref_gz", "sub_gz")
PHOTOMETRY_CSV = (
    "source_id string, image_id long, flux double, fluxerr double, flags int, ra double, dec double,"
    " zp double, filtercode string, obsjd double"
)

# --- fixed values: alert records (name: type; a trailing ? allows null) --------
_PS1_MATCH = {
    "objectidps": "long?", "sgscore": "float?", "distpsnr": "float?",
    "psgmag": "float?", "psrmag": "float?", "psimag": "float?", "pszmag": "float?",
}
_LEGACY_MATCH = {
    "lsdistnr": "float?", "lsobjectid": "long?", "lstype": "string?", "lsebv": "float?",
    "lsg": "float?", "lsr": "float?", "lsz": "float?",
    "lsw1_": "float?", "lsw2_": "float?", "lsw3_": "float?", "lsw4_": "float?",
    "lsgaiag": "float?", "lsgaiap": "float?",
    "lszphotmean": "float?", "lszphotmed": "float?", "lszphotstd": "float?", "lszphotl68": "float?",
    "lszphotu68": "float?", "lszphotl95": "float?", "lszphotu95": "float?", "lszspec": "float?",
}
_CANDIDATE = {
    "candid": "long", "pid": "long", "alert_type": "string", "isdiffpos": "string", "pdiffimfilename": "string",
    "programpi": "string", "programid": "int", "field": "int", "rcid": "int", "fid": "int",
    "ra": "float", "dec": "float", "xpos": "float", "ypos": "float",
    "aimage": "float", "bimage": "float", "aimagerat": "float", "bimagerat": "float", "elong": "float", "fwhm": "float",
    "snr": "float", "drb": "float", "drbversion": "string", "exptime": "float",
    "jdstartref": "double", "jdendref": "double", "nframesref": "int",
    "ndethist_single": "int", "ndethist_stack": "int",
    "jdstarthist_single": "double?", "jdendhist_single": "double?",
    "jdstarthist_stack": "double?", "jdendhist_stack": "double?",
}
_ONLY = {
    "single": {"jd": "double", "nid": "int", "diffmaglim": "float",
               "ztfname": "string", "mqid": "string", "tnsid": "string"},
    "stack": {"jdstartstack": "double", "jdendstack": "double", "jdmed": "double", "nframesstack": "int",
              "ztfname": "string?", "mqid": "string?", "tnsid": "string?"},
}
_LIGHT_CURVE = {
    "id": "int", "mjd": "double?", "filter": "string", "zp": "double", "zpsys": "string?",
    "flux": "float?", "fluxerr": "float?", "flags": "int", "lim_mag": "float",
}
ALERT_VERSION = "0.4"

_KINDS = {"long": T.LongType(), "int": T.IntegerType(), "float": T.FloatType(), "double": T.DoubleType(), "string": T.StringType()}


def table_schema(name: str) -> T.StructType:
    """A1: declared schema of a table."""
    return T.StructType.fromDDL(TABLES[name])


def _record(fields: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField(n, _KINDS[k.rstrip("?")], k.endswith("?")) for n, k in fields.items()])


def candidate_schema(kind: str) -> T.StructType:
    """The candidate record of a ``single`` or ``stack`` alert; three matches per catalog."""
    matches = {f"{stem}{k}": t for group in (_PS1_MATCH, _LEGACY_MATCH) for k in (1, 2, 3) for stem, t in group.items()}
    return _record({**_CANDIDATE, **_ONLY[kind], **matches})


def light_curve_schema() -> T.StructType:
    """One light-curve point; times are doubles for both kinds."""
    return _record(_LIGHT_CURVE)


def alert_schema(kind: str) -> T.StructType:
    """The whole alert record; cutouts are rows of pixel values."""
    stamp = T.ArrayType(T.ArrayType(T.DoubleType()))
    return T.StructType([
        T.StructField("objectId", T.StringType(), False),
        T.StructField("candid", T.LongType(), False),
        T.StructField("schemavsn", T.StringType(), False),
        T.StructField("publisher", T.StringType(), False),
        T.StructField("candidate", candidate_schema(kind), False),
        T.StructField("light_curve", T.ArrayType(light_curve_schema())),
        T.StructField("cutoutScience", stamp),
        T.StructField("cutoutTemplate", stamp),
        T.StructField("cutoutDifference", stamp),
    ])
