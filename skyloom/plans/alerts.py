"""Light curves and alert packets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom import constants as K
from skyloom.functions.naming import filter_name, rcid
from skyloom.functions.photometry import lim_mag, snr
from skyloom.functions.times import HALF_SECOND_DAYS, jd_to_mjd
from skyloom.operators.aggregates import stack_summary
from skyloom.operators.relational import history_single, history_stack
from skyloom.operators.skew import collect_parts, running_in_group
from skyloom.session import store
from skyloom.sources.schemas import ALERT_VERSION, alert_schema

POINTS_PER_PART = 10_000
POINT_FIELDS = ("id", "mjd", "filter", "zp", "zpsys", "flux", "fluxerr", "flags", "lim_mag")


def light_curve(phot: DataFrame) -> DataFrame:
    """P5: light-curve points of all sources, one row each."""
    return phot.select(
        "source_id", "id", jd_to_mjd(F.col("obsjd")).alias("mjd"), filter_name(F.col("filtercode")).alias("filter"),
        "zp", F.lit("ab").alias("zpsys"), "flux", "fluxerr", "flags", lim_mag(F.col("fluxerr"), F.col("zp")).alias("lim_mag"),
    )


def light_curve_parts(phot: DataFrame, size: int = POINTS_PER_PART) -> DataFrame:
    """P5: time-ordered point arrays per source, in parts of at most ``size`` points."""
    points = light_curve(phot)
    return collect_parts(points, ["source_id"], ["mjd", "id"], F.struct(*POINT_FIELDS), size, "points")


def history_before(
    epochs: DataFrame, single: DataFrame, stacked: DataFrame
) -> DataFrame:
    """Earlier detections of each alert's source, counted in one ordered pass.

    ``epochs(id, source_id, epoch)`` are the alerts; ``single`` and ``stacked`` come
    from ``history_single`` and ``history_stack``. Alerts and history are sorted
    together by time, alerts first at equal times, so that a running count at an
    alert covers what came strictly before: no alert meets its history row by row.
    """
    none = F.lit(None).cast("double")
    asked = epochs.select("source_id", F.col("epoch").alias("t"), F.lit(0).alias("kind"), F.col("id").cast("string").alias("tag"),
                          "id", none.alias("lo"), none.alias("hi"))
    nobody = F.lit(None).cast("long").alias("id")
    one = single.select("source_id", F.col("mjd").alias("t"), F.lit(1).alias("kind"), F.col("detection_id").cast("string").alias("tag"),
                        nobody, F.col("mjd").alias("lo"), F.col("mjd").alias("hi"))
    many = stacked.select("source_id", F.col("min_mjd").alias("t"), F.lit(2).alias("kind"), F.col("stack_id").cast("string").alias("tag"),
                          nobody, F.col("min_mjd").alias("lo"), F.col("max_mjd").alias("hi"))
    rows = asked.unionByName(one).unionByName(many)
    of = lambda kind, value: F.when(F.col("kind") == kind, value)
    out = running_in_group(rows, ["source_id"], ["t", "kind", "tag"], {
        "n1": ("sum", F.coalesce(of(1, F.lit(1)), F.lit(0)).cast("long")),
        "lo1": ("min", of(1, F.col("lo"))),
        "hi1": ("max", of(1, F.col("hi"))),
        "n2": ("sum", F.coalesce(of(2, F.lit(1)), F.lit(0)).cast("long")),
        # the stack that ends first gives the start
        "first2": ("min", of(2, F.struct("hi", "lo"))),
        "hi2": ("max", of(2, F.col("hi"))),
    })
    return out.filter("kind = 0").select(
        "id",
        F.col("n1").cast("int").alias("ndethist_single"),
        (F.col("lo1") + K.MJD_TO_JD).alias("jdstarthist_single"),
        (F.col("hi1") + K.MJD_TO_JD).alias("jdendhist_single"),
        F.col("n2").cast("int").alias("ndethist_stack"),
        (F.col("first2.lo") + K.MJD_TO_JD).alias("jdstarthist_stack"),
        (F.col("hi2") + K.MJD_TO_JD).alias("jdendhist_stack"),
    )


def of_sources(rows: DataFrame, det: DataFrame) -> DataFrame:
    """Rows of the sources that ``det`` belongs to."""
    return rows.join(det.select("source_id").distinct(), "source_id", "left_semi")


def candidate_rows(
    det: DataFrame, realbogus: DataFrame, images: DataFrame, single_subs: DataFrame, stack_subs: DataFrame,
    bridge: DataFrame, all_det: DataFrame, kind: str,
) -> DataFrame:
    """Image, shape, score, reference and history fields of each ready detection of one kind.

    ``det`` are the detections to alert; ``all_det`` all detections (history).
    ``bridge(coadd_id, image_id)`` covers references and stacks. Only the history of the sources
    at hand is looked at, and only the lineage of the coadds in it.
    """
    subs = single_subs if kind == "single" else stack_subs
    all_det = of_sources(all_det.select("id", "source_id", "image_id"), det)
    seen = subs.join(det.select(F.col("image_id").alias("id")).distinct(), "id", "left_semi")
    past = stack_subs.join(all_det.select(F.col("image_id").alias("id")).distinct(), "id", "left_semi")
    needed = seen.select(F.explode(F.array("reference_image_id", "target_image_id")).alias("coadd_id")).unionByName(
        past.select(F.col("target_image_id").alias("coadd_id")))
    bridge = bridge.join(needed.distinct(), "coadd_id", "left_semi")
    # one pass over the lineage serves reference spans, stack rows, headers and history
    head = lambda key: F.try_element_at("header", F.lit(key))
    coadds = store(stack_summary(bridge, images, {
        "programpi": F.min_by(head("PROGRMPI"), "id"), "programid": F.min_by(head("PROGRMID").try_cast("int"), "id"),
    }))
    on = subs.select(
        F.col("id").alias("image_id"), F.col("basename").alias("pdiffimfilename"), "target_image_id", "reference_image_id",
        "field", "ccdid", "qid", "fid",
    )
    rows = det.drop(*[n for n in on.columns if n != "image_id"]).join(on, ["image_id"])
    if kind == "single":
        target = images.select(
            F.col("id").alias("target_image_id"), F.col("obsjd").alias("jd"), "nid", F.col("maglimit").alias("diffmaglim"),
            "exptime", F.try_element_at("header", F.lit("PROGRMPI")).alias("programpi"),
            F.try_element_at("header", F.lit("PROGRMID")).try_cast("int").alias("programid"),
            jd_to_mjd(F.col("obsjd")).alias("epoch"),
        )
    else:
        target = coadds.withColumnRenamed("coadd_id", "target_image_id")
        target = target.withColumn("epoch", jd_to_mjd(F.col("jdendstack")))
    rows = rows.join(target, ["target_image_id"])
    span = coadds.select(
        F.col("coadd_id").alias("reference_image_id"), F.col("jdstartstack").alias("jdstartref"),
        F.col("jdendstack").alias("jdendref"), F.col("nframesstack").alias("nframesref"),
    )
    rows = rows.join(span, ["reference_image_id"], "left")
    scores = realbogus.groupBy("detection_id").agg(F.min_by(F.struct("rb_score", "rb_version"), "id").alias("_rb"))
    # read by the history, the light curves and the packets
    rows = store(rows.join(scores.withColumnRenamed("detection_id", "id"), "id", "left"))
    past = history_before(
        rows.select("id", "source_id", "epoch"),
        history_single(all_det, single_subs, images), history_stack(all_det, stack_subs, bridge, images, coadds.select(
            "coadd_id", jd_to_mjd(F.col("jdstartstack")).alias("min_mjd"), jd_to_mjd(F.col("jdendstack")).alias("max_mjd"))),
    )
    rows = rows.join(past, "id")
    return rows.withColumns({
        "candid": F.col("id"), "pid": F.col("image_id"), "alert_type": F.lit(kind), "isdiffpos": F.lit("t"),
        "rcid": rcid(F.col("ccdid"), F.col("qid")), "xpos": F.col("x_image"), "ypos": F.col("y_image"),
        "aimage": F.col("a_image"), "bimage": F.col("b_image"), "elong": F.col("elongation"), "fwhm": F.col("fwhm_image"),
        "aimagerat": F.try_divide("a_image", "fwhm_image"), "bimagerat": F.try_divide("b_image", "fwhm_image"),
        "snr": snr(F.col("flux"), F.col("fluxerr")),
        "drb": F.col("_rb.rb_score"), "drbversion": F.col("_rb.rb_version"),
    })


def _fit(rows: DataFrame, kind: str) -> list[Column]:
    """Candidate fields in schema order; a field no input provides is null."""
    fields = alert_schema(kind)["candidate"].dataType.fields
    have = set(rows.columns)
    return [(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]


def build_alerts(
    det: DataFrame, realbogus: DataFrame, images: DataFrame, single_subs: DataFrame, stack_subs: DataFrame,
    bridge: DataFrame, all_det: DataFrame, phot: DataFrame, matches: DataFrame, stamps: DataFrame,
    kind: str = "single", publisher: str = "skyloom", size: int = POINTS_PER_PART,
) -> DataFrame:
    """Nested packets for all given detections of one kind at once.

    ``matches`` is the frame of ``crossmatch_candidate`` (one or more ``part`` rows per
    id), ``stamps`` is (id, new, ref, sub). A packet holds at most ``size`` points;
    longer light curves go on in packets with ``part`` 1, 2, ... so none is cut off.
    Reading raises for a detection without a source and for a source without a
    light curve.
    """
    source = F.coalesce(
        F.col("source_id"),
        F.raise_error(F.concat(F.lit("no source for detection "), F.col("id").cast("string"))).cast("string"),
    )
    ready = det.withColumn("source_id", source)
    rows = store(candidate_rows(ready, realbogus, images, single_subs, stack_subs, bridge, all_det, kind))
    matches = store(matches)
    points = light_curve_parts(of_sources(phot, rows), size)
    cut = F.col("epoch") + HALF_SECOND_DAYS
    curves = rows.select("id", "source_id", "epoch").join(points.withColumn("_start", F.get("points", F.lit(0))["mjd"]), ["source_id"], "left")
    missing = F.raise_error(F.concat(F.lit("no light curve for source "), F.col("source_id"))).cast("boolean")
    curves = curves.filter(
        F.when(F.col("part").isNull(), missing).otherwise((F.col("part") == 0) | (F.col("_start") <= cut))
    ).select("id", "part", F.filter("points", lambda p: p["mjd"] <= cut).alias("light_curve"))
    curves = curves.join(matches.withColumn("_match", F.lit(True)), ["id", "part"], "full")
    catalog = [c for c in matches.columns if c not in ("id", "part")]
    # a further light-curve part repeats the catalog matches of the first
    first = matches.filter("part = 0").select("id", *[F.col(c).alias(f"_0_{c}") for c in catalog])
    packed = curves.join(first, ["id"], "left")
    lists = ("ztfname", "mqid", "tnsid")
    filled = {c: F.coalesce(c, F.lit("") if c in lists else F.col(f"_0_{c}")) for c in catalog}
    packed = packed.withColumns(filled).drop(*[f"_0_{c}" for c in catalog], "_match")
    packed = packed.join(rows, ["id"]).join(stamps, "id", "left")
    lc_type = alert_schema(kind)["light_curve"].dataType
    empty = F.array().cast(lc_type)
    return packed.select(
        F.col("source_id").alias("objectId"), F.col("id").alias("candid"), F.lit(ALERT_VERSION).alias("schemavsn"),
        F.lit(publisher).alias("publisher"), F.struct(*_fit(packed, kind)).alias("candidate"),
        F.coalesce(F.transform("light_curve", _point), empty).alias("light_curve"),
        F.col("new").alias("cutoutScience"), F.col("ref").alias("cutoutTemplate"), F.col("sub").alias("cutoutDifference"),
        "part", F.col("alert_type"),
    )


def _point(p: Column) -> Column:
    fields = alert_schema("single")["light_curve"].dataType.elementType.fields
    return F.struct(*[p[f.name].cast(f.dataType).alias(f.name) for f in fields])


def send_alerts(alerts: DataFrame, sent: DataFrame, created_at: Column) -> tuple[DataFrame, DataFrame]:
    """Alerts not sent before, stamped with their creation time, and the new sent list.

    ``sent(detection_id)``. Write the packets first, then append the second frame;
    running again sends nothing twice.
    """
    todo = alerts.join(sent.select(F.col("detection_id").alias("candid")), "candid", "left_anti")
    todo = todo.withColumn("created_at", created_at)
    return todo, todo.select(F.col("candid").alias("detection_id"), F.lit(True).alias("sent"), "created_at").distinct()


def refuse_resend(alerts: DataFrame, sent: DataFrame) -> DataFrame:
    """The strict form: reading raises when an alert was sent before."""
    known = sent.select(F.col("detection_id").alias("candid"), F.lit(True).alias("_sent"))
    message = F.concat(F.lit("already sent: "), F.col("objectId"))
    ok = F.when(F.col("_sent"), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return alerts.join(known, "candid", "left").filter(ok).drop("_sent")
