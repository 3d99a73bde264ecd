"""Queries for the composite jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.operators import relational
from skyloom.plans import alerts, association, detection, photometry, planning, stacking, vetting
from skyloom.session import store
from workload import frames as W
from workload import pixelops as X
from workload import relational as Q
from workload.frames import R2, R15, R30, VERSION, hav, near, r6, sql

c = F.col
QUERIES: dict = {}
ORACLE: dict[str, str] = {}
K4 = "field, ccdid, qid, fid"


def add(name: str, fn, text: str | None = None, extra: dict[str, str] | None = None) -> None:
    QUERIES[name] = fn
    if text is not None:
        ORACLE[name] = sql(text, extra)


# --- P1 association -------------------------------------------------------------
AS_OF = "2024-01-31 00:00:00"


def _associate(spark, sf):
    src = W.sources(spark, sf).select("id", "ra", "dec")
    return association.associate(W.detections(spark, sf), src, AS_OF, next_number=1, prefix="N")


def assoc_ctes() -> dict[str, str]:
    known = f"""SELECT id, sid FROM (SELECT d.id, s.id AS sid, row_number() OVER (PARTITION BY d.id ORDER BY {hav('d.ra', 'd.dec', 's.ra', 's.dec')}, s.id) AS k
      FROM v_det d JOIN v_src s ON d.source_id IS NULL AND d.created_at > TIMESTAMP '2024-01-24' AND {near('d', 's', R2)}) t WHERE k = 1"""
    return {
        "known": known,
        "free": "SELECT id, ra, dec FROM v_det WHERE source_id IS NULL AND rb > 0.4 AND id NOT IN (SELECT id FROM known)",
        "pairs": f"SELECT a.id AS i, b.id AS j FROM free a JOIN free b ON a.id <> b.id AND {near('a', 'b', R2)}",
        "r_reach": "SELECT DISTINCT i, i AS r FROM pairs UNION SELECT p.j, t.r FROM r_reach t JOIN pairs p ON p.i = t.i",
        "lab": "SELECT i AS id, min(r) AS root FROM r_reach GROUP BY 1",
        "fresh": "SELECT id, CONCAT('N', lpad(CAST(dense_rank() OVER (ORDER BY root) AS VARCHAR), 8, '0')) AS sid FROM lab",
    }


add("associate", lambda s, d: _associate(s, d)[0].select("id", "source_id", "triggers_alert"),
    """SELECT d.id, coalesce(d.source_id, k.sid, f.sid) AS source_id,
       coalesce(d.triggers_alert, false) OR coalesce(d.source_id, k.sid, f.sid) IS NOT NULL AS triggers_alert
       FROM v_det d LEFT JOIN known k ON k.id = d.id LEFT JOIN fresh f ON f.id = d.id""", assoc_ctes())
add("associate_sources", lambda s, d: _associate(s, d)[1].select("id", "is_new", *r6("ra", "dec")),
    """SELECT b.sid AS id, true AS is_new, round(d.ra, 6) AS ra, round(d.dec, 6) AS dec FROM
       (SELECT f.sid, d.id, row_number() OVER (PARTITION BY f.sid ORDER BY d.flux / d.fluxerr DESC, d.id) AS k FROM fresh f JOIN v_det d USING (id)) b
       JOIN v_det d ON d.id = b.id AND b.k = 1
       UNION ALL SELECT s.id, false, round(coalesce(b.ra, s.ra), 6), round(coalesce(b.dec, s.dec), 6) FROM v_src s LEFT JOIN
       (SELECT coalesce(d.source_id, k.sid) AS sid, d.ra, d.dec, row_number() OVER (PARTITION BY coalesce(d.source_id, k.sid)
        ORDER BY d.flux / d.fluxerr DESC, d.id) AS k FROM v_det d LEFT JOIN known k ON k.id = d.id WHERE coalesce(d.source_id, k.sid) IS NOT NULL) b
       ON b.sid = s.id AND b.k = 1""", assoc_ctes())

# --- P2-P4 vetting ------------------------------------------------------------------


def objects(spark, sf):
    return W.table(spark, sf, "events").select("user_id").distinct().selectExpr(
        "CONCAT('S', user_id) AS id", "(user_id * 137.50776405e0) % 360e0 AS ra", "(user_id * 7.31e0) % 120e0 - 60e0 AS dec")


def halves(spark, sf):
    cat = W.catalog(spark, sf)
    return cat.filter("objid % 2 = 0"), cat.filter("objid % 2 = 1")


def listed(spark, sf, rule: str, shift: str):
    return W.catalog(spark, sf).filter(rule).selectExpr("objid AS id", "ra", f"dec + {shift} AS dec")


OBJ = """SELECT CONCAT('S', user_id) AS id, (user_id * 137.50776405e0) % 360e0 AS ra, (user_id * 7.31e0) % 120e0 - 60e0 AS dec
  FROM (SELECT DISTINCT user_id FROM events) u"""
SEP = hav("s.ra", "s.dec", "p.ra", "p.dec") + " * 3600"
NB = f"SELECT s.id AS sid, p.*, {SEP} AS sep, p.objid % 2 AS half FROM obj s JOIN v_cat p ON {near('s', 'p', R30)}"
HOST = """SELECT sid, max_by(CASE WHEN z_spec = -99 THEN z_phot_median ELSE z_spec END, half) AS redshift, max_by(objid, half) AS host FROM
  (SELECT *, row_number() OVER (PARTITION BY sid, half ORDER BY sep, objid) AS k FROM nb) t WHERE k = 1 GROUP BY 1"""


def _list_rule(rule: str, shift: str, number: int, text: str) -> str:
    other = f"(SELECT objid AS lid, ra, dec + {shift} AS dec FROM v_cat WHERE {rule})"
    return f"""SELECT n.sid, {number} + 5 * n.half AS rule, CONCAT('{text}', min(l.lid)) AS reason FROM nb n JOIN {other} l
      ON n.sep < 1.5 AND {near('n', 'l', R15)} GROUP BY n.sid, n.half"""


FIRED = f"""SELECT sid, 1 + 5 * half AS rule, '{vetting.REASON_STAR}' AS reason FROM nb WHERE parallax > 0 AND sep < 1.5
  UNION ALL SELECT sid, 2 + 5 * half, '{vetting.REASON_MASKED}' FROM nb WHERE sep < 2 AND (fracmasked_g > 0.2 OR fracmasked_r > 0.2 OR fracmasked_z > 0.2)
  UNION ALL {_list_rule('objid % 7 = 0', '1e-4', 3, vetting.REASON_HITS)}
  UNION ALL {_list_rule('objid % 5 = 0', '-2e-4', 4, vetting.REASON_QUASAR)}
  UNION ALL SELECT sid, 5 + 5 * half, '{vetting.REASON_PSF}' FROM nb WHERE type = 'PSF' AND sep < 1
  UNION ALL SELECT o.id, 11, '{vetting.REASON_REDSHIFT}' FROM obj o LEFT JOIN host h ON h.sid = o.id WHERE h.redshift IS NULL OR h.redshift <= 0.0001"""
VETO_CTES = {"obj": OBJ, "nb": NB, "host": HOST, "fired": FIRED}


def _veto_args(s, d):
    north, south = halves(s, d)
    return objects(s, d), north, south, listed(s, d, "objid % 7 = 0", "1e-4"), listed(s, d, "objid % 5 = 0", "-2e-4")


add("veto_reasons", lambda s, d: vetting.veto_reasons(*_veto_args(s, d), redshifts=objects(s, d).withColumn("redshift", F.lit(1.0))),
    """SELECT sid AS id, max(rule) AS rule, max_by(reason, rule) AS reason FROM fired WHERE rule < 11 GROUP BY 1""", VETO_CTES)


def _veto(spark, sf):
    score = W.detections(spark, sf).groupBy(F.concat(F.lit("S"), "user_id").alias("source_id")).agg(F.sum("rb").alias("score"))
    return vetting.veto_sources(*_veto_args(spark, sf), scores=score).select("id", "altdata", *r6("score"))


add("veto_sources", _veto,
    """SELECT o.id, CASE WHEN f.sid IS NOT NULL THEN CONCAT('{"rejected":"', f.reason, '"}') END AS altdata,
       round(CASE WHEN f.sid IS NOT NULL THEN -1e0 ELSE r.score END, 6) AS score FROM obj o
       LEFT JOIN (SELECT sid, max_by(reason, rule) AS reason FROM fired GROUP BY 1) f ON f.sid = o.id
       LEFT JOIN (SELECT CONCAT('S', user_id) AS id, sum(rb) AS score FROM v_det GROUP BY 1) r ON r.id = o.id""", VETO_CTES)
add("host_redshift", lambda s, d: vetting.host_redshift(objects(s, d), *halves(s, d)).select(
        "id", F.get_json_object("neighbor_info", "$.objid").cast("long").alias("host"), *r6("redshift")),
    "SELECT sid AS id, host, round(redshift, 6) AS redshift FROM host", VETO_CTES)


def matches(spark, sf, det=None):
    det = det if det is not None else W.detections(spark, sf).withColumn("source_id", F.concat(F.lit("S"), "user_id"))
    cat = W.catalog(spark, sf)
    ps1 = cat.selectExpr("objid", "ra", "dec", "flux_g AS gmag", "flux_r AS rmag", "flux_z AS imag", "flux_w1 AS zmag")
    scores = cat.filter("objid % 4 <> 0").selectExpr("objid", "(objid % 10) / 10e0 AS ps_score")
    names = {"ztfname": (cat, "name"), "mqid": (cat.filter("objid % 5 = 0"), "name"), "tnsid": (cat.filter("objid % 7 = 0"), "name")}
    return vetting.crossmatch_candidate(det.select("id", "ra", "dec", "source_id"), objects(spark, sf), ps1, scores, *halves(spark, sf), names)


DNB = f"""SELECT d.id, p.*EXCLUDE (user_id), {hav('d.ra', 'd.dec', 'p.ra', 'p.dec')} * 3600 AS sep, row_number() OVER (PARTITION BY d.id
  ORDER BY {hav('d.ra', 'd.dec', 'p.ra', 'p.dec')}, objid) AS k FROM v_det d JOIN v_cat p ON {near('d', 'p', R30)}"""
LNB = "SELECT *, row_number() OVER (PARTITION BY sid, half ORDER BY sep, objid) AS k FROM nb"


def _names(rule: str) -> str:
    return f"""SELECT id, string_agg(name, ',' ORDER BY name) AS names FROM (SELECT DISTINCT d.id, p.name FROM v_det d JOIN v_cat p
      ON {rule} AND {near('d', 'p', R15)}) t GROUP BY 1"""


MATCH_CTES = {**VETO_CTES, "dnb": DNB, "lnb": LNB, "n1": _names("true"), "n2": _names("p.objid % 5 = 0"), "n3": _names("p.objid % 7 = 0"),
              "three": """SELECT id, max(CASE WHEN k = 1 THEN objid END) AS objectidps1, max(CASE WHEN k = 3 THEN objid END) AS objectidps3,
                max(CASE WHEN k = 1 THEN sep END) AS distpsnr1, max(CASE WHEN k = 2 THEN flux_g END) AS psgmag2,
                max(CASE WHEN k = 1 THEN CASE WHEN objid % 4 <> 0 THEN (objid % 10) / 10e0 ELSE -999e0 END END) AS sgscore1 FROM dnb GROUP BY 1""",
              "ls": """SELECT sid, half, max(CASE WHEN k = 1 THEN objid END) AS lsobjectid1, max(CASE WHEN k = 2 THEN sep END) AS lsdistnr2,
                max(CASE WHEN k = 1 THEN CASE WHEN flux_r <= 0 THEN 0 ELSE -2.5e0 * log10(greatest(flux_r, 1e-300)) + 22.5e0 END END) AS lsr1,
                max(CASE WHEN k = 3 THEN type END) AS lstype3 FROM lnb GROUP BY 1, 2"""}
add("crossmatch_candidate", lambda s, d: matches(s, d).select(
        "id", "part", "ztfname", "mqid", "tnsid", "objectidps1", "objectidps3", "lsobjectid1", "lstype3",
        *r6("distpsnr1", "psgmag2", "sgscore1", "lsdistnr2", "lsr1")),
    """SELECT d.id, 0 AS part, coalesce(n1.names, '') AS ztfname, coalesce(n2.names, '') AS mqid, coalesce(n3.names, '') AS tnsid, t.objectidps1,
       t.objectidps3, l.lsobjectid1, l.lstype3, round(t.distpsnr1, 6) AS distpsnr1, round(t.psgmag2, 6) AS psgmag2, round(t.sgscore1, 6) AS sgscore1,
       round(l.lsdistnr2, 6) AS lsdistnr2, round(l.lsr1, 6) AS lsr1 FROM v_det d LEFT JOIN n1 USING (id) LEFT JOIN n2 USING (id) LEFT JOIN n3 USING (id)
       LEFT JOIN three t USING (id) LEFT JOIN ls l ON l.sid = CONCAT('S', d.user_id) AND l.half = CASE WHEN d.dec < 32 THEN 1 ELSE 0 END""", MATCH_CTES)

# --- P5-P7 alerts ------------------------------------------------------------------------
LC = """SELECT source_id, id, obsjd - 2400000.5e0 AS mjd, CONCAT('ztf', right(filtercode, 1)) AS filter, zp, 'ab' AS zpsys, flux, fluxerr, flags,
  -2.5e0 * log10(5e0 * fluxerr) + zp AS lim_mag FROM v_phot"""
add("light_curve", lambda s, d: alerts.light_curve(W.photometry(s, d)).select("source_id", "id", "filter", "zpsys", "flags", *r6("mjd", "zp", "flux", "fluxerr", "lim_mag")),
    """SELECT source_id, id, filter, zpsys, flags, round(mjd, 6) AS mjd, round(zp, 6) AS zp, round(flux, 6) AS flux, round(fluxerr, 6) AS fluxerr,
       round(lim_mag, 6) AS lim_mag FROM lc""", {"lc": LC})


def _parts(spark, sf):
    parts = alerts.light_curve_parts(W.photometry(spark, sf), size=20)
    points = parts.select("source_id", "part", F.posexplode("points").alias("pos", "p"))
    return points.select("source_id", "part", "pos", c("p.id").alias("id"))


add("light_curve_parts", _parts,
    """SELECT source_id, (k - 1) // 20 AS part, (k - 1) % 20 AS pos, id FROM
       (SELECT source_id, id, row_number() OVER (PARTITION BY source_id ORDER BY mjd, id) AS k FROM lc) t""", {"lc": LC})


def headed_images(spark, sf):
    return W.images(spark, sf).withColumn("header", F.expr("map('PROGRMPI', CONCAT('PI', id % 3), 'PROGRMID', CAST(id % 3 AS STRING))"))


def all_bridges(spark, sf):
    return W.stack_bridge(spark, sf).unionByName(W.ref_bridge(spark, sf))


def ready(spark, sf):
    return relational.detections_needing_alert(W.placed_detections(spark, sf), Q.ALERTED(spark, sf))


def packets(spark, sf, kind: str, det=None):
    det = store(ready(spark, sf) if det is None else det)
    single, stack = W.subs(spark, sf), W.stack_subs(spark, sf)
    return alerts.build_alerts(
        det, W.realbogus(spark, sf), headed_images(spark, sf), single, stack, all_bridges(spark, sf), W.placed_detections(spark, sf),
        W.photometry(spark, sf), matches(spark, sf, det), X.stamps(spark, sf, 3, det), kind, size=40)


def flat_packets(kind: str, *own):
    def run(spark, sf):
        f = c("candidate")
        cols = "ndethist_single ndethist_stack rcid programid programpi nframesref objectidps1 lsobjectid1 ztfname drbversion".split()
        times = "jdstartref jdendref jdstarthist_single jdendhist_single jdstarthist_stack jdendhist_stack snr".split()
        return packets(spark, sf, kind).select(
            "objectId", "candid", "part", F.size("light_curve").alias("n_points"), F.size("cutoutScience").alias("n_rows"),
            *[f[n].alias(n) for n in cols], *[F.round(f[n].cast("double"), 3).alias(n) for n in [*times, *own]],
            F.round(F.aggregate("light_curve", F.lit(0.0), lambda a, p: a + p["mjd"]), 2).alias("sum_mjd"))
    return run


def alert_ctes(kind: str) -> dict[str, str]:
    if kind == "single":
        base = """SELECT a.*, i.obsjd AS jd, i.nid, i.exptime, i.obsjd - 2400000.5e0 AS epoch, s.reference_image_id AS rid, s.ccdid, s.qid,
          CONCAT('PI', i.id % 3) AS pi, i.id % 3 AS pid FROM ready a JOIN v_sub s ON s.id = a.image_id JOIN v_img i ON i.id = s.target_image_id"""
    else:
        base = """SELECT a.*, e.*, e.hi - 2400000.5e0 AS epoch, s.reference_image_id AS rid, s.ccdid, s.qid, CONCAT('PI', e.first % 3) AS pi,
          e.first % 3 AS pid FROM ready a JOIN v_ssub s ON s.id = a.image_id JOIN (SELECT stack_id, min(obsjd) AS lo, max(obsjd) AS hi,
          quantile_cont(obsjd, 0.5) AS med, count(*) AS nf, sum(exptime) AS exptime, min(id) AS first FROM v_img GROUP BY 1) e ON e.stack_id = s.target_image_id"""
    return {
        "ready": "SELECT * FROM v_pdet WHERE coalesce(alert_ready, false) AND id % 6 <> 0",
        "base": base, "lc": LC, "h1": Q.HIST1, "h2": Q.HIST2, **MATCH_CTES,
        "past1": """SELECT b.id, count(h.mjd) AS n, min(h.mjd) + 2400000.5e0 AS lo, max(h.mjd) + 2400000.5e0 AS hi FROM base b LEFT JOIN h1 h
          ON h.source_id = b.source_id AND h.mjd < b.epoch GROUP BY 1""",
        "past2": """SELECT b.id, count(h.min_mjd) AS n, min_by(h.min_mjd, (h.max_mjd, h.min_mjd)) + 2400000.5e0 AS lo, max(h.max_mjd) + 2400000.5e0 AS hi
          FROM base b LEFT JOIN h2 h ON h.source_id = b.source_id AND h.min_mjd < b.epoch GROUP BY 1""",
        "points": """SELECT b.id, (l.k - 1) // 40 AS part, count(*) FILTER (l.mjd <= b.epoch + 0.5e0 / 86400e0) AS n,
          coalesce(sum(l.mjd) FILTER (l.mjd <= b.epoch + 0.5e0 / 86400e0), 0e0) AS total FROM base b
          JOIN (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY mjd, id) AS k FROM lc) l ON l.source_id = b.source_id GROUP BY 1, 2""",
        "span": "SELECT 9000000 + kidx AS rid, count(*) AS n, min(obsjd) AS lo, max(obsjd) AS hi FROM v_img WHERE id % 3 = 0 GROUP BY 1",
    }


def alert_sql(own: dict[str, str]) -> str:
    extra = ", ".join(f"round({expr}, 3) AS {name}" for name, expr in own.items())
    return f"""SELECT b.source_id AS objectId, b.id AS candid, q.part, q.n AS n_points, 3 AS n_rows, p1.n AS ndethist_single, p2.n AS ndethist_stack,
      (b.ccdid - 1) * 4 + b.qid - 1 AS rcid, b.pid AS programid, b.pi AS programpi, sp.n AS nframesref, t.objectidps1, l.lsobjectid1,
      CASE WHEN q.part = 0 THEN coalesce(n1.names, '') ELSE '' END AS ztfname, 'm1' AS drbversion, round(sp.lo, 3) AS jdstartref, round(sp.hi, 3) AS jdendref,
      round(p1.lo, 3) AS jdstarthist_single, round(p1.hi, 3) AS jdendhist_single, round(p2.lo, 3) AS jdstarthist_stack, round(p2.hi, 3) AS jdendhist_stack,
      round(CAST(CAST(b.flux / b.fluxerr AS FLOAT) AS DOUBLE), 3) AS snr, {extra}, round(q.total, 2) AS sum_mjd
      FROM base b JOIN points q ON q.id = b.id AND (q.part = 0 OR q.n > 0) LEFT JOIN past1 p1 ON p1.id = b.id LEFT JOIN past2 p2 ON p2.id = b.id
      LEFT JOIN span sp ON sp.rid = b.rid LEFT JOIN three t ON t.id = b.id LEFT JOIN n1 ON n1.id = b.id
      LEFT JOIN ls l ON l.sid = b.source_id AND l.half = CASE WHEN b.dec < 32 THEN 1 ELSE 0 END"""


add("build_alerts_single", flat_packets("single", "jd", "nid", "exptime"),
    alert_sql({"jd": "jd", "nid": "CAST(nid AS DOUBLE)", "exptime": "b.exptime"}), alert_ctes("single"))
add("build_alerts_stack", flat_packets("stack", "jdstartstack", "jdendstack", "jdmed", "nframesstack", "exptime"),
    alert_sql({"jdstartstack": "b.lo", "jdendstack": "b.hi", "jdmed": "b.med", "nframesstack": "CAST(b.nf AS DOUBLE)", "exptime": "b.exptime"}), alert_ctes("stack"))


def _history(spark, sf):
    single = Q.single_history(spark, sf)
    epochs = single.groupBy(c("detection_id").alias("id"), "source_id").agg(F.max("mjd").alias("epoch"))
    return alerts.history_before(epochs, single, Q.stack_history(spark, sf)).select("id", "ndethist_single", "ndethist_stack", F.round("jdendhist_single", 3).alias("jdendhist_single"))


add("history_before", _history,
    """SELECT a.detection_id AS id, any_value(x.n) AS ndethist_single, count(h.min_mjd) AS ndethist_stack, round(any_value(x.hi), 3) AS jdendhist_single FROM h1 a
       JOIN (SELECT a.detection_id, count(b.mjd) AS n, max(b.mjd) + 2400000.5e0 AS hi FROM h1 a LEFT JOIN h1 b ON b.source_id = a.source_id AND b.mjd < a.mjd GROUP BY 1) x
       USING (detection_id) LEFT JOIN h2 h ON h.source_id = a.source_id AND h.min_mjd < a.mjd GROUP BY 1""", {"h1": Q.HIST1, "h2": Q.HIST2})


def _send(spark, sf):
    rows = W.placed_detections(spark, sf).select(c("id").alias("candid"), c("source_id").alias("objectId"))
    todo, sent = alerts.send_alerts(rows, Q.ALERTED(spark, sf), F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    return todo.join(sent.select(c("detection_id").alias("candid"), "sent"), "candid").select("candid", "objectId", "sent", "created_at")


add("send_alerts", _send, "SELECT id AS candid, source_id AS objectId, true AS sent, TIMESTAMP '2024-02-01' AS created_at FROM v_pdet WHERE id % 6 <> 0")



def _resend(spark, sf):
    sent = Q.ALERTED(spark, sf)
    rows = W.placed_detections(spark, sf).select(c("id").alias("candid"), c("source_id").alias("objectId"))
    return alerts.refuse_resend(rows.filter("candid % 6 <> 0"), sent)


add("refuse_resend", _resend, "SELECT id AS candid, source_id AS objectId FROM v_pdet WHERE id % 6 <> 0")

# --- P8-P10, P13 planning ---------------------------------------------------------------------
GOOD = f"""SELECT *, row_number() OVER (PARTITION BY {K4} ORDER BY maglimit DESC, id) AS rn FROM v_img WHERE kidx % 2 <> 0 AND infobits = 0
  AND seeing > 1.7 AND seeing < 2.5 AND maglimit > 19.2 AND maglimit < 22 AND obsdate < TIMESTAMP '2022-01-01'"""
add("plan_references", lambda s, d: planning.plan_references(W.images(s, d), W.refs(s, d), VERSION, n=5, n_min=3, fields=None, before="2022-01-01").select("basename", "id", "row"),
    f"""SELECT {Q.REFNAME} AS basename, id, rn AS row FROM (SELECT *, count(*) OVER (PARTITION BY {K4}) AS n FROM good WHERE rn <= 5) t WHERE n >= 3""", {"good": GOOD})
add("plan_stacks", lambda s, d: planning.plan_stacks(W.images(s, d), W.subs(s, d), W.refs(s, d), Q.coadds(s, d), VERSION, until="2023-01-01", min_maglimit=18.2,
                                                     after_day=20180107000000).select("field", "ccdid", "qid", "fid", "binleft", "size", "first_id"),
    f"""SELECT {K4}, binleft, count(*) AS size, min(id) AS first_id FROM mem WHERE seeing < 4 AND maglimit > 18.2 AND filefracday > 20180107000000
        AND NOT (kidx % 3 <> 0 AND bin % 2 = 0) GROUP BY {K4}, binleft HAVING count(*) >= 2""", Q.BIN_CTES)


def _night(spark, sf):
    return planning.plan_night(W.images(spark, sf), *Q.todo_args(spark, sf), size=100).select("id", "archive_path", "job")


add("plan_night", _night,
    f"""SELECT id, path AS archive_path, {Q.SPLIT.format(n='n')} AS job FROM (SELECT id, CONCAT('/a/', basename) AS path, row_number() OVER (ORDER BY basename DESC, id) - 1 AS r,
        count(*) OVER () AS t, CAST(ceil(count(*) OVER () / 100e0) AS BIGINT) AS n FROM v_img
        WHERE {Q.TODO} AND ipac_gid = 2 AND seeing < 4 AND maglimit > 19 AND basename > 'ztf_20200107') x""")
add("plan_retrieval", lambda s, d: planning.plan_retrieval(W.images(s, d).select("id"), W.images(s, d), Q.tape(s, d), Q.http(s, d), Q.archives(s, d)),
    """SELECT id, CASE WHEN on_tape THEN 'tape' WHEN id % 2 = 0 THEN 'http' ELSE 'remote' END AS location, CASE WHEN on_tape THEN j.job END AS job
       FROM (SELECT id, id % 3 = 0 AND id % 2 <> 0 AND fid <> 3 AS on_tape FROM v_img) i LEFT JOIN (SELECT path, (row_number() OVER (ORDER BY tape, position, path) - 1) % 14 AS job
       FROM arch WHERE path IN (SELECT CONCAT('/tape/', id % 50) FROM v_img WHERE id % 3 = 0 AND id % 2 <> 0 AND fid <> 3)) j ON j.path = CONCAT('/tape/', i.id % 50)""",
    {"arch": Q.ARCH})
add("download_list", lambda s, d: planning.download_list(W.images(s, d).select("id"), Q.tape(s, d).select(c("product_id").alias("id")), Q.http(s, d).select(c("product_id").alias("id"))),
    "SELECT id FROM v_img WHERE id % 3 <> 0 AND id % 2 <> 0")

# --- P11 photometry, P12 detection --------------------------------------------------------------


def solved_images(spark, sf):
    return W.table(spark, sf, "embeddings").selectExpr(
        "vec_id AS id", "4.5e0 AS crpix1", "4.5e0 AS crpix2", "(vec_id * 1.7e0) % 360e0 AS crval1", "(vec_id * 0.11e0) % 100e0 - 50e0 AS crval2",
        "-2.8e-4 AS cd11", "1e-6 AS cd12", "2e-6 AS cd21", "2.8e-4 AS cd22", "26e0 AS magzp", "0.05e0 AS apcor", "'ZTF_r' AS filter", "2458000e0 + vec_id AS obsjd")


def wanted(spark, sf):
    return W.table(spark, sf, "embeddings").selectExpr(
        "vec_id AS image_id", "CONCAT('S', vec_id % 20) AS source_id", "(vec_id * 1.7e0) % 360e0 + (vec_id % 5 - 2) * 1e-4 AS ra",
        "(vec_id * 0.11e0) % 100e0 - 50e0 + (vec_id % 7 - 3) * 1e-4 AS dec")


def _forced(spark, sf):
    todo, img = wanted(spark, sf), solved_images(spark, sf)
    src = todo.select(c("source_id").alias("id")).distinct().filter("id <> 'S3'")
    old = todo.filter("image_id % 10 = 9").selectExpr("source_id", "image_id", "1e0 AS flux", "1e0 AS fluxerr", "0 AS flags", "ra", "dec", "26e0 AS zp", "'zr' AS filtercode", "0e0 AS obsjd")
    out = photometry.force_photometry(todo.filter("image_id % 10 <> 9"), W.pixels(spark, sf), img, old, src, method="center")
    return out.select("source_id", "image_id", "flags", "filtercode", *r6("flux", "fluxerr", "zp", "obsjd"))


SOLVED = """SELECT vec_id AS image_id, CONCAT('S', vec_id % 20) AS source_id, (vec_id * 1.7e0) % 360e0 AS r0, (vec_id * 0.11e0) % 100e0 - 50e0 AS d0,
  (vec_id % 5 - 2) * 1e-4 AS dr, (vec_id * 0.11e0) % 100e0 - 50e0 + (vec_id % 7 - 3) * 1e-4 AS dec FROM embeddings"""
PLANE = """SELECT *, degrees(cos(radians(dec)) * sin(radians(dr)) / z) AS xi,
  degrees((cos(radians(d0)) * sin(radians(dec)) - sin(radians(d0)) * cos(radians(dec)) * cos(radians(dr))) / z) AS eta FROM
  (SELECT *, sin(radians(d0)) * sin(radians(dec)) + cos(radians(d0)) * cos(radians(dec)) * cos(radians(dr)) AS z FROM solved) t"""
PLACED = """SELECT *, (2.8e-4 * xi - 1e-6 * eta) / (-2.8e-4 * 2.8e-4 - 1e-6 * 2e-6) + 3.5e0 AS x,
  (-2.8e-4 * eta - 2e-6 * xi) / (-2.8e-4 * 2.8e-4 - 1e-6 * 2e-6) + 3.5e0 AS y FROM plane"""
add("force_photometry", _forced,
    f"""SELECT p.source_id, p.image_id, bit_or(q.mask) AS flags, 'zr' AS filtercode, round(sum(CASE WHEN {X.IN3} THEN q.value ELSE 0e0 END), 6) AS flux,
        round(sqrt(sum(CASE WHEN {X.IN3} THEN q.rms * q.rms ELSE 0e0 END)), 6) AS fluxerr, 26.05e0 AS zp, 2458000e0 + p.image_id AS obsjd
        FROM placed p JOIN v_pix q ON q.image_id = p.image_id AND {X.BOX} WHERE p.image_id % 10 <> 9 AND p.source_id <> 'S3' GROUP BY 1, 2
        UNION ALL SELECT source_id, image_id, 0, 'zr', 1e0, 1e0, 26e0, 0e0 FROM solved WHERE image_id % 10 = 9""",
    {"solved": SOLVED, "plane": PLANE, "placed": PLACED})


def footprints(spark, sf):
    """The pixel images with the corners of their 8 x 8 pixels."""
    rows = solved_images(spark, sf).withColumns({"ra": c("crval1"), "dec": c("crval2")})
    half = F.expr("1.12e-3 / cos(radians(dec))")
    sides = {1: (-1, -1), 2: (1, -1), 3: (1, 1), 4: (-1, 1)}
    return rows.withColumns({f"ra{k}": c("ra") + half * i for k, (i, _) in sides.items()} | {f"dec{k}": c("dec") + 1.12e-3 * j for k, (_, j) in sides.items()})


def photometry_run(spark, sf):
    src = wanted(spark, sf).select(F.concat(F.lit("S"), "image_id").alias("id"), "ra", "dec", "image_id")
    old = src.filter("image_id % 10 = 9").selectExpr("id AS source_id", "image_id", "1e0 AS flux", "1e0 AS fluxerr", "0 AS flags", "ra", "dec", "26e0 AS zp", "'zr' AS filtercode", "0e0 AS obsjd")
    det = W.pixel_positions(spark, sf).select("id", "image_id", F.lit(False).alias("alert_ready"))
    return photometry.photometry_run(footprints(spark, sf), src.drop("image_id"), W.pixels(spark, sf), old, det, method="center", prefilter_deg=4e-3)


add("photometry_run", lambda s, d: photometry_run(s, d)[0].select("source_id", "image_id", "flags", "filtercode", *r6("flux", "fluxerr", "zp", "obsjd")),
    f"""SELECT CONCAT('S', p.image_id) AS source_id, p.image_id, bit_or(q.mask) AS flags, 'zr' AS filtercode, round(sum(CASE WHEN {X.IN3} THEN q.value ELSE 0e0 END), 6) AS flux,
        round(sqrt(sum(CASE WHEN {X.IN3} THEN q.rms * q.rms ELSE 0e0 END)), 6) AS fluxerr, 26.05e0 AS zp, 2458000e0 + p.image_id AS obsjd
        FROM placed p JOIN v_pix q ON q.image_id = p.image_id AND {X.BOX} WHERE p.image_id % 10 <> 9 GROUP BY p.image_id
        UNION ALL SELECT CONCAT('S', image_id), image_id, 0, 'zr', 1e0, 1e0, 26e0, 0e0 FROM solved WHERE image_id % 10 = 9""",
    {"solved": SOLVED, "plane": PLANE, "placed": PLACED})
add("photometry_run_ready", lambda s, d: photometry_run(s, d)[1].select("id", "alert_ready"), "SELECT id, image_id % 10 <> 9 AS alert_ready FROM v_pos")
add("mark_alert_ready", lambda s, d: photometry.mark_alert_ready(W.detections(s, d), W.detections(s, d).filter("id % 5 = 0").select("id")).select("id", "alert_ready"),
    "SELECT id, CASE WHEN id % 5 = 0 THEN true ELSE alert_ready END AS alert_ready FROM v_det")


def clean_pixels(spark, sf):
    """Spiked pixels whose mask is set on every third image only."""
    mask = F.expr("CASE WHEN image_id % 3 = 0 THEN mask ELSE 0 END")
    return X.spiked(spark, sf).withColumn("value", F.expr("CASE WHEN image_id % 4 = 0 THEN value ELSE 0.001e0 * value END")).withColumn("mask", mask)


def object_catalog(spark, sf):
    det = W.detections(spark, sf).drop("image_id", "ra", "dec")
    return det.join(X.small_boxes(spark, sf), "id")


def _filter(spark, sf):
    kept, failed = detection.filter_detections(object_catalog(spark, sf), clean_pixels(spark, sf), max_rows=4)
    return kept.select("id", "image_id", F.lit("kept").alias("kind")).unionByName(
        failed.select(c("n").alias("id"), "image_id", F.lit("failed").alias("kind")))


FILTER_CTES = {
    "sp0": X.SPIKED, "sp": "SELECT image_id, x, y, CASE WHEN image_id % 4 = 0 THEN value ELSE 0.001e0 * value END AS value FROM sp0",
    "z": X.SIGMAS, "bad": X.BADPIX,
    "cl": "SELECT image_id, x, y, rms, CASE WHEN image_id % 3 = 0 THEN mask ELSE 0 END AS mask FROM v_pix",
    "med": "SELECT image_id, median(rms) AS m FROM cl WHERE (mask & 198589) = 0 GROUP BY 1",
    "ap": f"""SELECT id, sum(rms * w) / (acos(-1) * 36e0) AS rmscut, sum(CASE WHEN (mask & 198589) > 0 THEN w ELSE 0e0 END) AS bpmcut FROM (SELECT p.id, q.rms, q.mask,
      {X.overlap_sql('(q.x - p.x)', '(q.y - p.y)', 6)} AS w FROM (SELECT id, image_id, x + 1 AS x, y + 1 AS y FROM v_pos) p JOIN cl q ON q.image_id = p.image_id
      AND q.x BETWEEN floor(p.x - 5.5e0) AND ceil(p.x + 6.5e0) - 1 AND q.y BETWEEN floor(p.y - 5.5e0) AND ceil(p.y + 6.5e0) - 1) t GROUP BY 1""",
    "good": """SELECT d.id, p.image_id FROM v_det d JOIN v_pos p USING (id) LEFT JOIN ap USING (id) LEFT JOIN med ON med.image_id = p.image_id
      WHERE (d.imaflags_iso & 198589) = 0 AND d.flags_weight = 0 AND d.flags <= 2 AND a_image / b_image <= 2 AND fwhm_image / seeing <= 2
      AND fwhm_image >= seeing * 0.8e0 AND flux / fluxerr >= 5 AND NOT coalesce(bpmcut > 0, false) AND NOT coalesce(rmscut > 1.1e0 * m, false)
      AND rb >= CASE fid WHEN 3 THEN 0.6 ELSE 0.3 END AND NOT EXISTS (SELECT 1 FROM bad b WHERE b.image_id = p.image_id
      AND b.x BETWEEN round_even(p.x + 1, 0) - 6 AND round_even(p.x + 1, 0) + 4 AND b.y BETWEEN round_even(p.y + 1, 0) - 6 AND round_even(p.y + 1, 0) + 4)""",
}
add("filter_detections", _filter,
    """SELECT id, image_id, 'kept' AS kind FROM (SELECT *, count(*) OVER (PARTITION BY image_id) AS n FROM good) t WHERE n <= 4
       UNION ALL SELECT count(*), image_id, 'failed' FROM good GROUP BY image_id HAVING count(*) > 4""", FILTER_CTES)

# --- P14-P16 stacks and differences -------------------------------------------------------------------


def frame_images(spark, sf):
    return W.table(spark, sf, "embeddings").selectExpr(
        "vec_id AS id", "label AS field", "1 AS ccdid", "2 AS qid", "1 AS fid", "25e0 + (vec_id % 3) * 0.1e0 AS magzp", "0.05e0 AS apcor", "2e0 AS seeing",
        "2458000e0 + vec_id AS obsjd", "CONCAT('img', vec_id, '.fits') AS basename")


def frame_bridge(spark, sf):
    return W.table(spark, sf, "embeddings").selectExpr("label AS coadd_id", "vec_id AS image_id")


SCALED = """SELECT *, value * sc AS v, rms * sc AS r, weight / (sc * sc) AS wt FROM
  (SELECT *, pow(10e0, -0.4e0 * ((image_id % 3) * 0.1e0)) AS sc FROM w) t"""
CLIP = "abs(v - m) <= 4 * r + 0.3e0 * abs(m)"


def clipped(extra: str = "") -> str:
    return f"""round(CASE WHEN sum(wt) FILTER ({CLIP}) > 0 THEN sum(v * wt) FILTER ({CLIP}) / sum(wt) FILTER ({CLIP}) ELSE any_value(m) END {extra}, 6) AS value"""


def _stack(spark, sf):
    stacked, meta = stacking.build_stack(frame_bridge(spark, sf), frame_images(spark, sf), X.weighted(spark, sf))
    return stacked.join(meta.select("coadd_id", "n_inputs", "mjd"), "coadd_id").select("coadd_id", "x", "y", "n_frames", "n_inputs", "mask", *r6("value", "mjd"))


add("build_stack", _stack,
    f"""SELECT grp AS coadd_id, x, y, count(*) AS n_frames, count(*) AS n_inputs, bit_and(mask) | CASE WHEN sum(wt) = 0 THEN 65536 ELSE 0 END AS mask,
        {clipped('+ 150e0')}, round(median(2458000e0 + image_id - 2400000.5e0), 6) AS mjd FROM (SELECT *, median(v) OVER (PARTITION BY grp, x, y) AS m FROM sc) t GROUP BY 1, 2, 3""",
    {"w": X.WEIGHTED, "sc": SCALED})


def group_refs(spark, sf):
    """The first image of each group is the reference; group 9 has none."""
    first = W.table(spark, sf, "embeddings").filter("label <> 9").groupBy("label").agg(F.min("vec_id").alias("id"))
    return first.selectExpr("id", "label AS field", "1 AS ccdid", "2 AS qid", "1 AS fid", f"'{VERSION}' AS version", "CONCAT('ref', id, '.fits') AS basename")


def _subtract(spark, sf):
    img, ref = frame_images(spark, sf), group_refs(spark, sf)
    pix = W.pixels(spark, sf)
    ref_pix = pix.join(ref.select(c("id").alias("image_id")), "image_id", "left_semi")
    done = frame_images(spark, sf).filter("id % 6 = 0").join(ref.select("field", c("id").alias("reference_image_id")), "field").select(
        c("id").alias("target_image_id"), "reference_image_id")
    diff, rows, failed = stacking.subtract(img, ref, pix.filter("image_id % 11 <> 0"), ref_pix, done, VERSION)
    per = diff.groupBy(c("image_id").alias("id")).agg(F.round(F.sum("value"), 5).alias("total"), F.bit_or("mask").alias("mask"))
    good = rows.select(c("target_image_id").alias("id"), "basename").join(per, "id")
    bad = failed.select(c("target_image_id").alias("id"), c("reason").alias("basename"), F.lit(None).cast("double").alias("total"), F.lit(None).cast("int").alias("mask"))
    return good.unionByName(bad)


add("subtract", _subtract,
    """SELECT s.image_id AS id, CONCAT('sub.img', s.image_id, '_ref', r.image_id, '.fits') AS basename, round(sum(s.value - r.value), 5) AS total, bit_or(s.mask | r.mask) AS mask
       FROM v_pix s JOIN firsts f ON f.label = s.grp JOIN v_pix r ON r.image_id = f.rid AND r.x = s.x AND r.y = s.y WHERE s.image_id % 11 <> 0 AND s.image_id % 6 <> 0 GROUP BY s.image_id, r.image_id
       UNION ALL SELECT vec_id, CASE WHEN f.rid IS NULL THEN 'no reference' ELSE 'no pixels' END, NULL, NULL FROM embeddings e LEFT JOIN firsts f ON f.label = e.label
       WHERE f.rid IS NULL OR (vec_id % 11 = 0 AND vec_id % 6 <> 0)""",
    {"firsts": "SELECT label, min(vec_id) AS rid FROM embeddings WHERE label <> 9 GROUP BY 1"})


def _stack_sub(spark, sf):
    subs = W.table(spark, sf, "embeddings").filter("label <> 3 OR vec_id % 2 = 0").selectExpr("vec_id AS id", "vec_id AS target_image_id", "77 AS reference_image_id")
    out = stacking.stack_subtraction(frame_bridge(spark, sf), subs, frame_images(spark, sf), X.weighted(spark, sf))
    return out.select("stack_id", "reference_image_id", "x", "y", "n_frames", "mask", *r6("value"))


add("stack_subtraction", _stack_sub,
    f"""SELECT grp AS stack_id, 77 AS reference_image_id, x, y, count(*) AS n_frames, bit_and(mask) | CASE WHEN sum(wt) = 0 THEN 65536 ELSE 0 END AS mask, {clipped()}
        FROM (SELECT *, median(v) OVER (PARTITION BY grp, x, y) AS m FROM sc) t WHERE grp <> 3 GROUP BY 1, 3, 4""", {"w": X.WEIGHTED, "sc": SCALED})
