"""Queries for the streaming jobs.

The given tables are written as files in two steps, in time order; the stream is
run to its end after each step with the same checkpoint, so the second run goes on
from the state of the first.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.plans.association import match_known
from skyloom.session import scratch_root
from skyloom.streaming import jobs as T
from workload import frames as W
from workload import jobs as J
from workload.frames import R2, hav, near, r6, sql

c = F.col
QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def add(name: str, fn, text: str | None = None, extra: dict[str, str] | None = None) -> None:
    QUERIES[name] = fn
    if text is not None:
        ORACLE[name] = sql(text, extra)


def in_two_steps(spark, rows: DataFrame, first: str, run) -> str:
    """Write the rows that match ``first``, run, write the others, run again; returns the output folder."""
    root = f"{scratch_root(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    for cond in (F.expr(first), ~F.expr(first)):
        rows.filter(cond).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
        run(stream, f"{root}/out", f"{root}/checkpoint")
    return f"{root}/out"


def appended(spark, rows: DataFrame, first: str, transform) -> DataFrame:
    """All rows that the transformed stream appended."""
    out = in_two_steps(spark, rows, first, lambda s, out, check: T.run_to_end(transform(s), out, check))
    return spark.read.parquet(out)


HALF = "created_at < TIMESTAMP_NTZ '2024-01-16 00:00:00'"


def timed(spark, sf) -> DataFrame:
    return W.detections(spark, sf).withColumn("created_at", c("created_at").cast("timestamp"))


def _ingest(spark, sf):
    rows = timed(spark, sf).select(F.concat(F.lit("img"), c("id") - c("id") % 2).alias("basename"), (c("id") % 3).alias("ipac_gid"), "created_at")
    return appended(spark, rows, HALF, lambda s: T.stream_ingest(s, delay="60 days")).select("basename")


add("stream_ingest", _ingest, "SELECT DISTINCT CONCAT('img', id - id % 2) AS basename FROM v_det WHERE id % 3 > 0")
add("stream_filter", lambda s, d: appended(s, timed(s, d), HALF, T.stream_filter).select("id"),
    """SELECT id FROM v_det WHERE (imaflags_iso & 198589) = 0 AND flags <= 2 AND a_image / b_image <= 2 AND fwhm_image / seeing <= 2
       AND fwhm_image >= seeing * 0.8e0 AND flux / fluxerr >= 5 AND rb >= CASE fid WHEN 3 THEN 0.6 ELSE 0.3 END""")
add("stream_associate", lambda s, d: appended(
        s, timed(s, d).select("id", "ra", "dec", "created_at"), HALF, lambda x: T.stream_associate(x, W.sources(s, d))).select("id", "matched_source", *r6("sep_deg")),
    f"""SELECT d.id, s.id AS matched_source, round({hav('d.ra', 'd.dec', 's.ra', 's.dec')}, 6) AS sep_deg FROM v_det d JOIN v_src s ON {near('d', 's', R2)}""")


def _associate_batches(spark, sf):
    """Each micro-batch assigns its detections to the nearest known source, written under its number."""
    known = W.sources(spark, sf)

    def run(stream, out, check):
        def step(batch: DataFrame, number: int) -> None:
            match_known(batch, known).write.mode("overwrite").parquet(f"{out}/batch={number}")
        T.run_associate(stream, step, check).awaitTermination()

    out = in_two_steps(spark, timed(spark, sf).select("id", "ra", "dec", "created_at"), HALF, run)
    return spark.read.parquet(f"{out}/batch=*").select("id", "source_id")


add("stream_associate_batches", _associate_batches,
    f"""SELECT id, source_id FROM (SELECT d.id, s.id AS source_id, row_number() OVER (PARTITION BY d.id ORDER BY {hav('d.ra', 'd.dec', 's.ra', 's.dec')}, s.id) AS k
        FROM v_det d JOIN v_src s ON {near('d', 's', R2)}) t WHERE k = 1""")


def _associations(spark, sf, kind: str) -> DataFrame:
    """P1 on every micro-batch, with sources and open detections carried from the first to the second."""
    known = W.sources(spark, sf).select("id", "ra", "dec")
    det = W.detections(spark, sf)
    out = in_two_steps(spark, det, HALF, lambda s, out, check: T.stream_associations(s, known, out, check).awaitTermination())
    if kind == "sources":
        return T.associated_sources(spark, out, known, det.schema)
    return T.open_detections(spark, out, det.schema) if kind == "open" else spark.read.parquet(f"{out}/{kind}")


def _step(n: int, det: str, src: str, taken: str) -> dict[str, str]:
    """P1 of one batch as in ``jobs.assoc_ctes``, with the batch's own detections, sources and last taken number."""
    return {
        f"known{n}": f"""SELECT id, sid FROM (SELECT d.id, s.id AS sid, row_number() OVER (PARTITION BY d.id ORDER BY {hav('d.ra', 'd.dec', 's.ra', 's.dec')}, s.id) AS k
          FROM {det} d JOIN {src} s ON d.source_id IS NULL AND d.created_at > (SELECT max(created_at) FROM {det}) - INTERVAL 7 DAY AND {near('d', 's', R2)}) t WHERE k = 1""",
        f"free{n}": f"SELECT id, ra, dec FROM {det} WHERE source_id IS NULL AND rb > 0.4 AND id NOT IN (SELECT id FROM known{n})",
        f"pairs{n}": f"SELECT a.id AS i, b.id AS j FROM free{n} a JOIN free{n} b ON a.id <> b.id AND {near('a', 'b', R2)}",
        f"r_reach{n}": f"SELECT DISTINCT i, i AS r FROM pairs{n} UNION SELECT p.j, t.r FROM r_reach{n} t JOIN pairs{n} p ON p.i = t.i",
        f"lab{n}": f"SELECT i AS id, min(r) AS root FROM r_reach{n} GROUP BY 1",
        f"fresh{n}": f"SELECT id, CONCAT('N', lpad(CAST({taken} + dense_rank() OVER (ORDER BY root) AS VARCHAR), 8, '0')) AS sid FROM lab{n}",
        f"found{n}": f"""SELECT d.id, d.ra, d.dec, d.flux, d.fluxerr, d.triggers_alert, coalesce(d.source_id, k.sid, f.sid) AS sid
          FROM {det} d LEFT JOIN known{n} k ON k.id = d.id LEFT JOIN fresh{n} f ON f.id = d.id""",
    }


#: every source stands at the best of all detections it has by then, in whichever batch they came
_STANDS = """SELECT coalesce(s.id, b.sid) AS id, coalesce(b.ra, s.ra) AS ra, coalesce(b.dec, s.dec) AS dec, b.id AS best_id
  FROM v_src s FULL JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY flux / fluxerr DESC, id) AS k FROM {found} WHERE sid IS NOT NULL) t WHERE k = 1
    AND (sid LIKE 'N%' OR sid IN (SELECT id FROM v_src))) b ON b.sid = s.id"""
ASSOCIATIONS = {
    "det1": "SELECT * FROM v_det WHERE created_at < TIMESTAMP '2024-01-16'",
    **_step(1, "det1", "v_src", "0"), "src1": _STANDS.format(found="found1"),
    "det2": "SELECT * FROM v_det WHERE created_at >= TIMESTAMP '2024-01-16' OR id IN (SELECT id FROM found1 WHERE sid IS NULL)",
    **_step(2, "det2", "src1", "(SELECT count(DISTINCT sid) FROM fresh1)"),
    "found": "SELECT * FROM found1 WHERE sid IS NOT NULL UNION ALL SELECT * FROM found2",
}
add("stream_associations", lambda s, d: _associations(s, d, "detections").select("id", "source_id", "triggers_alert"),
    "SELECT id, sid AS source_id, true AS triggers_alert FROM found WHERE sid IS NOT NULL", ASSOCIATIONS)
add("stream_association_sources", lambda s, d: _associations(s, d, "sources").select("id", "best_id", *r6("ra", "dec")),
    "SELECT id, best_id, round(ra, 6) AS ra, round(dec, 6) AS dec FROM src2", ASSOCIATIONS | {"src2": _STANDS.format(found="found")})

add("stream_open_detections", lambda s, d: _associations(s, d, "open").select("id"), "SELECT id FROM found2 WHERE sid IS NULL", ASSOCIATIONS)


def _state(spark, sf):
    rows = timed(spark, sf).withColumn("source_id", F.concat(F.lit("S"), "user_id")).select("id", "source_id", "rb", "ra", "dec", "mjd", "flux", "fluxerr", "created_at")

    def run(stream, out, check):
        T.run_updates(T.stream_source_state(stream), out, check, ["source_id"], fold_every=1)

    out = in_two_steps(spark, rows, HALF, run)
    return T.latest_state(spark, out, ["source_id"]).select("source_id", "n", *r6("sum_rb", "ra", "dec", "last_mjd"))


add("stream_source_state", _state,
    """SELECT CONCAT('S', user_id) AS source_id, count(*) AS n, round(sum(rb), 6) AS sum_rb, round(max_by(ra, (flux / fluxerr, -id)), 6) AS ra,
       round(max_by(dec, (flux / fluxerr, -id)), 6) AS dec, round(max(mjd), 6) AS last_mjd FROM v_det GROUP BY user_id""")


def _bins(spark, sf):
    rows = W.images(spark, sf).select("id", "field", "ccdid", "qid", "fid", "obsdate")
    out = appended(spark, rows, "obsdate < TIMESTAMP_NTZ '2020-06-01 00:00:00'", T.stream_stack_bins)
    return out.withColumns({n: c(n).cast("timestamp_ntz") for n in ("binleft", "binright")})


BINS = """SELECT field, ccdid, qid, fid, TIMESTAMP '2017-01-03' + to_days(CAST(7 * k AS INT)) AS binleft, TIMESTAMP '2017-01-03' + to_days(CAST(7 * k + 7 AS INT)) AS binright,
  count(*) AS size FROM (SELECT *, CAST(ceil(date_diff('day', TIMESTAMP '2017-01-03', obsdate) / 7e0) AS BIGINT) - 1 AS k FROM v_img) t GROUP BY 1, 2, 3, 4, 5, 6"""
add("stream_stack_bins", _bins,
    "SELECT * FROM b WHERE binright <= (SELECT max(obsdate) - INTERVAL 1 MICROSECOND - INTERVAL 7 DAY FROM v_img)", {"b": BINS})


def _alerts(spark, sf):
    rows = timed(spark, sf).select((c("id") - c("id") % 2).alias("candid"), "created_at")

    def run(stream, out, check):
        T.stream_alerts(stream, out, check).awaitTermination()

    out = in_two_steps(spark, rows, HALF, run)
    return spark.read.parquet(out).select("candid")


add("stream_alerts", _alerts, "SELECT DISTINCT id - id % 2 AS candid FROM v_det")


def _packets(spark, sf):
    """Ready detections of single images as they come, each batch assembled into packets."""
    det = J.ready(spark, sf).withColumn("candid", c("id")).withColumn("created_at", c("created_at").cast("timestamp"))

    def build(batch: DataFrame) -> DataFrame:
        return J.packets(spark, sf, "single", batch.drop("candid")).select("objectId", "candid", "part", c("candidate.ndethist_single").alias("ndethist_single"),
                                                                        F.size("light_curve").alias("n_points"))

    def run(stream, out, check):
        T.stream_alerts(stream, out, check, build).awaitTermination()

    return spark.read.parquet(in_two_steps(spark, det, HALF, run)).select("objectId", "candid", "part", "ndethist_single", "n_points")


add("stream_alert_packets", _packets,
    """SELECT b.source_id AS objectId, b.id AS candid, q.part, p1.n AS ndethist_single, q.n AS n_points FROM base b
       JOIN points q ON q.id = b.id AND (q.part = 0 OR q.n > 0) LEFT JOIN past1 p1 ON p1.id = b.id""", J.alert_ctes("single"))


def _sessions(spark, sf):
    rows = timed(spark, sf).withColumn("source_id", F.concat(F.lit("S"), "user_id")).select("source_id", "flux", "created_at")
    out = appended(spark, rows, HALF, lambda s: T.stream_sessions(s, gap="6 hours"))
    return out.select("source_id", "n", F.round("max_flux", 6).alias("max_flux"), c("start").cast("timestamp_ntz").alias("start"), c("end").cast("timestamp_ntz").alias("end"))


SESSIONS = """SELECT source_id, count(*) AS n, round(max(flux), 6) AS max_flux, min(t) AS start, max(t) + INTERVAL 6 HOUR AS "end" FROM
  (SELECT *, sum(fresh) OVER (PARTITION BY source_id ORDER BY t) AS g FROM (SELECT CONCAT('S', user_id) AS source_id, flux, created_at AS t,
   CASE WHEN created_at - lag(created_at) OVER (PARTITION BY user_id ORDER BY created_at) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM v_det) a) b GROUP BY source_id, g"""
add("stream_sessions", _sessions,
    """SELECT * FROM s WHERE "end" <= (SELECT max(created_at) - INTERVAL 1 DAY FROM v_det)""", {"s": SESSIONS})
