"""Planted cases for relational operators, pixels and jobs."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.functions import headers
from skyloom.operators import aggregates, filters, pixels, ranking, relational, tables
from skyloom.operators.scoring import score_batches
from skyloom.plans import alerts, association, detection, photometry, stacking, vetting

DET = ("id long, ra double, dec double, flux double, fluxerr double, rb double, source_id string, created_at timestamp_ntz,"
       " triggers_alert boolean")
NOW = dt.datetime(2020, 1, 10)


def test_bin_edges(spark):
    """A time on an edge belongs to the bin that ends there; the origin to none; the last bin must be complete."""
    day = lambda n, us=0: dt.datetime(2017, 1, 3) + dt.timedelta(days=n, microseconds=us)
    rows = spark.createDataFrame([(1, day(7)), (2, day(0)), (3, day(7, 1)), (4, day(0, 1)), (5, day(-1)), (6, day(20))], "id long, obsdate timestamp_ntz")
    got = {r.id: r.bin for r in relational.interval_bins(rows, until="2017-01-20").collect()}
    assert got == {1: 0, 3: 1, 4: 0}
    bins = {r.id: (r.binleft, r.binright) for r in relational.interval_bins(rows).collect()}
    assert bins[1] == (day(0), day(7)) and bins[6] == (day(14), day(21))


def test_equal_snr_keeps_the_lowest_id(spark):
    det = spark.createDataFrame([(5, "s", 10.0, 1.0), (3, "s", 20.0, 2.0), (9, "s", 1.0, 0.0)], "id long, source_id string, flux double, fluxerr double")
    assert aggregates.best_detection(det).first().id == 3


def test_fifty_one_detections_fail_the_image(spark):
    det = spark.range(101).selectExpr("id", "CAST(id >= 50 AS INT) AS image_id")
    kept, failed = filters.too_many_detections(det)
    assert kept.count() == 50 and [(r.image_id, r.n) for r in failed.collect()] == [(1, 51)]


def test_upsert_bumps_modified_only_on_change(spark):
    t0, t1 = dt.datetime(2020, 1, 1), dt.datetime(2021, 1, 1)
    base = spark.createDataFrame([("a", 1, t0), ("b", 2, t0), ("c", 3, t0)], "k string, v int, modified timestamp_ntz")
    new = spark.createDataFrame([("a", 1), ("b", 5), ("d", 7), ("c", None)], "k string, v int")
    got = {r.k: (r.v, r.modified) for r in tables.upsert(base, new, "k", F.lit(t1)).collect()}
    assert got == {"a": (1, t0), "b": (5, t1), "c": (3, t0), "d": (7, t1)}


def test_duplicate_photometry_raises(spark):
    phot = spark.createDataFrame([(1, "s", 1.0)], "image_id long, source_id string, flux double")
    images, sources = spark.createDataFrame([(1,)], "id long"), spark.createDataFrame([("s",)], "id string")
    with pytest.raises(Exception, match="duplicate photometry"):
        tables.merge_photometry(phot, phot, images, sources).collect()


def test_mixed_stack_raises(spark):
    rows = spark.createDataFrame([(1, 7, 1, 1, 1, 1), (2, 7, 1, 1, 1, 2)], "id long, coadd_id long, field int, ccdid int, qid int, fid int")
    with pytest.raises(Exception, match="must share"):
        aggregates.assert_same_properties(rows, "coadd_id").collect()


def grid(spark, n=11, image=1, value="1e0"):
    return spark.range(n * n).selectExpr(f"{image}L AS image_id", f"CAST(id % {n} AS INT) AS x", f"CAST(id / {n} AS INT) AS y",
                                         f"{value} AS value", "2e0 AS rms", "0 AS mask")


def spot(spark, x, y, id=1):
    return spark.createDataFrame([(id, 1, float(x), float(y))], "id long, image_id long, x double, y double")


@pytest.mark.parametrize("method,edge,area", [("center", True, 29), ("center", False, 25), ("exact", False, np.pi * 9)])
def test_aperture_on_constant_image(spark, method, edge, area):
    row = pixels.aperture_photometry(grid(spark), spot(spark, 5, 5), 3.0, method, edge=edge).first()
    assert row.flux == pytest.approx(area) and row.fluxerr == pytest.approx(2 * np.sqrt(area))


def test_flags_cover_the_bounding_box(spark):
    px = grid(spark).withColumn("mask", F.expr("CASE WHEN x = 2 AND y = 2 THEN 4 WHEN x = 1 AND y = 5 THEN 8 ELSE 0 END"))
    assert pixels.aperture_photometry(px, spot(spark, 5, 5), 3.0).first().flags == 4


@pytest.mark.parametrize("x,y", [(5, 5), (0, 0), (10, 3), (40, 40), (-7, 2)])
def test_cutout_equals_numpy(spark, x, y):
    image = np.arange(121, dtype=float).reshape(11, 11)
    padded = np.zeros((111, 111))
    padded[50:61, 50:61] = image
    got = pixels.cutout(grid(spark, value="CAST(id AS DOUBLE)"), spot(spark, x, y), 5).first().stamp
    assert np.array_equal(np.array(got), padded[50 + y - 2:50 + y + 3, 50 + x - 2:50 + x + 3])


def test_wide_cutout_spans_strips(spark):
    px = grid(spark, n=140, value="CAST(id AS DOUBLE)")
    got = np.array(pixels.cutout(px, spot(spark, 64, 70), 63).first().stamp)
    want = np.arange(140 * 140, dtype=float).reshape(140, 140)[39:102, 33:96]
    assert np.array_equal(got, want)


def test_negative_pixel_cut_edges(spark):
    """A dip with a spike on its corner rejects only detections whose box holds the dip."""
    px = grid(spark, n=40, value="(id * 7919 % 11) - 5e0").withColumn("value", F.expr(
        "CASE WHEN x = 20 AND y = 20 THEN -500e0 WHEN x = 21 AND y = 21 THEN 500e0 WHEN x = 3 AND y = 3 THEN -500e0 ELSE value END"))
    rows = [(1, 1, 26.0, 26.0), (2, 1, 27.0, 21.0), (3, 1, 16.0, 21.0), (4, 1, 15.4, 21.0), (5, 1, 4.0, 4.0)]
    det = spark.createDataFrame(rows, "id long, image_id long, x_image double, y_image double")
    assert sorted(r.id for r in pixels.negative_pixel_cut(det, px).collect()) == [2, 4, 5]


def test_weights_and_borders(spark):
    px = grid(spark, 11).withColumn("mask", F.expr("CASE WHEN x = 5 AND y = 5 THEN 256 ELSE 0 END"))
    w = {(r.x, r.y): r.weight for r in pixels.weight_map(px, None).collect()}
    assert w[5, 5] == 0 and w[0, 0] == 0.25
    f = pixels.false_weight(px, 2)
    assert f.agg(F.sum("false_weight")).first()[0] == 7 * 7 - 1
    assert pixels.false_weight(px, 2, science=False).agg(F.sum("false_weight")).first()[0] == 120


def test_score_batches_loads_once_per_task(spark):
    stamps = spark.range(4).select("id", *[F.array(F.array(F.col("id").cast("double") + k)).alias(c) for k, c in enumerate(("new", "ref", "sub"))])

    def load():
        return lambda batch: batch.sum(axis=(1, 2, 3))

    assert {r.id: r.rb for r in score_batches(stamps, load).collect()} == {i: 3.0 * i + 3 for i in range(4)}


def det(spark, rows):
    return spark.createDataFrame([(i, ra, dec, f, 1.0, rb, s, when, None) for i, ra, dec, f, rb, s, when in rows], DET)


def test_associate(spark):
    old, new, arc = dt.datetime(2019, 12, 1), dt.datetime(2020, 1, 9), 1 / 3600
    rows = det(spark, [
        (1, 10.0, 0.0, 9.0, 0.1, None, new),       # between two sources: the nearer
        (2, 10.0, 1.5 * arc, 50.0, 0.1, None, new),
        (3, 10.0, 0.1 * arc, 5.0, 0.9, None, old),  # too old for a match, alone: no source
        (4, 50.0, 0.0, 5.0, 0.9, None, old),       # two that cluster
        (5, 50.0, 1.0 * arc, 7.0, 0.9, None, new),
        (6, 50.0, 2.0 * arc, 9.0, 0.4, None, new),  # score not above the limit
        (7, 70.0, 0.0, 9.0, 0.9, "keep", new),
    ])
    src = spark.createDataFrame([("a", 10.0, -0.5 * arc), ("b", 10.0, 2.0 * arc), ("keep", 0.0, 0.0), ("lone", 5.0, 5.0)], "id string, ra double, dec double")
    out, sources = association.associate(rows, src, "2020-01-10 00:00:00", next_number=41)
    got = {r.id: (r.source_id, r.triggers_alert) for r in out.collect()}
    assert got == {1: ("a", True), 2: ("b", True), 3: (None, False), 4: ("N00000041", True), 5: ("N00000041", True), 6: (None, False), 7: ("keep", True)}
    pos = {r.id: (r.ra, r.dec, r.is_new) for r in sources.collect()}
    assert pos["N00000041"] == (50.0, arc, True) and pos["lone"] == (5.0, 5.0, False) and pos["keep"] == (70.0, 0.0, False)
    assert pos["b"] == (10.0, 1.5 * arc, False)


def test_last_veto_rule_wins_and_redshift_falls_back(spark):
    cat = "objid long, ra double, dec double, type string, parallax double, fracmasked_g double, fracmasked_r double, fracmasked_z double, z_spec double, z_phot_median double"
    north = spark.createDataFrame([(1, 10.0, 0.0001, "PSF", 1.0, 0.0, 0.0, 0.0, -99.0, 0.2)], cat)
    none = north.filter("false")
    lists = spark.createDataFrame([], "id long, ra double, dec double")
    src = spark.createDataFrame([("s", 10.0, 0.0), ("far", 50.0, 0.0)], "id string, ra double, dec double")
    got = {r.id: (r.rule, r.reason) for r in vetting.veto_reasons(src, north, none, lists, lists).collect()}
    assert got == {"s": (5, vetting.REASON_PSF), "far": (11, vetting.REASON_REDSHIFT)}
    south = none.unionByName(north.withColumn("z_spec", F.lit(0.00005)))
    assert vetting.host_redshift(src, north, none).first().redshift == 0.2
    assert vetting.host_redshift(src, north, south).first().redshift == 0.00005
    assert {r.rule for r in vetting.veto_reasons(src, north, south, lists, lists).collect()} == {11}


def test_history_counts_strictly_earlier(spark):
    one = spark.createDataFrame([("s", 1, 10.0), ("s", 2, 11.0), ("s", 3, 11.0), ("t", 4, 1.0)], "source_id string, detection_id long, mjd double")
    many = spark.createDataFrame([("s", 100, 8.0, 14.0), ("s", 101, 9.0, 10.5), ("s", 102, 11.0, 12.0)], "source_id string, stack_id long, min_mjd double, max_mjd double")
    ask = spark.createDataFrame([(2, "s", 11.0), (9, "s", 5.0)], "id long, source_id string, epoch double")
    got = {r.id: r for r in alerts.history_before(ask, one, many).collect()}
    r = got[2]
    assert (r.ndethist_single, r.ndethist_stack) == (1, 2) and r.jdstarthist_single == 2400010.5
    assert (r.jdstarthist_stack, r.jdendhist_stack) == (2400009.5, 2400014.5)
    assert got[9].ndethist_single == 0 and got[9].jdstarthist_single is None and got[9].jdendhist_stack is None


def packet_inputs(spark, source="s", lc_source="s"):
    header = F.create_map(F.lit("PROGRMPI"), F.lit("P"), F.lit("PROGRMID"), F.lit("2"))
    images = spark.createDataFrame([(1, 2458000.5, 100, 20.0, 30.0)], "id long, obsjd double, nid int, maglimit double, exptime double").withColumn("header", header)
    subs = spark.createDataFrame([(11, "sub.x.fits", 1, 90, 600, 2, 3, 1)], "id long, basename string, target_image_id long, reference_image_id long, field int, ccdid int, qid int, fid int")
    bridge = spark.createDataFrame([(90, 1)], "coadd_id long, image_id long")
    d = spark.createDataFrame([(5, source, 11, 10.0, 0.0, 20.0, 2.0, 1.0, 2.0, 3.0, 1.5, 4.0, 0.0)],
                              "id long, source_id string, image_id long, ra double, dec double, flux double, fluxerr double, x_image double, y_image double,"
                              " a_image double, b_image double, fwhm_image double, elongation double")
    rb = spark.createDataFrame([(1, 5, 0.9, "m")], "id long, detection_id long, rb_score double, rb_version string")
    cut = 2458000.5
    phot = spark.createDataFrame([(k, lc_source, 26.0, "zr", 5.0, 1.0, 0, cut + s / 86400) for k, s in enumerate((-10.0, 0.0, 0.4, 0.6, 99.0))],
                                 "id long, source_id string, zp double, filtercode string, flux double, fluxerr double, flags int, obsjd double")
    match = spark.createDataFrame([(5, 0, "n", "", "", 7)], "id long, part int, ztfname string, mqid string, tnsid string, objectidps1 long")
    stamps = spark.createDataFrame([(5, [[1.0]], [[2.0]], [[3.0]])], "id long, new array<array<double>>, ref array<array<double>>, sub array<array<double>>")
    return d, rb, images, subs, subs.filter("false"), bridge, d, phot, match, stamps


def test_packet(spark):
    rows = alerts.build_alerts(*packet_inputs(spark), size=2).collect()
    rows.sort(key=lambda r: r.part)
    assert [[p.id for p in r.light_curve] for r in rows] == [[0, 1], [2]]
    c = rows[0].candidate
    assert (rows[0].objectId, c.candid, c.rcid, c.programid, c.ztfname, c.objectidps1, c.nframesref, c.jdstartref) == ("s", 5, 6, 2, "n", 7, 1, 2458000.5)
    assert rows[0].cutoutTemplate == [[2.0]] and rows[1].candidate.objectidps1 == 7 and rows[1].candidate.ztfname == ""


def test_packets_look_at_their_own_sources_only(spark, monkeypatch):
    """Photometry, history and lineage of other sources are left out before anything is sorted or summed."""
    d, rb, images, subs, stacks, bridge, _, phot, match, stamps = packet_inputs(spark)
    others = spark.range(1000).select((F.col("id") + 1000).alias("id"), F.lit("other").alias("source_id"))
    many = phot.unionByName(others.select("id", "source_id", F.lit(26.0).alias("zp"), F.lit("zr").alias("filtercode"), F.lit(5.0).alias("flux"),
                                          F.lit(1.0).alias("fluxerr"), F.lit(0).alias("flags"), F.lit(2458000.0).alias("obsjd")))
    history = d.select("id", "source_id", "image_id").unionByName(others.select("id", "source_id", F.lit(11).cast("long").alias("image_id")))
    lineage = bridge.unionByName(spark.range(500).select((F.col("id") + 5000).alias("coadd_id"), F.lit(1).cast("long").alias("image_id")))
    seen = {}

    def counted(name, at):
        inner = getattr(alerts, name)
        monkeypatch.setattr(alerts, name, lambda *a, **k: seen.__setitem__(name, a[at].count()) or inner(*a, **k))

    for name, at in (("light_curve_parts", 0), ("history_before", 1), ("stack_summary", 0)):
        counted(name, at)
    rows = alerts.build_alerts(d, rb, images, subs, stacks, lineage, history, many, match, stamps).collect()
    assert [p.id for p in rows[0].light_curve] == [0, 1, 2] and rows[0].candidate.ndethist_single == 0
    assert seen == {"light_curve_parts": 5, "history_before": 1, "stack_summary": 1}


def test_packet_errors(spark):
    with pytest.raises(Exception, match="no light curve for source s"):
        alerts.build_alerts(*packet_inputs(spark, lc_source="other")).collect()
    with pytest.raises(Exception, match="no source for detection 5"):
        alerts.build_alerts(*packet_inputs(spark, source=None)).collect()


def test_alerts_are_sent_once(spark):
    packets = spark.createDataFrame([(1, "a"), (2, "b")], "candid long, objectId string")
    sent = spark.createDataFrame([(1,)], "detection_id long")
    todo, log = alerts.send_alerts(packets, sent, F.lit(NOW))
    assert [r.candid for r in todo.collect()] == [2] and [r.detection_id for r in log.collect()] == [2]
    with pytest.raises(Exception, match="already sent: a"):
        alerts.refuse_resend(packets, sent).collect()


def test_stack_without_mask_raises(spark):
    images = spark.createDataFrame([(1, 1, 1, 1, 1, 25.0, 2458000.5)], "id long, field int, ccdid int, qid int, fid int, magzp double, obsjd double")
    bridge = spark.createDataFrame([(9, 1)], "coadd_id long, image_id long")
    px = grid(spark, 3).withColumn("mask", F.lit(None).cast("int")).withColumn("weight", F.lit(1.0))
    with pytest.raises(Exception, match="no mask for image 1"):
        stacking.build_stack(bridge, images, px)[1].collect()


def test_clipped_stack_drops_the_outlier(spark):
    px = None
    for k, v in enumerate((10.0, 10.2, 9.8, 500.0)):
        part = grid(spark, 2, k + 1, f"{v}e0").withColumn("weight", F.lit(0.25)).withColumn("grp", F.lit(1))
        px = part if px is None else px.unionByName(part)
    got = {round(r.value, 6) for r in pixels.stack_combine(px, "clipped").collect()}
    assert got == {10.0}


def test_forced_photometry_position(spark):
    """A source on the reference pixel is measured there (pixels are counted from one in the header)."""
    images = spark.createDataFrame([(1, 6.0, 6.0, 10.0, 20.0, -1e-4, 0.0, 0.0, 1e-4)],
                                   "id long, crpix1 double, crpix2 double, crval1 double, crval2 double, cd11 double, cd12 double, cd21 double, cd22 double")
    todo = spark.createDataFrame([(1, "s", 10.0, 20.0)], "image_id long, source_id string, ra double, dec double")
    row = photometry.place_sources(todo, images).first()
    assert (row.x, row.y) == (pytest.approx(5.0), pytest.approx(5.0))


def test_detection_without_pixels_keeps_its_cuts(spark):
    assert detection.filter_detections is not None
    cat = spark.createDataFrame([(1, 256, 0, 2.0, 1.9, 2.0, 2.0, 50.0, 1.0)],
                                "id long, imaflags_iso int, flags int, a_image double, b_image double, fwhm_image double, seeing double, flux double, fluxerr double")
    assert filters.detection_cuts(cat, with_pixels=False).first().failed_at == "imaflags"


def test_newest_first(spark):
    rows = spark.createDataFrame([("ztf_20200101_000600_zg_c01_o_q1_sciimg.fits",), ("ztf_20210101_000600_zg_c01_o_q1_sciimg.fits",)], "basename string")
    assert ranking.newest_first_limit(rows, 1).first().basename.startswith("ztf_2021")


def test_null_beside_a_value_is_a_mix(spark):
    rows = spark.createDataFrame([(1, 1, 2), (1, 1, None), (2, None, None), (2, None, None), (3, 1, 1)], "g int, a int, b int")
    assert [r.g for r in aggregates.mixed_groups(rows, "g", ["a", "b"]).collect()] == [1]
    with pytest.raises(Exception, match="must share"):
        aggregates.assert_same_properties(rows, "g", ["a", "b"]).collect()


def test_header_without_its_key_raises(spark):
    full = {"FIELDID": "600", "CCDID": "1", "QID": "2", "FILTERID": "3", "FILENAME": "ztf_20180101123456_000600_zi_c01_o_q2_sciimg.fits"}
    images = spark.createDataFrame([(1, full)], "id long, header map<string,string>")
    row = headers.header_extract(images).first()
    assert (row.field, row.filtercode, row.imgtypecode, row.filefracday) == (600, "zi", "g", 20180101123456)
    for key in full:
        part = spark.createDataFrame([(1, {k: v for k, v in full.items() if k != key})], "id long, header map<string,string>")
        with pytest.raises(Exception, match=f"no usable {key}"):
            headers.header_extract(part).collect()
