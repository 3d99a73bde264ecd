"""Planted cases for column functions."""

import math

import pytest
from pyspark.sql import functions as F

from skyloom.constants import BAD_SUM
from skyloom.functions import geometry, headers, naming, photometry, times
from skyloom.operators import filters, pixels
from skyloom.sources import schemas


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_bad_sum_and_masks(spark):
    assert BAD_SUM == 198589
    row = one(spark, *[pixels.bad_pixel(F.lit(m)).alias(f"m{m}") for m in (2, 256, 4096, 65536)])
    assert tuple(row) == (False, True, False, True)


def test_magnitudes_of_zero_and_negative_flux(spark):
    row = one(spark, *[f(F.lit(v)).alias(f"c{i}") for i, (f, v) in enumerate(
        [(photometry.abmag, 0.0), (photometry.abmag, -1.0), (photometry.mag_unguarded, 0.0), (photometry.mag_unguarded, -1.0), (photometry.abmag, 1.0)])])
    assert tuple(row) == (0.0, 0.0, None, None, 22.5)


def test_snr_of_zero_error_is_null(spark):
    assert one(spark, photometry.snr(F.lit(1.0), F.lit(0.0)).alias("s")).s is None


def test_get_time_prefers_first_key_and_raises_without_any(spark):
    head = F.create_map(F.lit("OBSJD"), F.lit("2458116.5"), F.lit("DATE-OBS"), F.lit("2018-01-01 12:00:00"))
    assert one(spark, times.get_time(head, "mjd").alias("t")).t == 58116.0
    iso = F.create_map(F.lit("DATE-OBS"), F.lit("2018-01-01 12:00:00"))
    row = one(spark, times.get_time(iso, "mjd").alias("m"), times.get_time(iso, "iso").alias("i"))
    assert row.m == 58119.5 and row.i == "2018-01-01 12:00:00.000"
    with pytest.raises(Exception, match="no time key"):
        one(spark, times.get_time(F.create_map(F.lit("A"), F.lit("1")), "jd").alias("t"))


def test_time_does_not_depend_on_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert one(spark, times.ts_to_mjd(F.lit("2018-03-11 02:30:00").cast("timestamp_ntz")).alias("m")).m == pytest.approx(58188.1041666667)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_names(spark):
    sub = naming.sub_name(F.lit("/d/a.fits"), F.lit("/r/b.fits"))
    bad = naming.parse_basename(F.lit("nothing"))["field"]
    strip = [naming.sg_strip(F.lit(v)) for v in (7.5, -7.5, 0.0)]
    row = one(spark, sub.alias("a"), bad.alias("b"), *[s.alias(f"s{i}") for i, s in enumerate(strip)])
    assert row.a == "/d/sub.a_b.fits" and row.b is None
    assert [r.split("_")[4] for r in row[2:]] == ["7", "-7", "0"]


def test_header_merge_and_scalars(spark):
    base = F.expr("map('A', '1', 'COMMENT', 'mine')")
    merged = headers.header_merge(base, F.expr("map('A', '2', 'B', '3', 'HISTORY', 'x', 'COMMENT', 'theirs')"))
    kept = headers.header_scalars(F.expr("map('n', '1', 's', '\"t\"', 'l', '[1]', 'o', '{}', 'z', 'null')"))
    row = one(spark, merged.alias("m"), F.sort_array(F.map_keys(kept)).alias("k"))
    assert row.m == {"A": "2", "B": "3", "COMMENT": "mine"} and row.k == ["n", "s"]


def test_json_nan_becomes_null(spark):
    df = spark.sql("SELECT named_struct('a', double('nan'), 'b', array(1d, double('nan')), 'c', binary('x'), 'd', named_struct('e', double('nan'))) AS s")
    text = df.select(headers.json_encode(F.col("s"), df.schema["s"].dataType).alias("j")).first().j
    assert text == '{"a":null,"b":[1.0,null],"c":"x","d":{"e":null}}'


def test_angle_changed(spark):
    row = one(spark, headers.angle_changed(F.lit(100.0), F.lit(100.0005)).alias("a"), headers.angle_changed(F.lit(100.0), F.lit(100.01)).alias("b"),
              headers.angle_changed(F.lit(None).cast("double"), F.lit(1.0)).alias("c"))
    assert tuple(row) == (False, True, True)


def test_field_image_footprint_and_centre(spark):
    """A real field: the centre lies inside its corners, and the solution maps the centre pixel near it."""
    w = dict(crpix1=1536.5, crpix2=1540.5, crval1=23.3491, crval2=30.9188, cd11=-2.8e-4, cd12=0.0, cd21=0.0, cd22=2.8e-4)
    wcs = {k: F.lit(v) for k, v in w.items()}
    corners = [(F.lit(r), F.lit(d)) for r, d in ((23.85, 30.49), (22.85, 30.49), (22.84, 31.35), (23.86, 31.35))]
    inside = geometry.inside_polygon(F.lit(23.3491), F.lit(30.9188), corners)
    outside = geometry.inside_polygon(F.lit(24.5), F.lit(30.9), corners)
    p = geometry.pix2world(F.lit(1536.5), F.lit(1540.5), wcs)
    row = one(spark, inside.alias("i"), outside.alias("o"), p["ra"].alias("ra"), p["dec"].alias("dec"))
    assert row.i and not row.o
    assert row.ra == pytest.approx(23.3491, abs=1e-9) and row.dec == pytest.approx(30.9188, abs=1e-9)


def test_world2pix_is_null_on_the_far_side(spark):
    wcs = {k: F.lit(v) for k, v in dict(crpix1=1.0, crpix2=1.0, crval1=0.0, crval2=0.0, cd11=-1e-4, cd12=0.0, cd21=0.0, cd22=1e-4).items()}
    assert one(spark, geometry.world2pix(F.lit(180.0), F.lit(0.0), wcs)["x"].alias("x")).x is None


@pytest.mark.parametrize("r,cx,cy", [(3.0, 5.0, 5.0), (2.7, 5.3, 4.8), (0.4, 5.5, 5.1), (6.0, 7.25, 7.75)])
def test_overlap_weights_sum_to_the_circle(spark, r, cx, cy):
    grid = spark.range(16).crossJoin(spark.range(16).withColumnRenamed("id", "y"))
    total = grid.select(F.sum(geometry.circle_pixel_overlap(F.col("id") - cx, F.col("y") - cy, r)).alias("s")).first().s
    assert total == pytest.approx(math.pi * r * r, rel=1e-9)


def test_alert_schemas(spark):
    assert len(schemas.candidate_schema("single").fields) == 123
    assert len(schemas.candidate_schema("stack").fields) == 124
    assert len(schemas.light_curve_schema().fields) == 9
    assert len(schemas.alert_schema("stack").fields) == 9
    only = set(schemas.candidate_schema("single").names) - set(schemas.candidate_schema("stack").names)
    assert only == {"nid", "jd", "diffmaglim"}
    for name in schemas.TABLES:
        assert schemas.table_schema(name).fields


def test_null_or_false(spark):
    row = one(spark, *[filters.null_or_false(F.lit(v).cast("boolean")).alias(f"v{i}") for i, v in enumerate((None, False, True))])
    assert tuple(row) == (True, True, False)
