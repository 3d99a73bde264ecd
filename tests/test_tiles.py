"""Tiles of pixels against the plain join by pixel."""

import random

import pytest
from pyspark.sql import functions as F

from skyloom.operators import pixels as P

PIXEL = "image_id long, ref_id long, x int, y int, value double, rms double, mask int, at string"


def rows(rng, image, ref, box, share):
    (x0, x1), (y0, y1) = box
    return [(image, ref, x, y, rng.uniform(0, 9), rng.uniform(1, 2), rng.randrange(8), f"p{x}")
            for x in range(x0, x1) for y in range(y0, y1) if rng.random() < share]


@pytest.fixture(scope="module")
def frames(spark):
    rng = random.Random(1)
    sci = rows(rng, 1, 9, ((0, 70), (0, 40)), 1.0) + rows(rng, 2, 9, ((-5, 50), (-40, 33)), 0.7) + rows(rng, 3, 8, ((0, 4), (30, 70)), 0.3)
    sci += rows(rng, 4, None, ((0, 3), (0, 3)), 1.0) + rows(rng, 5, 77, ((0, 3), (0, 3)), 1.0) + [(1, 9, None, 3, 1.0, 1.0, 0, "none")]
    ref = rows(rng, 9, None, ((-20, 64), (-33, 36)), 0.8) + rows(rng, 8, None, ((0, 9), (0, 64)), 1.0)
    return spark.createDataFrame(sci, PIXEL), spark.createDataFrame(ref, PIXEL).drop("ref_id")


def same(a, b):
    assert a.columns == b.columns and [f.dataType for f in a.schema] == [f.dataType for f in b.schema]
    left, right = (sorted(map(tuple, x.collect()), key=repr) for x in (a, b))
    assert left == right and left


@pytest.mark.parametrize("size", [1, 7, P.TILE, 200])
def test_tiles_hold_every_pixel_once(frames, size):
    sci, _ = frames
    whole = sci.filter("x is not null")
    tiles = P.tiles(whole, ["image_id"], ["value", "at"], size)
    assert tiles.filter(F.size("_px") != size * size).count() == 0
    back = tiles.select("image_id", "_ty", "_tx", F.posexplode("_px").alias("i", "p")).filter("p is not null").select(
        "image_id", (F.col("_tx") * size + F.col("i") % size).cast("int").alias("x"), (F.col("_ty") * size + F.floor(F.col("i") / size)).cast("int").alias("y"), "p.value", "p.at")
    same(back, whole.select("image_id", "x", "y", "value", "at"))


@pytest.mark.parametrize("size", [5, P.TILE])
def test_pairs_equal_the_join_by_pixel(frames, size):
    sci, ref = frames
    got = P.paired_pixels(sci, ref, "ref_id", ["value", "mask"], size).select(*sci.columns, "_ref.value", "_ref.mask")
    other = ref.select(F.col("image_id").alias("ref_id"), "x", "y", F.col("value").alias("v"), F.col("mask").alias("m"))
    want = sci.join(other, ["ref_id", "x", "y"]).select(*sci.columns, F.col("v").alias("value"), F.col("m").alias("mask"))
    same(got, want)


def test_difference_and_union(frames):
    sci, ref = frames
    other = ref.select(F.col("image_id").alias("ref_id"), "x", "y", *[F.col(c).alias(f"r_{c}") for c in ("value", "rms", "mask")])
    both = sci.join(other, ["ref_id", "x", "y"])
    masked = F.col("mask").bitwiseOR(F.col("r_mask"))
    want = both.select("image_id", "x", "y", (F.col("value") - F.col("r_value")).alias("value"), F.sqrt(F.col("rms") * F.col("rms") + F.col("r_rms") * F.col("r_rms")).alias("rms"), masked.alias("mask"))
    same(P.difference_image(sci, ref, "ref_id").select(*want.columns), want)
    same(P.mask_union(sci, ref, "ref_id").select("image_id", "x", "y", "value", "mask"), both.select("image_id", "x", "y", "value", masked.alias("mask")))


def test_arrays_are_shuffled(frames):
    """Pixels are packed on the map side: no exchange lies between a scan of pixels and its first packing."""
    sci, ref = frames
    plan = P.difference_image(sci, ref, "ref_id")._jdf.queryExecution().executedPlan().toString().splitlines()
    for line, text in enumerate(plan):
        if "LocalTableScan" in text or "Scan ExistingRDD" in text or "FileScan" in text:
            above = [x for x in plan[:line] if "Exchange" in x or "partial_collect_list" in x]
            assert "partial_collect_list" in above[-1]
