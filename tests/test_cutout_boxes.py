"""Each different box is cut once."""

from skyloom.operators import pixels as P


def test_a_box_is_cut_once_for_all_its_positions(spark, monkeypatch):
    seen = []
    strips = P.box_strips
    monkeypatch.setattr(P, "box_strips", lambda pixels, boxes, *rest, **how: seen.append(boxes.count()) or strips(pixels, boxes, *rest, **how))
    pixels = spark.createDataFrame([(1, x, y, float(10 * y + x)) for x in range(4) for y in range(4)], "image_id long, x int, y int, value double")
    positions = spark.createDataFrame([(1, 1, 1.0, 1.0), (2, 1, 1.2, 0.8), (3, 1, 3.0, 3.0), (4, None, 1.0, 1.0), (5, None, 1.0, 1.0)],
                                      "id long, image_id long, x double, y double")
    got = {r.id: (r.image_id, [v for line in r.stamp for v in line]) for r in P.cutout(pixels, positions, 3, fill=-1.0).collect()}
    assert seen == [3]
    assert got[1] == got[2] == (1, [0.0, 1.0, 2.0, 10.0, 11.0, 12.0, 20.0, 21.0, 22.0])
    assert got[3] == (1, [22.0, 23.0, -1.0, 32.0, 33.0, -1.0, -1.0, -1.0, -1.0])
    assert got[4] == got[5] == (None, [-1.0] * 9)


def test_aligned_stamps_go_through_pixels_and_boxes_once(spark, monkeypatch):
    seen = []
    strips = P.box_strips
    monkeypatch.setattr(P, "box_strips", lambda *given, **how: seen.append(given[2]) or strips(*given, **how))
    rows = [(1, x, y, float(10 * y + x), None if x == 2 else -1.0 * x) for x in range(4) for y in range(4)]
    pixels = spark.createDataFrame(rows, "image_id long, x int, y int, value double, ref double")
    positions = spark.createDataFrame([(1, 1, 1.0, 1.0), (2, 1, 1.2, 0.8), (3, 1, 3.0, 3.0), (4, None, 1.0, 1.0), (5, 7, 0.0, 0.0)],
                                      "id long, image_id long, x double, y double")
    both = {r.id: (r.new, r.ref) for r in P.cutout(pixels, positions, 3, -1.0, {"new": "value", "ref": "ref"}).collect()}
    assert seen == [["value", "ref"]]
    one = {r.id: r.stamp for r in P.cutout(pixels, positions, 3, -1.0).collect()}
    other = {r.id: r.stamp for r in P.cutout(pixels.withColumn("value", pixels["ref"]), positions, 3, -1.0).collect()}
    assert both == {i: (one[i], other[i]) for i in one} and len(both) == 5
    kinds = [P.cutout(pixels.withColumn("value", pixels[c]), positions, 3, -1.0).selectExpr("id", f"'{k}' AS type", "stamp")
             for k, c in (("new", "value"), ("ref", "ref"))]
    by_type = {r.id: (r.new, r.ref, r.sub) for r in P.triplets(kinds[0].unionByName(kinds[1])).collect()}
    assert by_type == {i: (*v, None) for i, v in both.items()}


def test_the_registered_stamps_are_cut_in_one_go(spark, monkeypatch):
    from workload import pixelops

    seen = []
    strips = P.box_strips
    monkeypatch.setattr(P, "box_strips", lambda *given, **how: seen.append(given[2]) or strips(*given, **how))
    row = pixelops.stamps(spark, "/root/testdata/sf0.001").orderBy("id").first()
    assert len(seen) == 1
    assert row.ref == [[0.5 * v for v in line] for line in row.new] and row.sub == [[-1.0 * v for v in line] for line in row.new]
