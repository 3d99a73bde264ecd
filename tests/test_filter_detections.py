"""What filter_detections and the apertures send: survivors once, boxes by whole tiles."""

import math
from collections import defaultdict

from pyspark.sql import functions as F

from skyloom.operators import pixels as P
from skyloom.plans import detection
from workload import jobs

TINY = "/root/testdata/sf0.001"


def test_the_catalog_is_read_once(spark):
    catalog, seen = jobs.object_catalog(spark, TINY), spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    kept, failed = detection.filter_detections(catalog.mapInArrow(counted, catalog.schema), jobs.clean_pixels(spark, TINY), max_rows=4)
    kept.count(), failed.count()
    assert seen.value == catalog.count()


def test_a_box_is_sent_to_four_tiles_at_most(spark):
    pixels = spark.range(40 * 40).selectExpr("1L AS image_id", "CAST(id % 40 AS INT) AS x", "CAST(id DIV 40 AS INT) AS y", "CAST(id AS DOUBLE) AS value", "1e0 + id % 3 AS rms", "CAST(id % 7 AS INT) AS mask")
    places = [(1, 3.25, 2.5), (2, 15.5, 15.75), (3, 31.0, 16.0), (4, 39.5, 39.5), (5, -2.0, 20.0), (6, -9.0, 3.0), (7, 60.0, 60.0)]
    positions = spark.createDataFrame([(i, 1, x, y) for i, x, y in places], "id long, image_id long, x double, y double")
    got = P.aperture_photometry(pixels, positions, 6.0, "center")
    want = defaultdict(lambda: [0.0, 0.0, 0])
    for i, cx, cy in places:
        for at in range(40 * 40):
            x, y = at % 40, at // 40
            if math.floor(cx - 5.5) <= x < math.ceil(cx + 6.5) and math.floor(cy - 5.5) <= y < math.ceil(cy + 6.5):
                inside = (x - cx) ** 2 + (y - cy) ** 2 < 36
                was = want[i]
                want[i] = [was[0] + at * inside, was[1] + (1 + at % 3) ** 2 * inside, was[2] | at % 7]
    rows = {r.id: [r.flux, r.fluxerr ** 2, r.flags] for r in got.collect()}
    assert set(rows) == set(want)
    assert all(math.isclose(a, b, rel_tol=1e-9) for i in want for a, b in zip(rows[i], want[i]))
    # each tile that a box meets is one row beside its packed pixels
    nodes, joined = [got._jdf.queryExecution().optimizedPlan()], []
    while nodes:
        node = nodes.pop()
        children = [node.children().apply(k) for k in range(node.children().size())]
        if node.nodeName() == "Join" and node.joinType().toString() == "Inner":
            joined.append(children[0])
        nodes += children
    rows_sent = [spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, plan).count() for plan in joined]
    assert len(rows_sent) == 1 and rows_sent[0] <= 4 * len(places)
