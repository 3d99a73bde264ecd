"""Queries for joins on the sphere."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from skyloom.operators import aggregates, cluster, ranking, relational, sky
from skyloom.session import scratch_root
from skyloom.sources import cells
from workload import frames as W
from workload.frames import R1, R2, R15, R30, hav, near, r6, sql

c = F.col
QUERIES: dict = {}
ORACLE: dict[str, str] = {}
ARCSEC = 1 / 3600


def add(name: str, fn, text: str | None = None, extra: dict[str, str] | None = None) -> None:
    QUERIES[name] = fn
    if text is not None:
        ORACLE[name] = sql(text, extra)


POS = ("id", "ra", "dec")
SEP_DS = hav("d.ra", "d.dec", "s.ra", "s.dec")
add("cone_join", lambda s, d: sky.cone_join(W.detections(s, d).select(*POS), W.sources(s, d).select(*POS), 2 * ARCSEC).select(
        "id", c("b_id").alias("source_id"), *r6("sep_deg")),
    f"SELECT d.id, s.id AS source_id, round({SEP_DS}, 6) AS sep_deg FROM v_det d JOIN v_src s ON {near('d', 's', R2)}")
add("cone_join_left", lambda s, d: sky.cone_join(W.detections(s, d).select(*POS), W.sources(s, d).select(*POS), 1 * ARCSEC, "left").select(
        "id", c("b_id").alias("source_id"), *r6("sep_deg")),
    f"SELECT d.id, s.id AS source_id, round({SEP_DS}, 6) AS sep_deg FROM v_det d LEFT JOIN v_src s ON {near('d', 's', R1)}")
add("cone_join_wide", lambda s, d: sky.cone_join(W.detections(s, d).select(*POS), W.sources(s, d).select(*POS), 3.0).groupBy("b_id").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("sep_deg"), 4).alias("total")),
    f"SELECT s.id AS b_id, count(*) AS n, round(sum({SEP_DS}), 4) AS total FROM v_det d JOIN v_src s ON {near('d', 's', '3e0')} GROUP BY 1")
add("cone_search", lambda s, d: sky.cone_search(W.detections(s, d), 359.9, -30.0, 25.0).select("id", F.lit("wrap").alias("kind")).unionByName(
        sky.cone_search(W.detections(s, d), 10.0, 80.0, 35.0).select("id", F.lit("pole").alias("kind"))),
    f"""SELECT id, 'wrap' AS kind FROM v_det WHERE {hav('ra', 'dec', '359.9e0', '-30e0')} <= 25 UNION ALL
        SELECT id, 'pole' FROM v_det WHERE {hav('ra', 'dec', '10e0', '80e0')} <= 35""")


def _search_by_cell(spark, sf):
    """The same caps on a table whose files follow the sky."""
    path = f"{scratch_root(spark).rstrip('/')}/query-{uuid.uuid4().hex}"
    cells.write_by_cell(W.detections(spark, sf).select(*POS), path)
    table = spark.read.parquet(path)
    found = [cells.cone_search_by_cell(table, *cap).select("id", F.lit(kind).alias("kind")) for kind, cap in (("wrap", (359.9, -30.0, 25.0)), ("pole", (10.0, 80.0, 35.0)))]
    return found[0].unionByName(found[1])


add("cone_search_by_cell", _search_by_cell,
    f"""SELECT id, 'wrap' AS kind FROM v_det WHERE {hav('ra', 'dec', '359.9e0', '-30e0')} <= 25 UNION ALL
        SELECT id, 'pole' FROM v_det WHERE {hav('ra', 'dec', '10e0', '80e0')} <= 35""")


def _unit(ra: str, dec: str) -> tuple[str, str, str]:
    return (f"cos(radians({dec})) * cos(radians({ra}))", f"cos(radians({dec})) * sin(radians({ra}))", f"sin(radians({dec}))")


def inside_sql(p: str, i: str) -> str:
    """Point of alias ``p`` inside the footprint of alias ``i`` (counter-clockwise corners)."""
    px, py, pz = _unit(f"{p}.ra", f"{p}.dec")
    conds = []
    for k in (1, 2, 3, 4):
        n = k % 4 + 1
        ax, ay, az = _unit(f"{i}.ra{k}", f"{i}.dec{k}")
        bx, by, bz = _unit(f"{i}.ra{n}", f"{i}.dec{n}")
        conds.append(f"(({ay}) * ({bz}) - ({az}) * ({by})) * ({px}) + (({az}) * ({bx}) - ({ax}) * ({bz})) * ({py}) "
                     f"+ (({ax}) * ({by}) - ({ay}) * ({bx})) * ({pz}) >= 0")
    return " AND ".join(conds)


def spread_sources(spark, sf):
    """Sources moved by up to half a degree, so that some leave their footprint."""
    return W.table(spark, sf, "events").select("user_id").distinct().selectExpr(
        "CONCAT('S', user_id) AS id", "((user_id * 137.50776405e0) % 360e0 + (user_id % 5) * 0.11e0) % 360e0 AS ra",
        "(user_id * 7.31e0) % 120e0 - 60e0 + (user_id % 7) * 0.06e0 AS dec")


SPREAD = """SELECT CONCAT('S', user_id) AS id, ((user_id * 137.50776405e0) % 360e0 + (user_id % 5) * 0.11e0) % 360e0 AS ra,
  (user_id * 7.31e0) % 120e0 - 60e0 + (user_id % 7) * 0.06e0 AS dec FROM (SELECT DISTINCT user_id FROM events) u"""
SPREAD_CTE = {"spread": SPREAD, "inside": f"""SELECT i.id AS image_id, p.id AS source_id, p.ra, p.dec FROM v_img i JOIN spread p
  ON p.dec BETWEEN i.dec - 0.64e0 AND i.dec + 0.64e0 AND {inside_sql('p', 'i')} AND {hav('p.ra', 'p.dec', 'i.ra', 'i.dec')} <= 0.64e0"""}


def covering(spark, sf):
    corners = [f"{a}{i}" for i in (1, 2, 3, 4) for a in ("ra", "dec")]
    return sky.polygon_join(spread_sources(spark, sf), W.images(spark, sf).select("id", "ra", "dec", *corners))


add("polygon_join", lambda s, d: covering(s, d).select("image_id", c("id").alias("source_id")), "SELECT image_id, source_id FROM inside", SPREAD_CTE)
add("polygon_contains_catalog", lambda s, d: sky.polygon_contains_catalog(W.images(s, d), W.catalog(s, d), ["objid"]),
    f"""SELECT i.id AS image_id, p.objid FROM v_img i JOIN v_cat p ON p.dec BETWEEN i.dec - 0.64e0 AND i.dec + 0.64e0
        AND {inside_sql('p', 'i')} AND {hav('p.ra', 'p.dec', 'i.ra', 'i.dec')} <= 0.64e0""")


def _todo(spark, sf):
    phot = covering(spark, sf).filter("image_id % 3 = 0").select("image_id", c("id").alias("source_id"))
    corners = [f"{a}{i}" for i in (1, 2, 3, 4) for a in ("ra", "dec")]
    img = W.images(spark, sf).select("id", "ra", "dec", *corners)
    return relational.photometry_todo(img, spread_sources(spark, sf), phot).select("image_id", "source_id")


add("photometry_todo", _todo, "SELECT image_id, source_id FROM inside WHERE image_id % 3 <> 0", SPREAD_CTE)
NEAREST = f"""SELECT d.id, p.objid, {hav('d.ra', 'd.dec', 'p.ra', 'p.dec')} AS sep, row_number() OVER (PARTITION BY d.id ORDER BY
  {hav('d.ra', 'd.dec', 'p.ra', 'p.dec')}, p.objid) AS k FROM v_det d JOIN v_cat p ON {near('d', 'p', R1)}"""
add("nearest_match", lambda s, d: sky.nearest_match(W.detections(s, d).select(*POS), W.catalog(s, d).select("objid", "ra", "dec"), ARCSEC, b_id="objid").select(
        "id", "b_objid", *r6("sep_deg")),
    f"SELECT id, objid AS b_objid, round(sep, 6) AS sep_deg FROM nn WHERE k = 1 AND sep < {R1}", {"nn": NEAREST})
SEP_SP = hav("s.ra", "s.dec", "p.ra", "p.dec")
RANKED = f"""SELECT s.id AS sid, p.*, rank() OVER (PARTITION BY s.id ORDER BY {SEP_SP} * 3600) AS rank, {SEP_SP} * 3600 AS sep
  FROM v_src s JOIN v_cat p ON {near('s', 'p', R30)}"""


def ranked(spark, sf):
    return sky.neighbors_ranked(W.sources(spark, sf).select(*POS), W.catalog(spark, sf))


add("neighbors_ranked", lambda s, d: ranked(s, d).select("sid", "objid", "rank", *r6("sep")),
    "SELECT sid, objid, rank, round(sep, 6) AS sep FROM nb", {"nb": RANKED})
add("closest_three", lambda s, d: ranking.closest_three(ranked(s, d), ["sid"], {"objid": "obj", "z_phot_median": "z"}, fill=-999).select(
        "sid", *[F.round(f"obj{k}", 0).cast("long").alias(f"obj{k}") for k in (1, 2, 3)], *r6("z1", "z2", "z3")),
    "SELECT sid, " + ", ".join(f"coalesce(max(CASE WHEN rank = {k} THEN objid END), -999) AS obj{k}, "
                               f"round(coalesce(max(CASE WHEN rank = {k} THEN z_phot_median END), -999), 6) AS z{k}" for k in (1, 2, 3))
    + " FROM nb GROUP BY 1", {"nb": RANKED})
add("catalog_scan", lambda s, d: sky.catalog_scan(W.catalog(s, d), W.sources(s, d), 10 * ARCSEC, ["objid", "type"], c("parallax") > 0).select(
        "point_id", "objid", "type", *r6("sep_deg")),
    f"""SELECT s.id AS point_id, p.objid, p.type, round({SEP_SP}, 6) AS sep_deg FROM v_src s JOIN v_cat p ON p.parallax > 0
        AND {near('s', 'p', '(10e0 / 3600e0)')}""")

# chains of linked detections: transitive closure by recursion, smallest member as the label
FREE = "SELECT id, ra, dec FROM v_det WHERE rb > 0.4"
PAIRS = f"SELECT a.id AS i, b.id AS j FROM free a JOIN free b ON a.id <> b.id AND {near('a', 'b', R2)}"
REACH = "SELECT DISTINCT i, i AS r FROM pairs UNION SELECT p.j, t.r FROM r_reach t JOIN pairs p ON p.i = t.i"
CLUSTERS = {"free": FREE, "pairs": PAIRS, "r_reach": REACH, "lab": "SELECT i AS id, min(r) AS root FROM r_reach GROUP BY 1"}


def free_detections(spark, sf):
    return W.detections(spark, sf).filter("rb > 0.4").select(*POS)


add("cluster_dbscan", lambda s, d: cluster.cluster_dbscan(free_detections(s, d), 2 * ARCSEC),
    "SELECT id, dense_rank() OVER (ORDER BY root) - 1 AS cluster FROM lab", CLUSTERS)

# a core size of 4: core points by counting, their closure, and the nearest core point for the others
DENSE = {
    "wide": "SELECT id, ra, dec FROM v_det",
    "wpairs": f"SELECT a.id AS i, b.id AS j, {hav('a.ra', 'a.dec', 'b.ra', 'b.dec')} AS sep FROM wide a JOIN wide b ON {near('a', 'b', '0.5e0')}",
    "core": "SELECT i AS id FROM wpairs GROUP BY 1 HAVING count(*) >= 4",
    "links": "SELECT i, j FROM wpairs WHERE i IN (SELECT id FROM core) AND j IN (SELECT id FROM core)",
    "r_dense": "SELECT DISTINCT i, i AS r FROM links UNION SELECT p.j, t.r FROM r_dense t JOIN links p ON p.i = t.i",
    "roots": "SELECT i AS id, min(r) AS root FROM r_dense GROUP BY 1",
    "border": """SELECT i AS id, root FROM (SELECT i, j, row_number() OVER (PARTITION BY i ORDER BY sep, j) AS k FROM wpairs
      WHERE i NOT IN (SELECT id FROM core) AND j IN (SELECT id FROM core)) b JOIN roots ON roots.id = b.j WHERE k = 1""",
}
add("cluster_dbscan_core", lambda s, d: cluster.cluster_dbscan(W.detections(s, d).select(*POS), 0.5, min_samples=4),
    "SELECT id, dense_rank() OVER (ORDER BY root) - 1 AS cluster FROM (SELECT * FROM roots UNION ALL SELECT * FROM border) u", DENSE)


def _components(spark, sf):
    """Suppliers and the parts they sell, as one graph."""
    li = W.table(spark, sf, "lineitem")
    edges = li.select(c("l_partkey").alias("src"), (c("l_suppkey") + 10_000_000).alias("dst"))
    return cluster.connected_components(edges).withColumnRenamed("node", "id")


add("connected_components", _components,
    "SELECT n AS id, min(r) AS root FROM r_reach GROUP BY 1",
    {"e": """SELECT DISTINCT l_partkey AS a, l_suppkey + 10000000 AS b FROM lineitem""",
     "u": "SELECT a, b FROM e UNION ALL SELECT b, a FROM e",
     "r_reach": "SELECT a AS n, a AS r FROM u UNION SELECT u.b, t.r FROM r_reach t JOIN u ON u.a = t.n"})


def _seeing(spark, sf):
    cat = W.detections(spark, sf).select("id", "user_id", "ra", "dec", "fwhm_image").withColumn("image_id", F.expr("user_id % 40"))
    stars = W.sources(spark, sf).filter("user_id % 4 = 0").select(c("user_id").alias("id"), "ra", "dec")
    more = W.sources(spark, sf).select(c("user_id").alias("id"), "ra", "dec")
    return aggregates.seeing_estimate(cat, stars, more, strict=False).select("image_id", *r6("seeing"))


def _hits(rule: str) -> str:
    return f"""SELECT d.user_id % 40 AS image_id, quantile_cont(d.fwhm_image, 0.5) AS m FROM v_det d WHERE EXISTS (SELECT 1 FROM v_src s
      WHERE {rule} AND {near('d', 's', R1)} AND {SEP_DS} < {R1}) GROUP BY 1"""


add("seeing_estimate", _seeing,
    """SELECT i.image_id, round(coalesce(a.m, b.m), 6) AS seeing FROM (SELECT DISTINCT user_id % 40 AS image_id FROM v_det) i
       LEFT JOIN star a USING (image_id) LEFT JOIN alls b USING (image_id)""", {"star": _hits("s.user_id % 4 = 0"), "alls": _hits("true")})
__all__ = ["QUERIES", "ORACLE", "R15"]
