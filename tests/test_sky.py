"""Sky joins and clustering against brute force, on planted and random positions."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import skyloom.operators.cluster as C
from skyloom.operators.relational import photometry_todo
from skyloom.operators.sky import cone_join, cone_search, nearest_match, neighbors_ranked, polygon_join

POS = "id long, ra double, dec double"


def frame(spark, rows):
    return spark.createDataFrame([(i, float(r), float(d)) for i, (r, d) in enumerate(rows)], POS)


def distances(rows):
    ra, dec = np.radians(np.array(rows, dtype=float).T)
    h = np.sin((dec[:, None] - dec) / 2) ** 2 + np.cos(dec[:, None]) * np.cos(dec) * np.sin((ra[:, None] - ra) / 2) ** 2
    return np.degrees(2 * np.arcsin(np.sqrt(np.minimum(1, h))))


def union_find(near):
    label = list(range(len(near)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, j in zip(*np.where(near)):
        a, b = root(i), root(j)
        label[max(a, b)] = min(a, b)
    roots = [root(i) for i in range(len(near))]
    return {i: r for i, r in enumerate(roots) if roots.count(r) > 1}


def sky(n, seed=1):
    rng = np.random.default_rng(seed)
    ra = np.concatenate([rng.uniform(0, 360, n), rng.uniform(359.5, 360.5, n) % 360, rng.uniform(0, 360, n), rng.uniform(0, 360, n)])
    dec = np.concatenate([rng.uniform(-90, 90, n), rng.uniform(-1, 1, n), 90 - rng.uniform(0, 1, n), -90 + rng.uniform(0, 1, n)])
    return list(zip(ra, dec))


@pytest.mark.parametrize("radius,cell", [(0.05, None), (0.4, 0.5), (3.0, None)])
def test_cone_join_equals_brute_force(spark, radius, cell):
    rows = sky(150)
    df = frame(spark, rows)
    got = [tuple(r) for r in cone_join(df, df, radius, cell_deg=cell).select("id", "b_id").collect()]
    assert len(got) == len(set(got))
    assert set(got) == set(zip(*map(list, np.where(distances(rows) <= radius))))


def test_self_join_gives_ordered_pairs(spark):
    rows = sky(60, 4)
    df = frame(spark, rows)
    got = {tuple(r) for r in cone_join(df, df, 0.5).filter("id <> b_id").select("id", "b_id").collect()}
    near = distances(rows) <= 0.5
    np.fill_diagonal(near, False)
    assert got == set(zip(*map(list, np.where(near))))


@pytest.mark.parametrize("a,b", [((0.0001, 0), (359.9999, 0)), ((10, 89.9999), (190, 89.9999))])
def test_pairs_across_the_seam_and_the_pole(spark, a, b):
    row = cone_join(frame(spark, [a]), frame(spark, [b]), 1 / 3600).collect()
    assert len(row) == 1 and row[0].sep_deg * 3600 == pytest.approx(0.72, abs=1e-6)


@pytest.mark.parametrize("shift,n", [(-1e-9, 1), (1e-9, 0)])
def test_radius_edge(spark, shift, n):
    r = 2 / 3600
    assert cone_join(frame(spark, [(10, 20)]), frame(spark, [(10, 20 + r + shift)]), r).count() == n


def test_left_and_semi_keep_left_rows_once(spark):
    a, b = frame(spark, [(10, 0), (50, 0)]), frame(spark, [(10, 0), (10, 1e-5)])
    assert sorted((r.id, r.b_id) for r in cone_join(a, b, 1e-3, "left").collect() if r.b_id is not None) == [(0, 0), (0, 1)]
    assert cone_join(a, b, 1e-3, "left").filter("b_id is null").count() == 1
    assert [r.id for r in cone_join(a, b, 1e-3, "left_semi").collect()] == [0]


def test_cone_plan_has_no_cartesian(spark):
    a = frame(spark, sky(10))
    plan = cone_join(a, a, 0.1)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "ArrowEval" not in plan


def test_empty_inputs(spark):
    none = frame(spark, [(1, 1)]).filter("id < 0")
    assert cone_join(none, none, 1.0).count() == 0
    assert C.cluster_dbscan(none, 1.0).count() == 0
    assert nearest_match(none, none, 1.0).count() == 0


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ra=st.floats(0, 360), dec=st.floats(-90, 90), r=st.floats(0.01, 60))
def test_cone_search_equals_distance_test(spark, ra, dec, r):
    rows = sky(50, 2)
    got = {x.id for x in cone_search(frame(spark, rows), ra, dec, r).collect()}
    dist = distances([(ra, dec), *rows])[0, 1:]
    assert {i for i in range(len(rows)) if dist[i] < r - 1e-9} <= got <= {i for i in range(len(rows)) if dist[i] <= r + 1e-9}


def test_nearest_then_lowest_id(spark):
    a = frame(spark, [(10, 0)])
    b = spark.createDataFrame([(7, 10.0001, 0.0), (3, 9.9999, 0.0), (9, 10.0003, 0.0)], POS)
    assert nearest_match(a, b, 1.0).first().b_id in (3, 7)
    b = spark.createDataFrame([(7, 10.0001, 0.0), (3, 10.0001, 0.0)], POS)
    assert nearest_match(a, b, 1.0).first().b_id == 3
    exact = spark.createDataFrame([(5, 10.0, 1 / 3600)], POS)
    assert nearest_match(a, exact, 0.5 / 3600).count() == 0


def test_rank_shares_ties(spark):
    src = frame(spark, [(10, 0)])
    cat = spark.createDataFrame([(1, 10.0, 1e-4), (2, 10.0, 1e-4), (3, 10.0, 2e-4)], "objid long, ra double, dec double")
    got = {r.objid: r["rank"] for r in neighbors_ranked(src, cat).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_polygon_seam_pole_and_todo(spark):
    def image(i, ra, dec, w):
        return (i, ra, dec, (ra - w) % 360, dec - .3, (ra + w) % 360, dec - .3, (ra + w) % 360, dec + .3, (ra - w) % 360, dec + .3)
    cols = "id long, ra double, dec double," + ",".join(f"ra{i} double, dec{i} double" for i in (1, 2, 3, 4))
    images = spark.createDataFrame([image(1, 0.0, 0.0, .3), image(2, 180.0, 60.0, .6)], cols)
    src = spark.createDataFrame([("a", 359.9, 0.1), ("b", 0.35, 0.0), ("c", 180.5, 60.2)], "id string, ra double, dec double")
    assert {(r.image_id, r.id) for r in polygon_join(src, images).collect()} == {(1, "a"), (2, "c")}
    done = spark.createDataFrame([(1, "a")], "image_id long, source_id string")
    assert [(r.image_id, r.source_id) for r in photometry_todo(images, src, done).collect()] == [(2, "c")]


def test_points_meet_each_footprint_once(spark, monkeypatch):
    from skyloom.operators import sky

    seen = []
    whole = sky.cone_join
    monkeypatch.setattr(sky, "cone_join", lambda a, b, *args, **kw: seen.append(b) or whole(a, b, *args, **kw))
    corners = [f"{a} + {v} AS {a}{k}" for k, xy in enumerate([(-0.3, -0.3), (0.3, -0.3), (0.3, 0.3), (-0.3, 0.3)], 1) for a, v in zip(("ra", "dec"), xy)]
    images = spark.range(300).selectExpr("id", "CAST(10 + id % 2 AS DOUBLE) AS ra", "0e0 AS dec").selectExpr("*", *corners)
    stars = spark.createDataFrame([(1, 10.1, 0.1), (2, 11.0, -0.2), (3, 10.5, 0.0)], "objid long, ra double, dec double")
    got = {(r.image_id, r.objid) for r in sky.polygon_contains_catalog(images, stars, ["objid"]).collect()}
    assert got == {(i, 1 + i % 2) for i in range(300)}
    assert seen[0].count() == 2



def test_chain_is_one_cluster_and_loner_is_noise(spark):
    step = 1.5 / 3600
    rows = frame(spark, [(10, 0), (10, step), (10, 2 * step), (10, 1)])
    got = {r.id: r.cluster for r in C.cluster_dbscan(rows, 2 / 3600).collect()}
    assert got == {0: 0, 1: 0, 2: 0}


@pytest.mark.parametrize("direct", [4096, 0])
def test_clusters_equal_union_find(spark, monkeypatch, direct):
    monkeypatch.setattr(C, "DIRECT_PAIRS", direct)
    rows = sky(80, 3)
    for eps in (0.05, 0.3):
        want = union_find(distances(rows) <= eps)
        got = {r.id: r.root for r in C.link_positions(frame(spark, rows), eps).collect()}
        assert got == want
    order = {r: k for k, r in enumerate(sorted(set(want.values())))}
    assert {r.id: r.cluster for r in C.cluster_dbscan(frame(spark, rows), 0.3).collect()} == {i: order[r] for i, r in want.items()}


def test_hot_cells_next_to_each_other_stay_apart(spark, monkeypatch):
    """Two dense clumps nearer than their boxes suggest: linked only if two points really are within reach."""
    monkeypatch.setattr(C, "DIRECT_PAIRS", 10)
    rng = np.random.default_rng(0)
    eps = 2 / 3600
    for gap, clusters in ((2.05, 2), (1.95, 1)):
        t = rng.uniform(0, np.pi, 200)
        arc = [(10 + 0.3 / 3600 * np.sin(x), 0.3 / 3600 * np.cos(x)) for x in t]
        other = [(ra, dec + (gap + 0.6) / 3600) for ra, dec in arc] + [(10, 0.3 / 3600), (10, (0.3 + gap) / 3600)]
        got = C.cluster_dbscan(frame(spark, arc + other), eps)
        assert got.select("cluster").distinct().count() == clusters


def test_long_chain_of_components(spark):
    edges = spark.range(400).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    assert C.connected_components(edges).filter("root <> 0").count() == 0


def brute_dbscan(dist, eps, m):
    """(clusters from the cores' components, borders to the nearest core), by the definition."""
    near = dist <= eps
    core = near.sum(axis=1) >= m
    ids = np.flatnonzero(core)
    roots = union_find(near[np.ix_(ids, ids)]) if len(ids) else {}
    # union_find leaves single points out
    label = {int(i): int(ids[roots.get(k, k)]) for k, i in enumerate(ids)}
    for i in np.flatnonzero(~core & near[:, core].any(axis=1)):
        reach = ids[near[i, ids]]
        label[int(i)] = label[int(reach[np.lexsort((reach, dist[i, reach]))[0]])]
    order = {r: k for k, r in enumerate(sorted(set(label.values())))}
    return {i: order[r] for i, r in label.items()}


def density_points(seed):
    rng = np.random.default_rng(seed)
    rows = [(rng.uniform(0, 4), rng.uniform(-2, 2)) for _ in range(150)]
    # a crowd in one cell with thin surroundings, and a chain whose ends are border points
    rows += [(1 + rng.normal(0, 0.004), 0.5 + rng.normal(0, 0.004)) for _ in range(80)]
    rows += [(1 + 0.1 * np.cos(t), 0.5 + 0.1 * np.sin(t)) for t in rng.uniform(0, 6.28, 12)]
    rows += [(3 + 0.08 * k, 89.2 + 0.0001 * k) for k in range(40)] + [(359.95 + 0.02 * k, 1.0) for k in range(8)]
    return rows


@pytest.mark.parametrize("m", [1, 2, 3, 4, 6, 10])
def test_density_clusters_equal_the_definition(spark, m):
    rows = density_points(m)
    want = brute_dbscan(distances(rows), 0.1, m)
    assert {r.id: r.cluster for r in C.cluster_dbscan(frame(spark, rows), 0.1, m).collect()} == want
    assert m > 2 or C.cluster_dbscan(frame(spark, rows[:0]), 0.1, m).count() == 0


def test_crowded_cell_is_counted_by_its_box(spark, monkeypatch):
    """Points around a cell with a third of all points count its box; only points that its rim decides are compared."""
    asked = []
    around = C._points_around
    monkeypatch.setattr(C, "_points_around", lambda pairs, *rest: asked.append(pairs.count()) or around(pairs, *rest))
    rng = np.random.default_rng(5)
    crowd = [(10 + rng.uniform(0, 1e-4), rng.uniform(0, 1e-4)) for _ in range(300)]
    others = [(10 + rng.uniform(-0.05, 0.05), rng.uniform(-0.05, 0.05)) for _ in range(40)]
    rows = crowd + others
    got = {r.id: r.cluster for r in C.cluster_dbscan(frame(spark, rows), 0.1, 5).collect()}
    assert got == brute_dbscan(distances(rows), 0.1, 5) and asked[0] < 40
