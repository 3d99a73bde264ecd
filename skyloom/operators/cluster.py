"""Clustering of positions without listing pairs (C9), and numbering.

With two members as the core size, density clusters are the connected components
of the graph that links points within ``eps``. Points are first collapsed to
cells whose diagonal is shorter than ``eps``, so a cell is connected by itself
however many points it holds. Two cells are compared by the boxes around their
points: farthest corners within ``eps`` means linked, nearest corners beyond it
means not linked. What stays open is split into smaller cells and compared again,
but only while the two sides are not already connected.

With larger core sizes the core points are found first. A cell with enough points has
only core points; the others hold fewer than the core size each. Their points count
the cells around them by their boxes, which settles most of them, and only those still
open count points: a cell of any size meets a bounded number of points, one by one.
Clusters are the components of the core points; a point that is not core joins the
nearest core point within ``eps``.
"""

from __future__ import annotations

from functools import reduce
from math import radians, sin, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.geometry import unit_vector
from skyloom.operators.skew import number_rows
from skyloom.session import store

_AXES = ("x", "y", "z")
_CELL = ("cx", "cy", "cz")
MAX_ROUNDS = 60
SPLIT = 4
DIRECT_PAIRS = 4096


def _boxes(points: DataFrame, keys: list[str]) -> DataFrame:
    """One row per group: smallest id, size and the box around its points."""
    return points.groupBy(*keys).agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"),
        *[F.min(a).alias(f"{a}0") for a in _AXES], *[F.max(a).alias(f"{a}1") for a in _AXES],
    )


def _box_distances(a: str, b: str) -> tuple[Column, Column]:
    """Squared nearest and farthest distance between the boxes ``a`` and ``b``."""
    near, far = [], []
    for ax in _AXES:
        lo_a, hi_a, lo_b, hi_b = (F.col(f"{s}.{ax}{i}") for s in (a, b) for i in (0, 1))
        gap = F.greatest(F.lit(0.0), lo_b - hi_a, lo_a - hi_b)
        span = F.greatest(hi_b - lo_a, hi_a - lo_b)
        near.append(gap * gap)
        far.append(span * span)
    return near[0] + near[1] + near[2], far[0] + far[1] + far[2]


def _is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def connected_components(edges: DataFrame, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """(node, root) for every node of an undirected edge list (src, dst); root is the smallest node.

    Alternates large-star and small-star steps: the number of rounds grows with the
    logarithm of the longest chain, not with its length. Each round is stored, so
    a lost executor costs at most one round. Only an emptiness test returns to the
    driver.
    """
    pairs = _canonical(edges)
    for _ in range(max_rounds):
        # each step reads its links twice, so a longer chain of steps would repeat the ones before
        pairs = store(_star(_star(pairs, large=True), large=False))
        if _is_empty(_not_stars(pairs)):
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    leaves = pairs.select(F.col("src").alias("node"), F.col("dst").alias("root"))
    roots = pairs.select(F.col("dst").alias("node"), F.col("dst").alias("root")).distinct()
    return leaves.unionByName(roots)


def _not_stars(pairs: DataFrame) -> DataFrame:
    """Nodes that still hang on two others, or on a node that itself hangs on one."""
    twice = pairs.groupBy("src").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("src").alias("node"))
    chained = pairs.select(F.col("dst").alias("node")).join(
        pairs.select(F.col("src").alias("node")), "node", "left_semi"
    )
    return twice.unionByName(chained)


def _canonical(edges: DataFrame) -> DataFrame:
    """Each link once, from the larger to the smaller node; loops dropped."""
    return (
        edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
        .filter(F.col("src") != F.col("dst"))
        .distinct()
    )


def _with_low(pairs: DataFrame) -> DataFrame:
    """Adds the smallest neighbour of ``src``; combined before the shuffle, so a node may have very many neighbours."""
    return pairs.join(pairs.groupBy("src").agg(F.min("dst").alias("low")), ["src"])


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """One star step on links from larger to smaller nodes.

    large: every node links its larger neighbours to the smallest of its neighbourhood.
    small: every node links itself and its smaller neighbours to that smallest one;
    repeated links go here.
    """
    if large:
        ends = F.explode(F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"))))
        near = _with_low(pairs.select(ends.alias("e")).select("e.*")).filter("dst > src")
        return near.select(F.col("dst").alias("src"), F.least("low", "src").alias("dst"))
    ends = F.explode(F.array("src", "dst"))
    return _canonical(_with_low(pairs).select(ends.alias("src"), F.col("low").alias("dst")))


def _candidate_cells(cells: DataFrame, side: float, eps2: float) -> DataFrame:
    """Pairs of neighbouring cells, each once; only cells that the unit sphere passes through, within reach of
    the box around a cell's points, are looked for."""
    steps = [(i, j, k) for i in range(-2, 3) for j in range(-2, 3) for k in range(-2, 3) if (i, j, k) > (0, 0, 0)]

    def along(cell: str, axis: str, step: int) -> Column:
        """Of the cells ``step`` further on: nearest and farthest to the centre of the sphere, and to the box."""
        lo, hi = (F.col(cell) + step) * side, (F.col(cell) + step + 1) * side
        low = F.when(lo > 0, lo * lo).when(hi < 0, hi * hi).otherwise(0.0)
        gap = F.greatest(F.lit(0.0), lo - F.col(f"{axis}1"), F.col(f"{axis}0") - hi)
        return F.struct(low.alias("low"), F.greatest(lo * lo, hi * hi).alias("high"), (gap * gap).alias("near"))

    # worked out once per cell and axis; what follows the explode is short and compiled, unlike a lambda over an array
    probe = cells.withColumns({f"_{c}": F.array(*[along(c, a, v) for v in range(-2, 3)]) for c, a in zip(_CELL, _AXES)})
    probe = probe.withColumn("_s", F.explode(F.array(*[F.struct(*[F.lit(v).alias(c) for v, c in zip(s, _CELL)]) for s in steps])))
    low, high, near = (sum((F.get(f"_{c}", F.col(f"_s.{c}") + 2)[part] for c in _CELL), F.lit(0.0)) for part in ("low", "high", "near"))
    # a hair more, so that a point beside the edge of its cell is not lost
    probe = probe.filter((low <= 1 + 1e-9) & (high >= 1 - 1e-9) & (near <= eps2 * (1 + 1e-6)))
    probe = probe.select(*cells.columns, *[(F.col(c) + F.col(f"_s.{c}")).alias(f"t{c}") for c in _CELL]).hint("merge").alias("a")
    cond = reduce(lambda p, q: p & q, [F.col(f"a.t{c}") == F.col(f"b.{c}") for c in _CELL])
    return probe.join(cells.alias("b"), cond)


def _judge(pairs: DataFrame, eps2: float, *keep: Column) -> DataFrame:
    """Compare two boxes: ``linked`` when surely within reach; ``weight`` counts the point pairs if not."""
    near, far = _box_distances("a", "b")
    return pairs.filter(near <= eps2).select(
        *keep, (far <= eps2).alias("linked"), (F.col("a.n") * F.col("b.n").cast("double")).alias("weight")
    )


def _reach(eps_deg: float) -> tuple[float, float]:
    """(squared chord of ``eps_deg``, side of a cell whose diagonal is shorter than that)."""
    chord = 2 * sin(radians(eps_deg) / 2)
    return chord * chord * (1 + 1e-12), chord / sqrt(3.0) * (1 - 1e-9)


def _placed(points: DataFrame, side: float) -> DataFrame:
    """id, x, y, z and the cell of each position."""
    vec = dict(zip(_AXES, unit_vector(F.col("ra"), F.col("dec"))))
    placed = points.select("id", "ra", "dec").withColumns(vec)
    return placed.withColumns({c: F.floor(F.col(a) / side) for c, a in zip(_CELL, _AXES)}).drop("ra", "dec")


def link_positions(points: DataFrame, eps_deg: float, singles: bool = False) -> DataFrame:
    """(id, root) for the connected components of positions ``(id, ra, dec)`` within ``eps_deg``.

    Points alone in their component are left out unless ``singles``. ``points`` is read
    several times: store it first if it is costly to compute.
    """
    eps2, side = _reach(eps_deg)
    placed = _placed(points, side)
    cells = store(_boxes(placed, list(_CELL)))
    ends = F.col("a.rep").alias("pa"), F.col("b.rep").alias("pb")
    judged = store(_judge(_candidate_cells(cells, side, eps2), eps2, *ends))
    roots = connected_components(judged.filter("linked").select(F.col("pa").alias("src"), F.col("pb").alias("dst")))
    level = _still_apart(judged.filter(~F.col("linked")).drop("linked"), roots)
    level = store(level.withColumns({"a_path": F.lit(""), "b_path": F.lit("")}))
    members = placed.join(cells.select(*_CELL, F.col("rep").alias("cell")), list(_CELL)).drop(*_CELL)
    if not _is_empty(level):
        roots = _refine(members.withColumn("path", F.lit("")), level, roots, eps2, side)
    labelled = members.select("id", "cell").join(roots.withColumnRenamed("node", "cell"), ["cell"], "left")
    labelled = labelled.select("id", F.coalesce("root", "cell").alias("root"))
    if singles:
        return labelled
    # a component has company if it has two cells, or one cell with two points
    sizes = cells.select(F.col("rep").alias("node"), "n").join(roots, "node", "left")
    sizes = sizes.groupBy(F.coalesce("root", "node").alias("root")).agg(F.sum("n").alias("n")).filter("n >= 2")
    return labelled.join(sizes.select("root"), ["root"], "left_semi")


def _still_apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs (pa, pb) whose components differ; nodes without links are their own component."""
    out = pairs
    for end in ("pa", "pb"):
        out = out.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root")), end, "left")
        out = out.withColumn(f"{end}_root", F.coalesce(f"{end}_root", end))
    return out.filter("pa_root != pb_root").drop("pa_root", "pb_root")


def _sides(level: DataFrame, table: DataFrame, path: str) -> DataFrame:
    """Open pairs with the rows of ``table`` that belong to their first and second cell."""
    a, b, l = table.alias("a"), table.alias("b"), level.alias("l")
    return l.join(a, (F.col("l.pa") == F.col("a.cell")) & (F.col("l.a_path") == F.col(f"a.{path}"))).join(
        b, (F.col("l.pb") == F.col("b.cell")) & (F.col("l.b_path") == F.col(f"b.{path}"))
    )


def _refine(members: DataFrame, level: DataFrame, roots: DataFrame, eps2: float, side: float) -> DataFrame:
    """Decide the open pairs of cells: the small ones point by point, the others on smaller cells.

    A pair is compared directly only when it holds at most ``DIRECT_PAIRS`` point
    pairs; a split compares a fixed number of sub-cells. It ends at the latest when
    a cell is a single position.
    """
    for _ in range(MAX_ROUNDS):
        light, heavy = level.filter(F.col("weight") <= DIRECT_PAIRS), level.filter(F.col("weight") > DIRECT_PAIRS)
        gap2 = sum(((F.col(f"a.{x}") - F.col(f"b.{x}")) * (F.col(f"a.{x}") - F.col(f"b.{x}")) for x in _AXES), F.lit(0.0))
        found = _sides(light, members, "path").filter(gap2 <= eps2).select("l.pa", "l.pb")
        split = not _is_empty(heavy)
        if split:
            side = side / SPLIT
            involved = heavy.select(F.col("pa").alias("cell"), F.col("a_path").alias("path")).unionByName(
                heavy.select(F.col("pb").alias("cell"), F.col("b_path").alias("path"))
            ).distinct()
            sub = F.concat_ws("/", *[F.floor(F.col(a) / side).cast("string") for a in _AXES])
            inside = members.join(involved, ["cell", "path"], "left_semi")
            inside = store(inside.withColumn("parent", F.col("path")).withColumn("path", sub))
            members = inside.drop("parent")
            boxes = _boxes(inside, ["cell", "parent", "path"]).drop("rep")
            keep = F.col("l.pa"), F.col("l.pb"), F.col("a.path").alias("a_path"), F.col("b.path").alias("b_path")
            judged = store(_judge(_sides(heavy, boxes, "parent"), eps2, *keep))
            found = found.unionByName(judged.filter("linked").select("pa", "pb"))
        known = roots.select(F.col("node").alias("src"), F.col("root").alias("dst"))
        roots = connected_components(known.unionByName(found.select(F.col("pa").alias("src"), F.col("pb").alias("dst"))))
        if not split:
            return roots
        level = store(_still_apart(judged.filter(~F.col("linked")).drop("linked"), roots))
        if _is_empty(level):
            return roots
    raise RuntimeError("positions could not be told apart")


def _near_cells(cells: DataFrame, side: float, eps2: float) -> DataFrame:
    """Cells with each cell around them that may hold a point within reach, themselves included.

    Columns: the cell, and of the other one its cell ``o*``, its box and its size ``n``.
    """
    near, _ = _box_distances("a", "b")
    pairs = _candidate_cells(cells, side, eps2).filter(near <= eps2)
    box = [f"{a}{i}" for a in _AXES for i in (0, 1)]

    def view(this: str, other: str) -> DataFrame:
        return pairs.select(*[F.col(f"{this}.{c}") for c in _CELL], *[F.col(f"{other}.{c}").alias(f"o{c}") for c in _CELL],
                            *[F.col(f"{other}.{c}") for c in (*box, "n")])

    alone = cells.select(*_CELL, *[F.col(c).alias(f"o{c}") for c in _CELL], *box, "n")
    return alone.unionByName(view("a", "b")).unionByName(view("b", "a"))


def _point_box_distances() -> tuple[Column, Column]:
    """Squared nearest and farthest distance of the point ``x, y, z`` to the box beside it."""
    near, far = F.lit(0.0), F.lit(0.0)
    for a in _AXES:
        gap = F.greatest(F.lit(0.0), F.col(f"{a}0") - F.col(a), F.col(a) - F.col(f"{a}1"))
        span = F.greatest(F.col(f"{a}1") - F.col(a), F.col(a) - F.col(f"{a}0"))
        near, far = near + gap * gap, far + span * span
    return near, far


def _points_around(pairs: DataFrame, placed: DataFrame, eps2: float) -> DataFrame:
    """``pairs`` (id, x, y, z, a cell ``o*``) with each point ``pid`` of that cell within reach, and the squared gap."""
    other = placed.select(F.col("id").alias("pid"), *[F.col(a).alias(f"p{a}") for a in _AXES], *[F.col(c).alias(f"o{c}") for c in _CELL])
    gap = sum(((F.col(a) - F.col(f"p{a}")) * (F.col(a) - F.col(f"p{a}")) for a in _AXES), F.lit(0.0))
    return pairs.join(other, [f"o{c}" for c in _CELL]).withColumn("gap", gap).filter(F.col("gap") <= eps2)


def core_points(placed: DataFrame, cells: DataFrame, near: DataFrame, eps2: float, min_samples: int) -> DataFrame:
    """Ids of the points with ``min_samples`` points within reach, themselves included.

    A point outside a full cell belongs to a cell of fewer than ``min_samples``, so a cell of
    any size is compared with a bounded number of points.
    """
    full = placed.join(cells.filter(F.col("n") >= min_samples).select(*_CELL), list(_CELL), "left_semi").select("id")
    sparse = placed.join(cells.filter(F.col("n") < min_samples).select(*_CELL), list(_CELL), "left_semi")
    closest, farthest = _point_box_distances()
    around = sparse.join(near, list(_CELL)).filter(closest <= eps2).withColumn("inside", farthest <= eps2)
    around = store(around.select("id", *_AXES, *[f"o{c}" for c in _CELL], "n", "inside"))
    counts = store(around.groupBy("id").agg(F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("sure"), F.sum("n").alias("most")))
    settled = counts.filter(F.col("sure") >= min_samples).select("id")
    open_ids = counts.filter((F.col("sure") < min_samples) & (F.col("most") >= min_samples)).select("id", "sure")
    asked = around.filter(~F.col("inside")).join(open_ids.select("id"), "id", "left_semi")
    found = _points_around(asked, placed, eps2).groupBy("id").agg(F.count(F.lit(1)).alias("found"))
    counted = open_ids.join(found, "id").filter(F.col("sure") + F.col("found") >= min_samples).select("id")
    return full.unionByName(settled).unionByName(counted)


def _density_labels(points: DataFrame, eps_deg: float, min_samples: int) -> DataFrame:
    """(id, root) of core points and of the points that they reach; ``root`` is the smallest core id of the cluster."""
    eps2, side = _reach(eps_deg)
    placed = store(_placed(points, side))
    cells = store(_boxes(placed, list(_CELL)))
    near = store(_near_cells(cells, side, eps2))
    core_ids = store(core_points(placed, cells, near, eps2, min_samples))
    core = store(link_positions(points.join(core_ids, "id", "left_semi"), eps_deg, singles=True))
    rest = placed.join(core_ids, "id", "left_anti")
    closest, _ = _point_box_distances()
    asked = rest.join(near, list(_CELL)).filter(closest <= eps2).select("id", *_AXES, *[f"o{c}" for c in _CELL])
    nearest = _points_around(asked, placed.join(core_ids, "id", "left_semi"), eps2)
    nearest = nearest.groupBy("id").agg(F.min(F.struct("gap", "pid")).alias("m")).select(F.col("id").alias("border"), F.col("m.pid").alias("id"))
    return core.unionByName(nearest.join(core, "id").select(F.col("border").alias("id"), "root"))


def cluster_dbscan(points: DataFrame, eps_deg: float, min_samples: int = 2) -> DataFrame:
    """(id, cluster) of positions ``(id, ra, dec)``; noise is left out.

    ``eps_deg`` is inclusive; ``min_samples`` counts the point itself. Clusters are numbered
    from 0 in the order of their smallest core point. A point within reach of the core points
    of several clusters joins the nearest of them, the smallest id on ties. With the survey's
    core size of 2 every linked point is a core point.
    """
    if min_samples < 1:
        raise ValueError("min_samples must be at least 1")
    if min_samples <= 2:
        linked = store(link_positions(points, eps_deg, singles=min_samples == 1))
    else:
        linked = store(_density_labels(points, eps_deg, min_samples))
    numbered = number_rows(linked.select("root").distinct(), "root", name="cluster").select("root", "cluster")
    return linked.join(numbered, ["root"]).select("id", "cluster")


def source_numbering(clusters: DataFrame, start: int, order: str = "cluster", prefix: str = "S", width: int = 8) -> DataFrame:
    """consecutive names for new sources in cluster order; one row per cluster comes in."""
    numbered = number_rows(clusters, order, name="number", start=start)
    return numbered.withColumn("name", F.concat(F.lit(prefix), F.lpad(F.col("number").cast("string"), width, "0")))
