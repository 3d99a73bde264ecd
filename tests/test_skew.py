"""Skew helpers against plain Spark forms, with one hot key, a null key and ties."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from skyloom.operators import ranking, skew
from skyloom.operators.sky import cone_join
from skyloom.session import scratch_root, store

ROWS = "id long, k string, v double"


@pytest.fixture(scope="module")
def hot(spark):
    """Half the rows share one key; values tie; some keys are null."""
    rng = np.random.default_rng(5)
    rows = [(i, None if i % 9 == 4 else "hot" if i % 2 else f"k{i % 14}", float(rng.integers(0, 40))) for i in range(600)]
    return store(spark.createDataFrame(rows, ROWS))


def same(a, b):
    assert sorted(map(tuple, a.select(sorted(a.columns)).collect()), key=repr) == sorted(map(tuple, b.select(sorted(b.columns)).collect()), key=repr)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_null_safe_join(spark, hot, how):
    dims = spark.createDataFrame([("hot", 1), (None, 2), ("none", 3)], "k string, w int")
    got = skew.null_safe_join(hot, dims, ["k"], how)
    want = hot.withColumn("k", F.coalesce("k", F.lit("?"))).join(dims.withColumn("k", F.coalesce("k", F.lit("?"))), ["k"], how)
    same(got.withColumn("k", F.coalesce("k", F.lit("?"))), want)


def test_running_and_numbering(hot):
    value = {"n": F.lit(1).cast("long"), "s": F.col("v"), "lo": F.col("v"), "hi": F.when(F.col("id") % 3 == 0, F.col("v"))}
    how = {"n": "sum", "s": "sum", "lo": "min", "hi": "max"}
    upto = Window.partitionBy("k").orderBy("v", "id").rowsBetween(Window.unboundedPreceding, 0)
    plain = hot.withColumns({n: getattr(F, how[n])(value[n]).over(upto) for n in value})
    same(skew.running_in_group(hot, ["k"], ["v", "id"], {n: (how[n], value[n]) for n in value}), plain)
    down = Window.partitionBy("k").orderBy(F.col("v").desc(), "id")
    same(skew.number_in_group(hot, ["k"], [F.col("v").desc(), "id"]), hot.withColumn("row", F.row_number().over(down).cast("long")))
    same(skew.rank_in_group(hot, ["k"], "v", "id"), hot.withColumn("rank", F.rank().over(Window.partitionBy("k").orderBy("v")).cast("long")))
    whole = hot.withColumn("row", F.row_number().over(Window.orderBy("v", "id")).cast("long") + 6)
    same(skew.number_rows(hot, "v", "id", start=7), whole)


def test_null_group_counts_like_any_other(spark):
    rows = spark.createDataFrame([(1, None, 1.0), (2, None, 3.0), (3, "a", 2.0), (4, "a", 4.0)], ROWS)
    assert {r.k: r.m for r in skew.exact_quantile(rows, ["k"], "v", 0.5, "m").collect()} == {None: 2.0, "a": 3.0}
    assert sorted((r.k is None, r["rank"]) for r in skew.rank_in_group(rows, ["k"], "v", "id").collect()) == [(False, 1), (False, 2), (True, 1), (True, 2)]
    assert sorted((str(r.k), r.row) for r in skew.number_in_group(rows, ["k"], ["id"]).collect()) == [("None", 1), ("None", 2), ("a", 1), ("a", 2)]
    parts = skew.collect_parts(rows, ["k"], ["id"], F.col("id"), 1, "ids").collect()
    assert sorted(r.ids for r in parts) == [[1], [2], [3], [4]]


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.9, 1.0])
@pytest.mark.parametrize("accuracy", [skew.ACCURACY, 20])
def test_exact_quantile(hot, q, accuracy, monkeypatch):
    monkeypatch.setattr(skew, "ACCURACY", accuracy)  # 20: the bracket is narrower than the groups
    data = hot.withColumn("v", F.when(F.col("id") % 50 == 0, float("nan")).when(F.col("id") % 51 != 0, F.col("v")))
    clean = data.filter("v is not null and not isnan(v)").groupBy("k").agg(F.round(F.percentile("v", F.lit(q)), 9).alias("m"))
    same(skew.exact_quantile(data, ["k"], "v", q, "m").withColumn("m", F.round("m", 9)), clean)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.sampled_from([0.0, 1.0, 2.5, 7.0, 1e6]), min_size=1, max_size=9), q=st.sampled_from([0.25, 0.5, 0.75]))
def test_quantiles_of_small_groups(spark, values, q):
    rows = spark.createDataFrame([(i, "a", v) for i, v in enumerate(values)], ROWS)
    assert skew.exact_quantile(rows, ["k"], "v", q, "m").first().m == pytest.approx(np.quantile(values, q))


def shapes(n, seed=0):
    rng = np.random.default_rng(seed)
    return {
        "normal": rng.normal(100, 3, n), "long tail": rng.lognormal(0, 2, n), "ties": rng.integers(0, 5, n).astype(float),
        "two heaps": np.where(rng.random(n) < 0.5, rng.normal(0, 1, n), rng.normal(1e6, 1, n)), "constant": np.full(n, 7.0),
        "half constant": np.where(rng.random(n) < 0.55, 3.0, rng.normal(0, 50, n)), "signs": rng.choice([-1.0, 1.0], n), None: -rng.random(n),
    }


@pytest.mark.parametrize("n,grid", [(1, 2000), (2, 2000), (7, 2000), (500, 2000), (30_001, 2000), (3000, 20), (4000, 50)])
def test_median_and_deviation(spark, n, grid, monkeypatch):
    monkeypatch.setattr(skew, "GRID", grid)  # a coarse grid leaves wide gaps
    groups = shapes(n, n)
    rows = spark.createDataFrame([(i, k, float(v)) for k, vs in groups.items() for i, v in enumerate(vs)] + [(1, "normal", None), (2, "ties", float("nan"))], ROWS)
    got = {r.k: (r.median, r.deviation) for r in skew.median_and_deviation(rows, ["k"], "v").collect()}
    assert set(got) == set(groups)
    for k, vs in groups.items():
        m = np.median(vs)
        assert got[k] == pytest.approx((m, np.median(np.abs(vs - m))), rel=1e-12, abs=1e-12), k


def test_median_and_deviation_in_two_scans(spark):
    rows = spark.range(1000).selectExpr("id", "cast(id % 3 as string) k", "cast(id * 7 % 101 as double) v")
    rows = store(rows)
    plan = skew.median_and_deviation(rows, ["k"], "v")._jdf.queryExecution().executedPlan().toString()
    # the first scan has written its brackets when the plan of the second is made
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len([s for s in scans if "id#" in s or ",v#" in s or "v#" in s]) == 1 and len(scans) == 2
    assert plan.count("Exchange hashpartitioning") <= 3


def test_parts_are_whole_and_bounded(hot):
    parts = skew.collect_parts(hot, ["k"], ["v", "id"], F.col("id"), 16, "ids")
    assert parts.filter(F.size("ids") > 16).count() == 0
    rows = {(r.k, r.part): r.ids for r in parts.collect()}
    for key in {k for k, _ in rows}:
        want = [r.id for r in hot.filter(F.col("k").eqNullSafe(F.lit(key))).orderBy("v", "id").collect()]
        assert sum((rows[key, p] for p in range((len(want) + 15) // 16)), []) == want


@pytest.mark.parametrize("crowded", ["left", "right"])
def test_crowded_cell_is_split(spark, crowded):
    """Most rows of one side lie in one sky cell: the adaptive join splits it, on either side."""
    settings_ = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in settings_}
    try:
        for key, value in settings_.items():
            spark.conf.set(key, value)
        many = spark.range(0, 4000, 1, 6).selectExpr("id", "CASE WHEN id % 10 < 9 THEN 10e0 + id * 1e-9 ELSE id * 0.08e0 END AS ra", "CASE WHEN id % 10 < 9 THEN 10e0 ELSE 20e0 END AS dec")
        few = spark.range(60).selectExpr("id", "10e0 + id * 1e-7 AS ra", "10e0 AS dec")
        a, b = (many, few) if crowded == "left" else (few, many)
        joined = cone_join(a, b, 1e-3)
        assert joined.count() == 3600 * 60
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.integers(1, 60), n=st.integers(1, 12))
def test_work_plan_equals_array_split(spark, rows, n):
    got = [r.chunk for r in ranking.work_plan(spark.range(rows), n, "id").orderBy("id").collect()]
    want = sum(([i] * len(part) for i, part in enumerate(np.array_split(range(rows), n))), [])
    assert got == want


def test_ten_items_in_three_chunks(spark):
    plan = ranking.work_plan(spark.range(10), 3, "id").groupBy("chunk").count().orderBy("chunk")
    assert [r["count"] for r in plan.collect()] == [4, 3, 3]
    last = ranking.recursive_split(spark.range(10), 3, "id").groupBy("chunk").count().orderBy("chunk")
    assert [r["count"] for r in last.collect()] == [3, 3, 4]


def test_ranking_limit_reaches_the_map_side(hot):
    best = ranking.reference_plan(
        hot.filter("k is not null").selectExpr("id", "CAST(id % 2 AS INT) AS field", "length(k) AS ccdid", "1 AS qid", "1 AS fid", "v AS maglimit"), "v1", 50, 14)
    assert "WindowGroupLimit" in best._jdf.queryExecution().optimizedPlan().toString()
    assert best.groupBy("field", "ccdid").count().agg(F.max("count")).first()[0] == 50


def test_scratch_needs_a_shared_folder(spark):
    assert scratch_root(spark)

    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://somewhere"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Session())
