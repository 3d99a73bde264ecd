"""Tables laid out by cell and by key range, and the newest rows by counting."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from skyloom.operators import ranking, tables
from skyloom.operators.sky import cone_search
from skyloom.session import scratch_root
from skyloom.sources import cells


def folder(spark):
    return f"{scratch_root(spark)}/layout-{uuid.uuid4().hex}"


def rows_read(df):
    """(ids of the result, rows that the scan gave out)."""
    ids = sorted(r.id for r in df.collect())
    plan = df._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().head()
    if plan.getClass().getSimpleName().startswith("AdaptiveSparkPlan"):
        plan = plan.executedPlan()
        while plan.children().size():
            plan = plan.children().head()
    return ids, plan.metrics().apply("numOutputRows").value()


@pytest.fixture(scope="module")
def sky_table(spark):
    rng = random.Random(2)
    rows = [(i, rng.uniform(0, 360), 90 - 180 * rng.random()) for i in range(20_000)] + [(20_000 + i, rng.uniform(0, 360), s * (90 - rng.random())) for i in range(100) for s in (1, -1)]
    rows += [(30_000, 0.0, 0.0), (30_001, 359.9999999, 0.0), (30_002, 180.0, 90.0), (30_003, 180.0, -90.0), (30_004, None, None)]
    df = spark.createDataFrame(rows, "id long, ra double, dec double")
    path = folder(spark)
    cells.write_by_cell(df, path, files=64)
    return df, spark.read.parquet(path)


@pytest.mark.parametrize("ra,dec,r", [(0, 0, 1.5), (359.99, 0.3, 2), (120, 45, 3), (10, 89.5, 1), (10, -89.9, 5), (200, -60, 0.01), (77, 30, 0.9999), (0, 0, 179), (50, 10, 60)])
def test_search_by_cell_equals_the_plain_search(sky_table, ra, dec, r):
    df, table = sky_table
    found, read = rows_read(cells.cone_search_by_cell(table, float(ra), float(dec), float(r)))
    assert found == sorted(x.id for x in cone_search(df, float(ra), float(dec), float(r)).collect())
    if r <= 3 and abs(dec) < 80:
        # a cap of a few zones opens a few of the 64 files
        assert read <= 20_205 * 12 / 64


def test_cell_predicates_reach_the_scan(sky_table):
    _, table = sky_table
    plan = cells.cone_search_by_cell(table, 120.0, 45.0, 0.5)._jdf.queryExecution().executedPlan().toString()
    assert "Equal(sky_cell," in plan.split("PushedFilters:")[1]


BASE = "k string, v int, modified string, part int"


def parts_of(spark, path):
    return {r.f: r.n for r in spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n")).collect()}


def test_upsert_rewrites_touched_ranges_only(spark):
    path = folder(spark)
    base = spark.createDataFrame([(f"k{i:04d}", i, "old", i // 100) for i in range(1000)], BASE)
    base.repartition("part").write.partitionBy("part").parquet(path)
    before = parts_of(spark, path)
    new = spark.createDataFrame([("k0201", 7, "x", 2), ("k0299", 299, "x", 2), ("k0250x", 9, "x", 2), ("k0555", None, "x", 5)], BASE)
    want = {(r.k, r.v, r.modified) for r in tables.upsert(base, new, "k", F.lit("now")).collect()}
    tables.upsert_ranges(path, new, "k", "part", base.schema, F.lit("now"))
    after = parts_of(spark, path)
    assert {(r.k, r.v, r.modified) for r in spark.read.parquet(path).collect()} == want and len(want) == 1001
    touched = lambda f: "part=2/" in f or "part=5/" in f
    assert {f for f in before if not touched(f)} == {f for f in after if not touched(f)} and not {f for f in after if touched(f)} & set(before)


def test_a_failed_rewrite_leaves_the_old_rows(spark):
    path = folder(spark)
    base = spark.createDataFrame([(f"k{i}", i, "old", i % 3) for i in range(30)], BASE)
    base.write.partitionBy("part").parquet(path)
    bad = base.withColumn("v", F.when(F.col("k") == "k7", F.raise_error(F.lit("broken")).cast("int")).otherwise(0))
    with pytest.raises(Exception, match="broken"):
        tables.rewrite_ranges(bad, path, "part")
    assert sorted((r.k, r.v) for r in spark.read.parquet(path).collect()) == sorted((f"k{i}", i) for i in range(30))


def test_photometry_ranges(spark):
    path = folder(spark)
    schema = "source_id string, image_id long, flux double, part int"
    old = spark.createDataFrame([("a", 1, 1.0, 1), ("a", 2, 2.0, 2), ("b", 1, 3.0, 1)], schema)
    old.write.partitionBy("part").parquet(path)
    untouched = {f for f in parts_of(spark, path) if "part=1/" in f}
    images, sources = spark.createDataFrame([(1,), (2,), (3,)], "id long"), spark.createDataFrame([("a",), ("b",)], "id string")
    new = spark.createDataFrame([("b", 2, 4.0, 2), ("b", 3, 5.0, 3), ("c", 3, 6.0, 3), ("a", 9, 7.0, 0)], schema)
    tables.merge_photometry_ranges(path, new, "part", old.schema, images, sources)
    assert sorted((r.source_id, r.image_id, r.flux) for r in spark.read.parquet(path).collect()) == [("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, 3.0), ("b", 2, 4.0), ("b", 3, 5.0)]
    assert untouched <= set(parts_of(spark, path))
    with pytest.raises(Exception, match="duplicate photometry of source b on image 2"):
        tables.merge_photometry_ranges(path, new.filter("image_id = 2"), "part", old.schema, images, sources)


@pytest.mark.parametrize("n", [0, 1, 5, 39, 40, 41, 100, 170, 171, 195, 200, 500])
def test_newest_rows_by_counting(spark, n):
    rng = random.Random(8)
    names = [f"ztf_{rng.choice(['20200101', '20200102', '20210305'])}{rng.randrange(3):06d}_000600_zg_c01_o_q{1 + i % 4}_sciimg.fits" for i in range(160)]
    names += [names[0]] * 10 + [f"other{i}" for i in range(25)]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(names)], "id long, basename string")
    got = ranking.newest_first_limit(rows, n)
    time = lambda x: (x[4:18] if x.startswith("ztf") else "", x)
    assert [r.basename for r in got.collect()] == sorted(names, key=time, reverse=True)[:n] and got.columns == rows.columns
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and ("Limit" not in plan or n == 0)
