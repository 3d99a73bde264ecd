"""Wanted ids against lists of found ones: one grouping, no join per list."""

from skyloom.operators import tables


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id long")


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_remaining_ids_take_one_grouping(spark):
    wanted, tape, http = ids(spark, 1, 2, 2, 3, None, 4), ids(spark, 2, 2, 9, None), ids(spark, 4, 2)
    out = tables.remaining_ids(wanted, tape, http)
    assert sorted(out.collect(), key=str) == sorted([(1,), (3,), (None,)], key=str)
    assert "Join" not in plan_of(out)
    assert sorted(tables.remaining_ids(ids(spark, 1, 1, 2)).collect()) == [(1,), (2,)]


def test_locate_takes_one_grouping(spark):
    out = tables.locate(ids(spark, 1, 2, 2, 3, None, 4), ids(spark, 2, 9, None), ids(spark, 4, 4, 2))
    assert {(r.id, r.location) for r in out.collect()} == {(1, "remote"), (2, "tape"), (3, "remote"), (None, "remote"), (4, "http")}
    assert out.count() == 5 and "Join" not in plan_of(out)


def test_retrieval_takes_the_job_along(spark):
    from skyloom.plans import planning

    files = spark.range(1, 7).selectExpr("id", "1 AS fid")
    tape = spark.createDataFrame([(1, "/a", "m"), (1, "/b", "m"), (2, "/b", "m"), (3, "/none", "m"), (4, "/a", "m")],
                                 "product_id long, archive_id string, member_name string")
    http = spark.createDataFrame([(4,), (5,)], "product_id long")
    archives = spark.createDataFrame([("/a", "T2", "1"), ("/b", "T1", "1")], "path string, tape string, position string")
    got = {tuple(r) for r in planning.plan_retrieval(files.select("id"), files, tape, http, archives, 14).collect()}
    assert got == {(1, "tape", 0), (2, "tape", 0), (3, "tape", None), (4, "http", None), (5, "http", None), (6, "remote", None)}
    found = tables.locate(ids(spark, 1, 2), spark.createDataFrame([(1, 5), (1, 3)], "id long, job int"), ids(spark), carry=["job"])
    assert {tuple(r) for r in found.collect()} == {(1, "tape", 3), (2, "remote", None)} and "Join" not in plan_of(found)
