"""Streaming behaviour that the batch comparison does not show."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from skyloom.plans.association import associate
from skyloom.streaming import jobs as T


def folder():
    return tempfile.mkdtemp(prefix="skyloom-stream-", dir="/tmp")


def feed(spark, root, rows, schema, run):
    df = spark.createDataFrame(rows, schema)
    df.write.mode("append").parquet(f"{root}/in")
    run(spark.readStream.schema(df.schema).parquet(f"{root}/in"))


def test_late_images_are_dropped(spark):
    """Bins close a week after their end; an image that comes later than that is not counted."""
    root = folder()
    day = lambda n: dt.datetime(2017, 1, 3) + dt.timedelta(days=n)
    schema = "id long, field int, ccdid int, qid int, fid int, obsdate timestamp_ntz"
    image = lambda i, n: (i, 1, 1, 1, 1, day(n))

    def run(stream):
        T.run_to_end(T.stream_stack_bins(stream), f"{root}/out", f"{root}/check")

    feed(spark, root, [image(1, 1), image(2, 7), image(3, 8), image(4, 30)], schema, run)
    feed(spark, root, [image(5, 2), image(6, 29), image(7, 60)], schema, run)
    got = {r.binleft.date(): r["size"] for r in spark.read.parquet(f"{root}/out").select(F.col("binleft").cast("timestamp_ntz"), "size").collect()}
    assert got == {day(0).date(): 2, day(7).date(): 1, day(28).date(): 2}


def test_alerts_go_out_once_across_restarts(spark):
    root = folder()

    def run(stream):
        T.stream_alerts(stream, f"{root}/out", f"{root}/check").awaitTermination()

    feed(spark, root, [(1, "a"), (2, "b"), (1, "a")], "candid long, objectId string", run)
    feed(spark, root, [(2, "b"), (3, "c")], "candid long, objectId string", run)
    assert sorted(r.candid for r in spark.read.parquet(f"{root}/out").collect()) == [1, 2, 3]


def test_a_new_checkpoint_loses_and_repeats_no_alert(spark):
    root = folder()

    def run(check):
        return lambda stream: T.stream_alerts(stream, f"{root}/out", f"{root}/{check}", build=lambda b: b.withColumn("packet", F.upper("objectId")), span=10).awaitTermination()

    schema = "candid long, objectId string"
    feed(spark, root, [(1, "a"), (25, "b")], schema, run("first"))
    feed(spark, root, [(3, "c"), (4_000_000_000, "d")], schema, run("second"))  # reads all files again
    feed(spark, root, [(3, "c"), (5, "e")], schema, run("first"))
    rows = spark.read.parquet(f"{root}/out").collect()
    assert sorted((r.candid, r.packet) for r in rows) == [(1, "A"), (3, "C"), (5, "E"), (25, "B"), (4_000_000_000, "D")]
    assert len({r.run for r in rows}) == 2


ASSOC = "id long, ra double, dec double, flux double, fluxerr double, rb double, source_id string, created_at timestamp_ntz, triggers_alert boolean"


def test_batches_associate_as_one(spark):
    """Sources and open detections carried over two batches give what one run over all rows gives."""
    root = folder()
    now = dt.datetime(2020, 1, 10)
    arc = 1 / 3600
    det = lambda i, ra, rb=0.9: (i, ra, 5.0, 10.0 + i, 1.0, rb, None, now, None)
    first = [det(1, 10.0), det(2, 50.0), det(3, 50.0 + 0.5 * arc), det(4, 80.0), det(5, 120.0, 0.1)]
    second = [det(6, 10.0 + 0.5 * arc), det(7, 50.0 + 0.2 * arc), det(8, 80.0 + 0.3 * arc), det(9, 200.0)]
    sources = spark.createDataFrame([("S1", 10.0, 5.0)], "id string, ra double, dec double")

    def run(stream):
        T.stream_associations(stream, sources, f"{root}/out", f"{root}/check").awaitTermination()

    feed(spark, root, first, ASSOC, run)
    feed(spark, root, second, ASSOC, run)
    got = {r.id: r.source_id for r in spark.read.parquet(f"{root}/out/detections").collect()}
    whole, state = associate(spark.createDataFrame(first + second, ASSOC), sources, str(now))
    want = {r.id: r.source_id for r in whole.collect() if r.source_id}
    assert got == want and got[1] == got[6] == "S1" and got[2] == got[3] == got[7] and got[4] == got[8]
    schema = whole.schema
    last = T.associated_sources(spark, f"{root}/out", sources, schema).collect()
    assert sorted((r.id, round(r.ra, 6)) for r in last) == sorted((r.id, round(r.ra, 6)) for r in state.collect())
    left = T.open_detections(spark, f"{root}/out", schema).collect()
    assert sorted(r.id for r in left) == [5, 9]


def test_fainter_detections_move_no_source(spark):
    """Known and new sources stay at the best detection of all batches, and later ones are matched there."""
    root = folder()
    now = dt.datetime(2020, 1, 10)
    arc = 1 / 3600
    det = lambda i, ra, flux: (i, ra, 5.0, flux, 1.0, 0.9, None, now, None)
    batches = [
        [det(11, 10.0, 90.0), det(12, 50.0, 80.0), det(13, 50.0 + 0.5 * arc, 30.0), det(14, 90.0, 40.0)],
        [det(21, 10.0 + 1.5 * arc, 20.0), det(22, 50.0 + 1.5 * arc, 20.0), det(4, 90.0 + 0.5 * arc, 40.0)],  # equal: the lower id
        [det(31, 10.0 - 1.5 * arc, 10.0), det(32, 50.0 - 1.5 * arc, 10.0)],
    ]
    sources = spark.createDataFrame([("S1", 10.0, 5.0), ("S2", 90.0, 5.0), ("S3", 130.0, 5.0)], "id string, ra double, dec double")
    for rows in batches:
        feed(spark, root, rows, ASSOC, lambda s: T.stream_associations(s, sources, f"{root}/out", f"{root}/check").awaitTermination())
    whole, state = associate(spark.createDataFrame(sum(batches, []), ASSOC), sources, str(now))
    got = {r.id: r.source_id for r in spark.read.parquet(f"{root}/out/detections").collect()}
    assert got[11] == got[21] == got[31] == "S1" and got[12] == got[13] == got[22] == got[32] == "N00000001"
    assert got == {r.id: r.source_id for r in whole.collect()}
    last = T.associated_sources(spark, f"{root}/out", sources, whole.schema).collect()
    best = {r.id: (round(r.ra, 6), r.best_id) for r in last}
    assert best == {"S1": (10.0, 11), "S2": (round(90.0 + 0.5 * arc, 6), 4), "S3": (130.0, None), "N00000001": (50.0, 12)}
    assert {r.id: round(r.ra, 6) for r in state.collect()} == {k: v[0] for k, v in best.items()}


def test_state_keeps_the_newest_value(spark):
    root = folder()
    schema = "id long, source_id string, rb double, ra double, dec double, flux double, fluxerr double, mjd double"

    def run(stream):
        T.run_updates(T.stream_source_state(stream), f"{root}/out", f"{root}/check")

    feed(spark, root, [(1, "s", 0.5, 1.0, 1.0, 9.0, 1.0, 10.0), (2, "t", 0.5, 2.0, 2.0, 9.0, 1.0, 10.0)], schema, run)
    feed(spark, root, [(3, "s", 0.25, 3.0, 3.0, 20.0, 1.0, 9.0)], schema, run)
    got = {r.source_id: (r.n, r.sum_rb, r.ra, r.last_mjd) for r in T.latest_state(spark, f"{root}/out", ["source_id"]).collect()}
    assert got == {"s": (2, 0.75, 3.0, 10.0), "t": (1, 0.5, 2.0, 10.0)}


def test_a_batch_writes_its_own_cells_only(spark):
    """Few rows are written for a batch of one detection beside many sources; a repeated batch changes nothing."""
    root = folder()
    now = dt.datetime(2020, 1, 10)
    arc = 1 / 3600
    det = lambda i, ra, dec, flux=10.0, when=now: (i, ra, dec, flux, 1.0, 0.9, None, when, None)
    sources = spark.createDataFrame([(f"S{k}", (k * 7.3) % 360, (k * 1.7) % 150 - 75) for k in range(3000)], "id string, ra double, dec double")
    batches = [[det(i, (i * 7.3) % 360, (i * 1.7) % 150 - 75 + 0.3 * arc) for i in range(40)] + [det(100 + i, 200.0 + i, 80.0) for i in range(30)],
               [det(500, 7.3, 1.7 - 75 + 0.6 * arc, 90.0)], [det(501, 200.0, 80.0 + 0.5 * arc), det(502, 7.3, 1.7 - 75 + 2.2 * arc)], [det(503, 300.0, -80.0)]]
    run = lambda s: T.stream_associations(s, sources, f"{root}/out", f"{root}/check").awaitTermination()
    for rows in batches:
        feed(spark, root, rows, ASSOC, run)
    by_batch = {r.batch: r.n for r in spark.read.parquet(f"{root}/out/sources").groupBy("batch").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert by_batch[1] < 30 and by_batch[2] < 30 and by_batch.get(3, 0) < 30
    schema = spark.createDataFrame([], ASSOC).schema
    state = {r.id: (round(r.dec, 6), r.best_id) for r in T.associated_sources(spark, f"{root}/out", sources, schema).collect()}
    assert len(state) == 3001 and state["S1"] == (round(1.7 - 75 + 0.6 * arc, 6), 500) and state["S2999"][1] is None
    got = {r.id: r.source_id for r in spark.read.parquet(f"{root}/out/detections").collect()}
    # the source has moved to the brighter detection of the batch before, which brings the last one within reach
    assert got[502] == "S1" and got[100] == got[501] == "N00000001"
    assert sorted(r.id for r in T.open_detections(spark, f"{root}/out", schema).collect()) == [*range(101, 130), 503]
    # the last batch breaks off before it is committed and is repeated
    import os

    last = max(int(f) for f in os.listdir(f"{root}/check/commits") if f.isdigit())
    os.replace(f"{root}/check/commits/{last}", f"{root}/broken-off")
    crc = f"{root}/check/commits/.{last}.crc"
    if os.path.exists(crc):
        os.replace(crc, f"{root}/broken-off.crc")
    run(spark.readStream.schema(schema).parquet(f"{root}/in"))
    again = {r.id: (round(r.dec, 6), r.best_id) for r in T.associated_sources(spark, f"{root}/out", sources, schema).collect()}
    assert again == state and got == {r.id: r.source_id for r in spark.read.parquet(f"{root}/out/detections").collect()}


def test_open_detections_close(spark):
    root = folder()
    day = lambda n: dt.datetime(2020, 1, 1) + dt.timedelta(days=n)
    det = lambda i, ra, n: (i, ra, 5.0, 10.0, 1.0, 0.9, None, day(n), None)
    sources = spark.createDataFrame([("S1", 10.0, 5.0)], "id string, ra double, dec double")
    for rows in ([det(1, 50.0, 0), det(2, 51.0, 9)], [det(3, 50.001, 20), det(4, 51.0 + 0.5 / 3600, 20)]):
        feed(spark, root, rows, ASSOC, lambda s: T.stream_associations(s, sources, f"{root}/out", f"{root}/check", close_days=15).awaitTermination())
    assert [r.id for r in T.open_detections(spark, f"{root}/out", spark.createDataFrame([], ASSOC).schema).collect()] == [3]
    assert [r.id for r in spark.read.parquet(f"{root}/out/closed").collect()] == [1]
    assert sorted(r.id for r in spark.read.parquet(f"{root}/out/detections").collect()) == [2, 4]


def test_folded_state_equals_the_batches(spark):
    from skyloom.streaming import state as S

    root = folder()
    out = f"{root}/out"
    for n in range(6):
        spark.createDataFrame([(k, n * 10 + k) for k in range(n, n + 3)], "k int, v int").write.parquet(f"{out}/run=a/batch={n}")
    want = {r.k: r.v for r in T.latest_state(spark, out, ["k"]).collect()}
    assert want == {0: 0, 1: 11, 2: 22, 3: 33, 4: 44, 5: 55, 6: 56, 7: 57}
    # a snapshot without its entry in the log is one that broke off
    spark.createDataFrame([(0, -1, 5, "a")], "k int, v int, batch int, run string").write.parquet(f"{out}-snapshots/run=a/upto=5")
    assert {r.k: r.v for r in T.latest_state(spark, out, ["k"]).collect()} == want
    for upto in (2, 4, 4):
        S.fold_state(spark, out, ["k"], "a", upto)
        assert {r.k: r.v for r in T.latest_state(spark, out, ["k"]).collect()} == want
    files = S.state_rows(spark, out)._jdf.queryExecution().executedPlan().toString()
    assert "upto=4" in files and "upto=2" not in files
    spark.createDataFrame([(9, 99)], "k int, v int").write.parquet(f"{out}/run=a/batch=6")
    assert {r.k: r.v for r in T.latest_state(spark, out, ["k"], "a").collect()} == want | {9: 99}


def test_repeats_are_refused_without_opening_packets(spark, monkeypatch):
    root = folder()
    run = lambda check: (lambda stream: T.stream_alerts(stream, f"{root}/out", f"{root}/{check}", span=10).awaitTermination())
    schema = "candid long, objectId string"
    feed(spark, root, [(1, "a"), (25, "b")], schema, run("first"))
    # packets that cannot be read any more: only their ids are
    for file in __import__("glob").glob(f"{root}/out/run=*/batch=*/id_range=*/*.parquet"):
        open(file, "r+b").truncate(0)
    feed(spark, root, [(1, "a"), (26, "c")], schema, run("second"))
    sent = spark.read.parquet(f"{root}/out-ids").collect()
    assert sorted(r.candid for r in sent) == [1, 25, 26]


def test_packets_without_ids_still_count(spark):
    """A run that broke off between its packets and their ids sends nothing twice."""
    root = folder()
    schema = "candid long, objectId string"
    spark.createDataFrame([(7, "x", 0)], f"{schema}, id_range long").write.partitionBy("id_range").parquet(f"{root}/out/run=old/batch=3")
    feed(spark, root, [(7, "x"), (8, "y")], schema, lambda s: T.stream_alerts(s, f"{root}/out", f"{root}/check", span=10).awaitTermination())
    assert sorted(r.candid for r in spark.read.parquet(f"{root}/out").collect()) == [7, 8]
