"""The state of a stream is a few files, whatever the number of cells."""

import datetime as dt
import glob

from pyspark.sql import functions as F

from skyloom.streaming import jobs as T
from test_streams import ASSOC, feed, folder


def test_a_batch_writes_few_files_for_many_cells(spark):
    root = folder()
    rows = [(i, (i * 7.3) % 360, (i * 1.7) % 150 - 75, 10.0, 1.0, 0.9, None, dt.datetime(2020, 1, 10), None) for i in range(200)]
    sources = spark.createDataFrame([(f"S{k}", (k * 7.3) % 360, (k * 1.7) % 150 - 75) for k in range(100)], "id string, ra double, dec double")
    feed(spark, root, rows, ASSOC, lambda s: T.stream_associations(s, sources, f"{root}/out", f"{root}/check").awaitTermination())
    for kind in ("sources", "open"):
        written = spark.read.parquet(f"{root}/out/{kind}")
        assert written.select("cell").distinct().count() > 60
        assert len(glob.glob(f"{root}/out/{kind}/**/*.parquet", recursive=True)) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = spark.createDataFrame([], ASSOC).schema
    assert T.associated_sources(spark, f"{root}/out", sources, schema).count() == 100
    assert T.open_detections(spark, f"{root}/out", schema).select(F.min("id"), F.count("id")).first() == (100, 100)
