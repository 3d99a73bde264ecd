"""The polling jobs as Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from skyloom import constants as K
from skyloom.operators.filters import cut_conditions, rb_cut
from skyloom.operators.sky import cone_join
from skyloom.plans.association import associate
from skyloom.session import store
from skyloom.streaming.state import CellState, SentIds, cells_around, fold_state, last_batch, newest_rows, state_rows

ALERT_SPAN = 1_000_000


def stream_ingest(new: DataFrame, event_time: str = "created_at", delay: str = "7 days", key: str = "basename") -> DataFrame:
    """Metadata rows with a program id, each name once within the delay."""
    rows = new.filter(F.col("ipac_gid") > 0)
    return rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def stream_filter(det: DataFrame) -> DataFrame:
    """The cuts that look at one row only."""
    for _, reject in cut_conditions(with_pixels=False):
        det = det.filter(~F.coalesce(reject, F.lit(False)))
    return rb_cut(det)


def stream_associate(det: DataFrame, sources: DataFrame, radius_deg: float = K.ASSOC_RADIUS_DEG) -> DataFrame:
    """S3: stream rows paired with every known source within the radius (stream-static join)."""
    known = sources.select(F.col("id").alias("source_id"), "ra", "dec")
    return cone_join(det, known, radius_deg, b_prefix="src_").withColumnRenamed("src_source_id", "matched_source")


def run_associate(
    det: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """S3: ``step`` (P1 on one micro-batch) for all data that is there now.

    A batch may be repeated after a failure: ``step`` gets the batch number and must
    write under it.
    """
    return (
        det.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def stream_source_state(det: DataFrame) -> DataFrame:
    """Per source: detections, summed score, position of the best detection, last time."""
    order = F.struct(F.try_divide("flux", "fluxerr"), -F.col("id"))
    return det.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rb").alias("sum_rb"),
        F.max(F.struct(order.alias("o"), "ra", "dec")).alias("_best"), F.max("mjd").alias("last_mjd"),
    ).select("source_id", "n", "sum_rb", F.col("_best.ra").alias("ra"), F.col("_best.dec").alias("dec"), "last_mjd")


def stream_stack_bins(images: DataFrame, event_time: str = "obsdate", delay: str = "7 days") -> DataFrame:
    """Images per key and left-open, right-closed 7-day bin; rows later than the delay are dropped.

    Windows are left-closed, so the time is moved back by a microsecond. Bins start
    on day 5 modulo 7 of the Unix era, as the first bin does.
    """
    moved = images.withColumn("_t", F.timestamp_add("MICROSECOND", F.lit(-1), F.col(event_time).cast("timestamp")))
    bins = F.window("_t", f"{K.STACK_DAYS} days", f"{K.STACK_DAYS} days", "5 days")
    return (
        moved.withWatermark("_t", delay).groupBy(*K.GROUP_KEY, bins.alias("w"))
        .agg(F.count(F.lit(1)).alias("size"))
        .select(*K.GROUP_KEY, F.col("w.start").alias("binleft"), F.col("w.end").alias("binright"), "size")
    )


def _run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that owns a checkpoint: the same after a restart, another one for a new checkpoint."""
    return spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def stream_alerts(
    alerts: DataFrame, out: str, checkpoint: str, build: Callable[[DataFrame], DataFrame] | None = None,
    span: int = ALERT_SPAN,
) -> StreamingQuery:
    """Every detection's alert once, across batches, restarts and new checkpoints.

    ``build`` makes packets (P6) of a batch's new rows; ``candid`` is their key. Packets lie
    under the stream's id and batch number, so a repeated batch replaces itself and a new
    checkpoint never touches what another one sent. The sent ids lie beside them by ranges of
    ``span`` ids: a batch looks only at the ranges its own ids fall in, and opens no packets.
    """
    def write(batch: DataFrame, number: int) -> None:
        spark, run = batch.sparkSession, _run_id(batch.sparkSession, checkpoint)
        part = F.floor(F.col("candid") / F.lit(span)).cast("long")
        rows = store(batch.dropDuplicates(["candid"]).withColumn("id_range", part))
        ranges = [r[0] for r in rows.select("id_range").distinct().collect()]  # as many as a batch's ids span
        sent = SentIds(spark, out)
        others = sent.others(ranges, run, number)
        if others is not None:
            rows = store(rows.join(others, "candid", "left_anti"))
        packets = rows.drop("id_range") if build is None else build(rows.drop("id_range"))
        packets.withColumn("id_range", part).write.mode("overwrite").partitionBy("id_range").parquet(f"{out}/run={run}/batch={number}")
        sent.add(rows, run, number)

    return alerts.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_associations(
    det: DataFrame, sources: DataFrame, out: str, checkpoint: str, lookback_days: int = 7, prefix: str = "N",
    radius_deg: float = K.ASSOC_RADIUS_DEG, close_days: int | None = None, **how
) -> StreamingQuery:
    """S3: P1 on every micro-batch, with sources and open detections carried on by sky cells.

    A batch's detections and those still open are matched with the sources as the batch
    before left them; what is left is clustered into new sources. A source carries the signal
    to noise and id of its best detection of all batches and moves only to a better one (those
    of the given sources may be in ``best_snr`` and ``best_id``).

    Only cells that a batch's detections reach, or that lie next to a source that changed in the
    batch before, can see a change: two detections that are both still open are not within
    reach of each other, else they would be a source. So only these cells are read and
    written anew. ``out`` gets ``detections`` (those with a source) by batch, ``sources`` and
    ``open`` by cell and batch, and an index of the newest versions; see ``associated_sources``
    and ``open_detections``. With ``close_days`` an open detection so much older than the newest
    one is closed when its cell is written, and goes to ``closed``. New sources are numbered on
    behind those of the given ones that begin with ``prefix``.
    """
    def step(batch: DataFrame, number: int) -> None:
        spark, run = batch.sparkSession, _run_id(batch.sparkSession, checkpoint)
        at = lambda kind: f"{out}/{kind}/run={run}/batch={number}"
        state = CellState(spark, out, run, number - 1, sources)
        batch = store(batch)
        touched = state.around(batch, radius_deg)
        known = store(state.known(touched, _source_schema(batch.schema, sources.schema)))
        todo = store(batch.unionByName(state.open(touched, batch.schema)))
        times = [t for t in (state.newest, batch.agg(F.max("created_at").cast("string")).first()[0]) if t]
        newest = max(times) if times else None
        taken = state.taken
        if taken is None:
            named = sources.filter(F.col("id").startswith(prefix))
            taken = named.agg(F.max(F.substring("id", len(prefix) + 1, 20).try_cast("long"))).first()[0] or 0
        found, after = associate(todo, known, newest or "1970-01-01", radius_deg=radius_deg, lookback_days=lookback_days, next_number=taken + 1, prefix=prefix, **how)
        found, after = store(found), store(after)
        found.filter("source_id is not null").write.mode("overwrite").parquet(at("detections"))
        left = found.filter("source_id is null")
        if close_days is not None:
            late = F.col("created_at") <= F.lit(newest or "1970-01-01").cast("timestamp_ntz") - F.make_dt_interval(F.lit(close_days))
            left.filter(late).write.mode("overwrite").parquet(at("closed"))
            left = left.filter(~F.coalesce(late, F.lit(False)))
        hit = after.join(found.select(F.col("source_id").alias("id")).distinct(), "id", "left_semi")
        made = after.filter("is_new").count()
        state.write(touched, after.drop("is_new"), left, cells_around(hit, radius_deg), newest, taken + made)

    return run_associate(det, step, checkpoint)


def _source_schema(det: T.StructType, sources: T.StructType) -> T.StructType:
    """Sources as the state keeps them."""
    return T.StructType([*[T.StructField(c, sources[c].dataType) for c in ("id", "ra", "dec")],
                         T.StructField("best_snr", T.DoubleType()), T.StructField("best_id", det["id"].dataType)])


def associated_sources(spark: SparkSession, out: str, sources: DataFrame, det: T.StructType, run: str | None = None) -> DataFrame:
    """S3: all sources after the last batch of ``stream_associations``; ``det`` is the schema of its detections."""
    run, number = last_batch(spark, out, run)
    return CellState(spark, out, run, number, sources).all("sources", _source_schema(det, sources.schema))


def open_detections(spark: SparkSession, out: str, det: T.StructType, run: str | None = None) -> DataFrame:
    """S3: the detections that are still without a source after the last batch."""
    run, number = last_batch(spark, out, run)
    return CellState(spark, out, run, number, spark.createDataFrame([], "id string, ra double, dec double")).all("open", det)


def stream_sessions(det: DataFrame, event_time: str = "created_at", gap: str = "30 minutes", delay: str = "1 day") -> DataFrame:
    """Visits of a source separated by at least ``gap``."""
    timed = det.withColumn("_t", F.col(event_time).cast("timestamp")).withWatermark("_t", delay)
    return (
        timed.groupBy("source_id", F.session_window("_t", gap).alias("w"))
        .agg(F.count(F.lit(1)).alias("n"), F.max("flux").alias("max_flux"))
        .select("source_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "max_flux")
    )


def run_updates(state: DataFrame, out: str, checkpoint: str, keys: list[str] | None = None, fold_every: int = 20) -> None:
    """Write the changed rows of an aggregated stream, each batch under the stream's id and its number.

    A repeated batch replaces itself; ``latest_state`` reads the newest row per key. With
    ``keys`` the finished batches are folded into a snapshot after every ``fold_every`` of
    them, so that a reader opens one snapshot and the batches behind it.
    """
    def write(batch: DataFrame, number: int) -> None:
        spark, run = batch.sparkSession, _run_id(batch.sparkSession, checkpoint)
        batch.write.mode("overwrite").parquet(f"{out}/run={run}/batch={number}")
        if keys and number and number % fold_every == 0:
            fold_state(spark, out, keys, run, number - 1)

    state.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start().awaitTermination()


def latest_state(spark: SparkSession, out: str, keys: list[str], run: str | None = None) -> DataFrame:
    """The state after the last batch; with several checkpoints behind ``out``, of the ``run`` given."""
    return newest_rows(state_rows(spark, out, run), keys).drop("run", "batch")


def run_to_end(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Write all data that is there now to Parquet files and return when it is done."""
    stream.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", checkpoint).option(
        "path", out
    ).trigger(availableNow=True).start().awaitTermination()
