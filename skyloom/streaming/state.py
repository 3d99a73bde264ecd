"""State of streams in files: versions per sky cell, folded snapshots, and sent ids.

Everything a batch writes lies under the stream's id (``run``) and the batch's number, so a
repeated batch replaces itself. What a batch reads is named by what its predecessor wrote
last: a batch that broke off leaves nothing that is read.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.functions.geometry import sky_cell
from skyloom.operators.sky import touched_cells
from skyloom.session import store

CELL_DEG = 5.0  # some 1,650 cells on the sky
INDEX = "cell long, version int, n_sources long, n_open long, moved boolean"
MARK = "newest string, taken long"


def written(spark: SparkSession, folder: str, schema: str) -> DataFrame | None:
    """What is under ``folder``, or None if nothing was written yet. Files are listed here, not opened."""
    try:
        return spark.read.schema(schema).option("basePath", folder).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def cell_of(ra: Column, dec: Column) -> Column:
    cell = sky_cell(ra, dec, CELL_DEG)
    return cell["zone"].cast("long") * 1_000_000 + cell["bucket"]


def cells_around(positions: DataFrame, radius_deg: float) -> DataFrame:
    """cell: all cells within ``radius_deg`` of the positions (ra, dec)."""
    caps = touched_cells(positions.select("ra", "dec"), "ra", "dec", radius_deg, CELL_DEG)
    return caps.select((F.col("_zone").cast("long") * 1_000_000 + F.col("_bucket")).alias("cell")).distinct()


class CellState:
    """Sources and open detections of one stream, one version per cell that a batch touched.

    The index of a batch names the newest version of every cell that any batch touched so far; it
    has at most one row per cell of the sky. Cells no batch touched are still in the given sources.
    """

    def __init__(self, spark: SparkSession, out: str, run: str, number: int, sources: DataFrame):
        self.spark, self.out, self.run, self.number, self.sources = spark, out, run, number, sources
        if number >= 0:
            self.index = spark.read.schema(INDEX).parquet(self._at("index", number))
            mark = spark.read.schema(MARK).parquet(self._at("mark", number)).first()
            self.newest, self.taken = mark.newest, mark.taken
        else:
            self.index, self.newest, self.taken = spark.createDataFrame([], INDEX), None, None

    def _at(self, kind: str, number: int) -> str:
        return f"{self.out}/{kind}/run={self.run}/batch={number}"

    def _read(self, kind: str, cells: list, schema: T.StructType) -> DataFrame:
        """Rows of the newest versions of ``cells``, rows of the index; only their folders are opened."""
        wanted: dict[int, list[int]] = {}
        for r in cells:
            if r.version is not None and r[f"n_{kind}"]:
                wanted.setdefault(r.version, []).append(r.cell)
        if not wanted:
            return self.spark.createDataFrame([], schema)
        # at most one row per cell of the sky; files of a batch lie in cell order, so the range skips most of the others
        newest = F.broadcast(self.spark.createDataFrame([(v, c) for v, held in wanted.items() for c in held], "batch int, cell long"))
        held = [c for group in wanted.values() for c in group]
        rows = self.spark.read.schema(T.StructType([*schema, T.StructField("cell", T.LongType())])).option(
            "basePath", f"{self.out}/{kind}/run={self.run}").parquet(*[self._at(kind, v) for v in sorted(wanted)])
        rows = rows.filter(F.col("cell").between(min(held), max(held)))
        return rows.join(newest, ["batch", "cell"], "left_semi").select(*schema.names)

    def around(self, batch: DataFrame, radius_deg: float) -> DataFrame:
        """Index rows of the cells that a batch touches, with those of open detections around sources that changed last."""
        changed = self.index.filter("moved and n_open > 0").select("cell")
        touched = cells_around(batch, radius_deg).unionByName(changed).distinct()
        return store(touched.join(self.index, "cell", "left"))

    def known(self, touched: DataFrame, schema: T.StructType) -> DataFrame:
        """Sources in the touched cells."""
        cells = touched.collect()  # at most one row per cell of the sky
        fresh = touched.filter("version is null").select(F.col("cell").alias("_cell"))
        first = self.sources.join(fresh, cell_of(F.col("ra"), F.col("dec")) == F.col("_cell"), "left_semi")
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name not in first.columns]
        return first.select("*", *missing).select(*schema.names).unionByName(self._read("sources", cells, schema))

    def open(self, touched: DataFrame, schema: T.StructType) -> DataFrame:
        return self._read("open", touched.collect(), schema)

    def all(self, kind: str, schema: T.StructType) -> DataFrame:
        """The newest version of every cell; for sources with the given ones of the cells no batch touched."""
        cells = self.index.collect()
        rows = self._read(kind, cells, schema)
        if kind != "sources":
            return rows
        seen = self.index.filter("version is not null").select(F.col("cell").alias("_cell"))
        rest = self.sources.join(seen, cell_of(F.col("ra"), F.col("dec")) == F.col("_cell"), "left_anti")
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name not in rest.columns]
        return rows.unionByName(rest.select("*", *missing).select(*schema.names))

    def write(self, touched: DataFrame, sources: DataFrame, open_rows: DataFrame, changed: DataFrame, newest: str | None, taken: int) -> None:
        """The next version of the touched cells. ``changed``: cells next to sources that may have moved."""
        number, counts = self.number + 1, []
        for kind, rows in (("sources", sources), ("open", open_rows)):
            rows = store(rows.withColumn("cell", cell_of(F.col("ra"), F.col("dec"))))
            # a few files in cell order, whatever the number of cells; a crowded cell spans several
            rows.repartitionByRange("cell", "id").sortWithinPartitions("cell").write.mode("overwrite").parquet(self._at(kind, number))
            counts.append(rows.groupBy("cell").agg(F.count(F.lit(1)).alias(f"n_{kind}")))
        fresh = touched.select("cell", F.lit(number).alias("version")).join(counts[0], "cell", "left").join(counts[1], "cell", "left")
        kept = self.index.select("cell", "version", "n_sources", "n_open").join(touched.select("cell"), "cell", "left_anti")
        moved = changed.select("cell", F.lit(True).alias("moved"))
        index = kept.unionByName(fresh).join(moved, "cell", "full").withColumn("moved", F.coalesce("moved", F.lit(False)))
        index.select("cell", "version", "n_sources", "n_open", "moved").write.mode("overwrite").parquet(self._at("index", number))
        # written last: it makes the batch a predecessor
        self.spark.createDataFrame([(newest, taken)], MARK).write.mode("overwrite").parquet(self._at("mark", number))


def last_batch(spark: SparkSession, out: str, run: str | None = None) -> tuple[str, int]:
    """(run, number) of the newest finished batch; with several runs behind ``out`` name one."""
    found = [re.search(r"run=([^/]+)/batch=(\d+)", f).groups() for f in spark.read.parquet(f"{out}/mark").inputFiles()]
    found = [(r, int(n)) for r, n in found if run in (None, r)]
    if len({r for r, _ in found}) != 1:
        raise ValueError(f"{len({r for r, _ in found})} streams wrote to {out}: name one")
    return max(found)


def fold_state(spark: SparkSession, out: str, keys: list[str], run: str, upto: int) -> None:
    """Fold the rows of all batches up to ``upto`` into one snapshot of the newest row per key.

    The snapshot counts from the moment its number stands in the log, which is written last;
    what breaks off before is not read, and the batches themselves stay.
    """
    rows = state_rows(spark, out, run).filter(F.col("batch") <= upto)
    folder = f"{out}-snapshots/run={run}/upto={upto}"
    newest_rows(rows, keys).write.mode("overwrite").parquet(folder)
    spark.createDataFrame([(run, upto)], "run string, upto int").write.mode("overwrite").parquet(f"{out}-snapshots/log/{run}-{upto}")


def _snapshots(spark: SparkSession, out: str) -> dict[str, int]:
    """The newest logged snapshot of each run."""
    try:
        log = spark.read.parquet(f"{out}-snapshots/log/*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {r.run: r.upto for r in log.groupBy("run").agg(F.max("upto").alias("upto")).collect()}


def newest_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of each key the row of the highest batch."""
    values = [n for n in rows.columns if n not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_s")).select(*keys, "_s.*")


def state_rows(spark: SparkSession, out: str, run: str | None = None) -> DataFrame:
    """The newest snapshot of each run and the batches after it, with ``run`` and ``batch``."""
    rows = spark.read.option("basePath", out).parquet(out)
    rows = rows if run is None else rows.filter(F.col("run") == run)
    for name, upto in _snapshots(spark, out).items():
        if run in (None, name):
            rows = rows.filter((F.col("run") != name) | (F.col("batch") > upto))
    parts = [spark.read.parquet(f"{out}-snapshots/run={name}/upto={upto}") for name, upto in _snapshots(spark, out).items() if run in (None, name)]
    for part in parts:
        rows = rows.unionByName(part.select(*[F.col(f.name).cast(f.dataType) for f in rows.schema]))
    return rows


class SentIds:
    """The ids that streams have sent, apart from the packets and by ranges of ids.

    Packets are written first, then their ids. Where a run broke off in between, the folder
    of packets without ids is the only one that is read for its ids.
    """

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out, self.folder = spark, out, f"{out}-ids"

    @staticmethod
    def _batches(df: DataFrame | None) -> set[tuple[str, str]]:
        found = [re.search(r"run=([^/]+)/batch=(\d+)", f) for f in (df.inputFiles() if df is not None else [])]
        return {m.groups() for m in found if m}

    def others(self, ranges: list[int], run: str, number: int) -> DataFrame | None:
        """candid: ids in ``ranges`` that other batches have sent; names of files are listed, packets not opened."""
        ids, packets = (written(self.spark, folder, "candid long") for folder in (self.folder, self.out))
        other = (F.col("run") != run) | (F.col("batch") != number)
        found = [] if ids is None else [ids.filter(F.col("id_range").isin(ranges) & other).select("candid")]
        for r, n in sorted(self._batches(packets) - self._batches(ids) - {(run, str(number))}):
            found.append(self.spark.read.schema("candid long").parquet(f"{self.out}/run={r}/batch={n}").select("candid"))
        out = None
        for part in found:
            out = part if out is None else out.unionByName(part)
        return out

    def add(self, ids: DataFrame, run: str, number: int) -> None:
        ids.select("candid", "id_range").write.mode("overwrite").partitionBy("id_range").parquet(f"{self.folder}/run={run}/batch={number}")
