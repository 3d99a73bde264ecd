"""Session settings and the shared folder for stored intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Runtime SQL settings the operators count on; all of them can be changed on a live session.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key even when the split costs one more exchange further down
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # the JVM never compiles a method of more bytes: wide projections are generated in parts instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "skyloom", cores: int | str = "*", memory: str = "8g", **conf) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", os.environ.get("SKYLOOM_SHUFFLE", "8"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


_SHIPPED: set[str] = set()
ARROW_ROWS = 2000  # whole texts go to Python: smaller batches than for numbers
ARROW_BYTES = 4 << 20


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application, and size their batches for texts.

    Nothing is sent where the workers' ``PYTHONPATH`` already has the package.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    root = Path(__file__).resolve().parents[1]
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    archive = Path(tempfile.mkdtemp(prefix="skyloom-ship-")) / "skyloom_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted((root / "skyloom").rglob("*.py")):
            out.write(file, file.relative_to(root))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A private temporary folder is used only on a local master, where driver and
    executors share one disk; on a cluster a missing setting is an error.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="skyloom-", dir="/tmp"))
    return spark.sparkContext.getCheckpointDir()


def store(df: DataFrame) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back.

    Cuts the lineage like a reliable checkpoint, but computes the frame once and
    keeps it columnar, so later readers prune columns. Survives lost executors.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
