"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import contextlib
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on; a cluster session keeps its own values for
# everything else (shuffle partitions, memory) and is never overridden here.
_REQUIRED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The 37-feature projection fuses into one generated method; past ~8000
    # bytecodes the JVM will not JIT-compile it and it runs interpreted (4-5x
    # slower, measured). At this limit Spark splits the stage instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # What a task holds of the rows that go to Python and back (rows here can be packed blocks).
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}

# Java's object streams hold on to the last 100 objects they wrote or read. Objects of a cached table are batches of rows, of 4 MB
# if there are rows enough, so each task that puts cached rows to disk or reads them there would hold 400 MB beside its memory limit.
CACHED_ROWS = 1_000     # rows of such a batch
BLOCK_BYTES = 512 << 10  # about the size of a packed block of rows, which is a batch by itself


@contextlib.contextmanager
def session_setting(spark: SparkSession, name: str, value: str):
    """The session has the setting inside the block only."""
    was = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, was)


def filled(df: DataFrame, rows: int = CACHED_ROWS) -> int:
    """Computes a table marked for caching, in batches of ``rows`` rows; their number."""
    with session_setting(df.sparkSession, "spark.sql.inMemoryColumnarStorage.batchSize", str(rows)):
        return df.count()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "patrolcast",
                  driver_memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")
    )
    for k, v in _REQUIRED.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make the package importable by Python workers (once per application).

    Batch maps and model closures reference this package's functions; workers do
    not see the driver's ``sys.path``, so the package is zipped and added with
    ``addPyFile`` (what ``--py-files`` does at submit time)."""
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    path = os.path.join(tempfile.mkdtemp(prefix="patrolcast-pyfiles-"), "patrolcast.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings the library needs to an existing session and ship the package."""
    for k, v in _REQUIRED.items():
        spark.conf.set(k, v)
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session (``spark.checkpoint.dir``).

    On a cluster this is set by the operator to a shared file system. Only when
    it is unset (local tests) is a fresh local folder created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if sc.master.startswith("local"):
            conf_dir = tempfile.mkdtemp(prefix="patrolcast-ckpt-")
        else:
            raise RuntimeError("spark.checkpoint.dir is not set; iterative fits need a shared checkpoint folder")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
