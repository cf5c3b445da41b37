"""Session helpers: one place that builds a SparkSession and resolves the
shared folder used to cut lineage (checkpoints, derived tables)."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "lodestar",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Session for the library's jobs; AQE on, so partition counts, join
    strategies and skewed partitions are re-planned at run time.  Master,
    shuffle partitions and driver memory are set only where the caller asks;
    else what spark-submit was given stands (``local[*]`` if nothing was)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if os.environ.get("LODESTAR_DRIVER_MEM"):
        builder = builder.config("spark.driver.memory", os.environ["LODESTAR_DRIVER_MEM"])
    log_dir = os.environ.get("LODESTAR_EVENT_LOG_DIR")
    if log_dir:  # opt-in: per-task metrics for offline analysis (no UI/server)
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_made: list[tuple[SparkSession, str]] = []
_tables: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _root(spark: SparkSession) -> str:
    """The shared checkpoint folder.  ``spark.checkpoint.dir`` names one that
    every executor can reach; only a local master, whose executors share the
    driver's disk, may do without and gets a private temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    return _private_root(spark.sparkContext.master)


def _private_root(master: str) -> str:
    if not master.startswith("local[") and master != "local":
        raise RuntimeError(f"master {master}: set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="lodestar-ckpt-")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared checkpoint folder; it is removed when
    the driver ends."""
    ensure_checkpoint_dir(spark)
    path = f"{_root(spark)}/lodestar/{purpose}-{uuid.uuid4().hex[:12]}"
    if not _made:
        atexit.register(_drop_all)
    _made.append((spark, path))
    return path


def materialize(df: DataFrame, purpose: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back: the
    lineage is cut, a lost executor costs no recomputation, and unlike
    ``checkpoint()`` the plan runs once.  The shuffle files of the write have no
    further reader and are removed with its end; the folder is removed by
    ``release`` or when the driver ends.  ``codec`` is the files' compression
    (the session's, if none is given): ``zstd`` for wide tables of text."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        (df.write.option("compression", codec) if codec else df.write).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    _tables[table] = path
    return table


def release(*tables: DataFrame) -> None:
    """Remove the files of ``materialize``d tables that nothing reads again."""
    for table in tables:
        path = _tables.pop(table, None)
        if path is not None:
            _drop(table.sparkSession, path)
            _made[:] = [(spark, other) for spark, other in _made if other != path]


def _drop(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def _drop_all() -> None:
    for spark, path in _made:
        if spark.sparkContext._jsc is not None:
            _drop(spark, path)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable: reuse the configured folder,
    set one only where none is configured."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(_root(spark))
