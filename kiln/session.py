"""Session helpers: a local session for tests/bench and checkpoint-dir resolution."""

from __future__ import annotations

import tempfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.storagelevel import StorageLevel


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "kiln", extra: dict | None = None) -> SparkSession:
    """A local session with the settings the library is tested with.

    AQE stays on (coalescing, skew-join splitting); the UI is off; the session
    zone is UTC so that day-of-log results are stable.
    """
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "8g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting it only when unset.

    Order: the SparkContext's directory, then ``spark.checkpoint.dir`` from the
    session conf.  Only a local-mode session (tests, bench) may fall back to a
    fresh temporary folder; on a cluster an unset directory is an error,
    because a machine-local folder would not survive the loss of an executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: the server owns the folder
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="kiln-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "iterative operators cut lineage with reliable checkpoints: set "
        "spark.checkpoint.dir to a shared (HDFS/object-store) folder")


#: what a loop that keeps each step in files of its own runs under: the shuffle files of a
#: step go when it is over, and not at some later collection of the driver's garbage
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the block; what was set before comes back after it."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@contextmanager
def persisted(*frames: DataFrame):
    """Cache ``frames`` (memory and disk) for the block; frames cached
    already are left as they are.  Use it around work that reads the same
    frame several times (several reports over one cleaned log, the fits of a
    rank search); results built inside must not be read lazily after the
    block unless recomputing them is acceptable."""
    fresh = [f for f in frames if not f.is_cached]
    for f in fresh:
        f.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield frames
    finally:
        for f in fresh:
            f.unpersist()
