"""Session construction and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Settings every job wants regardless of cluster size. Shuffle partition count is left
# to the cluster (or ``shuffle_partitions``); AQE coalesces small ones at run time.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    # Jobs that run at once (the datasets of an ingest) share the executors.
    "spark.scheduler.mode": "FAIR",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Window-group-limit pushes the partial top-k of the slot ranking below the shuffle.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    # Calendar columns are computed on timestamp_ntz and do not depend on this, but
    # any cast of a zoned timestamp to text does.
    "spark.sql.session.timeZone": "UTC",
    # A join may reuse a clustering on some of its keys (e.g. rows already clustered by
    # (crash, date) join on (crash, unit, date) in place). Every such clustering here
    # leads with the crash id, and crashes too large for one task are routed to the
    # skew-proof plans, so the shuffles saved cannot create a straggler.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.ui.enabled": "false",
    # PySpark records the Python call site of every Column / DataFrame call for error
    # messages: an inspection of the Python stack and extra JVM round trips per call,
    # which made planning a pipeline take ~2 s. Errors still name the failing expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Extra settings for cluster runs (no master given: spark-submit decides). Shuffles start
# wide and AQE merges partitions up to the advisory size, so partitions stay small
# enough for executor memory at any input size; scans split files at 256 MB.
_CLUSTER_DEFAULTS = {
    "spark.sql.shuffle.partitions": "4096",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def build_session(
    app_name: str = "wreckline",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    ``master`` is only set when given: on a cluster ``spark-submit`` decides it, and the
    cluster defaults apply. A setting already given to ``spark-submit --conf`` wins over
    every default here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    given = SparkConf()
    defaults = dict(_DEFAULTS)
    if not master:
        defaults.update(_CLUSTER_DEFAULTS)
    for key, value in defaults.items():
        if not given.contains(key):
            builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """The session's checkpoint folder; ``fallback`` is registered only when the session
    names none (local runs and tests), never over a cluster's ``spark.checkpoint.dir``."""
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if given:
        return given
    spark.sparkContext.setCheckpointDir(fallback)
    return spark.sparkContext.getCheckpointDir() or fallback


def shared_dir(spark: SparkSession, name: str | None = None) -> str:
    """A path for fresh data under the cluster's shared checkpoint location.

    The location is read from ``spark.checkpoint.dir``. Only when the session has none
    (local runs and tests) a private temporary folder is created and registered as the
    checkpoint directory, so ``DataFrame.checkpoint()`` works too.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster job needs a shared folder for staged data"
            )
        base = ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="wreckline-"))
    own = os.path.join(base.rstrip("/"), f"wreckline-{spark.sparkContext.applicationId}")
    _remove_at_exit(spark, own)
    return os.path.join(own, f"{name or 'stage'}-{uuid.uuid4().hex[:12]}")


def file_system(spark: SparkSession, path: str) -> tuple:
    """(Hadoop file system, Hadoop path) of a location, as the driver sees them."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    """Staged data is the session's own: its one folder goes when the driver's JVM ends."""
    store, where = file_system(spark, path)
    store.mkdirs(where)  # only what exists can be marked
    store.deleteOnExit(where)


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` has been completed."""
    store, where = file_system(spark, os.path.join(path, "_SUCCESS"))
    return store.exists(where)


_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Per session: the writes that run now, and the setting that was there before the first.
_FREEING: WeakKeyDictionary[SparkSession, list] = WeakKeyDictionary()
_FREEING_LOCK = threading.Lock()


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written within go as soon as it is written.

    Otherwise they stay until the driver happens to collect its garbage, so that a run of several
    steps holds the shuffles of all of them at once. The session's own setting is put back after
    the last of the writes that run at the same time.
    """
    with _FREEING_LOCK:
        running = _FREEING.setdefault(spark, [0, None])
        if running[0] == 0:
            running[1] = spark.conf.get(_SHUFFLES_GO, None)
            spark.conf.set(_SHUFFLES_GO, "true")
        running[0] += 1
    try:
        yield
    finally:
        with _FREEING_LOCK:
            running[0] -= 1
            if running[0] == 0:
                if running[1] is None:
                    spark.conf.unset(_SHUFFLES_GO)
                else:
                    spark.conf.set(_SHUFFLES_GO, running[1])
