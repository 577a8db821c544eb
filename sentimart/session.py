"""Session construction and the shared work folder.

Library code never builds its own session: every operator takes a
DataFrame (or a session handed in by the caller).  ``build_session`` is
for tests, the benchmark and local runs only.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "sentimart", driver_memory: str = "8g",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Local/test session with the settings the library is tuned for.

    On a cluster the same keys belong in the job's spark-defaults;
    ``spark.sql.shuffle.partitions`` should then be sized so one shuffle
    partition is ~128-256 MB (e.g. 100 TB / 200 MB ~ 500k is too many for
    one stage: let AQE coalesce from an upper bound instead).
    """
    master = master or os.environ.get("SPARK_MASTER", "local[8]")
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.sql.python.filterPushdown.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", driver_memory))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, for materialised tables.

    Taken from the session's checkpoint directory (``spark.checkpoint.dir``
    or ``SparkContext.setCheckpointDir``).  Only when nothing is set, as in
    local tests, a private temporary folder is created and registered as
    the checkpoint directory, so ``DataFrame.checkpoint()`` works too.
    """
    sc = _context(spark)
    if sc is None:  # Spark Connect: only the session conf is visible
        d = spark.conf.get("spark.checkpoint.dir", None)
        return (d or _local_folder(spark, spark.conf.get("spark.master", ""))).rstrip("/")
    d = sc.getCheckpointDir()
    if d:
        return d.rstrip("/")
    d = sc.getConf().get("spark.checkpoint.dir", None)
    sc.setCheckpointDir(d or _local_folder(spark, sc.master))
    return sc.getCheckpointDir().rstrip("/")


def _local_folder(spark: SparkSession, master: str) -> str:
    """A private folder for runs in one process; on a cluster the executors
    would not share it."""
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="sentimart-ckpt-")


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no context
        return None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-folder of :func:`shared_dir`."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def open_files(spark: SparkSession, most: int) -> Iterator[None]:
    """Writes below it that route rows to folders keep up to ``most`` files
    open in a task and write rows as they come.  Spark otherwise sorts a
    task's rows by their folder first, and spills what does not fit; rows of
    further folders than ``most`` still are."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


_SHIPPED: set[str] = set()  # application ids that already received the package


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by the Python workers, once per
    SparkContext, for runs where it is not installed on the executors
    (``spark-submit --py-files`` does the same at launch).

    The package is zipped on the driver and handed to ``addPyFile``,
    which distributes it through Spark's file server."""
    import zipfile
    sc = _context(spark)
    if sc is None or sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="sentimart-pkg-"), "sentimart.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def recommended_conf(input_bytes: int, executors_cores: int) -> dict[str, str]:
    """Session settings for a cluster run over ``input_bytes`` of input on
    ``executors_cores`` cores in total (pass them to ``spark-submit
    --conf``).  Shuffles start with one partition per ~256 MB of input
    (at least two per core, at most 200,000 so the map-output metadata,
    which grows with maps x reducers, stays bounded) and AQE merges them
    to ``advisoryPartitionSizeInBytes``; skewed join partitions are split;
    broadcasts stay size-checked by the planner (thresholds, never hints).
    """
    initial = min(200_000, max(executors_cores * 2, input_bytes // (256 << 20)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
        "spark.sql.files.maxPartitionBytes": "128m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
        "spark.sql.python.filterPushdown.enabled": "true",
    }
