"""Sinks: CSV with the shared dialect (K1, K4, K5), append of retried rows
(K2), partitioned Parquet (K3), write-if-non-empty (K6), table publishing
(K7, K8), run audit log (K9), and lineage cuts.

Writes go through Spark's commit protocol, so a job that loses executors
re-runs tasks and still commits each output exactly once.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import open_files, scratch_path
from ..sources.files import CSV_DIALECT


#: folders of a published table's versions begin with this
VERSION = "v-"
#: a CSV file with multi-line cells is read by one task, so files are bounded
RECORDS_PER_FILE = 100_000
#: files a task keeps open: CSV writers hold a small buffer, Parquet writers
#: the rows of their row group
OPEN_CSV, OPEN_PARQUET = 500, 20


def write_csv(df: DataFrame, path: str, mode: str = "overwrite",
              partition_by: Sequence[str] = (), single_file: bool = False, clustered: bool = False,
              compression: str | None = None) -> None:
    """K1/K4: CSV with the shared dialect.  ``partition_by`` writes one
    folder per value; with ``mode='overwrite'`` only the folders present in
    ``df`` are replaced (dynamic partition overwrite).  Rows that come
    ``clustered`` by these columns, as those of one file a value do, are not
    shuffled again.  A file holds ``RECORDS_PER_FILE`` records at most, but
    for ``single_file`` (K5), which is for small dimension outputs only - it
    funnels the data through one task."""
    if single_file:
        df = df.coalesce(1)
    elif partition_by and not clustered:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode).options(**CSV_DIALECT)
    if not single_file:
        w = w.option("maxRecordsPerFile", RECORDS_PER_FILE)
    if compression:
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    with open_files(df.sparkSession, OPEN_CSV):
        w.csv(path)


def write_if_nonempty(df: DataFrame, path: str, **kw) -> bool:
    """K6: write only when there is at least one row; returns whether it
    wrote.  Meant for materialised frames (the check is one ``limit(1)``)."""
    if df.isEmpty():
        return False
    write_csv(df, path, **kw)
    return True


def write_parquet_partitioned(df: DataFrame, path: str, by: Sequence[str],
                              mode: str = "overwrite",
                              shape: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """K3: one folder per entity value (the Spark form of one file per
    entity).  The ``rebalance`` hint clusters rows by the partition
    columns so each task writes few files, and lets AQE split a hot value
    (a third of all rows) over several tasks and merge tiny ones - a plain
    ``repartition(by)`` would send a hot value to a single task.  Wide rows
    that are made of a few columns are better given as these: ``shape``
    makes them once the few have been moved."""
    rows = df.hint("rebalance", *by)
    with open_files(df.sparkSession, OPEN_PARQUET):
        ((rows if shape is None else shape(rows)).write.mode(mode)
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy(*by).parquet(path))


def write_entity_files(df: DataFrame, path: str, by: str) -> None:
    """K3 as it was: one file an entity, ``<entity>.parquet``, in one flat
    folder.  An entity is written by one task, as its file is one, and the
    files get their names, by which they are selected later, by a rename."""
    spark, aside = df.sparkSession, f"{path}/_entities"
    with open_files(spark, OPEN_PARQUET):
        df.repartition(by).write.mode("overwrite").partitionBy(by).parquet(aside)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(aside)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for entity in fs.listStatus(folder):
        if entity.isDirectory():
            name = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(
                entity.getPath().getName().split("=", 1)[1])
            for part in fs.listStatus(entity.getPath()):
                if part.getPath().getName().endswith(".parquet"):
                    fs.rename(part.getPath(), hadoop.Path(f"{path}/{name}.parquet"))
    fs.delete(folder, True)


def materialize_at(df: DataFrame, name: str = "stage") -> tuple[DataFrame, str]:
    """Cut lineage: write to a new folder under the session's shared
    folder and read back; returns the frame and the folder.

    Used after expensive or side-effecting stages (the classifier) so
    that several downstream branches, and tasks re-run after an executor
    loss, read stored rows instead of recomputing (and re-calling a
    model).  Durable, unlike a cache or a local checkpoint."""
    spark = df.sparkSession
    out = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(out)
    return spark.read.parquet(out), out


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """:func:`materialize_at` without the folder."""
    return materialize_at(df, name)[0]


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder this library created (a materialised intermediate),
    through the Hadoop file system of the path's scheme, so it works the
    same on HDFS, object stores and local disks."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: left for the folder's lifecycle policy
        return False
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
    return bool(fs.delete(p, True))


def publish_table(df: DataFrame, name: str, location: str, mode: str = "overwrite",
                  bucket_by: tuple[int, Sequence[str]] | None = None, keep: int = 1) -> DataFrame:
    """K7/K8: create-or-replace (``mode='overwrite'``) or create-only
    (``mode='errorifexists'``) a named table stored below ``location``.

    The rows are written aside, as a version of their own, and only a whole
    version becomes the table: a replace points the table at it (one change
    of its location in the catalog), a create renames the version's table,
    which fails if the name is taken by then.  A replace that fails leaves
    the table as it was, and what reads it meanwhile reads one version.  The
    ``keep`` versions before the last one stay for such readers.  A replace
    with other columns or buckets cannot be one change: the name is dropped
    and given to the new version, so for a moment there is none.

    ``bucket_by=(n, cols)`` stores the table hash-bucketed on ``cols``:
    later joins and aggregations on those columns between tables with the
    same ``n`` read co-partitioned buckets instead of shuffling again.  The
    rows are first hash-partitioned into the same ``n`` partitions (the
    same hash as the buckets), so each task writes one bucket file instead
    of up to ``n`` files per task."""
    spark = df.sparkSession
    exists = spark.catalog.tableExists(name)
    if exists and mode == "errorifexists":
        raise AnalysisException(f"table {name} already exists")
    version = f"{time.time_ns():020d}"
    aside, path = f"{name}__v{version}", f"{location}/{VERSION}{version}"
    if bucket_by is not None:
        df = df.repartition(bucket_by[0], *[F.col(c) for c in bucket_by[1]])
    w = df.write.mode("errorifexists").format("parquet").option("path", path)
    if bucket_by is not None:
        w = w.bucketBy(bucket_by[0], *bucket_by[1])
    try:
        w.saveAsTable(aside)
        if exists and _shape(spark, name) == _shape(spark, aside):
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
            spark.catalog.refreshTable(name)
        else:
            if exists:
                spark.sql(f"DROP TABLE {name}")          # the files of an external table stay
            spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {aside}")
        remove_path(spark, path)
        raise
    spark.sql(f"DROP TABLE IF EXISTS {aside}")
    for old in _versions(spark, location)[:-1 - keep]:
        remove_path(spark, old)
    return spark.table(name)


def _shape(spark: SparkSession, name: str) -> tuple:
    """What a change of location cannot change: columns and buckets."""
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    return (spark.table(name).schema, described.get("Num Buckets"), described.get("Bucket Columns"))


def _versions(spark: SparkSession, location: str) -> list[str]:
    """The folders of a table's versions, oldest first."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(f"{location}/{n}" for n in names if n.startswith(VERSION))


def append_audit(spark: SparkSession, counts: DataFrame, path: str,
                 run_id: str, mode: str = "overwrite") -> DataFrame:
    """K9: add one row per source (total / processed / unprocessed) to an
    audit table, tagged with the run id and time.  Runs are new files, never
    a read-modify-write of one log object; a run id that is logged again
    replaces its rows (``mode='append'``: adds to them).  The log is
    partitioned by run id, so reading one run back (returned here,
    independent of ``counts``) opens only that run's folder."""
    rows = counts.select(F.lit(run_id).alias("run_id"),
                         F.current_timestamp().alias("logged_at"), "*")
    (rows.write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id").parquet(path))
    return spark.read.parquet(path).where(F.col("run_id") == run_id)
