"""Comment jobs: first classification pass (C3) and retry pass (C4).

Both are single Spark jobs over whole folders (no per-file driver loop):

    scan -> select sources -> extract -> classify (mapInArrow)
         -> one write that routes rows by status, its metrics observed (A3, F2)
              failed: the retry queue, with attempts, reason and due time
              processed -> CSV folders by source label (K1)
         -> audit rows per source (K9)
         -> commit

Only committed runs exist for readers (``sinks.runs``).  By source, a first
pass replaces all before it, a retry replaces the queue before it: the
queue is what the last run over a source could not classify, so neither a
retry nor a reader of the queue looks at a processed comment, and a comment
that succeeds on retry has left it (N12).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import iso_date_prefix, trim_spaces
from ..operators.aggregate import status_counts
from ..operators.classify import Classifier, classify_comments, rule_based_classifier
from ..operators.projection import nested_extract
from ..schemas import ALL_STRING_CLASSIFIED, CLASSIFIED_COMMENT, COMMENT_THREAD, SENTINEL, with_field
from ..session import open_files
from ..sinks import runs
from ..sinks.files import materialize, remove_path, write_csv
from ..sources.files import (filter_by_suffix, list_files, load_skip_bad, require_nonempty, scan_csv, scan_parquet,
                             select_files, source_label)

CLASSIFIED_COLUMNS = [f.name for f in ALL_STRING_CLASSIFIED.fields]
PROCESSED = "processedcomments"
#: they are compressed: a CSV file is read by one task either way
PROCESSED_FILES = "*.csv*"
#: classified rows by status; the failed ones stay and are the queue
CLASSIFIED = "notprocessedcomments"
AUDIT = "logs/uploadedfiles"
FILES = "logs/files"
FAILED_STATUS, PROCESSED_STATUS = "failed", "processed"

#: what the queue knows of a comment besides its columns
QUEUE = T.StructType([*CLASSIFIED_COMMENT.fields, *(T.StructField(n, t, True) for n, t in (
    ("source", T.StringType()), ("attempts", T.IntegerType()), ("reason", T.StringType()),
    ("due", T.TimestampType()), ("carried", T.BooleanType())))])
_AUDIT_SQL = ("run_id string, logged_at timestamp, source string, total_rows long, processed_rows long, "
              "unprocessed_rows long")


def extract_fields() -> dict[str, str | Column]:
    """Flat comment column -> nested source field (built on demand: no
    Column may be created at import time, executors import this module)."""
    snip = "snippet.topLevelComment.snippet."
    return {
        "commentid": "id", "videoid": "snippet.videoId",
        "publishedat": iso_date_prefix(snip + "publishedAt"),
        "textoriginal": trim_spaces(snip + "textOriginal"),
        "authordisplayname": snip + "authorDisplayName",
        "authorprofileimageurl": snip + "authorProfileImageUrl",
        "authorchannelurl": snip + "authorChannelUrl",
        "likecount": snip + "likeCount",
        "totalreplycount": "snippet.totalReplyCount",
    }


def extract_comments(threads: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Nested thread -> flat top-level comment (P1 + X1 + X3 + F1).
    Replies are never read (nested column pruning drops them)."""
    fields = extract_fields()
    fields.update({k: k for k in keep})
    return nested_extract(threads, fields).where(F.col("likecount").isNotNull())


def is_failed(emotion: Column | None = None) -> Column:
    """NULL or sentinel emotion -> failed (NULL is never dropped)."""
    e = F.col("emotion") if emotion is None else emotion
    return e.isNull() | (e == SENTINEL)


def route(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(processed, failed) over one stored frame."""
    bad = is_failed()
    return classified.where(~bad), classified.where(bad)


def publish(spark: SparkSession, labelled: DataFrame, out_dir: str, kind: str, run_id: str | None = None,
            carried: DataFrame | None = None, files: DataFrame | None = None, backoff: float = 0.0,
            keep_intermediate: bool = False, clustered: bool = False, commit: Callable | None = None) -> DataFrame:
    """Store, route, count and commit a run's classified rows (the columns
    of a classified comment, source, reason and the ``attempts`` before
    this one); returns its audit rows.

    One write takes the rows from the classifier and routes them by status;
    its counts are observed on the way.  ``carried`` are rows of the queue
    that this run does not touch but whose sources it has; ``files`` the
    files that it read, which the commit makes known.  A comment that
    failed is due again after ``backoff`` seconds, doubled each time.  Rows
    that come ``clustered`` by source (a task reads one file after another)
    go to their folders without a shuffle: about a file for each file read.
    ``commit`` is called in place of ``runs.commit``, when all is written."""
    run_id, attempt = run_id or f"{kind}-{uuid.uuid4().hex[:12]}", runs.new_attempt()
    copy = f"{out_dir}/{CLASSIFIED}/attempt={attempt}"
    wait = F.lit(backoff) * F.pow(F.lit(2.0), F.col("attempts") - 1)
    rows = (labelled.withColumn("attempts", (F.col("attempts") + 1).cast("int"))
            .withColumns({"due": F.timestamp_seconds(F.unix_micros(F.current_timestamp()) / 1e6 + wait),
                          "carried": F.lit(False)}).select(*QUEUE.names))
    if carried is not None:
        rows = rows.unionByName(carried.withColumn("carried", F.lit(True)).select(*QUEUE.names))
    seen = Observation()
    status = F.when(is_failed(), FAILED_STATUS).otherwise(PROCESSED_STATUS)
    with open_files(rows.sparkSession, 2):
        (rows.withColumn("status", status)
         .observe(seen, F.count(F.lit(1)).alias("total"), F.count_if(is_failed()).alias("failed"))
         .write.partitionBy("status").parquet(copy))
    stored = spark.read.schema(with_field(QUEUE, "status")).parquet(copy)
    write_csv(stored.where(F.col("status") == PROCESSED_STATUS).select(*CLASSIFIED_COLUMNS, "source"),
              f"{out_dir}/{PROCESSED}/attempt={attempt}", partition_by=["source"], clustered=clustered, compression="gzip")
    counts = status_counts(stored.where(~F.col("carried")), F.col("status") == PROCESSED_STATUS, by=["source"])
    audit_dir = f"{out_dir}/{AUDIT}/attempt={attempt}"
    (counts.select(F.lit(run_id).alias("run_id"), F.current_timestamp().alias("logged_at"), "*")
     .write.parquet(audit_dir))
    audit = spark.read.schema(_AUDIT_SQL).parquet(audit_dir)
    if files is not None:
        files.write.parquet(f"{out_dir}/{FILES}/attempt={attempt}")
    total, failed = seen.get["total"], seen.get["failed"]
    (commit or runs.commit)(spark, out_dir, run_id, attempt, kind, total - failed, failed)
    if not keep_intermediate:
        remove_path(spark, f"{copy}/status={PROCESSED_STATUS}")      # they are in the CSV folders now
    return audit


def first_pass(spark: SparkSession, threads_dir: str, out_dir: str,
               start: int | None = None, end: int | None = None,
               classifier: Classifier | Sequence[Classifier] = rule_based_classifier,
               parallelism: int | None = None, run_id: str | None = None,
               keep_intermediate: bool = False, flat_files: bool = False, only_new: bool = False,
               backoff: float = 0.0, commit: Callable | None = None, **kw) -> DataFrame:
    """Classify every comment thread under ``threads_dir``, optionally
    only sources whose label suffix is in ``[start, end)``.  Returns the
    audit rows of this run (``run_id``: a new one unless given; the same one
    again replaces what it published).

    The folder is partitioned by ``source``, or holds one file per source
    with ``flat_files`` (``{id}_{n}.parquet``; the label is the file's
    name).  ``only_new`` (flat files) takes the files that no run that holds
    has read, or that have changed since; others are not opened, and the
    rows of a changed file replace those it gave before.  An empty selection
    raises (S10)."""
    files = None
    if only_new:
        if not flat_files:
            raise ValueError("new files can be told apart where a source is one file")
        files = select_files(list_files(spark, threads_dir), start, end, read_files(spark, out_dir, run_id))
        files, start, end = materialize(files, "files"), None, None
        paths = [r["path"] for r in require_nonempty(files, f"new files of {threads_dir}").select("path").collect()]
        threads = scan_parquet(spark, paths, COMMENT_THREAD).withColumn("source", source_label("_metadata.file_path"))
    elif flat_files:
        threads = scan_parquet(spark, threads_dir, COMMENT_THREAD).withColumn(
            "source", source_label("_metadata.file_path"))
    else:
        threads = scan_parquet(spark, threads_dir, with_field(COMMENT_THREAD, "source"))
    if start is not None and end is not None:
        threads = filter_by_suffix(threads, "source", start, end)
    require_nonempty(threads, f"selection [{start}, {end}) of {threads_dir}")
    labelled = classify_comments(extract_comments(threads, keep=["source"]), classifier=classifier,
                                 parallelism=parallelism, reason_col="reason", **kw)
    return publish(spark, labelled.withColumn("attempts", F.lit(0)), out_dir, "first", run_id, files=files,
                   backoff=backoff, keep_intermediate=keep_intermediate,
                   clustered=not (parallelism or kw.get("rows_per_task")), commit=commit)


def retry_pass(spark: SparkSession, out_dir: str,
               classifier: Classifier | Sequence[Classifier] = rule_based_classifier,
               parallelism: int | None = None, run_id: str | None = None,
               keep_intermediate: bool = False, max_passes: int | None = None, backoff: float = 0.0, **kw) -> DataFrame:
    """C4: re-classify the queue: the comments that are due and, with
    ``max_passes``, were tried in fewer passes.  Successes join the
    processed comments; the others are the queue of their sources.

    A run that died has published nothing and can be run again; one that is
    repeated under its ``run_id`` starts from the queue as it was before it
    (only the last run can be repeated)."""
    before = runs.commits(spark, out_dir)
    if run_id is not None and any(c.run_id == run_id for c in before[:-1]):
        raise ValueError(f"run {run_id} is not the last one: it cannot be repeated")
    queue = failed_comments(spark, out_dir, without=run_id)
    ready = F.coalesce(F.col("due") <= F.current_timestamp(), F.lit(True))
    if max_passes is not None:
        ready = ready & (F.col("attempts") < max_passes)
    todo = queue.where(ready)
    waiting = queue.where(~ready).join(todo.select("source").distinct(), "source", "left_semi")
    labelled = classify_comments(todo.drop("emotion", "sentimentnature", "reason"), classifier=classifier,
                                 parallelism=parallelism, reason_col="reason", **kw)
    return publish(spark, labelled, out_dir, "retry", run_id, carried=waiting, backoff=backoff,
                   keep_intermediate=keep_intermediate)


def read_files(spark: SparkSession, out_dir: str, without: str | None = None) -> DataFrame:
    """The files that runs that hold have read, as they were then."""
    schema = "path string, length long, modified timestamp"
    paths = [p for c in runs.commits(spark, out_dir, without) for p in [f"{out_dir}/{FILES}/attempt={c.attempt}"]
             if runs.exists(spark, p)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def audit_log(spark: SparkSession, out_dir: str, without: str | None = None) -> DataFrame:
    """K9: the audit rows of the runs that hold, with their ``attempt``."""
    held = runs.commits(spark, out_dir, without)
    if not held:
        return spark.createDataFrame([], _AUDIT_SQL + ", attempt string")
    return (spark.read.schema(_AUDIT_SQL + ", attempt string").option("basePath", f"{out_dir}/{AUDIT}")
            .parquet(*[f"{out_dir}/{AUDIT}/attempt={c.attempt}" for c in held]))


def _resolved(spark: SparkSession, rows: DataFrame, out_dir: str, held: list[runs.Commit], replacing: Sequence[str],
              without: str | None) -> DataFrame:
    """The ``rows`` (source, attempt, ...) that no later run of a kind in
    ``replacing`` over their source replaced.  The runs are few; their
    sources meet the rows by a join."""
    if not any(c.kind in replacing for c in held[1:]):
        return rows
    number = F.create_map(*(F.lit(x) for c in held for x in (c.attempt, c.number)))[F.col("attempt")]
    since = F.max(F.when(F.col("attempt").isin(*(c.attempt for c in held if c.kind in replacing)), F.col("number")))
    live = (audit_log(spark, out_dir, without).select("source", "attempt", number.alias("number"))
            .withColumn("since", since.over(Window.partitionBy("source")))
            .where("since is null or number >= since").select("source", "attempt"))
    return rows.join(live, ["source", "attempt"], "left_semi")


def failed_comments(spark: SparkSession, out_dir: str, without: str | None = None) -> DataFrame:
    """The queue: what the last run over each source could not classify,
    with attempts, reason and due time."""
    held = runs.commits(spark, out_dir, without)
    paths = [f"{out_dir}/{CLASSIFIED}/attempt={c.attempt}/status={FAILED_STATUS}" for c in held if c.failed]
    if not paths:
        return spark.createDataFrame([], QUEUE).drop("carried")
    rows = (spark.read.schema(with_field(QUEUE, "attempt")).option("basePath", f"{out_dir}/{CLASSIFIED}").parquet(*paths))
    return _resolved(spark, rows, out_dir, held, ("first", "retry"), without).select(*QUEUE.names).drop("carried")


def _processed_paths(spark: SparkSession, out_dir: str) -> list[str]:
    """Folders of the processed rows that hold: of whole runs, and by source
    of those that a later first pass replaced in part."""
    held = runs.commits(spark, out_dir)
    firsts = [c.number for c in held if c.kind == "first"]
    whole = [c for c in held if c.processed and c.number >= max(firsts, default=0)]
    partly = [c for c in held if c.processed and c.number < max(firsts, default=0)]
    base = f"{out_dir}/{PROCESSED}"
    paths = [f"{base}/attempt={c.attempt}" for c in whole]
    if partly:
        rows = audit_log(spark, out_dir).where(F.col("attempt").isin(*(c.attempt for c in partly)) & (F.col("processed_rows") > 0))
        live = _resolved(spark, rows, out_dir, held, ("first",), None).select("attempt", "source").collect()
        paths += [f"{base}/attempt={r['attempt']}/source={r['source']}" for r in live]
    return paths


def processed_comments(spark: SparkSession, out_dir: str) -> DataFrame:
    """All processed rows of every run that holds, as strings."""
    paths = _processed_paths(spark, out_dir)
    if not paths:
        return spark.createDataFrame([], ALL_STRING_CLASSIFIED)
    return scan_csv(spark, paths, ALL_STRING_CLASSIFIED, glob=PROCESSED_FILES, recursive=True)


def load_processed(spark: SparkSession, out_dir: str, schema: T.StructType) -> DataFrame:
    """C5 for the processed rows: by position into ``schema``, bad rows
    skipped."""
    paths = _processed_paths(spark, out_dir)
    return load_skip_bad(spark, paths, schema, glob=PROCESSED_FILES) if paths else spark.createDataFrame([], schema)


def vacuum(spark: SparkSession, out_dir: str) -> list[str]:
    """Remove the outputs of attempts that died or were repeated.  Not for
    a time when a run is under way, which has no commit yet."""
    dead = [p for folder in (CLASSIFIED, PROCESSED, AUDIT, FILES) for p in runs.dead_attempts(spark, out_dir, folder)]
    for path in dead:
        remove_path(spark, path)
    return dead
