"""Incremental comment classification with Structured Streaming.

The batch job's per-file loop becomes a file-source stream: every trigger
takes at most ``max_files_per_trigger`` new comment files from the
folder, classifies them and writes the processed / failed folders and the
audit rows for that micro-batch.  The stream's checkpoint (in the shared
folder) records which files were consumed, so a restart after a crash
resumes without reclassifying or skipping files; each micro-batch is a run
of its own id, so a batch replayed after a crash replaces what it had
published instead of duplicating it (idempotent sink).  What fails joins
the retry queue like the failures of a first pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.classify import Classifier, classify_comments, rule_based_classifier
from ..plans import comments as C
from ..schemas import COMMENT_THREAD, with_field


def comment_stream(spark: SparkSession, threads_dir: str,
                   max_files_per_trigger: int = 64) -> DataFrame:
    """Streaming view of the nested comment files (partitioned by
    ``source``), flattened to comments."""
    threads = (spark.readStream.schema(with_field(COMMENT_THREAD, "source"))
               .option("maxFilesPerTrigger", max_files_per_trigger)
               .parquet(threads_dir))
    return C.extract_comments(threads, keep=["source"])


def run_comment_stream(spark: SparkSession, threads_dir: str, out_dir: str,
                       classifier: Classifier | Sequence[Classifier] = rule_based_classifier,
                       max_files_per_trigger: int = 64, checkpoint: str | None = None,
                       available_now: bool = True, **kw):
    """Start the stream; with ``available_now`` process every file present
    and return when done (otherwise return the running query)."""
    def each_batch(batch: DataFrame, batch_id: int) -> None:
        labelled = classify_comments(batch, classifier=classifier, reason_col="reason", **kw)
        C.publish(spark, labelled.withColumn("attempts", F.lit(0)), out_dir, "append", f"batch-{batch_id}",
                  clustered=not (kw.get("parallelism") or kw.get("rows_per_task")))

    w = (comment_stream(spark, threads_dir, max_files_per_trigger).writeStream
         .foreachBatch(each_batch)
         .option("checkpointLocation", checkpoint or f"{out_dir}/_checkpoint"))
    if available_now:
        q = w.trigger(availableNow=True).start()
        q.awaitTermination()
        return q
    return w.start()
