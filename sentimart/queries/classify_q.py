"""Registered queries: classification (U1-U6), comment jobs (C3, C4),
warehouse load (C5), run audit (K9) and the incremental stream."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import oracle as O
from ..catalog import register
from ..operators.classify import (LEXICON, NO_LABEL, SENTIMENT_OF, classify_comments, flaky_classifier,
                                  picky_classifier, shy_classifier)
from ..operators.leases import lease_report, store_leased
from ..plans import comments as C
from ..plans.warehouse import fn_comments
from ..schemas import COMMENT_THREAD, COMMENTS, SENTINEL, with_field
from ..session import scratch_path
from ..sinks.files import write_entity_files
from ..sources import adapters as A
from ..sources.files import LoadError
from ..streaming.incremental import run_comment_stream
from .io_q import N_SOURCES, SOURCE_SQL, stage_threads


def _sql_rule(text: str) -> tuple[str, str]:
    """DuckDB twin of ``rule_label``: (emotion, sentiment) CASE expressions."""
    def lit(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"
    em = "CASE " + " ".join(f"WHEN strpos({text}, {lit(k)}) > 0 THEN {lit(e)}" for k, e in LEXICON) + \
        " ELSE 'neutral' END"
    se = "CASE " + " ".join(f"WHEN strpos({text}, {lit(k)}) > 0 THEN {lit(SENTIMENT_OF[e])}"
                            for k, e in LEXICON) + " ELSE 'neutral' END"
    return em, se


_EM, _SE = _sql_rule("text")


@register("classify_comments", f"SELECT CAST(doc_id AS VARCHAR) AS commentid, source AS videoid, "
          f"{_EM} AS emotion, {_SE} AS sentimentnature FROM documents")
def q_classify_comments(spark, sf):
    out = classify_comments(A.comment_text(spark, sf))
    return out.select("commentid", "videoid", "emotion", "sentimentnature")


@register("classify_with_failures", f"SELECT CAST(doc_id AS VARCHAR) AS commentid, "
          f"CASE WHEN strpos(text, '@') > 0 THEN '{SENTINEL}' ELSE {_EM} END AS emotion, "
          f"CASE WHEN strpos(text, '@') > 0 THEN NULL ELSE {_SE} END AS sentimentnature FROM documents")
def q_classify_with_failures(spark, sf):
    out = classify_comments(A.comment_text(spark, sf), classifier=flaky_classifier(),
                            sleep=lambda s: None)
    return out.select("commentid", "emotion", "sentimentnature")


#: calls a second and key of the leased query, and its keys
LEASE_RATE, LEASES = 400.0, 4


def _leased(spark: SparkSession, sf: str) -> DataFrame:
    clients = [picky_classifier] * LEASES
    return store_leased(A.comment_text(spark, sf), clients, LEASE_RATE, burst=2, sleep=time.sleep)


@register("classify_leased", f"SELECT CAST(doc_id AS VARCHAR) AS commentid, source AS videoid, "
          f"CASE WHEN starts_with(text, 'NO') THEN '{SENTINEL}' ELSE {_EM} END AS emotion, "
          f"CASE WHEN starts_with(text, 'NO') THEN NULL ELSE {_SE} END AS sentimentnature FROM documents")
def q_classify_leased(spark, sf):
    """U1-U5 with each of four keys leased to one task, at its rate."""
    return _leased(spark, sf).select("commentid", "videoid", "emotion", "sentimentnature")


@register("lease_report", "SELECT CAST(k AS INTEGER) AS lease, CAST(0 AS BIGINT) AS n_overlapping, "
          f"CAST(0 AS BIGINT) AS n_over_rate FROM range({LEASES}) AS r(k), (SELECT count(*) AS n FROM documents) d WHERE n >= {LEASES}")
def q_lease_report(spark, sf):
    """U4 + U5: no call of a key overlaps another, none exceeds the rate."""
    return lease_report(_leased(spark, sf), LEASE_RATE, burst=2).select("lease", "n_overlapping", "n_over_rate")


_THREAD_ROWS = f"""SELECT {SOURCE_SQL} AS source, l_returnflag || l_linestatus AS fs
  FROM lineitem WHERE l_orderkey % 23 <> 0"""


def _first_pass(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    out = scratch_path(spark, "comments")
    audit = C.first_pass(spark, stage_threads(spark, sf), out, 0, N_SOURCES, run_id="first",
                         classifier=picky_classifier, sleep=lambda s: None)
    return out, audit


@register("comments_first_pass", "SELECT source, CAST(count(*) AS BIGINT) AS total_rows, "
          "CAST(count(*) FILTER (WHERE fs <> 'NO') AS BIGINT) AS processed_rows, "
          "CAST(count(*) FILTER (WHERE fs = 'NO') AS BIGINT) AS unprocessed_rows "
          f"FROM ({_THREAD_ROWS}) t GROUP BY source")
def q_comments_first_pass(spark, sf):
    _, audit = _first_pass(spark, sf)
    return audit.drop("run_id", "logged_at")


@register("comments_retry_pass", "SELECT source, CAST(count(*) AS BIGINT) AS total_rows, "
          "CAST(count(*) AS BIGINT) AS processed_rows, CAST(0 AS BIGINT) AS unprocessed_rows "
          f"FROM ({_THREAD_ROWS}) t WHERE fs = 'NO' GROUP BY source")
def q_comments_retry_pass(spark, sf):
    out, _ = _first_pass(spark, sf)
    return C.retry_pass(spark, out, run_id="retry", sleep=lambda s: None).drop("run_id", "logged_at")


_TEM, _TSE = _sql_rule("textoriginal")
_LOADED = (f"SELECT commentid, videoid, CAST(publishedat AS DATE) AS publishedat, textoriginal, "
           f"{_TEM} AS emotion, {_TSE} AS sentimentnature, authordisplayname, authorprofileimageurl, "
           f"authorchannelurl, likecount, totalreplycount FROM ({O.THREADS_SQL}) t WHERE likecount IS NOT NULL")


@register("load_tables", "SELECT * EXCLUDE (rw) FROM (SELECT *, row_number() OVER "
          f"(PARTITION BY commentid ORDER BY (emotion IS NULL OR emotion = '{SENTINEL}'), "
          f"{O.COMMENT_ORDER}) AS rw FROM ({_LOADED}) l) d WHERE rw = 1")
def q_load_tables(spark, sf):
    """C5 + C7 after both passes: processed CSV folders -> typed comments
    table (positional, bad rows skipped) -> one row per comment."""
    out, _ = _first_pass(spark, sf)
    C.retry_pass(spark, out, run_id="retry", sleep=lambda s: None)
    typed = C.load_processed(spark, out, COMMENTS)
    return fn_comments(typed)


_ROWS = ["commentid", "videoid", "publishedat", "textoriginal", "authordisplayname", "authorprofileimageurl",
         "authorchannelurl", "likecount", "totalreplycount"]


def _rows_sql(failed: str) -> str:
    """Every classified row as text with its status; ``failed`` says which
    rows the classifier does not answer."""
    return (f"SELECT CASE WHEN {failed} THEN 'failed' ELSE 'processed' END AS status, "
            + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _ROWS)
            + f", CASE WHEN {failed} THEN '{SENTINEL}' ELSE {_TEM} END AS emotion, "
            f"CASE WHEN {failed} THEN NULL ELSE {_TSE} END AS sentimentnature "
            f"FROM ({O.THREADS_SQL}) t WHERE likecount IS NOT NULL")


def _rows(spark: SparkSession, out: str) -> DataFrame:
    """What readers see of the runs in ``out``: processed rows and queue."""
    columns = [*(F.col(c).cast("string").alias(c) for c in _ROWS), "emotion", "sentimentnature"]
    both = [df.select(F.lit(status).alias("status"), *columns) for status, df in
            (("processed", C.processed_comments(spark, out)), ("failed", C.failed_comments(spark, out)))]
    return both[0].unionByName(both[1])


@register("comments_first_pass_rows", _rows_sql("starts_with(textoriginal, 'NO')"))
def q_comments_first_pass_rows(spark, sf):
    """The rows themselves, processed and queued."""
    return _rows(spark, _first_pass(spark, sf)[0])


class _Died(Exception):
    """Of a run that is lost between its outputs and its commit."""


def _die(*_) -> None:
    raise _Died


@register("comments_retry_rows", _rows_sql("starts_with(textoriginal, 'NO') AND strpos(textoriginal, '!') > 0"))
def q_comments_retry_rows(spark, sf):
    """C4: all rows after a pass that was published twice under one run id,
    one that died before its commit, and a retry that answers but some."""
    out, _ = _first_pass(spark, sf)
    C.first_pass(spark, stage_threads(spark, sf), out, 0, N_SOURCES, run_id="first", classifier=picky_classifier,
                 sleep=lambda s: None)
    try:
        C.first_pass(spark, stage_threads(spark, sf), out, 0, N_SOURCES, run_id="died", sleep=lambda s: None, commit=_die)
    except _Died:
        C.retry_pass(spark, out, run_id="retry", classifier=shy_classifier, sleep=lambda s: None)
        return _rows(spark, out)
    raise AssertionError("a pass was published without its commit")


@register("comments_queue", f"SELECT commentid, source, CAST(2 AS INTEGER) AS attempts, '{NO_LABEL}' AS reason FROM ("
          f"SELECT *, 'comments_' || CAST(CAST(videoid AS BIGINT) % {N_SOURCES} AS VARCHAR) AS source FROM ({O.THREADS_SQL}) r) t "
          "WHERE likecount IS NOT NULL AND starts_with(textoriginal, 'NO') AND strpos(textoriginal, '!') > 0")
def q_comments_queue(spark, sf):
    """C4: the queue after two passes, with attempts and reasons."""
    out, _ = _first_pass(spark, sf)
    C.retry_pass(spark, out, run_id="retry", classifier=shy_classifier, sleep=lambda s: None)
    return C.failed_comments(spark, out).select("commentid", "source", "attempts", "reason")


@register("comments_stream_rows", _rows_sql("starts_with(textoriginal, 'NO')"))
def q_comments_stream_rows(spark, sf):
    """The stream's rows, processed and queued."""
    out = scratch_path(spark, "stream")
    run_comment_stream(spark, stage_threads(spark, sf), out, classifier=picky_classifier,
                       max_files_per_trigger=100, sleep=lambda s: None)
    return _rows(spark, out)


@register("incremental_selection", "SELECT CASE WHEN suffix < 150 THEN 'one' ELSE 'two' END AS run_id, source, "
          "CAST(count(*) AS BIGINT) AS total_rows FROM ("
          f"SELECT {SOURCE_SQL} AS source, l_partkey % {N_SOURCES} AS suffix FROM lineitem WHERE l_orderkey % 23 <> 0) t "
          "GROUP BY source, suffix")
def q_incremental_selection(spark, sf):
    """S8 + N11: flat files, of which a second run opens only those that the
    first did not, and a third finds none."""
    flat, out = scratch_path(spark, "flat"), scratch_path(spark, "comments")
    write_entity_files(spark.read.schema(with_field(COMMENT_THREAD, "source")).parquet(stage_threads(spark, sf)), flat, "source")
    kw = {"classifier": picky_classifier, "sleep": lambda s: None, "flat_files": True, "only_new": True}
    C.first_pass(spark, flat, out, 0, 150, run_id="one", **kw)
    C.first_pass(spark, flat, out, 100, N_SOURCES, run_id="two", **kw)
    try:
        C.first_pass(spark, flat, out, 0, N_SOURCES, run_id="three", **kw)
    except LoadError:
        return C.audit_log(spark, out).select("run_id", "source", "total_rows")
    raise AssertionError("a file was read twice")


@register("run_audit", "SELECT run_id, CAST(count(*) AS BIGINT) AS sources, CAST(sum(total_rows) AS BIGINT) AS total_rows, "
          "CAST(sum(processed_rows) AS BIGINT) AS processed_rows FROM ("
          "SELECT 'first' AS run_id, source, count(*) AS total_rows, count(*) FILTER (WHERE fs <> 'NO') AS processed_rows "
          f"FROM ({_THREAD_ROWS}) t GROUP BY source UNION ALL "
          "SELECT 'retry' AS run_id, source, count(*) AS total_rows, count(*) AS processed_rows "
          f"FROM ({_THREAD_ROWS}) t WHERE fs = 'NO' GROUP BY source) a GROUP BY run_id")
def q_run_audit(spark, sf):
    """K9: the audit log after both passes, read back from storage."""
    out, _ = _first_pass(spark, sf)
    C.retry_pass(spark, out, run_id="retry", sleep=lambda s: None)
    log = C.audit_log(spark, out)
    return log.groupBy("run_id").agg(F.count(F.lit(1)).alias("sources"),
                                     F.sum("total_rows").alias("total_rows"),
                                     F.sum("processed_rows").alias("processed_rows"))


@register("comments_stream", "SELECT source, CAST(count(*) AS BIGINT) AS total_rows, "
          "CAST(count(*) FILTER (WHERE fs <> 'NO') AS BIGINT) AS processed_rows "
          f"FROM ({_THREAD_ROWS}) t GROUP BY source")
def q_comments_stream(spark, sf):
    """The first pass as an incremental file stream: each micro-batch takes
    at most a few new comment files; the stream's checkpoint makes every
    file count exactly once even across restarts."""
    out = scratch_path(spark, "stream")
    run_comment_stream(spark, stage_threads(spark, sf), out, classifier=picky_classifier,
                       max_files_per_trigger=100, sleep=lambda s: None)
    log = C.audit_log(spark, out)
    return log.groupBy("source").agg(F.sum("total_rows").alias("total_rows"),
                                     F.sum("processed_rows").alias("processed_rows"))
