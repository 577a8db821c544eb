"""Runs are published once: repeated runs, runs that die, replaced sources,
and the retry queue."""

import time

import pytest
from pyspark.sql import functions as F

from sentimart.operators.classify import NO_LABEL, NO_TEXT, classify_comments, picky_classifier, rule_based_classifier, shy_classifier
from sentimart.plans import comments as C
from sentimart.queries import classify_q as Q
from sentimart.schemas import SENTINEL
from sentimart.session import scratch_path
from sentimart.sinks import runs
from sentimart.sinks.files import write_parquet_partitioned


def threads(spark, sources, n=6):
    """``n`` comments a source; every third cannot be read at first, of
    these every other one not on a first retry either; ids repeat."""
    snip = F.struct(F.lit("2024-01-01T00:00:00Z").alias("publishedAt"), F.col("text").alias("textOriginal"),
                    F.lit("a").alias("authorDisplayName"), F.lit("b").alias("authorProfileImageUrl"),
                    F.lit("c").alias("authorChannelUrl"), F.col("n").alias("likeCount"))
    rows = [(s, i, f"{s}-{i // 2}", ("NO! " if i % 2 else "NO ") + "x" if i % 3 == 0 else "love") for s in sources for i in range(n)]
    df = spark.createDataFrame(rows, "source string, n long, id string, text string")
    out = df.select("id", F.struct(F.lit("v").alias("videoId"), F.lit(0).cast("long").alias("totalReplyCount"),
                                   F.struct(snip.alias("snippet")).alias("topLevelComment")).alias("snippet"), "source")
    path = scratch_path(spark, "threads")
    write_parquet_partitioned(out, path, ["source"])
    return path


def first(spark, path, out, **kw):
    return C.first_pass(spark, path, out, classifier=picky_classifier, sleep=lambda s: None, **kw)


def state(spark, out):
    done = sorted((r["commentid"], r["likecount"], r["emotion"]) for r in C.processed_comments(spark, out).collect())
    queue = sorted((r["source"], r["likecount"], r["attempts"], r["reason"]) for r in C.failed_comments(spark, out).collect())
    return done, queue


def totals(spark, out):
    return {r["run_id"]: (r["t"], r["p"]) for r in C.audit_log(spark, out).groupBy("run_id").agg(
        F.sum("total_rows").alias("t"), F.sum("processed_rows").alias("p")).collect()}


def test_a_repeated_run_replaces_itself(spark):
    path, out = threads(spark, ["s_1", "s_2"]), scratch_path(spark, "out")
    first(spark, path, out, run_id="r1")
    once = state(spark, out)
    assert len(once[0]) == 8 and len(once[1]) == 4 and totals(spark, out) == {"r1": (12, 8)}
    first(spark, path, out, run_id="r1")
    assert state(spark, out) == once and totals(spark, out) == {"r1": (12, 8)}
    C.retry_pass(spark, out, classifier=shy_classifier, run_id="r2", sleep=lambda s: None)
    after = state(spark, out)
    assert len(after[0]) == 10 and [q[2:] for q in after[1]] == [(2, NO_LABEL)] * 2
    C.retry_pass(spark, out, classifier=shy_classifier, run_id="r2", sleep=lambda s: None)
    assert state(spark, out) == after and totals(spark, out) == {"r1": (12, 8), "r2": (4, 2)}
    dead = C.vacuum(spark, out)
    assert len(dead) == 6 and state(spark, out) == after                # three folders of each replaced attempt
    C.retry_pass(spark, out, run_id="r3", sleep=lambda s: None)
    assert state(spark, out)[1] == [] and len(state(spark, out)[0]) == 12
    with pytest.raises(ValueError):
        C.retry_pass(spark, out, run_id="r2")


@pytest.mark.parametrize("where", ["write_csv", "status_counts", "commit"])
def test_a_run_that_dies_is_invisible(spark, monkeypatch, where):
    path, out = threads(spark, ["s_1"]), scratch_path(spark, "out")

    def die(*a, **kw):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(*((C.runs, "commit") if where == "commit" else (C, where)), die)
        with pytest.raises(RuntimeError):
            first(spark, path, out, run_id="r1")
    assert state(spark, out) == ([], []) and C.audit_log(spark, out).count() == 0
    first(spark, path, out, run_id="r1")
    before = state(spark, out)
    with monkeypatch.context() as m:
        m.setattr(*((C.runs, "commit") if where == "commit" else (C, where)), die)
        with pytest.raises(RuntimeError):
            C.retry_pass(spark, out, run_id="r2", sleep=lambda s: None)
    assert state(spark, out) == before and len(before[0]) == 4 and len(before[1]) == 2
    C.retry_pass(spark, out, run_id="r2", sleep=lambda s: None)
    assert len(state(spark, out)[0]) == 6 and state(spark, out)[1] == []


def test_a_pass_over_some_sources_replaces_these_only(spark):
    out = scratch_path(spark, "out")
    first(spark, threads(spark, ["s_1", "s_2", "s_3"]), out)
    C.retry_pass(spark, out, classifier=shy_classifier, sleep=lambda s: None)
    first(spark, threads(spark, ["s_2", "s_4"], n=3), out)
    done, queue = state(spark, out)
    assert sorted({(q[0], q[2]) for q in queue}) == [("s_1", 2), ("s_2", 1), ("s_3", 2), ("s_4", 1)]
    per = {s: sum(d[0].startswith(s) for d in done) for s in ("s_1", "s_2", "s_3", "s_4")}
    assert per == {"s_1": 5, "s_2": 2, "s_3": 5, "s_4": 2}
    loaded = C.load_processed(spark, out, C.CLASSIFIED_COMMENT)
    assert loaded.count() == 14
    C.retry_pass(spark, out, sleep=lambda s: None)
    done, queue = state(spark, out)
    assert len(done) == 18 and queue == []


def test_only_due_comments_are_tried_and_the_others_stay(spark):
    out = scratch_path(spark, "out")
    first(spark, threads(spark, ["s_1"]), out, backoff=3_600.0)
    assert C.retry_pass(spark, out, sleep=lambda s: None).count() == 0            # due in an hour
    assert len(state(spark, out)[1]) == 2
    first(spark, threads(spark, ["s_1", "s_2"]), out)
    C.retry_pass(spark, out, classifier=shy_classifier, sleep=lambda s: None)
    assert C.retry_pass(spark, out, max_passes=2, sleep=lambda s: None).count() == 0
    assert [q[2] for q in state(spark, out)[1]] == [2, 2]
    late = C.failed_comments(spark, out).where("due > current_timestamp()").count()
    assert late == 0


def test_carried_rows_stay_in_the_queue(spark):
    out, path = scratch_path(spark, "out"), threads(spark, ["s_1"])
    first(spark, path, out)
    queue = C.failed_comments(spark, out)
    some = queue.where("likecount = 0")
    labelled = classify_comments(some.drop("emotion", "sentimentnature", "reason"), reason_col="reason")
    C.publish(spark, labelled, out, "retry", carried=queue.where("likecount <> 0"))
    done, left = state(spark, out)
    assert len(done) == 5 and left == [("s_1", 3, 1, NO_LABEL)]
    assert sorted(totals(spark, out).values()) == [(1, 1), (6, 4)]


def test_the_queue_reads_no_processed_text(spark):
    out = scratch_path(spark, "out")
    first(spark, threads(spark, ["s_1", "s_2"]), out)
    C.retry_pass(spark, out, classifier=shy_classifier, sleep=lambda s: None)
    files = C.failed_comments(spark, out).inputFiles()
    assert files and not any(C.PROCESSED in f.replace(C.CLASSIFIED, "") or "status=processed" in f for f in files)


def test_reasons(spark):
    def broken(texts):
        raise ConnectionError("down")
    df = spark.createDataFrame([(None,), ("a",)], "textoriginal string").coalesce(1)
    got = {r["textoriginal"]: (r["emotion"], r["reason"]) for r in
           classify_comments(df, classifier=broken, sleep=lambda s: None, reason_col="reason").collect()}
    assert got == {None: (SENTINEL, NO_TEXT), "a": (SENTINEL, "ConnectionError: down")}
    assert {r["reason"] for r in classify_comments(df.where("textoriginal is not null"), classifier=rule_based_classifier,
                                                   reason_col="reason").collect()} == {None}


def test_two_commits_cannot_have_one_number(spark, monkeypatch):
    out = scratch_path(spark, "out")
    real, calls = runs.all_commits, []

    def stale(spark_, out_dir):
        calls.append(1)
        return [] if len(calls) == 2 else real(spark_, out_dir)        # the second commit sees an old listing once
    monkeypatch.setattr(runs, "all_commits", stale)
    a = runs.commit(spark, out, "a", "x", "first", 1, 0)
    b = runs.commit(spark, out, "b", "y", "first", 2, 0)
    assert (a.number, b.number) == (1, 2) and [c.run_id for c in real(spark, out)] == ["a", "b"]
    assert abs(a.committed_at - time.time()) < 600


def flat_threads(spark, sources, path, n=6):
    from sentimart.sinks.files import write_entity_files
    from sentimart.schemas import COMMENT_THREAD, with_field
    df = spark.read.schema(with_field(COMMENT_THREAD, "source")).parquet(threads(spark, sources, n))
    write_entity_files(df, path, "source")
    return path


def test_a_second_run_opens_only_new_and_changed_files(spark):
    import os
    from sentimart.sources.files import LoadError, list_files, select_files
    flat, out = scratch_path(spark, "flat"), scratch_path(spark, "out")
    flat_threads(spark, ["s_9", "s_10", "s_11", "other"], flat)
    assert sorted(os.listdir(flat.removeprefix("file:"))) and len(list_files(spark, flat).collect()) == 4
    kw = {"flat_files": True, "only_new": True}
    got = {r["source"] for r in first(spark, flat, out, start=9, end=11, **kw).collect()}
    assert got == {"s_9", "s_10"}                              # half open; a name without a number is not selected
    chosen = select_files(list_files(spark, flat), None, None, C.read_files(spark, out))
    assert {r["path"].rsplit("/")[-1] for r in chosen.collect()} == {"s_11.parquet", "other.parquet"}
    assert {r["source"] for r in first(spark, flat, out, **kw).collect()} == {"s_11", "other"}
    with pytest.raises(LoadError):
        first(spark, flat, out, **kw)
    before = state(spark, out)
    assert len(before[0]) == 16 and len(before[1]) == 8
    more = flat_threads(spark, ["s_10"], scratch_path(spark, "flat"), n=9)
    os.replace(more.removeprefix("file:") + "/s_10.parquet", flat.removeprefix("file:") + "/s_10.parquet")
    crc = flat.removeprefix("file:") + "/.s_10.parquet.crc"
    if os.path.exists(crc):                                    # the old checksum is not that of the new file
        os.remove(crc)
    assert {r["source"]: r["total_rows"] for r in first(spark, flat, out, **kw).collect()} == {"s_10": 9}
    after = state(spark, out)
    assert len(after[0]) == 18 and len(after[1]) == 9           # its rows replaced the old ones
    with pytest.raises(ValueError):
        first(spark, flat, out, only_new=True)


def test_files_of_a_run_that_died_are_new(spark, monkeypatch):
    flat, out = flat_threads(spark, ["s_1"], scratch_path(spark, "flat")), scratch_path(spark, "out")

    def die(*a, **kw):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(C.runs, "commit", die)
        with pytest.raises(RuntimeError):
            first(spark, flat, out, flat_files=True, only_new=True)
    assert C.read_files(spark, out).count() == 0
    assert first(spark, flat, out, flat_files=True, only_new=True).count() == 1


def test_retry_rows_follow_a_run_that_died(spark, tmp_path, monkeypatch):
    """between the repeated pass and the retry, one pass classifies and
    writes everything but its commit; no reader sees it."""
    spark.range(120).selectExpr(
        "id + 1 AS l_orderkey", "CAST(id % 7 AS INT) AS l_linenumber", "id % 60 AS l_partkey", "id % 11 AS l_suppkey",
        "element_at(array('A', 'N', 'R'), CAST(id % 3 + 1 AS INT)) AS l_returnflag", "IF(id % 2 = 0, 'O', 'F') AS l_linestatus",
        "CAST(id % 50 AS DOUBLE) AS l_quantity", "timestamp_seconds(id * 86400) AS l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    outs, kept = [], Q._rows
    monkeypatch.setattr(Q, "_rows", lambda s, out: (outs.append(out), kept(s, out))[1])
    got = {(r["commentid"], r["status"]) for r in Q.q_comments_retry_rows(spark, str(tmp_path)).collect()}
    ids = [i for i in range(120) if (i + 1) % 23]
    assert got == {(f"{i + 1}-{i % 7}", "failed" if i % 3 == 1 and i % 2 == 0 and (i + 1) % 5 == 0 else "processed") for i in ids}
    out, = outs
    assert {c.run_id for c in runs.all_commits(spark, out)} == {"first", "retry"}
    dead = {f: runs.dead_attempts(spark, out, f) for f in (C.CLASSIFIED, C.PROCESSED, C.AUDIT)}
    assert [len(d) for d in dead.values()] == [2, 2, 2]                # the replaced attempt and the one that died
    logged = spark.read.parquet(*dead[C.AUDIT]).where("run_id = 'died'").agg(F.sum("total_rows"), F.sum("processed_rows")).first()
    assert tuple(logged) == (len(ids), len(ids))
