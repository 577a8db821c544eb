"""Fault tests for the classifier stage (U1-U5, X15, X16) and the
comment jobs (C3, C4, K9, N12)."""

import pytest
from pyspark.sql import functions as F

from sentimart.operators import classify as K
from sentimart.operators.classify import (classify_comments, classify_slice, parse_response,
                                          rule_based_classifier, rule_label)
from sentimart.plans import comments as C
from sentimart.schemas import SENTINEL
from sentimart.session import scratch_path


def comments(spark, texts, parts=3):
    rows = [(str(i), f"v{i % 4}", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "commentid string, videoid string, textoriginal string").repartition(parts)


def test_parse_response_rules():
    assert parse_response("Comment 1: joy, positive\nComment 2: a: b, c", 2) == ["joy, positive", "a: b, c"]
    assert parse_response("\n Comment 1: x \r\n", 1) == ["x"]          # outer and \r stripped
    assert parse_response("Comment 1:\nnope", 2) == ["", SENTINEL]       # empty label counts
    with pytest.raises(ValueError):
        parse_response("Comment 1: a\n\nComment 2: b", 2)                # blank line is a line
    with pytest.raises(ValueError):
        parse_response("Comment 1: a", 3)                                 # short response


def test_retry_then_success_and_permanent_failure():
    calls, waits = [], []

    def flaky(texts):
        calls.append(1)
        if len(calls) < 3:
            raise TimeoutError
        return rule_based_classifier(texts)
    assert classify_slice(["great!", "x"], flaky, sleep=waits.append) == [
        rule_label("great!"), rule_label("x")]
    assert waits == [2, 4]

    def broken(texts):
        return "Comment 1: only one line"
    waits.clear()
    assert classify_slice(["a", "b"], broken, sleep=waits.append) == [SENTINEL, SENTINEL]
    assert waits == [2, 4]


def test_every_input_row_gets_exactly_one_output_row(spark):
    texts = [f"t{i} hate" if i % 7 == 0 else (None if i % 11 == 0 else f"t{i}") for i in range(203)]
    seen = []

    def counting(batch):
        seen.append(len(batch))
        return rule_based_classifier(batch)
    out = classify_comments(comments(spark, texts), classifier=counting).collect()
    assert len(out) == len(texts)
    by_id = {r.commentid: r for r in out}
    for i, t in enumerate(texts):
        r = by_id[str(i)]
        if t is None:
            assert (r.emotion, r.sentimentnature) == (SENTINEL, None)
        else:
            e, s = rule_label(t).split(", ")
            assert (r.emotion, r.sentimentnature) == (e, s)


def test_slices_span_arrow_batches(spark):
    def size_tagging(batch):  # local: pickled by value for the workers
        return "\n".join(f"Comment {i}: size{len(batch)}, neutral" for i in range(1, len(batch) + 1))

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = comments(spark, [f"c{i}" for i in range(45)] + [None], parts=1)
        out = K.label_partitions(df, "textoriginal", classifier=size_tagging).collect()
        assert len(out) == 46
        tags = sorted(r.label for r in out)
        # Arrow batches of 7 rows, yet slices of 20, 20 and the last 5 texts
        assert tags.count("size20, neutral") == 40 and tags.count("size5, neutral") == 5
        assert tags.count(SENTINEL) == 1
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_partition_affine_clients(spark):
    def make(tag):
        def clf(texts):
            return "\n".join(f"Comment {i}: {tag}, neutral" for i in range(1, len(texts) + 1))
        return clf
    df = comments(spark, [f"c{i}" for i in range(60)], parts=4)
    out = classify_comments(df, classifier=[make("k0"), make("k1")])
    got = out.select(F.spark_partition_id().alias("p"), "emotion").distinct().collect()
    for r in got:
        assert r.emotion == f"k{r.p % 2}"


def test_plan_has_one_python_stage(spark):
    df = classify_comments(comments(spark, ["a", "b"]))
    routed = df.where(F.col("emotion") != SENTINEL)
    plan = routed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") + plan.count("PythonMapInArrow") >= 1 and plan.count("MapIn") == 1
    assert "ArrowEvalPython" not in plan


def test_first_pass_then_retry_converges(spark):
    """Comments that fail first and succeed on retry leave the queue,
    and the audit log has one row per source and run."""
    from sentimart.queries.io_q import stage_threads
    from paths import SF_SMALL
    threads = stage_threads(spark, SF_SMALL)
    out = scratch_path(spark, "jobs")
    first = C.first_pass(spark, threads, out, classifier=K.picky_classifier, sleep=lambda s: None)
    f = first.agg(F.sum("total_rows"), F.sum("processed_rows"), F.sum("unprocessed_rows")).collect()[0]
    assert f[0] == f[1] + f[2] and f[2] > 0
    retry = C.retry_pass(spark, out, sleep=lambda s: None)
    r = retry.agg(F.sum("total_rows"), F.sum("processed_rows"), F.sum("unprocessed_rows")).collect()[0]
    assert (r[0], r[1], r[2]) == (f[2], f[2], 0)
    assert C.failed_comments(spark, out).count() == 0
    processed = C.processed_comments(spark, out)
    assert processed.count() == f[0]
    log = C.audit_log(spark, out)
    assert sorted(r.run_id.split("-")[0] for r in log.select("run_id").distinct().collect()) == ["first", "retry"]


def test_two_ranges_keep_both_queues_and_flat_files_work(spark):
    """A pass over other sources leaves the first one's failures in the
    queue; the same comments in one flat file per source give the same
    audit; an empty selection raises; a retry after a lost run repeats."""
    from sentimart.queries.io_q import stage_threads
    from sentimart.sources.files import LoadError
    from paths import SF_SMALL
    threads = stage_threads(spark, SF_SMALL)
    out = scratch_path(spark, "ranges")
    kw = {"classifier": K.picky_classifier, "sleep": lambda s: None}
    audits = [C.first_pass(spark, threads, out, a, b, **kw) for a, b in ((0, 150), (150, 300))]
    sums = [a.agg(F.count("*"), F.sum("unprocessed_rows")).first() for a in audits]
    assert all(n and bad for n, bad in sums) and C.failed_comments(spark, out).count() == sums[0][1] + sums[1][1]

    flat = scratch_path(spark, "flat")
    import pathlib
    import shutil
    root = pathlib.Path(threads.removeprefix("file:"))
    picked = sorted(root.glob("source=*"))[:5]
    pathlib.Path(flat.removeprefix("file:")).mkdir(parents=True)
    for folder in picked:
        part = next(folder.glob("*.parquet"))
        shutil.copy(part, f"{flat.removeprefix('file:')}/{folder.name.split('=')[1]}.parquet")
    got = C.first_pass(spark, flat, scratch_path(spark, "flat-out"), flat_files=True, **kw)
    assert {r.source for r in got.collect()} == {f.name.split("=")[1] for f in picked}
    with pytest.raises(LoadError):
        C.first_pass(spark, flat, out, 10**6, 10**6 + 1, flat_files=True, **kw)

    before = C.processed_comments(spark, out).count()
    C.retry_pass(spark, out, sleep=lambda s: None)
    C.retry_pass(spark, out, sleep=lambda s: None)      # nothing left to append
    assert C.processed_comments(spark, out).count() == before + sums[0][1] + sums[1][1]


def test_concurrency_and_rows_per_task_keep_results(spark):
    texts = [f"c{i}{'!' if i % 3 == 0 else ''}" for i in range(130)]
    base = {r.commentid: (r.emotion, r.sentimentnature)
            for r in classify_comments(comments(spark, texts)).collect()}
    out = classify_comments(comments(spark, texts), concurrency=4, rows_per_task=40)
    assert out.rdd.getNumPartitions() == 4
    got = {r.commentid: (r.emotion, r.sentimentnature) for r in out.collect()}
    assert got == base and len(got) == 130


def test_n13_optional_line_number_check():
    swapped = "Comment 2: a, positive\nComment 1: b, negative"
    assert parse_response(swapped, 2) == ["a, positive", "b, negative"]      # positional
    with pytest.raises(ValueError):
        parse_response(swapped, 2, check_numbers=True)
    waits = []
    assert classify_slice(["x", "y"], lambda t: swapped, sleep=waits.append,
                          check_numbers=True) == [SENTINEL, SENTINEL]


def test_wide_integers_and_nulls_pass_through_exactly(spark):
    rows = [("a", "t1", 2 ** 60 + 1), ("b", None, None), ("c", "t3", -(2 ** 62) - 7)]
    df = spark.createDataFrame(rows, "commentid string, textoriginal string, likecount long")
    got = {r.commentid: r.likecount for r in classify_comments(df).collect()}
    assert got == {"a": 2 ** 60 + 1, "b": None, "c": -(2 ** 62) - 7}


def test_catalyst_and_python_response_parsers_agree(spark):
    """X15/X16 exist twice (stored responses in Catalyst, live calls in the
    retry loop); both must read every response the same way."""
    import random
    from sentimart.operators.responses import validated_labels
    rng = random.Random(7)
    pieces = ["Comment 1: joy, positive", "Comment 2:  a: b ", "no colon here", "", " \t",
              "Comment 3:\r", ":", "x:\u00a0y\u2003", "Comment 9: é, neutral  "]
    rows = []
    for i in range(300):
        n = rng.randint(1, 4)
        lines = [rng.choice(pieces) for _ in range(rng.randint(0, 5))]
        lead, trail = rng.choice(["", "\n", " \n"]), rng.choice(["", "\n", "\r\n  "])
        rows.append((i, n, lead + "\n".join(lines) + trail))
    df = spark.createDataFrame(rows, "i long, n int, response string")
    got = {r.i: list(r.labels) for r in df.select("i", validated_labels(F.col("response"), F.col("n"))
                                                  .alias("labels")).collect()}
    for i, n, resp in rows:
        try:
            want = parse_response(resp, n)
        except ValueError:
            want = [SENTINEL] * n
        assert got[i] == want, (resp, n)
