"""Hot keys (a third of all rows on one key) give the same answers as a
brute-force pandas computation, and the plans keep their map-side
reduction; plus the stream's exactly-once restart."""

from fractions import Fraction
import math

import pandas as pd
from pyspark.sql import functions as F

from sentimart.operators.joins import left_join_fanout
from sentimart.plans import marts, warehouse
from sentimart.schemas import SENTINEL, SENTIMENTS
from sentimart.sources import adapters as A

from paths import SF_SMALL


def hot_comments(spark):
    c = A.comments(spark, SF_SMALL)
    k = F.split("commentid", "-")[0].cast("bigint")
    hot = k % 3 == 0
    return c.withColumns({
        "commentid": F.when(hot, F.lit("hot-1")).otherwise(F.col("commentid")),
        "videoid": F.when(k % 3 == 1, F.lit("hotvideo")).otherwise(F.col("videoid")),
        "emotion": F.when(k % 7 == 0, F.lit(SENTINEL)).otherwise(F.col("emotion")),
    })


def brute_dedup(pdf: pd.DataFrame) -> pd.DataFrame:
    cols = [c for c in pdf.columns if c != "commentid"]
    pdf = pdf.assign(__f=(pdf["emotion"] == SENTINEL).astype(int))
    # NULLs first within every column, like the Spark total order
    key = pdf[["__f"] + cols].astype(object).where(pdf[["__f"] + cols].notna(), None)
    order = sorted(range(len(pdf)), key=lambda i: tuple(
        (0, "") if v is None else (1, v) for v in key.iloc[i].tolist()))
    ordered = pdf.iloc[order]
    return ordered.drop_duplicates("commentid", keep="first").drop(columns="__f")


def test_hot_comment_id_dedup_matches_brute_force(spark):
    c = hot_comments(spark)
    got = warehouse.fn_comments(c).toPandas()
    want = brute_dedup(c.toPandas())
    assert len(got) == len(want)
    g = got.sort_values("commentid").reset_index(drop=True)
    w = want[got.columns].sort_values("commentid").reset_index(drop=True)
    pd.testing.assert_frame_equal(g.astype(str), w.astype(str))


def test_hot_video_percentages_match_exact_arithmetic(spark):
    fc = warehouse.fn_comments(hot_comments(spark))
    got = {r.videoid: r for r in marts.sentiment_pct(fc).collect()}
    pdf = fc.toPandas()
    pdf = pdf[pdf.sentimentnature.isin(SENTIMENTS)]
    for vid, grp in pdf.groupby("videoid"):
        total = len(grp)
        for lab in SENTIMENTS:
            n = int((grp.sentimentnature == lab).sum())
            want = math.floor(Fraction(100 * n, total) * 100 + Fraction(1, 2)) / 100
            assert getattr(got[vid], marts.PCT_COLUMNS[lab]) == want
    assert "hotvideo" in got


def test_fanout_join_with_hot_key(spark):
    left = spark.createDataFrame([(f"v{i}", i) for i in range(50)] + [(None, -1)], "videoid string, x long")
    rows = [("v1", f"t{i}") for i in range(300)] + [(f"v{i}", "a") for i in range(2, 40)] + [(None, "n")]
    right = spark.createDataFrame(rows, "videoid string, topic string")
    got = left_join_fanout(left, right, "videoid").toPandas()
    want = left.toPandas().merge(right.toPandas().dropna(subset=["videoid"]), on="videoid", how="left")
    assert len(got) == len(want) == 300 + 38 + 12
    assert (got.topic.isna()).sum() == (want.topic.isna()).sum()


def test_stream_restart_processes_each_file_once(spark, tmp_path):
    from sentimart.queries.io_q import stage_threads
    from sentimart.streaming.incremental import run_comment_stream
    from sentimart.plans import comments as C
    from sentimart.sinks.files import write_parquet_partitioned
    threads = stage_threads(spark, SF_SMALL, fresh=True)  # this test adds files to it
    out = str(tmp_path / "out")
    run_comment_stream(spark, threads, out, max_files_per_trigger=50, sleep=lambda s: None)
    first = C.audit_log(spark, out).agg(F.sum("total_rows")).collect()[0][0]
    # new files arrive in new source folders; restart on the same checkpoint
    extra = spark.read.parquet(threads).where(F.col("source") == "comments_7") \
        .withColumn("source", F.lit("comments_999"))
    write_parquet_partitioned(extra, threads, ["source"], mode="append")
    run_comment_stream(spark, threads, out, max_files_per_trigger=50, sleep=lambda s: None)
    log = C.audit_log(spark, out)
    total = log.agg(F.sum("total_rows")).collect()[0][0]
    n_extra = C.extract_comments(extra).count()
    assert total == first + n_extra
    assert log.where("source = 'comments_999'").agg(F.sum("total_rows")).collect()[0][0] == n_extra
