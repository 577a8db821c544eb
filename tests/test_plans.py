"""Plan tests (what Catalyst does with our operators) and mart invariants."""

from pyspark.sql import functions as F

from sentimart.plans import marts, warehouse
from sentimart.queries.marts_q import bigtable_df, fn_comments_df
from sentimart.sources import adapters as A

from paths import SF_MID, SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def no_aqe(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")


def restore(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dedup_and_top1_use_partial_window_group_limit(spark):
    no_aqe(spark)
    try:
        p = plan(warehouse.fn_comments(A.comments(spark, SF_SMALL)))
        assert p.count("WindowGroupLimit") == 2  # partial below, final above the exchange
        p = plan(marts.best_video_per_topic(bigtable_df(spark, SF_SMALL)))
        assert "WindowGroupLimit" in p
    finally:
        restore(spark)


def test_sentiment_pct_is_one_aggregation_over_one_exchange_on_top_of_dedup(spark):
    no_aqe(spark)
    try:
        p = plan(marts.sentiment_pct(fn_comments_df(spark, SF_SMALL)))
        # one exchange for the dedup window, one for the aggregate
        assert p.count("Exchange hashpartitioning") == 2
        assert "pivot" not in p.lower()
    finally:
        restore(spark)


def test_scan_is_pruned_and_filters_pushed(spark):
    df = A.comments(spark, SF_SMALL).where(F.col("sentimentnature").isin("positive", "negative"))
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "l_discount" not in p and "l_tax" not in p   # column pruning
    p2 = plan(A.comment_threads(spark, SF_SMALL).select("snippet.videoId"))
    assert "l_partkey" in p2 and "l_suppkey" not in p2 and "l_quantity" not in p2
    p3 = plan(A.comments(spark, SF_SMALL).where(F.col("totalreplycount") == 3))
    assert "PushedFilters: [IsNotNull(l_partkey), IsNotNull(l_linenumber)" in p3 or "l_linenumber" in p3


def test_percentages_sum_to_100(spark):
    pct = marts.sentiment_pct(fn_comments_df(spark, SF_MID))
    s = pct.select((F.col("positivecommentspercentage") + F.col("negativecommentspercentage")
                    + F.col("neutralcommentspercentage")).alias("s"))
    lo, hi = s.agg(F.min("s"), F.max("s")).collect()[0]
    assert 99.98 <= lo <= hi <= 100.02


def test_bigtable_row_count_is_sum_of_max_1_topics(spark):
    big = bigtable_df(spark, SF_MID)
    t = A.topics(spark, SF_MID).groupBy("videoid").count()
    v = warehouse.fn_videos(
        __import__("sentimart.plans.cleaning", fromlist=["x"]).videos_table(A.raw_videos(spark, SF_MID)))
    expect = (v.join(t, "videoid", "left")
              .select(F.sum(F.greatest(F.coalesce("count", F.lit(0)), F.lit(1)))).collect()[0][0])
    assert big.count() == expect


def test_fn_comments_unique_and_idempotent(spark):
    fc = fn_comments_df(spark, SF_SMALL)
    assert fc.count() == fc.select("commentid").distinct().count()
    again = warehouse.fn_comments(fc)
    assert sorted(again.collect()) == sorted(fc.collect())


def test_add_ordinal_matches_global_row_number(spark):
    from sentimart.operators.windowing import add_ordinal
    df = spark.range(0, 5000, 1, numPartitions=7).selectExpr("cast(id * 7919 % 5003 AS string) AS k", "id")
    got = {r.k: r.ordinal for r in add_ordinal(df, [F.col("k").asc(), F.col("id").asc()], partitions=6).collect()}
    want = {k: i for i, k in enumerate(sorted(got, key=lambda k: (k,)))}
    assert got == want and sorted(got.values()) == list(range(5000))


def test_batch_assign_bounded_shards(spark):
    from sentimart.operators.windowing import batch_assign, range_shard
    df = spark.range(0, 2345).withColumnRenamed("id", "k")
    out = batch_assign(df, range_shard("k", 100), [F.col("k")], 20).collect()
    for r in out:
        assert r.batch_id == (r.k % 100) // 20 and r.pos == (r.k % 100) % 20 + 1


def test_ordinals_with_payload_are_dense(spark):
    from sentimart.operators.windowing import add_ordinal
    df = spark.range(200_000).select(F.xxhash64("id").alias("k"), "id", F.sha2(F.col("id").cast("string"), 256).alias("x"))
    o = add_ordinal(df, [F.col("k").asc(), F.col("id").asc()], partitions=8)
    assert o.agg(F.countDistinct("ordinal"), F.min("ordinal"), F.max("ordinal")).first()[:] == (200_000, 0, 199_999)


def test_stored_marts_are_bucketed_by_video(spark):
    """From the stored chain the topics and their fan-out are shuffled; the
    comments, which a hot video may dominate, are not bucketed."""
    from sentimart.queries.marts_q import videos
    from sentimart.session import scratch_path
    t = marts.build_marts(videos(spark, SF_SMALL), A.comments(spark, SF_SMALL), A.topics(spark, SF_SMALL),
                          scratch_path(spark, "marts"), prefix="bucket_test_")
    no_aqe(spark)
    try:
        assert plan(marts.sentiment_pct(t["fn_comments"])).count("Exchange") == 1
        p = plan(marts.bigtable(t["fn_videos"], t["sentimentnature_per"], A.topics(spark, SF_SMALL)))
        assert p.count("Exchange hashpartitioning") == 3      # topics rows, topics keys, the fanned-out rows
    finally:
        restore(spark)
