"""Registered queries: warehouse tables, marts and their building blocks
(W1-W3, A1-A2, J1-J3, F3, F6, O1, C6-C10)."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import oracle as O
from ..catalog import register
from ..operators.aggregate import (conditional_sum_pivot, count_by_keys,
                                   ratio_to_group_total)
from ..operators.joins import left_join_fanout, left_join_one
from ..operators.windowing import dedup_by_key
from ..plans import marts, warehouse
from ..plans.cleaning import videos_table
from ..schemas import SENTIMENTS
from ..session import scratch_path
from ..sinks.files import publish_table
from ..sources import adapters as A


def videos(spark: SparkSession, sf: str) -> DataFrame:
    return videos_table(A.raw_videos(spark, sf))


def fn_comments_df(spark: SparkSession, sf: str) -> DataFrame:
    return warehouse.fn_comments(A.comments(spark, sf))


def fn_videos_df(spark: SparkSession, sf: str) -> DataFrame:
    return warehouse.fn_videos(videos(spark, sf))


def bigtable_df(spark: SparkSession, sf: str) -> DataFrame:
    fc = fn_comments_df(spark, sf)
    return marts.bigtable(fn_videos_df(spark, sf), marts.sentiment_pct(fc),
                          A.topics(spark, sf))


@register("fn_comments", O.with_views(["fn_comments"], "SELECT * FROM fn_comments"))
def q_fn_comments(spark: SparkSession, sf: str) -> DataFrame:
    return fn_comments_df(spark, sf)


@register("dedup_by_key", O.with_views(
    ["comments"],
    "SELECT commentid, videoid, sentimentnature, likecount FROM (SELECT *, row_number() OVER "
    "(PARTITION BY commentid ORDER BY " + O.COMMENT_ORDER + ") AS rw FROM comments) d WHERE rw = 1"))
def q_dedup_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_by_key(A.comments(spark, sf), "commentid").select(
        "commentid", "videoid", "sentimentnature", "likecount")


@register("fn_videos", O.with_views(["fn_videos"], "SELECT * FROM fn_videos"))
def q_fn_videos(spark: SparkSession, sf: str) -> DataFrame:
    return fn_videos_df(spark, sf)


@register("sentiment_pct", O.with_views(["sentimentnature_per"], "SELECT * FROM sentimentnature_per"))
def q_sentiment_pct(spark: SparkSession, sf: str) -> DataFrame:
    return marts.sentiment_pct(fn_comments_df(spark, sf))


@register("filter_in", O.with_views(
    ["comments"],
    "SELECT commentid, videoid, sentimentnature FROM comments "
    "WHERE sentimentnature = 'positive' OR sentimentnature = 'negative' OR sentimentnature = 'neutral'"))
def q_filter_in(spark: SparkSession, sf: str) -> DataFrame:
    c = A.comments(spark, sf)
    return c.where(F.col("sentimentnature").isin(*SENTIMENTS)).select(
        "commentid", "videoid", "sentimentnature")


@register("count_by_two_keys", O.with_views(
    ["fn_comments"],
    "SELECT videoid, sentimentnature, COUNT(sentimentnature) AS n FROM fn_comments "
    "GROUP BY videoid, sentimentnature"))
def q_count_by_two_keys(spark: SparkSession, sf: str) -> DataFrame:
    return count_by_keys(fn_comments_df(spark, sf), ["videoid", "sentimentnature"],
                         "sentimentnature", "n")


@register("ratio_to_group_total", O.with_views(
    ["fn_comments"],
    "SELECT videoid, sentimentnature, COUNT(sentimentnature) AS n, "
    + O.pct("COUNT(sentimentnature)", "SUM(COUNT(sentimentnature)) OVER (PARTITION BY videoid)")
    + " AS percentage FROM fn_comments "
    "WHERE sentimentnature IN ('positive', 'negative', 'neutral') GROUP BY videoid, sentimentnature"))
def q_ratio_to_group_total(spark: SparkSession, sf: str) -> DataFrame:
    c = fn_comments_df(spark, sf).where(F.col("sentimentnature").isin(*SENTIMENTS))
    return ratio_to_group_total(c, ["videoid", "sentimentnature"], "sentimentnature",
                                ["videoid"], name="percentage", count_name="n")


@register("conditional_sum_pivot", O.with_views(
    ["comments"],
    "SELECT videoid, "
    "CAST(SUM(CASE WHEN sentimentnature = 'positive' THEN likecount ELSE 0 END) AS DOUBLE) AS positive_likes, "
    "CAST(SUM(CASE WHEN sentimentnature = 'negative' THEN likecount ELSE 0 END) AS DOUBLE) AS negative_likes, "
    "CAST(SUM(CASE WHEN sentimentnature = 'neutral' THEN likecount ELSE 0 END) AS DOUBLE) AS neutral_likes "
    "FROM comments GROUP BY videoid"))
def q_conditional_sum_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return conditional_sum_pivot(
        A.comments(spark, sf), ["videoid"], "sentimentnature", "likecount",
        {"positive": "positive_likes", "negative": "negative_likes",
         "neutral": "neutral_likes"})


@register("left_join_one", O.with_views(
    ["fn_videos", "sentimentnature_per"],
    "SELECT a.videoid, a.viewcount, b.positivecommentspercentage, b.neutralcommentspercentage "
    "FROM fn_videos a LEFT JOIN sentimentnature_per b ON a.videoid = b.videoid"))
def q_left_join_one(spark: SparkSession, sf: str) -> DataFrame:
    v = fn_videos_df(spark, sf).select("videoid", "viewcount")
    p = marts.sentiment_pct(fn_comments_df(spark, sf)).select(
        "videoid", "positivecommentspercentage", "neutralcommentspercentage")
    return left_join_one(v, p, "videoid")


@register("left_join_fanout", O.with_views(
    ["fn_videos", "topics"],
    "SELECT a.videoid, a.videocategory, c.topic FROM fn_videos a "
    "LEFT JOIN topics c ON a.videoid = c.videoid"))
def q_left_join_fanout(spark: SparkSession, sf: str) -> DataFrame:
    v = fn_videos_df(spark, sf).select("videoid", "videocategory")
    return left_join_fanout(v, A.topics(spark, sf), "videoid")


@register("bigtable", O.with_views(["fn_bigtable"], "SELECT * FROM fn_bigtable"))
def q_bigtable(spark: SparkSession, sf: str) -> DataFrame:
    return bigtable_df(spark, sf)


@register("best_video_per_topic", O.with_views(["fn_rk1_table"], "SELECT * FROM fn_rk1_table"))
def q_best_video_per_topic(spark: SparkSession, sf: str) -> DataFrame:
    return marts.best_video_per_topic(bigtable_df(spark, sf))


@register("top1_per_topic", O.with_views(
    ["fn_bigtable"],
    "SELECT topic, videoid, viewcount, likescount, rank FROM (SELECT *, row_number() OVER "
    "(PARTITION BY topic ORDER BY viewcount DESC NULLS FIRST, likescount DESC NULLS FIRST, "
    "videoid ASC NULLS FIRST, title ASC NULLS FIRST) AS rank FROM fn_bigtable) r WHERE rank = 1"))
def q_top1_per_topic(spark: SparkSession, sf: str) -> DataFrame:
    return marts.best_video_per_topic(bigtable_df(spark, sf)).select(
        "topic", "videoid", "viewcount", "likescount", "rank")


@register("order_by_key", O.with_views(
    ["sentimentnature_per"], "SELECT * FROM sentimentnature_per ORDER BY videoid"))
def q_order_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return marts.sentiment_pct(fn_comments_df(spark, sf)).orderBy("videoid")


@register("publish_marts", O.with_views(["fn_rk1_table"], "SELECT * FROM fn_rk1_table"))
def q_publish_marts(spark: SparkSession, sf: str) -> DataFrame:
    """C6-C10 as a chain of stored tables; returns the last one, read back."""
    tables = marts.build_marts(videos(spark, sf), A.comments(spark, sf), A.topics(spark, sf),
                               scratch_path(spark, "marts"), prefix=f"m{uuid.uuid4().hex[:8]}_")
    return tables["fn_rk1_table"]


@register("table_replace", O.with_views(["fn_videos"], "SELECT * FROM fn_videos WHERE likescount > 25"))
def q_table_replace(spark: SparkSession, sf: str) -> DataFrame:
    """K7: a table, replaced once as a whole, then by rows that fail half
    way: what is left is the first replacement."""
    name, location = f"replaced_{uuid.uuid4().hex[:12]}", scratch_path(spark, "replaced")
    videos = fn_videos_df(spark, sf)
    publish_table(videos, name, location)
    publish_table(videos.where("likescount > 25"), name, location)
    broken = videos.withColumn("title", F.when(F.col("likescount") > 25, F.raise_error(F.lit("broken"))).otherwise(F.col("title")))
    try:
        publish_table(broken, name, location)
    except Exception as e:  # noqa: BLE001 - whatever the failed task is reported as
        if "broken" not in str(e):
            raise
        return spark.table(name)
    raise AssertionError("the broken rows were published")


@register("table_create_only", O.with_views(["fn_videos"], "SELECT * FROM fn_videos"))
def q_table_create_only(spark: SparkSession, sf: str) -> DataFrame:
    """K8: a second create of one name fails and changes nothing."""
    name, location = f"created_{uuid.uuid4().hex[:12]}", scratch_path(spark, "created")
    videos = fn_videos_df(spark, sf)
    publish_table(videos, name, location, mode="errorifexists")
    try:
        publish_table(videos.where("likescount > 25"), name, location, mode="errorifexists")
    except AnalysisException:
        return spark.table(name)
    raise AssertionError("the table was created twice")
