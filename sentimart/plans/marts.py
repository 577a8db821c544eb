"""Marts: sentiment percentages (C8), wide video-topic table (C9), best
video per topic (C10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import percent_of
from ..operators.joins import left_join_fanout, left_join_one
from ..operators.windowing import top_n_per_group
from ..schemas import SENTIMENTS
from ..sinks.files import publish_table
from . import warehouse

PCT_COLUMNS = {"positive": "positivecommentspercentage",
               "negative": "negativecommentspercentage",
               "neutral": "neutralcommentspercentage"}

BIGTABLE_COLUMNS = ["videoid", "title", "description", "thumbnailimageurl",
                    "videolink", "videocategory", "guest", "publisheddate",
                    "duration", "viewcount", "likescount", "commentscount",
                    "positivecommentspercentage", "negativecommentspercentage",
                    "neutralcommentspercentage", "topic"]


def sentiment_pct(fn_comments: DataFrame, compat_scale6: bool = False) -> DataFrame:
    """Per video, the share of positive / negative / neutral comments
    among comments carrying one of those three labels, in percent,
    rounded half-up to 2 places; a label with no comments gets 0.

    Same result as count-by-(video, label) -> window total -> pivot, but
    in ONE hash aggregation keyed by video: the per-label counts are
    conditional counts, their sum is the window total.  One shuffle of
    partial aggregates instead of three exchanges.  ``compat_scale6``
    selects the warehouse-style rounding (see ``percent_of``).
    """
    s = F.col("sentimentnature")
    labelled = fn_comments.select("videoid", "sentimentnature").where(s.isin(*SENTIMENTS))
    counts = labelled.groupBy("videoid").agg(
        *[F.count_if(s == lab).alias(f"__n_{lab}") for lab in SENTIMENTS])
    total = sum((F.col(f"__n_{lab}") for lab in SENTIMENTS), F.lit(0))
    return counts.select("videoid", *[
        percent_of(F.col(f"__n_{lab}"), total, compat_scale6=compat_scale6).alias(PCT_COLUMNS[lab])
        for lab in SENTIMENTS])


def bigtable(fn_videos: DataFrame, pct: DataFrame, topics: DataFrame) -> DataFrame:
    """Videos x percentages (J1) x topics (J2), five text columns
    lower-cased (X10); one row per (video, topic), NULL topic when none."""
    v = fn_videos.select(
        "videoid", F.lower("title").alias("title"),
        F.lower("description").alias("description"), "thumbnailimageurl",
        "videolink", F.lower("videocategory").alias("videocategory"),
        F.lower("guest").alias("guest"), "publisheddate", "duration",
        "viewcount", "likescount", "commentscount")
    t = topics.select("videoid", F.lower("topic").alias("topic"))
    # topics first: the fan-out evaluates its left side twice, and the
    # percentages are the expensive input
    return left_join_one(left_join_fanout(v, t, "videoid"), pct, "videoid").select(*BIGTABLE_COLUMNS)


def best_video_per_topic(big: DataFrame) -> DataFrame:
    """Per topic (NULL topic included) the video with most views,
    then most likes; NULL counts rank first as in the warehouse's
    descending order; ``videoid`` breaks remaining ties.  Keeps ``rank``."""
    order = [F.col("viewcount").desc_nulls_first(),
             F.col("likescount").desc_nulls_first()]
    return top_n_per_group(big, "topic", order, n=1, rank_col="rank",
                           tie_break=[F.col("videoid").asc_nulls_first(),
                                      F.col("title").asc_nulls_first()])


def build_marts(videos: DataFrame, comments: DataFrame, topics: DataFrame,
                location: str, prefix: str = "", buckets: int | None = None) -> dict[str, DataFrame]:
    """The warehouse chain as stored tables (CTAS, K7): ``fn_videos`` and
    ``fn_comments`` are written once and read by everything after them,
    so the comment dedup and the video cleaning run once even though the
    wide table reads the video dimension twice (inner + anti branches).

    ``fn_videos`` and the percentages, one row a video, are bucketed on
    ``videoid`` (``buckets``, default the shuffle partition count): the
    video joins then read co-partitioned buckets, and only ``topics`` is
    shuffled for the wide table."""
    n = buckets or int(videos.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def pub(name: str, df: DataFrame, bucketed: bool = False) -> DataFrame:
        return publish_table(df, f"{prefix}{name}", f"{location}/{name}",
                             bucket_by=(n, ["videoid"]) if bucketed else None)
    # the comments are not bucketed: a video may hold a third of them
    out = {"fn_videos": pub("fn_videos", warehouse.fn_videos(videos), True),
           "fn_comments": pub("fn_comments", warehouse.fn_comments(comments))}
    out["sentimentnature_per"] = pub("sentimentnature_per", sentiment_pct(out["fn_comments"]), True)
    out["fn_bigtable"] = pub("fn_bigtable", bigtable(out["fn_videos"], out["sentimentnature_per"], topics))
    out["fn_rk1_table"] = pub("fn_rk1_table", best_video_per_topic(out["fn_bigtable"]))
    return out
