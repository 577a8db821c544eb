"""Adapters: the driver's test tables re-shaped into this data model.

Every view is a narrow projection / filter of one given table, so its size
grows with the table and Catalyst prunes the scan to the columns used.
``sentimart.oracle`` holds the DuckDB twin of each definition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c) -> F.Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def raw_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Video records as the video API returns them (nested structs, counts
    as text), one per ``part`` row; ``p_partkey`` plays the video id."""
    p = table(spark, sf_dir, "part")
    k, name, typ, brand, size = (F.col("p_partkey"), F.col("p_name"),
                                 F.col("p_type"), F.col("p_brand"),
                                 F.col("p_size"))
    m = k % 6
    title = (F.when(m == 0, F.concat(F.lit("  "), name, F.lit(" | "), typ))
             .when(m == 1, F.concat(F.lit("Essentials: "), name, F.lit(" | "), typ))
             .when(m == 2, F.concat(F.lit("AMA #"), _s(size), F.lit(": "), name))
             .when(m == 3, F.concat(F.lit("LIVE EVENT Q&A: "), name, F.lit(" ")))
             .when(m == 4, F.concat(brand, F.lit(": "), name, F.lit(" | "), typ))
             .otherwise(F.concat(name, F.lit(" | "), brand, F.lit(": x"))))
    published = F.concat(F.lit("2024-01-"),
                         F.lpad(_s(F.lit(1) + size % 28), 2, "0"),
                         F.lit("T00:00:00Z"))
    thumb = F.when(k % 13 != 0, F.struct(F.struct(
        F.concat(F.lit("img/"), _s(k), F.lit("/maxres.jpg")).alias("url")
    ).alias("maxres")))
    return p.select(
        _s(k).alias("id"),
        F.struct(published.alias("publishedAt"), title.alias("title"),
                 F.concat(F.lit(" "), name, F.lit("\n"), typ, F.lit("  "))
                 .alias("description"),
                 thumb.alias("thumbnails")).alias("snippet"),
        F.struct(F.when(k % 97 != 0, _s(F.floor("p_retailprice"))).alias("viewCount"),
                 _s(size).alias("likeCount"),
                 _s(size * 3).alias("commentCount")).alias("statistics"),
        F.struct(F.concat(F.lit("PT"), _s(size), F.lit("M"), _s(k % 60),
                          F.lit("S")).alias("duration")).alias("contentDetails"))


def raw_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel records (nested structs) derived from ``supplier``."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        F.concat(F.lit("UC"), _s(k)).alias("id"),
        F.struct(F.col("s_name").alias("title"),
                 F.concat(F.lit("About "), F.col("s_name"), F.lit("\nline two\n"))
                 .alias("description"),
                 F.concat(F.lit("@"), F.lower(F.replace(F.col("s_name"), F.lit("#"), F.lit(""))))
                 .alias("customUrl"),
                 F.concat(F.lit("2019-0"), _s(F.lit(1) + k % 9), F.lit("-15T12:00:00Z"))
                 .alias("publishedAt"),
                 F.when(k % 7 != 0, F.lit("US")).alias("country"),
                 F.struct(F.struct(F.concat(F.lit("img/ch"), _s(k), F.lit(".jpg"))
                                   .alias("url")).alias("high")).alias("thumbnails"))
        .alias("snippet"),
        F.struct(_s(k * 1000).alias("viewCount"),
                 _s(k * 10).alias("subscriberCount"),
                 _s(F.col("s_nationkey")).alias("videoCount")).alias("statistics"),
        F.struct(F.concat(F.lit("UU"), _s(k)).alias("uploads")).alias("contentDetails"))


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed ``comments`` table (11 columns) from ``lineitem``.

    ``commentid`` = order-line, which is *not* unique in the source, so the
    table carries genuine duplicates for the dedup operator.
    """
    return comments_of(table(spark, sf_dir, "lineitem"))


#: the columns of ``lineitem`` that :func:`comments_of` reads
COMMENT_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate", "l_quantity"]


def comments_of(li: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The comments of some ``lineitem`` rows, with the columns ``keep``."""
    # comments of every tenth video go to the next one: it has none
    video = F.col("l_partkey") + (F.col("l_partkey") % 10 == 0).cast("int")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return li.select(
        F.concat(_s("l_orderkey"), F.lit("-"), _s("l_linenumber")).alias("commentid"),
        _s(video).alias("videoid"),
        F.to_date("l_shipdate").alias("publishedat"),
        F.concat(flag, status, F.lit(" qty "), _s(F.col("l_quantity").cast("bigint")))
        .alias("textoriginal"),
        F.when(flag == "A", "joy").when(flag == "R", "anger").otherwise("neutral")
        .alias("emotion"),
        F.when(flag == "A", "positive").when(flag == "R", "negative")
        .when((flag == "N") & (status == "O"), "neutral").otherwise("unknown")
        .alias("sentimentnature"),
        F.concat(F.lit("@user"), _s("l_suppkey")).alias("authordisplayname"),
        F.concat(F.lit("img/u"), _s("l_suppkey")).alias("authorprofileimageurl"),
        F.concat(F.lit("channel/u"), _s("l_suppkey")).alias("authorchannelurl"),
        F.col("l_quantity").cast("bigint").alias("likecount"),
        F.col("l_linenumber").cast("bigint").alias("totalreplycount"), *keep)


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``topics`` (videoid, topic): two topics per row; every fifth video has
    none, its topics go to the next one."""
    p = table(spark, sf_dir, "part")
    video = F.col("p_partkey") + (F.col("p_partkey") % 5 == 0).cast("int")
    # one scan: each row yields its two topics
    return p.select(_s(video).alias("videoid"),
                    F.explode(F.array("p_type", "p_brand")).alias("topic"))


def comment_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested comment threads (the comment API's shape) from ``lineitem``.

    ``likeCount`` is NULL for one line in 23 so the not-null filter has
    work; text gets surrounding blanks so the trim has work.
    """
    return threads_of(table(spark, sf_dir, "lineitem"), keep=[F.col("l_partkey").alias("_part")])


def threads_of(li: DataFrame, keep: Sequence[str | F.Column] = ()) -> DataFrame:
    """The threads of some ``lineitem`` rows (``COMMENT_LINE``), with the
    columns ``keep``."""
    sk = _s("l_suppkey")
    inner = F.struct(
        F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("T08:30:00Z"))
        .alias("publishedAt"),
        F.concat(F.lit("  "), F.col("l_returnflag"), F.col("l_linestatus"),
                 F.lit(" comment on "), _s("l_partkey"),
                 F.when(F.col("l_orderkey") % 5 == 0, F.lit("! ")).otherwise(F.lit(" ")))
        .alias("textOriginal"),
        F.concat(F.lit("@user"), sk).alias("authorDisplayName"),
        F.concat(F.lit("img/u"), sk).alias("authorProfileImageUrl"),
        F.concat(F.lit("channel/u"), sk).alias("authorChannelUrl"),
        F.when(F.col("l_orderkey") % 23 != 0, F.col("l_quantity").cast("bigint"))
        .alias("likeCount"))
    return li.select(
        F.concat(_s("l_orderkey"), F.lit("-"), _s("l_linenumber")).alias("id"),
        F.struct(_s("l_partkey").alias("videoId"),
                 (F.col("l_linenumber") - 1).cast("bigint").alias("totalReplyCount"),
                 F.struct(inner.alias("snippet")).alias("topLevelComment"))
        .alias("snippet"), *keep)


def comment_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments to classify: whole ``documents`` texts."""
    d = table(spark, sf_dir, "documents")
    return d.select(_s("doc_id").alias("commentid"), F.col("source").alias("videoid"),
                    F.col("text").alias("textoriginal"))


def responses(spark: SparkSession, sf_dir: str, batch_size: int = 20) -> DataFrame:
    """Raw classifier responses, one row per batch of ``batch_size`` orders.

    Line ``i`` is ``Comment i: <priority>, <status>``; a batch numbered
    ``b`` (from 0) loses its last line when ``b % 7 = 0`` and line 3 loses
    its colon when ``b % 11 = 0``.  Built with one aggregation whose group
    size is bounded by ``batch_size``.
    """
    o = table(spark, sf_dir, "orders")
    b = F.floor(F.col("o_orderkey") / batch_size).cast("bigint")
    pos = (F.col("o_orderkey") % batch_size + 1).cast("int")
    lines = o.select(
        b.alias("batch_id"), pos.alias("pos"),
        F.format_string("Comment %d%s %s, %s", pos,
                        F.when((b % 11 == 0) & (pos == 3), F.lit("")).otherwise(F.lit(":")),
                        F.col("o_orderpriority"), F.col("o_orderstatus")).alias("line"))
    g = lines.groupBy("batch_id").agg(
        F.count("*").cast("int").alias("n_comments"),
        F.sort_array(F.collect_list(F.struct("pos", "line"))).alias("ls"))
    kept = F.when(F.col("batch_id") % 7 == 0,
                  F.slice("ls", 1, F.greatest(F.size("ls") - 1, F.lit(0)))).otherwise(F.col("ls"))
    return g.select("batch_id", "n_comments",
                    F.array_join(F.transform(kept, lambda x: x["line"]), "\n").alias("response"))
