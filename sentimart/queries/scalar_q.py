"""Registered queries: scalar functions (X*), projections (P*), filters
(F*), sort / limit / batching (O*), prompt and response handling
(A3, A4, X14-X16), cleaning (C1, C2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import oracle as O
from ..catalog import register
from ..functions import text as X
from ..operators import projection as P
from ..operators.aggregate import status_counts
from ..operators.ranks import rank_slice
from ..operators.responses import batch_prompt, explode_labels
from ..operators.windowing import batch_assign, range_shard
from ..plans.cleaning import VIDEO_CELLS, clean_channel, clean_videos
from ..plans.comments import extract_comments
from ..schemas import SENTINEL
from ..sources import adapters as A

SF_STRIP = O.strip

# ---------------------------------------------------------------- titles

TITLES_SQL = f"titles AS (SELECT CAST(p_partkey AS VARCHAR) AS videoid, {O.RAW_TITLE} AS rawtitle FROM part)"


def titles(spark: SparkSession, sf: str) -> DataFrame:
    return A.raw_videos(spark, sf).select(F.col("id").alias("videoid"),
                                          F.col("snippet.title").alias("rawtitle"))


@register("title_prefix", O.with_views([], f"SELECT videoid, split_part({SF_STRIP('rawtitle')}, '|', 1) AS title FROM titles", [TITLES_SQL]))
def q_title_prefix(spark, sf):
    return titles(spark, sf).select("videoid", X.title_prefix(X.strip_ws("rawtitle")).alias("title"))


_GUEST_SQL = (f"CASE WHEN strpos({SF_STRIP('rawtitle')}, ':') > 0 "
              f"THEN split_part({SF_STRIP('rawtitle')}, ':', 1) ELSE 'N/A' END")


@register("guest_prefix", O.with_views([], f"SELECT videoid, {_GUEST_SQL} AS guest FROM titles", [TITLES_SQL]))
def q_guest_prefix(spark, sf):
    return titles(spark, sf).select("videoid", X.guest_prefix(X.strip_ws("rawtitle")).alias("guest"))


@register("case_category", O.with_views(
    [], f"SELECT videoid, {O.CATEGORY} AS videocategory FROM (SELECT videoid, {_GUEST_SQL} AS guest FROM titles) g",
    [TITLES_SQL]))
def q_case_category(spark, sf):
    g = titles(spark, sf).select("videoid", X.guest_prefix(X.strip_ws("rawtitle")).alias("guest"))
    return g.select("videoid", X.video_category("guest").alias("videocategory"))


@register("like_prefix", O.with_views(
    [], f"SELECT videoid, guest FROM (SELECT videoid, {_GUEST_SQL} AS guest FROM titles) g "
    "WHERE guest LIKE 'AMA%' OR guest LIKE 'LIVE%'", [TITLES_SQL]))
def q_like_prefix(spark, sf):
    g = titles(spark, sf).select("videoid", X.guest_prefix(X.strip_ws("rawtitle")).alias("guest"))
    return g.where(F.col("guest").like("AMA%") | F.col("guest").like("LIVE%"))


@register("concat_link", O.with_views(
    [], "SELECT p_partkey, '" + O.VIDEO_LINK_PREFIX + "' || (CASE WHEN p_partkey % 50 <> 0 "
    "THEN CAST(p_partkey AS VARCHAR) END) AS videolink FROM part"))
def q_concat_link(spark, sf):
    p = A.table(spark, sf, "part")
    vid = F.when(F.col("p_partkey") % 50 != 0, F.col("p_partkey").cast("string"))
    return p.select("p_partkey", X.video_link(vid).alias("videolink"))


@register("lower_cols", "SELECT p_partkey, lower(p_name) AS name, lower(p_type) AS type, "
          "lower(p_brand) AS brand FROM part")
def q_lower_cols(spark, sf):
    p = A.table(spark, sf, "part")
    return p.select("p_partkey", F.lower("p_name").alias("name"), F.lower("p_type").alias("type"),
                    F.lower("p_brand").alias("brand"))


# ------------------------------------------------------- whitespace / text

_WRAP_SQL = "' ' || chr(9) || text || chr(10) || chr(160) || ' '"


def _wrapped(c):
    return F.concat(F.lit(" \t"), c, F.lit("\n\u00a0 "))


@register("str_strip_ws", f"SELECT doc_id, {O.strip(_WRAP_SQL)} AS text FROM documents")
def q_str_strip_ws(spark, sf):
    d = A.table(spark, sf, "documents")
    return d.select("doc_id", X.strip_ws(_wrapped(F.col("text"))).alias("text"))


@register("str_trim", f"SELECT conv_id, turn, trim({_WRAP_SQL}, ' ') AS text FROM conversations")
def q_str_trim(spark, sf):
    c = A.table(spark, sf, "conversations")
    return c.select("conv_id", "turn", X.trim_spaces(_wrapped(F.col("text"))).alias("text"))


@register("remove_newlines", "SELECT doc_id, replace(text, chr(10), '') AS text FROM documents")
def q_remove_newlines(spark, sf):
    d = A.table(spark, sf, "documents")
    return d.select("doc_id", X.remove_newlines("text").alias("text"))


_ISO_SQL = "strftime(o_orderdate, '%Y-%m-%d') || 'T' || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':15:00Z'"


def _iso(o):
    return F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T"),
                    F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0"), F.lit(":15:00Z"))


@register("iso_date_prefix", f"SELECT o_orderkey, substr({_ISO_SQL}, 1, 10) AS publishedat FROM orders")
def q_iso_date_prefix(spark, sf):
    o = A.table(spark, sf, "orders")
    return o.select("o_orderkey", X.iso_date_prefix(_iso(o)).alias("publishedat"))


@register("to_date_cast", "SELECT o_orderkey, TRY_CAST(substr(CASE WHEN o_orderkey % 17 = 0 THEN 'not-a-date' "
          f"ELSE {_ISO_SQL} END, 1, 10) AS DATE) AS publisheddate FROM orders")
def q_to_date_cast(spark, sf):
    o = A.table(spark, sf, "orders")
    s = F.when(F.col("o_orderkey") % 17 == 0, F.lit("not-a-date")).otherwise(_iso(o))
    return o.select("o_orderkey", X.to_date_lenient(s).alias("publisheddate"))


# label cells: "joy, positive" | "joy,positive" | "a, b, c" | "" | sentinel | NULL
_LABEL_SQL = f"""CASE o_orderkey % 6
  WHEN 0 THEN lower(o_orderpriority) || ', ' || CASE o_orderstatus WHEN 'F' THEN 'positive' ELSE 'negative' END
  WHEN 1 THEN 'joy,' || o_orderstatus
  WHEN 2 THEN 'a, b, c'
  WHEN 3 THEN ''
  WHEN 4 THEN '{SENTINEL}'
  ELSE NULL END"""


def _label(o):
    k = F.col("o_orderkey") % 6
    return (F.when(k == 0, F.concat(F.lower("o_orderpriority"), F.lit(", "),
                                    F.when(F.col("o_orderstatus") == "F", "positive").otherwise("negative")))
            .when(k == 1, F.concat(F.lit("joy,"), F.col("o_orderstatus")))
            .when(k == 2, F.lit("a, b, c")).when(k == 3, F.lit(""))
            .when(k == 4, F.lit(SENTINEL)))


@register("split_pair", f"""SELECT o_orderkey, trim(list_extract(string_split(l, ','), 1), ' ') AS emotion,
  trim(list_extract(string_split(l, ','), 2), ' ') AS sentimentnature FROM (SELECT o_orderkey, {_LABEL_SQL} AS l FROM orders) x""")
def q_split_pair(spark, sf):
    o = A.table(spark, sf, "orders")
    e, s = X.split_pair(_label(o))
    return o.select("o_orderkey", e.alias("emotion"), s.alias("sentimentnature"))


# ------------------------------------------------------- nested projections

_THREAD_SQL = O.THREADS_SQL


@register("nested_extract", f"SELECT commentid, videoid, likecount FROM ({_THREAD_SQL}) t")
def q_nested_extract(spark, sf):
    return P.nested_extract(A.comment_threads(spark, sf), {
        "commentid": "id", "videoid": "snippet.videoId",
        "likecount": "snippet.topLevelComment.snippet.likeCount"})


@register("extract_comments", f"SELECT * FROM ({_THREAD_SQL}) t WHERE likecount IS NOT NULL")
def q_extract_comments(spark, sf):
    return extract_comments(A.comment_threads(spark, sf))


@register("filter_not_null", f"SELECT commentid, likecount FROM ({_THREAD_SQL}) t WHERE likecount IS NOT NULL")
def q_filter_not_null(spark, sf):
    flat = P.nested_extract(A.comment_threads(spark, sf), {
        "commentid": "id", "likeCount": "snippet.topLevelComment.snippet.likeCount"})
    # lower-case name resolves the camel-case column (case-insensitive analysis)
    return flat.where(F.col("likecount").isNotNull()).select("commentid", F.col("likeCount").alias("likecount"))


@register("project_reorder", O.with_views(
    ["comments"], "SELECT totalreplycount, commentid, videoid, emotion FROM comments"))
def q_project_reorder(spark, sf):
    return P.project_reorder(A.comments(spark, sf), ["totalreplycount", "commentid", "videoid", "emotion"])


@register("rename_columns", "SELECT CAST(p_partkey AS VARCHAR) AS videoid, CAST(p_size AS VARCHAR) AS likescount, "
          "CAST(p_size * 3 AS VARCHAR) AS commentscount FROM part")
def q_rename_columns(spark, sf):
    flat = P.flatten_struct(A.raw_videos(spark, sf).select("id", "statistics"), "statistics")
    return P.rename_columns(flat, {"id": "videoid", "likeCount": "likescount",
                                   "commentCount": "commentscount", "absent": "x"}).drop("viewCount")


@register("drop_columns", "SELECT CAST(p_partkey AS VARCHAR) AS id, "
          "'PT' || CAST(p_size AS VARCHAR) || 'M' || CAST(p_partkey % 60 AS VARCHAR) || 'S' AS duration FROM part")
def q_drop_columns(spark, sf):
    flat = P.flatten_struct(A.raw_videos(spark, sf), "contentDetails")
    return P.drop_columns(flat, ["snippet", "statistics", "not_there"])


@register("star_plus_expr", O.with_views(
    ["videos"], f"SELECT *, {O.CATEGORY} AS videocategory, '{O.VIDEO_LINK_PREFIX}' || videoid AS videolink FROM videos"))
def q_star_plus_expr(spark, sf):
    from .marts_q import videos
    return P.star_plus(videos(spark, sf), {"videocategory": X.video_category("guest"),
                                           "videolink": X.video_link("videoid")})


@register("flatten_struct", "SELECT CAST(p_partkey AS VARCHAR) AS id, "
          "'2024-01-' || lpad(CAST(1 + p_size % 28 AS VARCHAR), 2, '0') || 'T00:00:00Z' AS publishedAt, "
          f"{O.RAW_TITLE} AS title, ' ' || p_name || chr(10) || p_type || '  ' AS description, "
          "CASE WHEN p_partkey % 13 <> 0 THEN 'img/' || CAST(p_partkey AS VARCHAR) || '/maxres.jpg' END "
          "AS \"thumbnails.maxres.url\" FROM part")
def q_flatten_struct(spark, sf):
    return P.flatten_struct(A.raw_videos(spark, sf).select("id", "snippet"), "snippet")


def drifting_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Video records with a dict cell whose fields drift: missing, nested
    deeper, of another type, Python and JSON spellings."""
    k = F.col("id").cast("bigint")
    extra = (F.when(k % 5 == 0, F.concat(F.lit("{'n': "), F.col("id"), F.lit(", 'live': True}")))
             .when(k % 5 == 1, F.concat(F.lit('{"n": '), F.col("id"), F.lit('.5, "mixed": 1, "tags": ["a", "b"]}')))
             .when(k % 5 == 2, F.concat(F.lit("{'deep': {'x.y': {'z': '"), F.col("id"), F.lit("'}}, 'mixed': 'text', 'n': None}")))
             .when(k % 5 == 3, F.lit("not a dict")))
    return video_literals(spark, sf).select("id", "statistics", extra.alias("extra"))


@register("flatten_discovered", "SELECT CAST(p_partkey AS VARCHAR) AS id, "
          "CAST(p_size * 3 AS VARCHAR) AS commentCount, CAST(p_size AS VARCHAR) AS likeCount, "
          "CASE WHEN p_partkey % 97 <> 0 THEN CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) END AS viewCount, "
          "CASE WHEN p_partkey % 3 = 0 THEN false END AS hiddenSubscriberCount, "
          "CASE p_partkey % 5 WHEN 2 THEN CAST(p_partkey AS VARCHAR) END AS \"deep.x.y.z\", "
          "CASE p_partkey % 5 WHEN 0 THEN true END AS live, "
          "CASE p_partkey % 5 WHEN 1 THEN '1' WHEN 2 THEN 'text' END AS mixed, "
          "CASE p_partkey % 5 WHEN 0 THEN p_partkey::DOUBLE WHEN 1 THEN p_partkey + 0.5::DOUBLE END AS n, "
          "CASE p_partkey % 5 WHEN 1 THEN 'a,b' END AS tags FROM part")
def q_flatten_discovered(spark, sf):
    """P7 with the fields found in the data."""
    out = P.flatten_discovered(drifting_cells(spark, sf), ["statistics", "extra"])
    return out.withColumn("tags", F.array_join("tags", ","))


_JUNK_VIEWS = ("CASE WHEN p_partkey % 31 = 0 THEN NULL WHEN p_partkey % 97 = 0 THEN NULL "
               "ELSE CAST(floor(p_retailprice) AS BIGINT) END")


@register("cast_counts", f"SELECT CAST(p_partkey AS VARCHAR) AS id, {_JUNK_VIEWS} AS viewCount, "
          "CAST(p_size AS BIGINT) AS likeCount FROM part")
def q_cast_counts(spark, sf):
    st = P.flatten_struct(A.raw_videos(spark, sf).select("id", "statistics"), "statistics")
    junk = st.withColumn("viewCount", F.when(F.col("id").cast("bigint") % 31 == 0, F.lit("n/a"))
                         .otherwise(F.col("viewCount")))
    return P.cast_counts(junk.select("id", "viewCount", "likeCount"), ["viewCount", "likeCount"])


@register("count_rejects", f"SELECT 'viewCount' AS column_name, CAST(count(v) AS BIGINT) AS n_good, "
          "CAST(count(*) FILTER (WHERE p_partkey % 31 = 0) AS BIGINT) AS n_rejected "
          f"FROM (SELECT p_partkey, {_JUNK_VIEWS} AS v FROM part) t "
          "UNION ALL SELECT 'likeCount', CAST(count(p_size) AS BIGINT), CAST(0 AS BIGINT) FROM part")
def q_count_rejects(spark, sf):
    st = P.flatten_struct(A.raw_videos(spark, sf).select("id", "statistics"), "statistics")
    junk = st.withColumn("viewCount", F.when(F.col("id").cast("bigint") % 31 == 0, F.lit("n/a"))
                         .otherwise(F.col("viewCount")))
    return P.count_rejects(junk, ["viewCount", "likeCount"])


# ----------------------------------------------------- dict cells

@register("unreadable_cells", "SELECT CAST(p_partkey AS VARCHAR) AS id FROM part WHERE p_partkey % 37 = 0")
def q_unreadable_cells(spark, sf):
    """Dict cells that lost their last character."""
    v = video_literals(spark, sf).withColumn("statistics", F.when(
        F.col("id").cast("bigint") % 37 == 0, F.expr("left(statistics, char_length(statistics) - 1)"))
        .otherwise(F.col("statistics")))
    return P.unreadable_cells(v, "statistics", VIDEO_CELLS["statistics"]).select("id")


def _py_repr_str(c):
    """Python ``repr`` of a str column for the plain characters used here:
    single quotes, with ``\\n`` escaped (a backslash forces the fallback)."""
    return F.concat(F.lit("'"), F.replace(c, F.lit("\n"), F.lit("\\n")), F.lit("'"))


def video_literals(spark: SparkSession, sf: str) -> DataFrame:
    """Video records as the video API's CSV export holds them: each dict
    column is the Python ``repr`` of the dict, with ``True`` / ``None``
    for some videos (so both parse paths are exercised)."""
    r = A.raw_videos(spark, sf)
    k = F.col("id").cast("bigint")
    sn = F.col("snippet")
    thumb = F.when(sn["thumbnails"].isNotNull(), F.concat(
        F.lit(", 'thumbnails': {'maxres': {'url': "), _py_repr_str(sn["thumbnails"]["maxres"]["url"]),
        F.lit(", 'width': 1280}}")))
    snippet = F.concat(
        F.lit("{'publishedAt': "), _py_repr_str(sn["publishedAt"]),
        F.lit(", 'title': "), _py_repr_str(sn["title"]),
        F.lit(", 'description': "), _py_repr_str(sn["description"]),
        F.coalesce(thumb, F.lit("")),
        F.when(k % 4 == 0, F.lit(", 'defaultAudioLanguage': None")).otherwise(F.lit("")),
        F.lit("}"))
    st = F.col("statistics")
    stats = F.concat(
        F.lit("{"), F.when(st["viewCount"].isNotNull(),
                           F.concat(F.lit("'viewCount': "), _py_repr_str(st["viewCount"]), F.lit(", ")))
        .otherwise(F.lit("")),
        F.lit("'likeCount': "), _py_repr_str(st["likeCount"]),
        F.lit(", 'commentCount': "), _py_repr_str(st["commentCount"]),
        F.when(k % 3 == 0, F.lit(", 'hiddenSubscriberCount': False")).otherwise(F.lit("")),
        F.lit("}"))
    cd = F.concat(F.lit("{'duration': "), _py_repr_str(F.col("contentDetails.duration")),
                  F.lit(", 'caption': 'false', 'licensedContent': True}"))
    return r.select("id", snippet.alias("snippet"), stats.alias("statistics"), cd.alias("contentDetails"))


@register("parse_struct_column", "SELECT CAST(p_partkey AS VARCHAR) AS id, "
          f"{O.RAW_TITLE} AS title, ' ' || p_name || chr(10) || p_type || '  ' AS description, "
          "CASE WHEN p_partkey % 13 <> 0 THEN 'img/' || CAST(p_partkey AS VARCHAR) || '/maxres.jpg' END AS thumb FROM part")
def q_parse_struct_column(spark, sf):
    parsed = P.parse_struct_column(video_literals(spark, sf), "snippet", VIDEO_CELLS["snippet"])
    return parsed.select("id", F.col("snippet.title").alias("title"),
                         F.col("snippet.description").alias("description"),
                         F.col("snippet.thumbnails.maxres.url").alias("thumb"))


@register("clean_videos", O.with_views(
    ["videos"], "SELECT videoid, title, guest, description, publisheddate AS publishedat, duration, "
    "thumbnailimageurl, viewcount AS viewscount, likescount, commentscount FROM videos"))
def q_clean_videos(spark, sf):
    return clean_videos(video_literals(spark, sf))


def channel_literals(spark: SparkSession, sf: str) -> DataFrame:
    r = A.raw_channels(spark, sf)
    sn = F.col("snippet")
    snippet = F.concat(
        F.lit("{'title': "), _py_repr_str(sn["title"]),
        F.lit(", 'description': "), _py_repr_str(sn["description"]),
        F.lit(", 'customUrl': "), _py_repr_str(sn["customUrl"]),
        F.lit(", 'publishedAt': "), _py_repr_str(sn["publishedAt"]),
        F.lit(", 'thumbnails': {'high': {'url': "), _py_repr_str(sn["thumbnails"]["high"]["url"]), F.lit("}}"),
        F.when(sn["country"].isNotNull(), F.concat(F.lit(", 'country': "), _py_repr_str(sn["country"])))
        .otherwise(F.lit("")),
        F.lit("}"))
    st = F.col("statistics")
    stats = F.concat(F.lit("{'viewCount': "), _py_repr_str(st["viewCount"]),
                     F.lit(", 'subscriberCount': "), _py_repr_str(st["subscriberCount"]),
                     F.lit(", 'hiddenSubscriberCount': False, 'videoCount': "),
                     _py_repr_str(st["videoCount"]), F.lit("}"))
    cd = F.concat(F.lit("{'relatedPlaylists': {'likes': '', 'uploads': "),
                  _py_repr_str(F.col("contentDetails.uploads")), F.lit("}}"))
    return r.select("id", snippet.alias("snippet"), stats.alias("statistics"), cd.alias("contentDetails"))


@register("clean_channel", """SELECT 'UC' || CAST(s_suppkey AS VARCHAR) AS channelid, s_name AS channeltitle,
  'About ' || s_name || 'line two' AS description,
  '@' || lower(replace(s_name, '#', '')) AS channelcustomurl,
  '2019-0' || CAST(1 + s_suppkey % 9 AS VARCHAR) || '-15' AS publishedat,
  CASE WHEN s_suppkey % 7 <> 0 THEN 'US' END AS channelcountry,
  CAST(s_suppkey * 1000 AS VARCHAR) AS viewscount, CAST(s_suppkey * 10 AS VARCHAR) AS subscribercount,
  CAST(s_nationkey AS VARCHAR) AS videoscount, 'img/ch' || CAST(s_suppkey AS VARCHAR) || '.jpg' AS channelthumbnailurl
FROM supplier""")
def q_clean_channel(spark, sf):
    return clean_channel(channel_literals(spark, sf))


# ------------------------------------------------- ordinals, batches, prompts

@register("ordinal_slice", "SELECT videoid, ordinal FROM (SELECT CAST(p_partkey AS VARCHAR) AS videoid, "
          "row_number() OVER (ORDER BY CAST(p_partkey AS VARCHAR)) - 1 AS ordinal FROM part) o "
          "WHERE ordinal >= 200 AND ordinal < 280")
def q_ordinal_slice(spark, sf):
    ids = A.table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("videoid"))
    return rank_slice(ids, ["videoid"], 200, 280)


@register("ordinal_slice_wide", "SELECT * EXCLUDE (rn), rn AS ordinal FROM (SELECT *, row_number() OVER ("
          "ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS rn "
          "FROM lineitem) o WHERE rn >= (SELECT count(*) // 2 FROM lineitem) "
          "AND rn < (SELECT count(*) // 2 FROM lineitem) + 1000")
def q_ordinal_slice_wide(spark, sf):
    """O5 in the middle of the largest table, over six columns: whole rows."""
    lines = A.table(spark, sf, "lineitem")
    middle = lines.count() // 2
    return rank_slice(lines, ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"],
                      middle, middle + 1000)


@register("batch_assign", "SELECT o_orderkey, o_orderkey // 1000 AS shard, "
          "CAST((row_number() OVER w - 1) // 20 AS BIGINT) AS batch_id, "
          "CAST((row_number() OVER w - 1) % 20 + 1 AS INTEGER) AS pos FROM orders "
          "WINDOW w AS (PARTITION BY o_orderkey // 1000 ORDER BY o_orderkey)")
def q_batch_assign(spark, sf):
    o = A.table(spark, sf, "orders").select("o_orderkey", range_shard("o_orderkey", 1000).alias("shard"))
    return batch_assign(o, F.col("shard"), [F.col("o_orderkey")], 20)


_BATCHED_DOCS_SQL = ("SELECT doc_id // 1000 AS shard, CAST((row_number() OVER w - 1) // 20 AS BIGINT) AS batch_id, "
                     "CAST((row_number() OVER w - 1) % 20 + 1 AS INTEGER) AS pos, text FROM documents "
                     "WINDOW w AS (PARTITION BY doc_id // 1000 ORDER BY doc_id)")


@register("batch_prompt", "SELECT shard, batch_id, CAST(count(*) AS INTEGER) AS n_comments, "
          "string_agg('Comment ' || CAST(pos AS VARCHAR) || ': ' || text, chr(10) ORDER BY pos) AS prompt "
          f"FROM ({_BATCHED_DOCS_SQL}) b GROUP BY shard, batch_id")
def q_batch_prompt(spark, sf):
    d = A.table(spark, sf, "documents").select("doc_id", "text", range_shard("doc_id", 1000).alias("shard"))
    b = batch_assign(d, F.col("shard"), [F.col("doc_id")], 20)
    return batch_prompt(b, ["shard", "batch_id"], "pos", "text")


RESPONSES_SQL = """responses AS (
  SELECT batch_id, CAST(count(*) AS INTEGER) AS n_comments,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '') AS response
  FROM (SELECT batch_id, pos, line,
               batch_id % 7 = 0 AND pos = max(pos) OVER (PARTITION BY batch_id) AS dropped
        FROM (SELECT o_orderkey // 20 AS batch_id, CAST(o_orderkey % 20 + 1 AS INTEGER) AS pos,
                     'Comment ' || CAST(o_orderkey % 20 + 1 AS VARCHAR)
                     || CASE WHEN (o_orderkey // 20) % 11 = 0 AND o_orderkey % 20 + 1 = 3 THEN '' ELSE ':' END
                     || ' ' || o_orderpriority || ', ' || o_orderstatus AS line
              FROM orders) l) d
  GROUP BY batch_id)"""

PARSED_SQL = f"""parsed AS (
  SELECT batch_id, CAST(pos AS INTEGER) AS pos,
         CASE WHEN len(ls) <> n_comments THEN '{SENTINEL}'
              WHEN strpos(ls[pos], ':') > 0 THEN {O.strip("substr(ls[pos], strpos(ls[pos], ':') + 1)")}
              ELSE '{SENTINEL}' END AS label
  FROM (SELECT batch_id, n_comments, string_split({O.strip("response")}, chr(10)) AS ls,
               unnest(generate_series(1, n_comments)) AS pos FROM responses) e)"""


def parsed_responses(spark: SparkSession, sf: str) -> DataFrame:
    return explode_labels(A.responses(spark, sf), ["batch_id"], "response", "n_comments")


@register("parse_response_lines", f"WITH {RESPONSES_SQL}, {PARSED_SQL} SELECT * FROM parsed")
def q_parse_response_lines(spark, sf):
    return parsed_responses(spark, sf)


@register("validate_batch_size", f"WITH {RESPONSES_SQL}, {PARSED_SQL} "
          f"SELECT batch_id, CAST(count(*) AS BIGINT) AS n_comments, "
          f"CAST(count(*) FILTER (WHERE label = '{SENTINEL}') AS BIGINT) AS n_failed FROM parsed GROUP BY batch_id")
def q_validate_batch_size(spark, sf):
    return parsed_responses(spark, sf).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_comments"),
        F.count_if(F.col("label") == SENTINEL).alias("n_failed"))


@register("status_counts", f"WITH {RESPONSES_SQL}, {PARSED_SQL} "
          "SELECT CAST(count(*) AS BIGINT) AS total_rows, "
          f"CAST(count(*) FILTER (WHERE label <> '{SENTINEL}') AS BIGINT) AS processed_rows, "
          f"CAST(count(*) FILTER (WHERE label IS NULL OR label = '{SENTINEL}') AS BIGINT) AS unprocessed_rows FROM parsed")
def q_status_counts(spark, sf):
    p = parsed_responses(spark, sf)
    return status_counts(p, F.col("label") != SENTINEL)


@register("route_by_sentinel", f"WITH {RESPONSES_SQL}, {PARSED_SQL} "
          f"SELECT batch_id, pos FROM parsed WHERE label IS NULL OR label = '{SENTINEL}'")
def q_route_by_sentinel(spark, sf):
    p = parsed_responses(spark, sf)
    return p.where(F.col("label").isNull() | (F.col("label") == SENTINEL)).select("batch_id", "pos")


@register("limit_preview", O.with_views(
    ["fn_comments"], "SELECT commentid, videoid, emotion FROM fn_comments ORDER BY commentid LIMIT 20"))
def q_limit_preview(spark, sf):
    from .marts_q import fn_comments_df
    return fn_comments_df(spark, sf).orderBy("commentid").limit(20).select("commentid", "videoid", "emotion")
