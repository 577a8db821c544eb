"""DuckDB twins of the adapters and marts, for the correctness oracle.

Each entry of :data:`CTES` mirrors one Spark definition in
``sentimart.sources.adapters`` / ``sentimart.plans``.  Conventions: ``||``
(NULL-propagating) instead of ``concat``; explicit ``NULLS FIRST``; every
``row_number`` has a total order; counts BIGINT, percentages DOUBLE.
"""

from __future__ import annotations

from .functions.text import PY_WHITESPACE
from .schemas import SENTINEL, VIDEO_LINK_PREFIX

STRIP = f"'^{PY_WHITESPACE}+|{PY_WHITESPACE}+$'"


def strip(expr: str) -> str:
    return f"regexp_replace({expr}, {STRIP}, '', 'g')"


def pct(n: str, total: str) -> str:
    """Percentage to two places, half up, in exact decimals."""
    whole = f"(10000 * ({n})::HUGEINT) // ({total})"
    up = f"((10000 * ({n})::HUGEINT) % ({total})) * 2 >= ({total})"
    return f"(({whole} + ({up})::INT)::DOUBLE / 100.0::DOUBLE)"


RAW_TITLE = """CASE p_partkey % 6
    WHEN 0 THEN '  ' || p_name || ' | ' || p_type
    WHEN 1 THEN 'Essentials: ' || p_name || ' | ' || p_type
    WHEN 2 THEN 'AMA #' || CAST(p_size AS VARCHAR) || ': ' || p_name
    WHEN 3 THEN 'LIVE EVENT Q&A: ' || p_name || ' '
    WHEN 4 THEN p_brand || ': ' || p_name || ' | ' || p_type
    ELSE p_name || ' | ' || p_brand || ': x' END"""

# Flat top-level comments of the comment-thread adapter.
THREADS_SQL = """SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS commentid,
   CAST(l_partkey AS VARCHAR) AS videoid,
   strftime(l_shipdate, '%Y-%m-%d') AS publishedat,
   trim('  ' || l_returnflag || l_linestatus || ' comment on ' || CAST(l_partkey AS VARCHAR)
        || CASE WHEN l_orderkey % 5 = 0 THEN '! ' ELSE ' ' END, ' ') AS textoriginal,
   '@user' || CAST(l_suppkey AS VARCHAR) AS authordisplayname,
   'img/u' || CAST(l_suppkey AS VARCHAR) AS authorprofileimageurl,
   'channel/u' || CAST(l_suppkey AS VARCHAR) AS authorchannelurl,
   CASE WHEN l_orderkey % 23 <> 0 THEN CAST(trunc(l_quantity) AS BIGINT) END AS likecount,
   CAST(l_linenumber - 1 AS BIGINT) AS totalreplycount
 FROM lineitem"""

CTES: dict[str, str] = {}

CTES["videos"] = f"""videos AS (
  SELECT videoid, split_part(st, '|', 1) AS title,
         CASE WHEN strpos(st, ':') > 0 THEN split_part(st, ':', 1) ELSE 'N/A' END AS guest,
         description, publisheddate, duration, thumbnailimageurl, viewcount, likescount, commentscount
  FROM (SELECT CAST(p_partkey AS VARCHAR) AS videoid,
               {strip(RAW_TITLE)} AS st,
               {strip("' ' || p_name || chr(10) || p_type || '  '")} AS description,
               CAST('2024-01-' || lpad(CAST(1 + p_size % 28 AS VARCHAR), 2, '0') AS DATE) AS publisheddate,
               'PT' || CAST(p_size AS VARCHAR) || 'M' || CAST(p_partkey % 60 AS VARCHAR) || 'S' AS duration,
               CASE WHEN p_partkey % 13 <> 0 THEN 'img/' || CAST(p_partkey AS VARCHAR) || '/maxres.jpg' END
                 AS thumbnailimageurl,
               CASE WHEN p_partkey % 97 <> 0 THEN CAST(floor(p_retailprice) AS BIGINT) END AS viewcount,
               CAST(p_size AS BIGINT) AS likescount,
               CAST(p_size * 3 AS BIGINT) AS commentscount
        FROM part) v)"""

CTES["comments"] = """comments AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS commentid,
         CAST(l_partkey + (l_partkey % 10 = 0)::INT AS VARCHAR) AS videoid,
         CAST(l_shipdate AS DATE) AS publishedat,
         l_returnflag || l_linestatus || ' qty ' || CAST(CAST(trunc(l_quantity) AS BIGINT) AS VARCHAR)
           AS textoriginal,
         CASE l_returnflag WHEN 'A' THEN 'joy' WHEN 'R' THEN 'anger' ELSE 'neutral' END AS emotion,
         CASE WHEN l_returnflag = 'A' THEN 'positive' WHEN l_returnflag = 'R' THEN 'negative'
              WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'neutral' ELSE 'unknown' END
           AS sentimentnature,
         '@user' || CAST(l_suppkey AS VARCHAR) AS authordisplayname,
         'img/u' || CAST(l_suppkey AS VARCHAR) AS authorprofileimageurl,
         'channel/u' || CAST(l_suppkey AS VARCHAR) AS authorchannelurl,
         CAST(trunc(l_quantity) AS BIGINT) AS likecount,
         CAST(l_linenumber AS BIGINT) AS totalreplycount
  FROM lineitem)"""

CTES["topics"] = """topics AS (
  SELECT CAST(p_partkey + (p_partkey % 5 = 0)::INT AS VARCHAR) AS videoid, unnest([p_type, p_brand]) AS topic FROM part)"""

COMMENT_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in [
    "videoid", "publishedat", "textoriginal", "emotion", "sentimentnature",
    "authordisplayname", "authorprofileimageurl", "authorchannelurl",
    "likecount", "totalreplycount"])

CTES["fn_comments"] = f"""fn_comments AS (
  SELECT commentid, videoid, publishedat, textoriginal, emotion, sentimentnature,
         authordisplayname, authorprofileimageurl, authorchannelurl, likecount, totalreplycount
  FROM (SELECT *, row_number() OVER (PARTITION BY commentid ORDER BY
          (emotion IS NULL OR emotion = '{SENTINEL}') ASC, {COMMENT_ORDER}) AS rw
        FROM comments) d
  WHERE rw = 1)"""

_VIDEO_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in [
    "title", "guest", "description", "publisheddate", "duration",
    "thumbnailimageurl", "viewcount", "likescount", "commentscount",
    "videocategory", "videolink"])

# written out apart from the library's rule
CATEGORY = """coalesce(CASE guest WHEN 'N/A' THEN 'Solo' WHEN 'Essentials' THEN 'Essentials' END,
    CASE left(guest, 3) WHEN 'AMA' THEN 'AMA' END, CASE left(guest, 4) WHEN 'LIVE' THEN 'LIVE EVENT' END, 'WITH GUEST')"""

CTES["fn_videos"] = f"""fn_videos AS (
  SELECT videoid, title, guest, videocategory, videolink, description, publisheddate,
         duration, thumbnailimageurl, viewcount, likescount, commentscount
  FROM (SELECT *, row_number() OVER (PARTITION BY videoid ORDER BY {_VIDEO_ORDER}) AS rw
        FROM (SELECT *, {CATEGORY} AS videocategory,
                     '{VIDEO_LINK_PREFIX}' || videoid AS videolink
              FROM videos) e) d
  WHERE rw = 1)"""

# Filtered counts per video; a percentage is null-free because only videos
# with at least one of the three labels have a row.
_LABELS = {"positive": "positivecommentspercentage", "negative": "negativecommentspercentage",
           "neutral": "neutralcommentspercentage"}
CTES["sentimentnature_per"] = f"""sentimentnature_per AS (
  SELECT videoid, {", ".join(f"{pct('n_' + k, 'n_positive + n_negative + n_neutral')} AS {v}" for k, v in _LABELS.items())}
  FROM (SELECT videoid, {", ".join(f"count(*) FILTER (WHERE sentimentnature = '{k}') AS n_{k}" for k in _LABELS)}
        FROM fn_comments GROUP BY videoid) counted
  WHERE n_positive + n_negative + n_neutral > 0)"""

_LOWERED = ["title", "description", "videocategory", "guest"]
CTES["fn_bigtable"] = f"""fn_bigtable AS (
  SELECT v.* REPLACE ({", ".join(f"lower({c}) AS {c}" for c in _LOWERED)}),
         {", ".join(_LABELS.values())}, lower(topic) AS topic
  FROM (fn_videos v NATURAL LEFT JOIN sentimentnature_per) NATURAL LEFT JOIN topics)"""

CTES["fn_rk1_table"] = """fn_rk1_table AS (
  SELECT *, CAST(1 AS BIGINT) AS rank FROM fn_bigtable
  QUALIFY row_number() OVER (PARTITION BY topic ORDER BY viewcount DESC NULLS FIRST,
    likescount DESC NULLS FIRST, videoid NULLS FIRST, title NULLS FIRST) = 1)"""

# Which CTEs each CTE needs (in dependency order).
DEPS = {
    "videos": [], "comments": [], "topics": [],
    "fn_comments": ["comments"],
    "fn_videos": ["videos"],
    "sentimentnature_per": ["fn_comments"],
    "fn_bigtable": ["fn_videos", "sentimentnature_per", "topics"],
    "fn_rk1_table": ["fn_bigtable"],
}


def _closure(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        for d in DEPS.get(n, []):
            visit(d)
        if n not in out:
            out.append(n)
    for n in names:
        visit(n)
    return out


def with_views(names: list[str], body: str, extra: list[str] | None = None) -> str:
    """``WITH <needed CTEs>, <extra CTEs> <body>``."""
    parts = [CTES[n] for n in _closure(names)] + list(extra or [])
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body
