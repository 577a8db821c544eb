"""Registered queries: sources and sinks.

Each query stages files derived from the given tables in the session's
shared folder (``spark.checkpoint.dir``), then reads them back through the
operator under test, so its work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import oracle as O
from ..catalog import register
from ..operators.projection import nested_extract
from ..operators.windowing import dedup_by_key, range_shard
from ..plans.cleaning import as_table
from ..plans.comments import extract_comments, extract_fields
from ..schemas import COMMENT_THREAD, COMMENTS, with_field
from ..session import open_files, scratch_path
from ..sinks.files import RECORDS_PER_FILE, write_csv, write_parquet_partitioned
from ..sources import adapters as A
from ..sources import fetch, pages
from ..sources.rejects import located_rejects
from ..sources.files import (filter_by_suffix, load_csv_table, load_skip_bad, load_strict, scan_csv,
                             scan_parquet, sort_by_suffix, source_label, suffix_of,
                             with_source_file)

N_SOURCES = 300  # comment files ("videos") the staged threads are spread over
N_LOCATED = 50   # files of the comment lines whose malformed ones are located

SOURCE_SQL_OF_VIDEO = f"'comments_' || CAST(CAST(videoid AS BIGINT) % {N_SOURCES} AS VARCHAR)"
SOURCE_SQL = f"'comments_' || CAST(l_partkey % {N_SOURCES} AS VARCHAR)"


# Input folders derived from the (read-only) test tables, written once per
# Spark application and test-data folder; callers that modify a folder
# ask for a fresh one.
_STAGED: dict[tuple[str, str, str], str] = {}


def _staged(spark: SparkSession, sf: str, kind: str, build, fresh: bool) -> str:
    key = (spark.sparkContext.applicationId, sf, kind)
    if fresh or key not in _STAGED:
        path = build()
        if fresh:
            return path
        _STAGED[key] = path
    return _STAGED[key]


def stage_threads(spark: SparkSession, sf: str, fresh: bool = False) -> str:
    """K3: nested comment threads, one folder per source label."""
    def build() -> str:
        lines = A.table(spark, sf, "lineitem").select(
            *A.COMMENT_LINE, F.concat(F.lit("comments_"), (F.col("l_partkey") % N_SOURCES).cast("string")).alias("source"))
        path = scratch_path(spark, "threads")
        write_parquet_partitioned(lines, path, ["source"], shape=lambda rows: A.threads_of(rows, keep=["source"]))
        return path
    return _staged(spark, sf, "threads", build, fresh)


_FLAT_SQL = f"""SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS commentid,
   CAST(l_partkey AS VARCHAR) AS videoid,
   CASE WHEN l_orderkey % 23 <> 0 THEN CAST(trunc(l_quantity) AS BIGINT) END AS likecount,
   {SOURCE_SQL} AS source, l_partkey % {N_SOURCES} AS suffix
 FROM lineitem"""


@register("scan_parquet", f"SELECT commentid, videoid, likecount, source FROM ({_FLAT_SQL}) t "
          "WHERE likecount IS NOT NULL")
def q_scan_parquet(spark, sf):
    threads = scan_parquet(spark, stage_threads(spark, sf), with_field(COMMENT_THREAD, "source"))
    return extract_comments(threads, keep=["source"]).select("commentid", "videoid", "likecount", "source")


_THREAD_SQL = f"SELECT *, {SOURCE_SQL_OF_VIDEO} AS source FROM ({O.THREADS_SQL}) t"


def _thread_rows(threads: DataFrame) -> DataFrame:
    """Whole threads, flat, without the not-null filter of the extractor."""
    return nested_extract(threads, {**extract_fields(), "source": "source"})


@register("sink_parquet_partitioned", _THREAD_SQL)
def q_sink_parquet_partitioned(spark, sf):
    """K3: what the sink wrote, row by row."""
    return _thread_rows(spark.read.parquet(stage_threads(spark, sf, fresh=True)))


@register("source_label", _THREAD_SQL)
def q_source_label(spark, sf):
    """Each row with the label of its folder."""
    raw = with_source_file(spark.read.schema(COMMENT_THREAD).option("recursiveFileLookup", "true")
                           .parquet(stage_threads(spark, sf)))
    return _thread_rows(raw.withColumn("source", source_label("source_file")))


@register("filter_by_suffix", f"SELECT commentid, source FROM ({_FLAT_SQL}) t "
          "WHERE likecount IS NOT NULL AND suffix >= 200 AND suffix < 280")
def q_filter_by_suffix(spark, sf):
    threads = scan_parquet(spark, stage_threads(spark, sf), with_field(COMMENT_THREAD, "source"))
    picked = filter_by_suffix(threads, "source", 200, 280)
    return extract_comments(picked, keep=["source"]).select("commentid", "source")


@register("sort_by_suffix", f"SELECT DISTINCT source, CAST(suffix AS BIGINT) AS suffix FROM ({_FLAT_SQL}) t")
def q_sort_by_suffix(spark, sf):
    labels = spark.read.parquet(stage_threads(spark, sf)).select("source").distinct()
    return sort_by_suffix(labels, "source").select("source", suffix_of("source").alias("suffix"))


# ------------------------------------------------------------------- CSV

def _comment_strings(spark: SparkSession, sf: str) -> DataFrame:
    return A.comments(spark, sf).select(*[F.col(c).cast("string").alias(c) for c in COMMENTS.fieldNames()])


_COMMENT_STR_SQL = O.with_views(["comments"], "SELECT " + ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}" for c in COMMENTS.fieldNames()) + " FROM comments")


@register("scan_csv_header", _COMMENT_STR_SQL)
def q_scan_csv_header(spark, sf):
    path = scratch_path(spark, "csv")
    write_csv(_comment_strings(spark, sf), path)
    return scan_csv(spark, path, T.StructType([T.StructField(c, T.StringType()) for c in COMMENTS.fieldNames()]))


@register("typed_schema_cast", O.with_views(["comments"], "SELECT * FROM comments"))
def q_typed_schema_cast(spark, sf):
    path = scratch_path(spark, "csv")
    write_csv(_comment_strings(spark, sf), path)
    strings = scan_csv(spark, path, T.StructType([T.StructField(f"_c{i}", T.StringType())
                                                  for i in range(len(COMMENTS.fields))]))
    return as_table(strings, COMMENTS)


_DOC_CELL_SQL = ("CASE WHEN doc_id % 99 = 0 THEN NULL WHEN doc_id % 99 = 1 THEN '' "
                 "WHEN doc_id % 9 = 2 THEN '  \"quoted\", with comma' || chr(10) || 'and \\\\ backslash ' || text "
                 "ELSE text END")


def _doc_cells(spark: SparkSession, sf: str) -> DataFrame:
    d = A.table(spark, sf, "documents")
    k, few = F.col("doc_id") % 9, F.col("doc_id") % 99
    cell = (F.when(few == 0, F.lit(None).cast("string")).when(few == 1, F.lit(""))
            .when(k == 2, F.concat(F.lit('  "quoted", with comma\nand \\\\ backslash '), F.col("text"))).otherwise(F.col("text")))
    return d.select("doc_id", cell.alias("text"), "lang")


@register("sink_csv_roundtrip", f"SELECT doc_id, {_DOC_CELL_SQL} AS text, lang FROM documents")
def q_sink_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    write_csv(_doc_cells(spark, sf), path)
    return scan_csv(spark, path, T.StructType([T.StructField("doc_id", T.LongType()),
                                               T.StructField("text", T.StringType()),
                                               T.StructField("lang", T.StringType())]))


@register("scan_csv_multiline", "SELECT doc_id, text, length(text) - length(replace(text, chr(10), '')) AS newlines "
          "FROM documents")
def q_scan_csv_multiline(spark, sf):
    path = scratch_path(spark, "csv")
    write_csv(A.table(spark, sf, "documents").select("doc_id", "text"), path)
    back = scan_csv(spark, path, T.StructType([T.StructField("doc_id", T.LongType()),
                                               T.StructField("text", T.StringType())]))
    return back.select("doc_id", "text", (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))))
                       .cast("bigint").alias("newlines"))


@register("append_retry_union", "SELECT doc_id, lang FROM documents")
def q_append_retry_union(spark, sf):
    d = A.table(spark, sf, "documents").select("doc_id", "lang")
    path = scratch_path(spark, "csv")
    write_csv(d.where(F.col("doc_id") % 2 == 0), path, mode="overwrite")
    write_csv(d.where((F.col("doc_id") % 2 == 1) | (F.col("doc_id") % 3 == 0)), path, mode="append")  # overlaps on % 6
    back = scan_csv(spark, path, T.StructType([T.StructField("doc_id", T.LongType()),
                                               T.StructField("lang", T.StringType())]))
    return dedup_by_key(back, "doc_id")


# ------------------------------------------------------------------ loads

# bad rows: date, integer, too few fields, too many fields
_BAD = [(41, "date"), (43, "int"), (47, "short"), (53, "long")]


def _comment_lines(spark: SparkSession, sf: str, with_bad: bool) -> DataFrame:
    """The comments table as raw CSV lines (values contain no separator or
    quote), optionally with malformed lines keyed on the order number."""
    c = A.comments(spark, sf).withColumn("__ok", F.split("commentid", "-")[0].cast("bigint"))
    cols = [F.col(n).cast("string") for n in COMMENTS.fieldNames()]
    line = F.concat_ws(",", *[F.coalesce(x, F.lit("")) for x in cols])
    if with_bad:
        k = F.col("__ok")
        date_bad = F.concat_ws(",", *[F.lit("not-a-date") if n == "publishedat" else F.coalesce(x, F.lit(""))
                                      for n, x in zip(COMMENTS.fieldNames(), cols)])
        int_bad = F.concat_ws(",", *[F.lit("many") if n == "likecount" else F.coalesce(x, F.lit(""))
                                     for n, x in zip(COMMENTS.fieldNames(), cols)])
        short = F.concat_ws(",", *[F.coalesce(x, F.lit("")) for x in cols[:-1]])
        long_ = F.concat(line, F.lit(",extra"))
        line = (F.when(k % 41 == 0, date_bad).when(k % 43 == 0, int_bad)
                .when(k % 47 == 0, short).when(k % 53 == 0, long_).otherwise(line))
    return c.select(line.alias(",".join(COMMENTS.fieldNames())))


def _stage_lines(spark: SparkSession, sf: str, with_bad: bool) -> str:
    def build() -> str:
        path = scratch_path(spark, "load")
        # one string column per line; a tab separator means the commas inside
        # are written verbatim, and the column name is the header line
        (_comment_lines(spark, sf, with_bad).write.mode("overwrite")
         .option("header", "true").option("sep", "\t").option("quote", '"')
         .option("maxRecordsPerFile", RECORDS_PER_FILE).csv(path))
        return path
    return _staged(spark, sf, f"lines-{with_bad}", build, fresh=False)


@register("load_strict", O.with_views(["comments"], "SELECT * FROM comments"))
def q_load_strict(spark, sf):
    return load_strict(spark, _stage_lines(spark, sf, with_bad=False), COMMENTS)


_ORDERKEY = "CAST(split_part(commentid, '-', 1) AS BIGINT)"
_NOT_BAD = " AND ".join(f"{_ORDERKEY} % {m} <> 0" for m, _ in _BAD)


@register("load_skip_bad", O.with_views(["comments"], f"SELECT * FROM comments WHERE {_NOT_BAD}"))
def q_load_skip_bad(spark, sf):
    return load_skip_bad(spark, _stage_lines(spark, sf, with_bad=True), COMMENTS)


@register("load_rejects", O.with_views(
    ["comments"], f"SELECT CASE WHEN {_NOT_BAD} THEN 'good' ELSE 'rejected' END AS kind, "
    "CAST(count(*) AS BIGINT) AS n_rows FROM comments GROUP BY 1"))
def q_load_rejects(spark, sf):
    """What the tolerant load keeps and what it refuses."""
    good, bad = load_csv_table(spark, _stage_lines(spark, sf, with_bad=True), COMMENTS)
    kinds = good.select(F.lit("good").alias("kind")).unionByName(bad.select(F.lit("rejected").alias("kind")))
    return kinds.groupBy("kind").agg(F.count("*").alias("n_rows"))


def _stage_located(spark: SparkSession, sf: str) -> str:
    """Comment lines, malformed ones among them, one file a source in a
    known order; the text of some has a quoted line break."""
    def build() -> str:
        path = scratch_path(spark, "located")
        names = COMMENTS.fieldNames()
        # a source is one file, so one task's: a task has one source, whose
        # rows are moved as the few columns that they are made of
        number = "__source"
        body = (A.comments_of(A.table(spark, sf, "lineitem"), keep=A.COMMENT_LINE)
                .select(*A.COMMENT_LINE, (F.col("videoid").cast("bigint") % N_LOCATED).cast("int").alias(number), F.lit(1).alias("body")))
        header = body.select(number).distinct().select(
            *(F.lit(None).cast(f.dataType).alias(f.name) for f in body.schema.fields[:-2]), number, F.lit(0).alias("body"))
        moved = header.unionByName(body).repartitionById(N_LOCATED, F.col(number))
        c = A.comments_of(moved, keep=[number, "body"]).withColumns({
            "k": F.split("commentid", "-")[0].cast("bigint"),
            "source": F.concat(F.lit("s"), F.col(number).cast("string"))})
        cells = [F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names]
        two_lines = F.concat(F.lit('"'), F.col("textoriginal"), F.lit('\n""said"", once"'))
        cells[names.index("textoriginal")] = F.when(F.col("k") % 3 == 0, two_lines).otherwise(F.col("textoriginal"))
        def joined(**changed):
            return F.concat_ws(",", *[changed.get(n, x) for n, x in zip(names, cells)])
        line = (F.when(F.col("k") % 41 == 0, joined(publishedat=F.lit("not-a-date"))).when(F.col("k") % 43 == 0, joined(likecount=F.lit("many")))
                .when(F.col("k") % 47 == 0, F.concat_ws(",", *cells[:-1])).when(F.col("k") % 53 == 0, F.concat(joined(), F.lit(",extra")))
                .otherwise(joined()))
        value = F.when(F.col("body") == 0, F.lit(",".join(names))).otherwise(line)
        lines = c.sortWithinPartitions("source", "body", *names).select("source", value.alias("value"))
        with open_files(spark, 2):
            lines.write.partitionBy("source").text(path)
        return path
    return _staged(spark, sf, "located", build, fresh=False)


_LOCATED_SQL = O.with_views(["comments"], f"""SELECT source, line, column_name, reason FROM (
  SELECT *, 1 + n + coalesce(sum(CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY n
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS line,
    CASE WHEN k % 41 = 0 THEN 'publishedat' WHEN k % 43 = 0 THEN 'likecount' END AS column_name,
    CASE WHEN k % 41 = 0 THEN 'not a date: not-a-date' WHEN k % 43 = 0 THEN 'not a bigint: many'
      WHEN k % 47 = 0 THEN '10 fields of 11' WHEN k % 53 = 0 THEN '12 fields for 11' END AS reason
  FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY {", ".join(COMMENTS.fieldNames())}) AS n
        FROM (SELECT *, {_ORDERKEY} AS k, 's' || CAST(CAST(videoid AS BIGINT) % 50 AS VARCHAR) AS source FROM comments) a) b) c
  WHERE reason IS NOT NULL""")


@register("reject_places", _LOCATED_SQL)
def q_reject_places(spark, sf):
    """File, line, column and reason of every row the load skips."""
    bad = located_rejects(spark, _stage_located(spark, sf), COMMENTS, glob="*.txt")
    return bad.select(source_label("file").alias("source"), "line", "column_name", "reason")


# ---------------------------------------------------------- fetch

@register("id_batches_text", "SELECT batch_id, CAST(count(*) AS INTEGER) AS n_ids, "
          "string_agg(videoid, ',' ORDER BY videoid) AS ids FROM ("
          "SELECT 'v-' || CAST(p_partkey AS VARCHAR) AS videoid, CAST((row_number() OVER ("
          "ORDER BY 'v-' || CAST(p_partkey AS VARCHAR)) - 1) // 50 AS BIGINT) AS batch_id FROM part) b GROUP BY batch_id")
def q_id_batches_text(spark, sf):
    """S12 over ids that are texts: no integer shard exists."""
    ids = A.table(spark, sf, "part").select(F.concat(F.lit("v-"), F.col("p_partkey").cast("string")).alias("videoid"))
    return fetch.id_batches(ids, "videoid", size=50)


@register("id_batches", "SELECT shard, CAST(batch_id AS BIGINT) AS batch_id, CAST(count(*) AS INTEGER) AS n_ids, "
          "string_agg(videoid, ',' ORDER BY videoid) AS ids FROM ("
          "SELECT p_partkey // 1000 AS shard, CAST(p_partkey AS VARCHAR) AS videoid, "
          "(row_number() OVER (PARTITION BY p_partkey // 1000 ORDER BY CAST(p_partkey AS VARCHAR)) - 1) // 50 AS batch_id "
          "FROM part) b GROUP BY shard, batch_id")
def q_id_batches(spark, sf):
    ids = A.table(spark, sf, "part").select(range_shard("p_partkey", 1000).alias("shard"),
                                            F.col("p_partkey").cast("string").alias("videoid"))
    return fetch.id_batches(ids, "videoid", F.col("shard"), size=50)


def _page_sql(entity: str, rows: str, order: str, columns: str, size: int) -> str:
    """All pages of ``rows``: the entity, its page, the next page's token,
    the item's ordinal and its columns."""
    return (f"SELECT entity, n // {size} AS page, CASE WHEN (n // {size} + 1) * {size} < total "
            f"THEN CAST(n // {size} + 1 AS VARCHAR) END AS next_token, n AS ordinal, {columns} FROM ("
            f"SELECT CAST({entity} AS VARCHAR) AS entity, {columns}, count(*) OVER (PARTITION BY {entity}) AS total, "
            f"row_number() OVER (PARTITION BY {entity} ORDER BY {order}) - 1 AS n FROM ({rows}) r) p")


def _fetched(spark: SparkSession, items: DataFrame, entity: str, order: list, size: int) -> DataFrame:
    path = scratch_path(spark, "pages")
    pages.store_pages(items, entity, order, path, page_size=size)
    return pages.paged_fetch(spark, path).drop("span", "at")


_COMMENT_PAGE_ORDER = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity", "l_partkey", "l_shipdate"]


@register("paged_fetch", _page_sql(
    "source", f"SELECT {SOURCE_SQL} AS source, * FROM lineitem", ", ".join(_COMMENT_PAGE_ORDER),
    "l_orderkey, l_linenumber, l_partkey, l_extendedprice", pages.COMMENTS_PER_PAGE))
def q_paged_fetch(spark, sf):
    """The comment lines of each source, 100 a page."""
    lines = A.table(spark, sf, "lineitem").withColumn(
        "source", F.concat(F.lit("comments_"), (F.col("l_partkey") % N_SOURCES).cast("string")))
    items = lines.select("source", *_COMMENT_PAGE_ORDER)
    return (_fetched(spark, items, "source", [F.col(c) for c in _COMMENT_PAGE_ORDER], pages.COMMENTS_PER_PAGE)
            .select("entity", "page", "next_token", "ordinal", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"))


@register("paged_fetch_ids", _page_sql(
    "l_suppkey", "SELECT DISTINCT l_suppkey, CAST(l_partkey AS VARCHAR) AS videoid FROM lineitem", "videoid", "videoid",
    pages.IDS_PER_PAGE))
def q_paged_fetch_ids(spark, sf):
    """The video ids of each channel, 50 a page."""
    ids = A.table(spark, sf, "lineitem").select("l_suppkey", F.col("l_partkey").cast("string").alias("videoid")).distinct()
    return _fetched(spark, ids, "l_suppkey", [F.col("videoid")], pages.IDS_PER_PAGE)


# ------------------------------------------------------ warehouse load

@register("load_warehouse", "SELECT 'channel' AS table_name, CAST(count(*) AS BIGINT) AS n_rows FROM supplier "
          "UNION ALL SELECT 'videos', CAST(count(*) AS BIGINT) FROM part "
          "UNION ALL SELECT 'topics', CAST(2 * count(*) AS BIGINT) FROM part "
          "UNION ALL " + O.with_views(["comments"], f"SELECT 'comments', CAST(count(*) AS BIGINT) FROM comments "
                                      f"WHERE {_NOT_BAD}").replace("WITH ", "(WITH ", 1) + ")")
def q_load_warehouse(spark, sf):
    """The four cleaned files written as CSV folders, loaded back into
    the declared tables (strict for three, skip-bad for comments)."""
    from ..plans.cleaning import clean_channel, clean_videos
    from ..plans.warehouse import load_warehouse
    from .scalar_q import channel_literals, video_literals
    dirs = {}
    for name, df in (("channel", clean_channel(channel_literals(spark, sf))),
                     ("videos", clean_videos(video_literals(spark, sf))),
                     ("topics", A.topics(spark, sf))):
        dirs[name] = scratch_path(spark, name)
        write_csv(df, dirs[name])
    dirs["comments"] = _stage_lines(spark, sf, with_bad=True)
    tables = load_warehouse(spark, dirs)
    out = None
    for name, t in tables.items():
        c = t.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = c if out is None else out.unionByName(c)
    return out


@register("load_warehouse_videos", O.with_views(["videos"], "SELECT * FROM videos"))
def q_load_warehouse_videos(spark, sf):
    """The rows of a table that was loaded by position."""
    from ..plans.cleaning import clean_videos
    from ..plans.warehouse import load_warehouse
    from .scalar_q import video_literals
    path = scratch_path(spark, "videos")
    write_csv(clean_videos(video_literals(spark, sf)), path)
    return load_warehouse(spark, {"videos": path})["videos"]


@register("clean_videos_csv", O.with_views(
    ["videos"], "SELECT videoid, title, guest, description, publisheddate AS publishedat, duration, "
    "thumbnailimageurl, viewcount AS viewscount, likescount, commentscount FROM videos"))
def q_clean_videos_csv(spark, sf):
    """S3 + C2 end to end: the raw video export (dict-literal cells with
    commas, both quote kinds and escaped newlines) written as CSV, read
    back with the shared dialect, then cleaned."""
    from ..plans.cleaning import clean_videos
    from .scalar_q import video_literals
    path = scratch_path(spark, "raw-videos")
    write_csv(video_literals(spark, sf), path)
    raw = scan_csv(spark, path, T.StructType([T.StructField(c, T.StringType()) for c in
                                              ("id", "snippet", "statistics", "contentDetails")]))
    return clean_videos(raw)
