"""One test per semantic trap and the string rules."""

import ast
import json
import math
import os
import tempfile
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentimart.functions import text as X
from sentimart.functions.pyliteral import literal_to_json_text
from sentimart.operators.projection import parse_struct_column
from sentimart.operators.windowing import dedup_by_key, top_n_per_group
from sentimart.schemas import SENTINEL
from sentimart.sinks.files import write_csv
from sentimart.sources.files import (LoadError, filter_by_suffix, load_skip_bad, load_strict,
                                     scan_csv, sort_by_suffix, source_label)


def one_col(spark, values, name="s", dtype=T.StringType()):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField(name, dtype)]))


def test_n1_n2_split_pair_never_raises_and_trims(spark):
    df = one_col(spark, ["joy, positive", "joy,positive", "a, b, c", "", SENTINEL, None])
    e, s = X.split_pair("s")
    got = [tuple(r) for r in df.select(e, s).collect()]
    assert got == [("joy", "positive"), ("joy", "positive"), ("a", "b"), ("", None),
                   (SENTINEL, None), (None, None)]


def test_strip_matches_python_and_trim_only_spaces(spark):
    samples = [" \t a b \n", " x ", "\r\nline\x0b", "  ", "", "x", "　y z "]
    df = one_col(spark, samples)
    got = [r[0] for r in df.select(X.strip_ws("s")).collect()]
    assert got == [s.strip() for s in samples]
    trimmed = [r[0] for r in df.select(X.trim_spaces("s")).collect()]
    assert trimmed == [s.strip(" ") for s in samples]


def test_titles_and_guest_rules(spark):
    titles = ["  solo | show ", "Essentials: x | y", "AMA #3: x", "LIVE EVENT Q&A: x",
              "Dr. A: x | y", "a | b: c", "no marks", None]
    df = one_col(spark, titles).select(X.strip_ws("s").alias("t"))
    rows = df.select(X.title_prefix("t").alias("title"), X.guest_prefix("t").alias("g")).collect()
    expect_title = [t.strip().split("|")[0] if t is not None else None for t in titles]
    expect_guest = [(t.strip().split(":")[0] if ":" in t else "N/A") if t is not None else None
                    for t in titles]
    assert [r.title for r in rows] == expect_title
    assert [r.g for r in rows] == expect_guest  # N14: "a | b: c" -> "a | b"
    cats = [r[0] for r in df.select(X.video_category(X.guest_prefix("t"))).collect()]
    assert cats == ["Solo", "Essentials", "AMA", "LIVE EVENT", "WITH GUEST", "WITH GUEST",
                    "Solo", "WITH GUEST"]


def test_n5_percent_rounds_half_up_exactly(spark):
    pairs = [(n, t) for t in range(1, 161) for n in range(0, t + 1)]
    df = spark.createDataFrame(pairs, "n long, t long")
    got = {(r.n, r.t): r.p for r in df.select("n", "t", X.percent_of(F.col("n"), F.col("t")).alias("p")).collect()}
    for (n, t), p in got.items():
        exact = Fraction(100 * n, t)
        hundredths = math.floor(exact * 100 + Fraction(1, 2))
        assert p == hundredths / 100, (n, t, p)
    assert got[(23, 160)] == 14.38


def test_n6_nulls_rank_first_in_descending_order(spark):
    df = spark.createDataFrame([("t", "a", 10, 1), ("t", "b", None, 1), ("t", "c", 10, 5)],
                               "topic string, videoid string, viewcount long, likescount long")
    top = top_n_per_group(df, "topic", [F.col("viewcount").desc_nulls_first(),
                                        F.col("likescount").desc_nulls_first()])
    assert [r.videoid for r in top.collect()] == ["b"]


def test_n7_dedup_survivor_is_deterministic_and_idempotent(spark):
    rows = [("k", "z", 1), ("k", "a", 2), ("k", "a", 1), ("j", None, 3), ("j", "b", 0)]
    df = spark.createDataFrame(rows, "k string, v string, n long")
    for parts in (1, 3, 7):
        got = sorted(tuple(r) for r in dedup_by_key(df.repartition(parts), "k").collect())
        assert got == [("j", None, 3), ("k", "a", 1)]
    once = dedup_by_key(df, "k")
    assert sorted(once.collect()) == sorted(dedup_by_key(once, "k").collect())


def test_n3_csv_round_trip_keeps_every_cell(spark):
    cells = ['with "quotes"', "new\nline", "a,b", " lead", "trail ", "back\\slash", "", None, "N/A"]
    df = spark.createDataFrame(list(enumerate(cells)), "i long, s string")
    path = tempfile.mkdtemp(prefix="rt-", dir=os.environ.get("TMPDIR", "/tmp"))
    write_csv(df, path + "/out")
    back = scan_csv(spark, path + "/out", df.schema)
    assert sorted(back.collect()) == sorted(df.collect())


py_values = st.recursive(
    st.none() | st.booleans() | st.integers(-10**12, 10**12) | st.text(max_size=12),
    lambda c: st.lists(c, max_size=3) | st.dictionaries(st.text(max_size=5), c, max_size=3),
    max_leaves=8)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.sampled_from(["a", "b", "title"]), py_values, max_size=3))
def test_n4_literal_to_json_matches_ast(d):
    assert json.loads(literal_to_json_text(repr(d))) == json.loads(json.dumps(d))


def test_n4_both_parse_paths_agree_with_python(spark):
    dicts = [{"title": "plain", "n": "1"}, {"title": "It's", "n": "2"},
             {"title": 'both \' and "', "n": "3"}, {"title": "tab\there\nnl", "n": None},
             {"title": "\x41\x07bell", "n": "5", "flag": True}, {"title": "é ü 東京", "n": "6"},
             {"title": "a\\x41", "n": "7"}, {"n": "8"}]
    cells = [repr(d) for d in dicts] + [None]
    schema = T.StructType([T.StructField("title", T.StringType()), T.StructField("n", T.StringType())])
    df = spark.createDataFrame(list(enumerate(cells)), "i long, cell string")
    out = parse_struct_column(df, "cell", schema, "p").orderBy("i").collect()
    for row, cell in zip(out, cells):
        if cell is None:
            assert row.p is None
            continue
        d = ast.literal_eval(cell)
        assert (row.p.title, row.p.n) == (d.get("title"), d.get("n")), cell


def test_n15_bad_cell_in_unread_column_is_still_dropped(spark):
    d = tempfile.mkdtemp(prefix="load-")
    with open(f"{d}/a.csv", "w") as f:
        f.write("a,b,c\n1,2024-01-01,5\n2,bad,6\n3,2024-01-02\n4,2024-01-03,7,9\n5,2024-01-04,x\n")
    with open(f"{d}/skip.txt", "w") as f:
        f.write("a,b,c\n9,2024-01-01,9\n")
    s = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DateType()),
                      T.StructField("c", T.LongType())])
    good = load_skip_bad(spark, d, s)
    assert [r.a for r in good.select("a").collect()] == [1]  # only column a read
    assert good.count() == 1
    with pytest.raises(LoadError):
        load_strict(spark, d, s)


def test_s8_s13_o3_suffix_selection(spark):
    names = ["/x/a_9.parquet", "/x/a_10.parquet", "/x/__x_155.parquet", "/x/a.parquet",
             "/x/a_b.parquet", "/x/src=v_12/part-0.parquet"]
    df = one_col(spark, names, "path").withColumn("label", source_label("path"))
    labels = [r.label for r in df.collect()]
    assert labels == ["a_9", "a_10", "__x_155", "a", "a_b", "v_12"]
    picked = [r.label for r in filter_by_suffix(df, "label", 9, 13).collect()]
    assert sorted(picked) == ["a_10", "a_9", "v_12"]
    ordered = [r.label for r in sort_by_suffix(df, "label").collect()]
    assert ordered[:4] == ["a_9", "a_10", "v_12", "__x_155"]


def test_n9_missing_thumbnail_stays_null(spark):
    from sentimart.plans.cleaning import clean_videos
    raw = spark.createDataFrame([(
        "v1", repr({"publishedAt": "2024-02-03T10:00:00Z", "title": " T: x ", "description": " d "}),
        repr({"viewCount": "12", "likeCount": "junk"}), repr({"duration": "PT1M"}))],
        "id string, snippet string, statistics string, contentDetails string")
    r = clean_videos(raw).collect()[0]
    assert r.thumbnailimageurl is None and r.commentscount is None and r.likescount is None
    assert (r.title, r.guest, r.description, r.viewscount) == ("T: x", "T", "d", 12)
    assert str(r.publishedat) == "2024-02-03"


WS = [chr(c) for c in range(0x110000) if chr(c).isspace()]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(WS + list("ab:|c d​é")), max_size=12),
                min_size=50, max_size=50))
def test_strip_title_guest_match_python_on_random_text(spark, texts):
    df = one_col(spark, texts)
    got = df.select(X.strip_ws("s").alias("st")).select(
        "st", X.title_prefix("st").alias("t"), X.guest_prefix("st").alias("g")).collect()
    for s, r in zip(texts, got):
        st_ = s.strip()
        assert r.st == st_
        assert r.t == st_.split("|")[0]
        assert r.g == (st_.split(":")[0] if ":" in st_ else "N/A")


def test_n8_video_without_labelled_comments_has_null_percentages(spark):
    from sentimart.plans import marts
    videos = spark.createDataFrame(
        [("v1", "t", "g", "Solo", "l", "d", None, "PT1M", None, 5, 1, 1),
         ("v2", "t", "g", "Solo", "l", "d", None, "PT1M", None, 7, 1, 1)],
        "videoid string, title string, guest string, videocategory string, videolink string, "
        "description string, publisheddate date, duration string, thumbnailimageurl string, "
        "viewcount long, likescount long, commentscount long")
    comments = spark.createDataFrame([("c1", "v1", "positive"), ("c2", "v2", "unknown")],
                                     "commentid string, videoid string, sentimentnature string")
    topics = spark.createDataFrame([("v1", "Sleep")], "videoid string, topic string")
    big = {r.videoid: r for r in marts.bigtable(videos, marts.sentiment_pct(comments), topics).collect()}
    assert big["v1"].positivecommentspercentage == 100.0 and big["v1"].topic == "sleep"
    assert big["v2"].positivecommentspercentage is None and big["v2"].topic is None


def test_n10_every_page_is_kept(spark):
    from sentimart.session import scratch_path
    from sentimart.sources.pages import paged_fetch, store_pages
    sizes = {"a": 1, "b": 99, "c": 100, "d": 249, "e": 250}
    items = spark.createDataFrame([(e, f"{i:03}") for e, n in sizes.items() for i in range(n)], "videoid string, id string")
    path = scratch_path(spark, "pages")
    store_pages(items, "videoid", [F.col("id")], path, page_size=100)
    got = paged_fetch(spark, path)
    assert {r.entity: (r.n, r.p) for r in got.groupBy("entity").agg(
        F.count("*").alias("n"), F.countDistinct("page").alias("p")).collect()} == {
        "a": (1, 1), "b": (99, 1), "c": (100, 1), "d": (249, 3), "e": (250, 3)}
    assert got.where("cast(id as long) <> ordinal").count() == 0


def test_n11_directory_scan_has_no_listing_cap(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq
    for i in range(1050):
        pq.write_table(pa.table({"k": [i]}), str(tmp_path / f"v_{i}.parquet"))
    df = spark.read.parquet(str(tmp_path))
    assert df.count() == 1050
    assert filter_by_suffix(df.withColumn("label", source_label(F.col("_metadata.file_path"))),
                            "label", 200, 280).count() == 80


def test_n5_compat_scale6_rounding(spark):
    from decimal import ROUND_HALF_UP, Decimal
    pairs = [(n, t) for t in range(1, 130) for n in range(0, t + 1)]
    df = spark.createDataFrame(pairs, "n long, t long")
    got = {(r.n, r.t): r.p for r in df.select(
        "n", "t", X.percent_of(F.col("n"), F.col("t"), compat_scale6=True).alias("p")).collect()}
    for (n, t), p in got.items():
        q6 = (Decimal(n) / Decimal(t)).quantize(Decimal("0.000001"), ROUND_HALF_UP)
        want = (q6 * 100).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert p == float(want), (n, t, p, want)
    assert got[(1, 113)] == 0.89


@settings(max_examples=4, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from(list('ab "\',\n\\;é\t#\r')), max_size=10)),
                min_size=30, max_size=30))
def test_csv_dialect_round_trips_random_cells(spark, cells):
    df = spark.createDataFrame(list(enumerate(cells)), "i long, s string")
    path = tempfile.mkdtemp(prefix="rt-")
    write_csv(df, path + "/out")
    back = {r.i: r.s for r in scan_csv(spark, path + "/out", df.schema).collect()}
    assert back == dict(enumerate(cells))


@settings(max_examples=4, deadline=None)
@given(st.lists(st.fixed_dictionaries(
    {"title": st.text(alphabet=st.sampled_from(list("ab '\"\\\n\té()x41:,{}")), max_size=12),
     "n": st.one_of(st.none(), st.text(alphabet=st.sampled_from(list("0123 '\"")), max_size=4))},
    optional={"flag": st.booleans(), "extra": st.none()}), min_size=40, max_size=40))
def test_n4_parse_struct_column_matches_literal_eval(spark, dicts):
    schema = T.StructType([T.StructField("title", T.StringType()), T.StructField("n", T.StringType())])
    df = spark.createDataFrame([(i, repr(d)) for i, d in enumerate(dicts)], "i long, cell string")
    got = {r.i: (r.p.title, r.p.n) for r in parse_struct_column(df, "cell", schema, "p").collect()}
    assert got == {i: (d["title"], d["n"]) for i, d in enumerate(dicts)}


def test_n4_constants_are_read_in_the_jvm_and_only_outside_quotes(spark, monkeypatch):
    from sentimart.operators import projection

    def refuse(cell):
        return F.when(cell.isNotNull(), F.raise_error(F.lit("python path")).cast("string"))
    monkeypatch.setattr(projection, "literal_to_json", refuse)
    titles = ["True, None: False", "it's (True)", 'say "None"', "a\nTrue", "None", "x" * 200_000 + " True '" + "\n" * 50_000]
    dicts = [{"flag": True, "title": t, "n": None, "more": [False, None, True, 1.5e3]} for t in titles]
    schema = T.StructType([T.StructField("flag", T.BooleanType()), T.StructField("title", T.StringType()),
                           T.StructField("n", T.StringType())])
    df = spark.createDataFrame([(i, repr(d)) for i, d in enumerate(dicts)], "i long, cell string")
    got = {r.i: (r.p.flag, r.p.title, r.p.n) for r in parse_struct_column(df, "cell", schema, "p").collect()}
    assert got == {i: (True, t, None) for i, t in enumerate(titles)}


def test_unreadable_cells_and_count_rejects(spark):
    from sentimart.operators.projection import count_rejects, unreadable_cells
    schema = T.StructType([T.StructField("a", T.StringType())])
    cells = ["{'a': 'x'}", "{'a': 'x'", None, "{'a': None}", "{}", "no dict", "{'a': '\\x41'}", "{'a': ('x'}", ""]
    df = spark.createDataFrame(list(enumerate(cells)), "i long, cell string")
    assert sorted(r.i for r in unreadable_cells(df, "cell", schema).collect()) == [1, 5, 7, 8]
    counts = spark.createDataFrame([("1", "x"), (None, "2"), ("", "3")], "a string, b string")
    assert {tuple(r) for r in count_rejects(counts, ["a", "b"]).collect()} == {("a", 1, 1), ("b", 2, 1)}


def test_batches_of_text_ids_hold_every_id_once(spark):
    from sentimart.sources.fetch import id_batches
    ids = [f"dQw4-{i:05d}" for i in range(1_234)]
    rows = id_batches(spark.createDataFrame([(i,) for i in ids], "id string"), "id", size=50).collect()
    assert sorted(r.n_ids for r in rows) == [34] + [50] * 24
    assert sorted(x for r in rows for x in r.ids.split(",")) == ids


def test_failed_strict_load_leaves_nothing_behind(spark):
    from sentimart.session import shared_dir
    d = tempfile.mkdtemp(prefix="load-")
    with open(f"{d}/a.csv", "w") as f:
        f.write("a\n1\nx\n")
    here = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(here)) if os.path.isdir(here) else set()
    with pytest.raises(LoadError):
        load_strict(spark, d, T.StructType([T.StructField("a", T.LongType())]))
    assert (set(os.listdir(here)) if os.path.isdir(here) else set()) <= before


def test_clean_channel_keeps_every_page_and_only_removes_newlines(spark):
    from sentimart.plans.cleaning import clean_channel
    pages = [("UC1", {"title": "A", "description": "one\ntwo\r\nthree", "customUrl": "@a",
                      "publishedAt": "2019-05-15T12:00:00Z", "thumbnails": {"high": {"url": "u1"}}},
              {"viewCount": "10", "subscriberCount": "2", "hiddenSubscriberCount": False, "videoCount": "3"}),
             ("UC2", {"title": "B", "description": None, "publishedAt": "2020-01-02T00:00:00Z"},
              {"viewCount": "x"})]
    raw = spark.createDataFrame([(i, repr(s), repr(st), repr({"relatedPlaylists": {"uploads": "UU"}}))
                                 for i, s, st in pages],
                                "id string, snippet string, statistics string, contentDetails string")
    got = {r.channelid: r for r in clean_channel(raw).collect()}
    assert len(got) == 2                                          # every page kept (N10)
    a = got["UC1"]
    assert (a.description, a.publishedat, a.channelthumbnailurl, a.channelcountry) == (
        "onetwo\rthree", "2019-05-15", "u1", None)
    assert (a.viewscount, a.subscribercount, a.videoscount) == ("10", "2", "3")
    b = got["UC2"]
    assert b.description is None and b.viewscount == "x" and b.channelcustomurl is None
