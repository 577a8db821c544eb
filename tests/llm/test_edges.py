"""Every operator on nulls, empty and long texts, repeated rows, clashing
extra columns, and empty tables."""

import pytest
from pyspark.sql import functions as F

from sentimart.llm.decontaminate import benchmark_overlap
from sentimart.llm.language_id import identify_language
from sentimart.llm.line_dedup import _near, dedup_lines
from sentimart.llm.mixing import mix
from sentimart.llm.simhash import simhash_groups
from sentimart.llm.substring_dedup import dedup_word_windows
from sentimart.llm.suffix_dedup import dedup_byte_windows
from sentimart.llm.topk import top_k
from sentimart.llm.toxicity import score_toxicity
from sentimart.llm.url_filter import filter_urls


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, toxic int")


def by_id(df, column):
    return {r["doc_id"]: r[column] for r in df.collect()}


def test_word_windows(spark, edge_docs, no_docs):
    out = dedup_word_windows(edge_docs, cells=1 << 16).collect()
    assert len(out) == 13
    gone = [(r["doc_id"], r["n_words"], r["n_removed"]) for r in out]
    assert gone.count((5, 127, 0)) == 2          # repeated rows do not remove each other's words
    assert (6, 127, 127) in gone and (7, 128, 127) in gone
    assert (None, 127, 0) in gone                # no id: whole, and no part in it
    assert (1, 0, 0) in gone and (2, 0, 0) in gone
    # its windows repeat inside one document only
    assert (4, 30_000, 0) in gone
    assert dedup_word_windows(no_docs, cells=1 << 16).count() == 0


def test_byte_windows(spark, edge_docs, no_docs):
    out = dedup_byte_windows(edge_docs, cells=1 << 16).collect()
    assert len(out) == 13
    of = {}
    for r in out:
        of.setdefault(r["doc_id"], []).append(r)
    assert [r["n_removed"] for r in of[5]] == [0, 0]
    assert of[6][0]["kept"] == b"" and bytes(of[7][0]["kept"]) == b" more"
    assert of[None][0]["n_removed"] == 0 and of[1][0]["n_bytes"] == 0
    # repeats inside one document: of 5,000 equal bytes the first window stays but for its last 99
    assert of[10][0]["n_removed"] == 4_999 and [tuple(s) for s in of[10][0]["spans"]] == [(1, 5_000)]
    period = len(" ".join(f"word{i % 997}" for i in range(997))) + 1
    assert of[4][0]["n_removed"] == of[4][0]["n_bytes"] - period
    assert dedup_byte_windows(no_docs, cells=1 << 16).count() == 0


def test_simhash(spark, edge_docs, no_docs):
    out = simhash_groups(edge_docs).collect()
    assert len(out) == 13
    component = {r["doc_id"]: r["component_id"] for r in out}
    assert {component[i] for i in (1, 2, 3)} == {1}
    assert component[5] == component[6] == component[None] == 5
    assert all(len(r["fingerprint"]) == 16 for r in out)
    assert simhash_groups(no_docs).count() == 0


def test_decontaminate(spark, edge_docs, no_docs):
    bench = items(spark, [(1, " ".join(f"copied{i}" for i in range(20, 40))), (1, "naive cafe"), (2, "Café déjà"),
                          (3, None), (None, "x"), (4, ""), (5, "word5 WORD6!")])
    out = {r["document"]["doc_id"]: r for r in benchmark_overlap(edge_docs, bench).collect()}
    assert out[6]["n_hit"] == 20 and out[6]["items"] == ["1"] and [tuple(s) for s in out[6]["spans"]] == [(20, 40)]
    assert out[9]["items"] == ["2"] and out[9]["n_hit"] == 2
    assert out[11]["n_hit"] == 0                      # an item without an id takes no part
    assert out[4]["items"] == ["5"] and out[4]["n_hit"] == 2 * 30 + 2 * (30_000 % 997 > 6)
    assert out[1]["n_words"] == 0 and len(out) == 12
    assert "domain" in out[6]["document"].asDict()    # extra columns come along
    assert benchmark_overlap(edge_docs, items(spark, [])).agg(F.sum("n_hit")).first()[0] == 0
    assert benchmark_overlap(no_docs, bench).count() == 0


def test_decontaminate_in_blocks(spark, edge_docs, monkeypatch):
    import sentimart.llm.decontaminate as D
    bench = items(spark, [(i, " ".join(f"copied{j}" for j in range(i, i + 12))) for i in range(0, 100, 5)])
    whole = [r.asDict(True) for r in D.benchmark_overlap(edge_docs, bench).orderBy("document.doc_id").collect()]
    monkeypatch.setattr(D, "BLOCK_BYTES", 1_000)
    assert [r.asDict(True) for r in D.benchmark_overlap(edge_docs, bench).orderBy("document.doc_id").collect()] == whole


def test_lines(spark, edge_docs, no_docs):
    out = dedup_lines(edge_docs, cells=1 << 16).collect()
    assert len(out) == 13
    of = {}
    for r in out:
        of.setdefault(r["document"]["doc_id"], []).append(r)
    assert [r["n_removed"] for r in of[5]] == [0, 0]
    assert of[6][0]["n_removed"] == 2 and of[6][0]["kept_text"] == ""
    assert of[7][0]["n_removed"] == 1 and of[7][0]["kept_text"].endswith("copied. more")
    assert of[None][0]["n_removed"] == 0 and of[1][0]["kept_text"] == "" and of[3][0]["kept_text"] == " \n\t "
    assert dedup_lines(no_docs, cells=1 << 16).count() == 0


def test_short_lines_go_as_exact_repeats(spark):
    docs = spark.createDataFrame([(1, "Yes\nYet\n\nPage 1"), (2, "Yes\nPage 2\n\n Yes "), (3, "")], "doc_id long, text string")
    got = {r["document"]["doc_id"]: (r["n_lines"], r["n_removed"], r["kept_text"])
           for r in dedup_lines(docs, cells=1 << 16, min_exact=1).collect()}
    assert got == {1: (4, 0, "Yes\nYet\n\nPage 1"), 2: (4, 2, "Page 2\n"), 3: (1, 0, "")}


def test_line_variants_are_not_broadcast(spark, tmp_path):
    """a line has as many as characters, but the planner takes them to
    be smaller than the lines; the later of two lines is near, whatever
    their hashes are."""
    line = "a line of more than twenty characters"
    for low, high in ((-5, 7), (7, -5)):
        spark.createDataFrame(
            [(low, 1, (2, 8, 0), line), (high, 0, (2, 8, 1), line + "!"), (low, 2, (1, 8, 0), line[::-1]), (3, 3, (0, 8, 0), None)],
            "h1 long, h2 long, first struct<doc_id:long,text_key:long,line_no:long>, line string").write.parquet(f"{tmp_path}/{low}")
        near = _near(spark.read.parquet(f"{tmp_path}/{low}"))          # files have a size for the planner
        assert "Broadcast" not in near._jdf.queryExecution().executedPlan().toString()
        assert [tuple(r) for r in near.collect()] == [(high, 0)]


def test_toxicity(spark, edge_docs, no_docs):
    marks = labels(spark, [(2, 1), (2, 0), (99, 1), (3, None), (None, 1)])
    out = score_toxicity(edge_docs, marks).collect()
    assert len(out) == 13 and all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in out)
    assert {r["document"]["doc_id"] for r in out if r["document"]["text"] is None} == {1}
    assert score_toxicity(edge_docs, labels(spark, [])).count() == 13
    assert score_toxicity(no_docs, marks).count() == 0


def test_toxicity_sample_is_bounded(spark, monkeypatch):
    import numpy as np
    from sentimart.llm import toxicity as X
    seen = []
    monkeypatch.setattr(X, "_fitted", lambda prior: lambda sample: (__import__("pyarrow").table(
        {"weights": __import__("pyarrow").array([np.zeros(X.FEATURES, np.float32).tobytes()], __import__("pyarrow").binary()),
         "bias": [float(sample.num_rows)]})))
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(2, "same")] * 500 + [(i, "x") for i in range(3, 40)],
                                 "doc_id long, text string")
    marks = labels(spark, [(1, 1), (2, 1), (3, 0)])
    seen.append(X.learn(docs, marks, F.lit(True), max_positive=10, max_unlabelled=20).bias)
    assert seen[0] == 10 + 20


def test_language(spark, edge_docs, no_docs):
    out = identify_language(edge_docs).collect()
    assert len(out) == 13
    of = {r["document"]["doc_id"]: r for r in out}
    for i in (1, 2, 3, 8):
        assert (of[i]["lang_pred"], of[i]["score"]) == ("und", 0.0)
    assert {of[i]["lang_pred"] for i in (4, 5, 9)} <= {"en", "fr", "de", "es"}
    assert identify_language(no_docs).count() == 0
    nothing = edge_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in identify_language(nothing).collect()} == {"und"}


def test_mixing(spark, edge_docs, no_docs):
    domain = F.when(F.col("source") == "src0", "a").otherwise("b")
    out = mix(edge_docs, domain, {"domain": {"a": 1, "b": 3}}, fraction=1.0, max_epochs=2).collect()
    assert all(r["n_tokens"] > 0 and r["doc_id"] is not None and 1 <= r["epoch"] <= 2 for r in out)
    assert {r["source"] for r in out if r["doc_id"] == 7} <= {"unknown"}
    assert mix(no_docs, domain, {}).count() == 0


def test_mixing_of_one_id_in_two_leaves(spark):
    rows = [(1, "a b c", "en", "src0"), (1, "d e", "fr", "src1"), (2, "f", "en", "src0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("at", F.col("text"))
    domain = F.when(F.col("source") == "src0", "a").otherwise("b")
    out = mix(docs, domain, {"domain": {"a": 1, "b": 0}}, fraction=1.0, keep=["at"]).collect()
    assert {(r["doc_id"], r["at"], r["domain"]) for r in out} == {(1, "a b c", "a"), (2, "f", "a")}


def test_mixing_without_weight(spark):
    rows = [(i, "w " * 10, lang, "src0") for i, lang in enumerate(["en"] * 10 + ["fr"] * 10)]
    rows += [(i, "w " * 10, "en", "src1") for i in range(20, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    domain = F.when(F.col("source") == "src0", "a").otherwise("b")
    out = mix(docs, domain, {"domain": {"a": 1, "b": 1}, "lang": {"fr": 0}}, fraction=0.5, max_epochs=1)
    # of 300 tokens a can give 100 in English, so b gives the other 200
    got = {r["domain"]: r["n"] for r in out.groupBy("domain").agg(F.sum("n_tokens").alias("n")).collect()}
    assert got == {"a": 100, "b": 200} and out.filter("lang = 'fr'").count() == 0


def test_top_k(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, -9.0]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]),
            (6, [float("inf"), 1.0]), (7, [0.5, 0.5]), (7, [0.5, 0.5]), (None, [1.0, 1.0]), (50, [0.0, 0.0]), (100, [1.0]),
            (150, [])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("low", F.lit("x"))
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in top_k(vectors, F.col("vec_id") % 50 == 0, k=3).collect()}
    half = 256 * 128
    assert got[0, 1] == (1, half) and got[0, 2] == (2, half) and got[0, 3] == (7, half)
    assert [got[50, i][0] for i in (1, 2, 3)] == [0, 1, 2]
    assert {q for q, _ in got} == {0, 50}          # nothing else has the dimension of 100 and 150
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_k(empty, F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("parts", [1, 3, 8, 211])
def test_top_k_repeated_queries(spark, parts):
    rows = [(0, None), (0, [0.0, 1.0]), (0, [1.0, 0.0]), (0, [float("nan"), 0.0]), (0, [0.0, 1.0]), (1, [2.0, 0.0]), (2, [0.0, 3.0]),
            (50, None), (None, [9.0, 9.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(parts)
    got = sorted(tuple(r) for r in top_k(vectors, F.col("vec_id") % 50 == 0).collect())
    assert got == [(0, 1, 2, 3 * 256 * 256), (0, 2, 1, 0)]          # the smallest vector of 0 that takes part


@pytest.mark.parametrize("slots", [8, 200])
def test_candidate_blocks_are_spread(spark, slots):
    from sentimart.llm import topk as K
    blocks = spark.range(0, 400 * 64, 1, 400).selectExpr("id as vec_id", "array(cast(id as double)) as embedding")
    slot = F.pmod(F.xxhash64("ids"), F.lit(slots))
    n = blocks.mapInArrow(K._pack(64), K._BLOCK_SQL).groupBy(slot.alias("slot")).count().collect()
    assert len(n) > 0.6 * min(slots, 400) and max(r["count"] for r in n) < 400 / slots * 2 + 6


@pytest.mark.parametrize("copies", [3, 5, 9])
def test_top_k_repeated_best(spark, copies):
    rows = [(0, [1.0, 0.0]), *[(9, [2.0, 0.0])] * copies, (3, [1.0, 1.0]), (4, [0.5, 0.0]), (5, [0.25, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got = [(r["rank"], r["vec_id"], r["score"]) for r in
           top_k(vectors, F.col("vec_id") == 0).orderBy("rank").collect()]
    scores = sorted([(-2 * 256 * 256, 9)] * copies + [(-256 * 256, 3), (-128 * 256, 4), (-64 * 256, 5)])
    assert got == [(i, v, -s) for i, (s, v) in enumerate(scores[:5], 1)]


@pytest.mark.parametrize("url,host,path,rule,verdict", [
    (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("no scheme", "", "", None, "allow"),
    ("http://Example.ORG/es/x?q=/es/", "example.org", "/es/x", "example.org/es/", "block"),
    ("http://a.example.org/en/10#x", "a.example.org", "/en/10", "example.org/en/1", "block"),
    ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    ("http://x.com/de/", "x.com", "/de/", "com/de/", "block"), ("http://x.com/DE/", "x.com", "/DE/", None, "allow"),
    ("http://x.net/a.com/de/", "x.net", "/a.com/de/", None, "allow"), ("http://x.org?a://b.com/de/", "x.org", "", None, "allow"),
    ("http://org/", "org", "/", "org/", "allow"), ("http://my-spam.net", "my-spam.net", "", None, "block"),
    ("://h/" + "y" * 50_000 + ".exe", "h", "/" + "y" * 50_000 + ".exe", None, "block"),
])
def test_urls(spark, url, host, path, rule, verdict):
    pages = spark.createDataFrame([(1, url, "x"), (1, url, "x")], "page_id long, url string, rule string")
    got = [(r["host"], r["path"], r["rule"], r["verdict"]) for r in filter_urls(pages).collect()]
    assert got == [(host, path, rule, verdict)] * 2
    assert filter_urls(pages.limit(0)).count() == 0


def folders(spark):
    import os
    from sentimart.session import shared_dir
    return set(os.listdir(shared_dir(spark).removeprefix("file:")))


def test_intermediates_are_removed(spark, edge_docs):
    from sentimart.llm.common import intermediates, stored
    before = folders(spark)
    with intermediates(spark):
        stored(spark.range(3), "gone")
        with intermediates(spark):
            stored(spark.range(3), "gone")
            inner = stored(spark.range(3), "inner", keep=True)
        outer = stored(inner.selectExpr("id + 1 as id"), "outer", keep=True)
    assert {f.split("-")[0] for f in folders(spark) - before} == {"outer"} and outer.count() == 3
    before = folders(spark)
    with pytest.raises(ZeroDivisionError), intermediates(spark):
        stored(spark.range(3), "lost", keep=True)
        1 / 0
    assert folders(spark) == before
    marks = spark.createDataFrame([(4, 1, 0), (5, 0, 1)], "doc_id long, quality int, toxic int")
    vectors = spark.createDataFrame([(i, [float(i)]) for i in range(60)], "vec_id long, embedding array<float>")
    bench = items(spark, [(1, "copied1 copied2")])
    from sentimart.llm.lexical import rank_documents
    from sentimart.llm.quality import score_quality
    for run, kept in ((lambda: dedup_word_windows(edge_docs, cells=1 << 16), {"parts"}),
                      (lambda: dedup_byte_windows(edge_docs, cells=1 << 16), {"parts"}),
                      (lambda: dedup_lines(edge_docs, cells=1 << 16), {"removed"}),
                      (lambda: simhash_groups(edge_docs), {"fingerprints", "labels"}),
                      (lambda: top_k(vectors, F.col("vec_id") % 50 == 0), {"best"}),
                      (lambda: score_toxicity(edge_docs, marks), set()), (lambda: score_quality(edge_docs, marks), set()),
                      (lambda: benchmark_overlap(edge_docs, bench), set()), (lambda: rank_documents(edge_docs, bench), {"ranked"})):
        before = folders(spark)
        out = run()
        assert {f.split("-")[0] for f in folders(spark) - before} == kept
        out.collect()                                  # nothing that was removed is read


def test_too_many_languages_are_an_error(spark, monkeypatch):
    from sentimart.llm import language_id as L
    monkeypatch.setattr(L, "MAX_LANGUAGES", 3)
    docs = spark.createDataFrame([(i, "abc", f"l{i}") for i in range(9)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError):
        identify_language(docs)
