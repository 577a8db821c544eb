"""The corpus pipeline: every stage's decisions, on the stage's own input."""

import random

import pytest
from test_brute_force import edits

import corpus_pipeline as P
from sentimart.llm.common import stored
from sentimart.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_take_effect(spark, duck):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    ids = {r[0] for r in docs.select("doc_id").collect()}
    for i, (name, stage) in enumerate(P.STAGES):
        before, docs = docs, stored(stage(spark, docs, SF), name)
        left = {r[0] for r in docs.select("doc_id").collect()}
        assert left <= ids
        ids = left
        if i < len(P.STAGES) - 1:
            assert docs.columns == columns and docs.count() == len(left)
        if name == "decontaminate":
            hit = "SELECT doc_id FROM (%s) WHERE contaminated"
            from sentimart.llm.queries import ORACLE
            dirty = {r[0] for r in duck.execute(hit % ORACLE["op3_decontaminate"]).fetchall()}
            untouched = {r[0] for r in before.join(spark.read.parquet(f"{SF}/documents.parquet"), ["doc_id", "text"])
                         .select("doc_id").collect()}
            assert not left & dirty & untouched and (untouched - dirty) <= left
    assert set(docs.columns) == {*columns, "domain", "epoch"}
    assert docs.count() > 0


def test_run_equals_the_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in P.STAGES:
        docs = stored(stage(spark, docs, SF), "stage")
    want = sorted((r["doc_id"], r["epoch"], r["text"]) for r in docs.collect())
    assert sorted((r["doc_id"], r["epoch"], r["text"]) for r in QUERIES["pipeline"](spark, SF).collect()) == want


def test_edges(spark, edge_docs, no_docs):
    for _, stage in P.STAGES[:4]:
        out = stage(spark, edge_docs, SF)
        assert out.columns == edge_docs.columns and 0 < out.count() <= 13
        assert stage(spark, no_docs, SF).count() == 0
    kept = [r["doc_id"] for r in P.near_duplicates(spark, edge_docs, SF).collect()]
    assert kept.count(5) == 1 and 6 not in kept and kept.count(None) == 1 and 2 not in kept
    lines = {r["doc_id"] for r in P.line_dedup(spark, edge_docs, SF).collect()}
    assert {1, 2, 3, 5} <= lines and 6 not in lines
    mixed = P.mixing(spark, edge_docs, SF)
    assert mixed.filter("doc_id is null").count() == 0
    assert P.mixing(spark, no_docs, SF).count() == 0


def test_short_lines_go_as_exact_repeats(spark):
    long = "a line of more than twenty characters"
    texts = {1: f"Menu\n{long}\nYes\nx\n\n", 2: f" Menu\t\nYet\nx\n{long}!\n\nnew", 3: "Menu\nx", 4: "Menu 1\nMenu 2\nMenu 1"}
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in texts.items()], DOCUMENTS)
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in P.line_dedup(spark, docs, SF).collect()}
    want = {1: texts[1], 2: "Yet\n\nnew", 4: "Menu 1\nMenu 2"}
    assert got == {i: (t, len(t)) for i, t in want.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_line_stage_by_brute_force(spark, seed):
    rng = random.Random(seed)
    pool = ["".join(rng.choices("abé ", k=rng.choice((1, 2, 3, 19, 20, 21)))).strip() for _ in range(40)]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(1, 6)))) for i in range(60)]
    exact, near, want = set(), [], {}
    for doc, text in rows:
        kept = []
        for line in text.split("\n"):
            if line in exact or len(line) >= 20 and any(edits(line, other) <= 1 for other in near):
                gone = True
            else:
                gone = False
                kept.append(line)
            if line:
                exact.add(line)
                near += [line] if len(line) >= 20 else []
        if "".join(kept) or "\n".join(kept) == text:
            want[doc] = "\n".join(kept)
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in rows], DOCUMENTS)
    assert {r["doc_id"]: r["text"] for r in P.line_dedup(spark, docs, SF).collect()} == want and len(want) < 60


def test_near_duplicates_under_one_id(spark):
    clean, other = (" ".join(f"{w}{i}" for i in range(300)) for w in ("clean", "other"))
    rows = [(1, other, "en"), (5, clean, "en"), (5, other, "en"),           # one of 5 is a copy of 1
            (7, "seven one", "en"), (7, "quite another text", "fr"),        # both are clean
            (8, "folded", "en"), (8, "folded", "en"), (8, "kept beside it", "de"),
            (9, " seven   ONE", "en"), (3, "Order of groups", "en"), (3, "order of  groups", "en")]
    docs = spark.createDataFrame([(i, t, lang, "src0", len(t)) for i, t, lang in rows], DOCUMENTS)
    got = sorted((r["doc_id"], r["text"]) for r in P.near_duplicates(spark, docs, SF).collect())
    assert len([t for i, t in got if i == 3]) == 1
    assert [x for x in got if x[0] != 3] == sorted([
        (1, other), (5, clean), (7, "seven one"), (7, "quite another text"), (8, "folded"), (8, "kept beside it")])
    again = docs.orderBy("text").repartition(7)
    assert sorted((r["doc_id"], r["text"]) for r in P.near_duplicates(spark, again, SF).collect()) == got
