"""What one task reads, sorts or writes does not grow with the table."""

import glob
import re

import pytest
from pyspark.sql import functions as F

from sentimart.operators.classify import picky_classifier
from sentimart.operators.leases import lease_report, store_leased
from sentimart.plans import comments as C
from sentimart.queries import io_q
from sentimart.schemas import COMMENT_THREAD, with_field
from sentimart.session import open_files, scratch_path
from sentimart.sinks import files as sinks
from sentimart.sources.files import load_csv_table, scan_csv, source_label

KEY = "spark.sql.maxConcurrentOutputFileWriters"


@pytest.fixture
def lines(spark, tmp_path):
    """A ``lineitem`` of 400 rows over 60 parts, some keys null."""
    spark.range(400).selectExpr(
        "id + 1 AS l_orderkey", "CAST(id % 7 AS INT) AS l_linenumber", "IF(id % 91 = 5, NULL, id % 60) AS l_partkey",
        "id % 11 AS l_suppkey", "element_at(array('A', 'N', 'R'), CAST(id % 3 + 1 AS INT)) AS l_returnflag",
        "IF(id % 2 = 0, 'O', 'F') AS l_linestatus", "CAST(id % 50 AS DOUBLE) AS l_quantity",
        "timestamp_seconds(id * 86400) AS l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


OLD = (r"[^/=]+=([^/]+)/[^/]*$", r"([^/]+?)(\.[^./]*)?$")


def test_label_is_that_of_the_whole_path(spark):
    """the patterns see the last names only, with the same label;
    over whole paths they took some 90 microseconds a row."""
    paths = ["file:/a/source=x_1/part-0.parquet", "/a/k=1/source=b=c/p.x", "/a/=x/p.y", "/a/x=/p.y", "/a/==q/p", "s=1/p.csv",
             "s=1", "p.tar.gz", "/flat/a_10.parquet", "/flat/.hidden", "/flat/", "", None, "/s=1/sub/p.c", "/a/x==y/p", "/a/a.b/c."]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    part = F.regexp_extract("p", OLD[0], 1)
    want = F.when(part != "", part).otherwise(F.regexp_extract("p", OLD[1], 1))
    for r in df.select("p", want.alias("want"), source_label("p").alias("got")).collect():
        assert r.got == r.want, r.p
    plan = df.select(source_label("p").alias("l"))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract(p#" not in plan


def test_open_files_ends_with_the_block(spark):
    assert spark.conf.get(KEY, None) in (None, "0")
    with pytest.raises(ZeroDivisionError), open_files(spark, 3):
        assert spark.conf.get(KEY) == "3"
        1 / 0
    assert spark.conf.get(KEY, None) in (None, "0")


def test_csv_files_are_bounded(spark, tmp_path, monkeypatch):
    """a multi-line CSV file is one task's."""
    monkeypatch.setattr(sinks, "RECORDS_PER_FILE", 10)
    path = str(tmp_path / "csv")
    sinks.write_csv(spark.range(0, 95, 1, 1).selectExpr("id", "'a\nb' AS text"), path)
    assert len(glob.glob(f"{path}/*.csv")) == 10
    assert scan_csv(spark, path, spark.range(1).selectExpr("id", "'' AS text").schema).count() == 95


def test_staged_lines_are_bounded(spark, lines, monkeypatch):
    monkeypatch.setattr(io_q, "RECORDS_PER_FILE", 50)
    path = io_q._stage_lines(spark, lines, with_bad=True)
    assert len(glob.glob(f"{path.removeprefix('file:')}/*.csv")) >= 8


def test_load_routes_without_a_sort(spark, tmp_path):
    """two open files a task, no sort of its rows by kind."""
    (tmp_path / "a.csv").write_text("id,text\n1,a\nx,b\n3,c\n")
    seen = []
    schema = spark.range(1).selectExpr("id", "'' AS text").schema
    with _written(seen):
        good, bad = load_csv_table(spark, str(tmp_path), schema, glob="a.csv")
    assert (good.count(), bad.count()) == (2, 1)
    assert seen == ["2"]


class _written:
    """The setting at the writes made below it."""

    def __init__(self, seen):
        self.seen = seen

    def __enter__(self):
        from pyspark.sql import DataFrameWriter
        self.kept = DataFrameWriter.parquet

        def parquet(w, *a, **kw):
            self.seen.append(w._spark.conf.get(KEY, "0"))
            return self.kept(w, *a, **kw)
        DataFrameWriter.parquet = parquet

    def __exit__(self, *_):
        from pyspark.sql import DataFrameWriter
        DataFrameWriter.parquet = self.kept


def test_threads_move_as_few_columns(spark, lines, monkeypatch):
    """What is shuffled are the table's columns."""
    moved = []
    kept = sinks.write_parquet_partitioned

    def write(df, path, by, **kw):
        moved.append(df.columns)
        return kept(df, path, by, **kw)
    monkeypatch.setattr(io_q, "write_parquet_partitioned", write)
    back = spark.read.schema(with_field(COMMENT_THREAD, "source")).parquet(io_q.stage_threads(spark, lines, fresh=True))
    assert moved and "snippet" not in moved[0]
    got = back.select("id", "snippet.videoId", "source").collect()
    assert len(got) == 400 and all(r.source == (f"comments_{int(r.videoId) % 300}" if r.videoId else None) for r in got)


def test_first_pass_rows_are_not_shuffled_again(spark, lines, monkeypatch):
    """Rows come by source, the processed files are compressed,
    and all rows are there."""
    asked = []
    kept = C.write_csv
    monkeypatch.setattr(C, "write_csv", lambda *a, **kw: (asked.append(kw.get("clustered")), kept(*a, **kw)))
    threads, out = io_q.stage_threads(spark, lines, fresh=True), scratch_path(spark, "growth")
    C.first_pass(spark, threads, out, run_id="first", classifier=picky_classifier, sleep=lambda s: None)
    C.first_pass(spark, threads, scratch_path(spark, "growth"), run_id="second", classifier=picky_classifier, sleep=lambda s: None, parallelism=3)
    assert asked == [True, False]
    files = glob.glob(f"{out.removeprefix('file:')}/{C.PROCESSED}/**/*.csv*", recursive=True)
    assert [f for f in files if f.endswith(".csv.gz")]
    want = spark.read.parquet(f"{lines}/lineitem.parquet").where("l_orderkey % 23 <> 0")
    failed = want.where("l_returnflag = 'N' AND l_linestatus = 'O' OR l_partkey IS NULL").count()      # no text without a part
    assert C.processed_comments(spark, out).count() == want.count() - failed
    assert C.failed_comments(spark, out).count() == failed


def test_located_files_hold_one_source_a_task(spark, lines):
    """one file a source, its header first, one source a task."""
    path = io_q._stage_located(spark, lines).removeprefix("file:")
    files = glob.glob(f"{path}/source=*/*.txt")
    sources = [f.split("source=")[1].split("/")[0] for f in files]
    assert len(sources) == len(set(sources)) == 46        # no video ends with 0; one of null keys
    assert all(open(f).readline().startswith("commentid,videoid") for f in files)
    tasks = [re.search(r"part-(\d+)", f).group(1) for f, s in zip(files, sources) if not s.startswith("__")]
    assert len(set(tasks)) == 45


def test_keys_take_turns(spark):
    """a key's task has a bounded text, all rows get a label and
    the calls keep apart over turns."""
    df = spark.range(0, 400, 1, 3).selectExpr("CAST(id AS STRING) AS commentid", "IF(id % 50 = 7, NULL, concat('great ', id)) AS textoriginal")
    rows = store_leased(df, [picky_classifier] * 2, rate=200.0, burst=2, text_per_turn=700).cache()
    assert rows.select("commentid").distinct().count() == rows.count() == 400
    assert rows.where("textoriginal IS NOT NULL AND emotion <> 'admiration'").isEmpty()
    turns = rows.where("call IS NOT NULL").groupBy((F.col("call.slice") / 2 ** 32).cast("int").alias("turn"), "call.lease").agg(
        F.sum(F.octet_length("textoriginal")).alias("size")).collect()
    assert len({r.turn for r in turns}) == 3 and max(r["size"] for r in turns) < 1000
    assert {(r.lease, r.n_overlapping, r.n_over_rate) for r in lease_report(rows, 200.0, burst=2).collect()} == {(0, 0, 0), (1, 0, 0)}
