"""Paged acquisition: spans planned from the index, quotas, resumption."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import In

from sentimart.session import scratch_path
from sentimart.sources.pages import PLACE, FilteringPageReader, PageReader, landed_pages, paged_fetch, store_pages


def items(spark):
    # one entity holds most rows; repeated rows and NULLs
    rows = [("hot", i, f"h{i}") for i in range(400)] + [(f"e{i % 30}", i, None) for i in range(90)]
    return spark.createDataFrame(rows + [("e1", 1, None), (None, 5, "lost")], "entity_id string, n long, text string")


@pytest.fixture(scope="module")
def store(spark):
    path = scratch_path(spark, "pages")
    store_pages(items(spark), "entity_id", [F.col("n"), F.col("text")], path, page_size=5, span_pages=4)
    return path


def rows(df):
    return sorted(tuple(r) for r in df.select("entity", "page", "ordinal", "n").collect())


def test_every_item_once_in_order(spark, store):
    got = paged_fetch(spark, store)
    assert got.count() == 491 and got.where("entity = 'hot' and n <> ordinal").count() == 0
    assert got.where("page <> floor(ordinal / 5)").count() == 0
    last = got.groupBy("entity").agg(F.max("page").alias("p"), F.max(F.col("next_token").cast("long")).alias("t"))
    assert last.where("p > 0 and t <> p").count() == 0 and last.where("p = 0 and t is not null").count() == 0


def test_a_hot_entity_is_read_by_many_tasks(spark, store):
    tasks = paged_fetch(spark, store).where("entity = 'hot'").select(F.spark_partition_id().alias("t")).distinct().count()
    assert tasks >= 20          # 80 pages, 4 a span
    per_span = paged_fetch(spark, store).groupBy("span").agg(F.countDistinct("entity", "page").alias("n"))
    assert per_span.agg(F.max("n")).first()[0] <= 4


def test_bounded_runs_resume_behind_what_landed(spark, store):
    whole, got, landed, runs = rows(paged_fetch(spark, store)), None, None, 0
    while True:
        more = paged_fetch(spark, store, pages_per_task=1, landed=landed)
        out = scratch_path(spark, "landed-rows")
        more.write.parquet(out)
        more = spark.read.parquet(out)
        if more.isEmpty():
            break
        runs += 1
        assert more.groupBy("span").agg(F.countDistinct("at").alias("n")).where("n > 1").isEmpty()
        got = more if got is None else got.unionByName(more)
        landed = landed_pages(got, scratch_path(spark, "landed"))
    assert runs == 4 and rows(got) == whole


def test_filters_choose_spans_by_the_index(spark, store):
    whole = paged_fetch(spark, store)
    some = whole.where(F.col("entity").isin("e3", "e4", "absent"))
    assert rows(some) == [r for r in rows(whole) if r[0] in ("e3", "e4")]
    reader = FilteringPageReader({"path": store}, PLACE)
    assert len(list(reader.pushFilters([In(("entity",), ("e3", "e4"))]))) == 1
    assert 0 < len(reader.partitions()) <= len(PageReader({"path": store}, PLACE).partitions()) / 5
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")
    try:
        assert rows(paged_fetch(spark, store).where("entity = 'e3'")) == [r for r in rows(whole) if r[0] == "e3"]
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def test_empty_store(spark):
    path = scratch_path(spark, "pages")
    store_pages(items(spark).limit(0), "entity_id", [F.col("n")], path)
    assert paged_fetch(spark, path).count() == 0
