"""Sinks and load guards: K6, K7, K8, S10, materialize."""

import pytest
from pyspark.errors import AnalysisException

from sentimart.session import scratch_path
from sentimart.sinks.files import materialize, publish_table, write_if_nonempty
from sentimart.sources.files import LoadError, require_nonempty


def test_write_if_nonempty(spark):
    empty = spark.range(0)
    p = scratch_path(spark, "k6")
    assert write_if_nonempty(empty, p) is False
    assert write_if_nonempty(spark.range(3), p) is True
    assert spark.read.option("header", "true").csv(p).count() == 3


def test_publish_replace_and_create_only(spark):
    loc = scratch_path(spark, "tbl")
    t = publish_table(spark.range(5), "k7_table", loc)
    assert t.count() == 5
    t = publish_table(spark.range(2), "k7_table", loc)          # create or replace
    assert t.count() == 2
    with pytest.raises(AnalysisException):
        publish_table(spark.range(1), "k7_table", loc, mode="errorifexists")   # K8


def rows(spark, name):
    return sorted(r[0] for r in spark.table(name).collect())


@pytest.mark.parametrize("buckets", [None, (3, ["id"])])
def test_failed_replace_leaves_the_table(spark, buckets):
    from pyspark.sql import functions as F
    loc, name = scratch_path(spark, "tbl"), f"k7_atomic_{'b' if buckets else 'p'}"
    publish_table(spark.range(5), name, loc, bucket_by=buckets)
    reader = spark.table(name)                                     # planned before the replacements
    broken = spark.range(9).withColumn("id", F.when(F.col("id") > 6, F.raise_error(F.lit("broken"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="broken"):
        publish_table(broken.select(F.col("id").cast("long")), name, loc, bucket_by=buckets)
    assert rows(spark, name) == list(range(5))
    publish_table(spark.range(3), name, loc, bucket_by=buckets)
    assert rows(spark, name) == [0, 1, 2]
    assert reader.count() in (3, 5)                                # one version or the other, never none
    publish_table(spark.range(7), name, loc, bucket_by=buckets)
    from sentimart.sinks.files import _versions
    assert rows(spark, name) == list(range(7)) and len(_versions(spark, loc)) == 2
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(name)] == [name]
    publish_table(spark.range(2).withColumn("more", F.lit("x")), name, loc)      # other columns
    assert spark.table(name).columns == ["id", "more"] and rows(spark, name) == [0, 1]


def test_create_only_loses_to_an_earlier_create(spark, monkeypatch):
    import sentimart.sinks.files as S
    loc = scratch_path(spark, "tbl")
    publish_table(spark.range(5), "k8_race", loc)
    # the name is taken after the check: the rename finds out
    monkeypatch.setattr(type(spark.catalog), "tableExists", lambda self, name: False)
    with pytest.raises(AnalysisException):
        S.publish_table(spark.range(2), "k8_race", loc, mode="errorifexists")
    monkeypatch.undo()
    assert rows(spark, "k8_race") == list(range(5)) and len(S._versions(spark, loc)) == 1


def test_single_file(spark):
    from sentimart.sinks.files import write_csv
    p = scratch_path(spark, "k5")
    write_csv(spark.range(0, 100, 1, 8).selectExpr("id", "'a\nb' as text"), p, single_file=True)       # K5
    back = spark.read.option("header", "true").option("multiLine", "true").csv(p)
    assert len(back.inputFiles()) == 1 and back.count() == 100


def test_require_nonempty(spark):
    with pytest.raises(LoadError):
        require_nonempty(spark.range(0))
    assert require_nonempty(spark.range(1)).count() == 1


def test_materialize_cuts_lineage(spark):
    df = spark.range(10).selectExpr("id * 2 AS x")
    m = materialize(df)
    assert sorted(r.x for r in m.collect()) == list(range(0, 20, 2))
    assert "Range" not in m._jdf.queryExecution().executedPlan().toString()


def test_recommended_conf_scales_with_input():
    from sentimart.session import recommended_conf
    small = recommended_conf(10 << 30, 64)
    big = recommended_conf(100 << 40, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 128          # 2 per core
    assert int(big["spark.sql.shuffle.partitions"]) == 200_000          # capped
    assert int(recommended_conf(10 << 40, 8000)["spark.sql.shuffle.partitions"]) == 40960


def test_bucketed_table_has_one_file_per_bucket(spark):
    df = spark.range(0, 10000, 1, numPartitions=8).selectExpr("cast(id as string) AS videoid", "id")
    t = publish_table(df, "bucket_files_test", scratch_path(spark, "b"), bucket_by=(4, ["videoid"]))
    assert len(t.inputFiles()) == 4 and t.count() == 10000
